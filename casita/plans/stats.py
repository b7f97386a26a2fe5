"""Grouped statistics, counts and profiles over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casita.operators.aggregate import bedrooms_bucket, price_summary, ratio
from casita.operators.dedup import zone_rollup
from casita.operators.profile import column_profile, missing_report, mode_or_varies, value_counts
from casita.sources.tables import table

def rounded(df: DataFrame) -> DataFrame:
    """Doubles at a fixed number of digits, so that results of two engines can be held against each other."""
    return df.select(*[F.round(c, 4 if c.endswith("_std") or "_std_" in c else 6).alias(c) if t == "double" else c for c, t in df.dtypes])


KEYS = ["n_name", "c_mktsegment", "year_month", "l_returnflag"]


def a1_price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: line prices by nation, segment, month and return flag."""
    item = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = item.join(order, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rounded(price_summary(rows, KEYS, F.col("l_extendedprice")))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    item = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity", "l_linenumber", "l_shipdate", "l_returnflag")
    return item.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn("year_month", F.date_format("l_shipdate", "yyyy-MM"))


def a2_price_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year, price and price per quantity by brand and month."""
    price, n = F.col("l_extendedprice"), F.col("l_quantity")
    return rounded(price_summary(_items(spark, sf_dir).where(F.col("year_month").startswith("1995-")), ["p_brand", "year_month"], price, ratios={"price_per_m2": ratio(price, n)}, require=n > 0))


def a3_flexible_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ratios that may be null."""
    price, size = F.col("l_extendedprice"), F.col("p_size")
    return rounded(price_summary(_items(spark, sf_dir), ["p_brand", "l_returnflag"], price, ratios={"price_per_m2": ratio(price, size - 25), "beds_per_area": ratio(F.col("l_linenumber"), size - 10)}))


def a4_by_bedrooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a bucket of counts."""
    rows = _items(spark, sf_dir).withColumn("bedrooms_norm", bedrooms_bucket(F.col("l_linenumber") - 1))
    return rounded(price_summary(rows, ["p_brand", "bedrooms_norm"], F.col("l_extendedprice"), min_n=20, ratios={"price_per_bed": ratio(F.col("l_extendedprice"), F.col("l_linenumber") - 1)}))


def a5_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


def a7_missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.nullif("lang", F.lit("en")).alias("lang"), F.when(F.col("n_chars") > 500, F.col("source")).alias("source"), "text")
    return missing_report(rows, ["lang", "source", "text"])


def a8_zone_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_rollup(table(spark, sf_dir, "nation"), "n_regionkey", "n_name")


def a9_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


def a10_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return mode_or_varies(rows, ["year", "o_orderstatus"], "o_orderpriority", 0.205)


def queries() -> dict:
    return {f.__name__: f for f in (a1_price_stats, a2_price_per_unit, a3_flexible_ratios, a4_by_bedrooms, a5_value_counts, a7_missing_report, a8_zone_rollup, a9_column_profile, a10_mode)}


def _block(value: str, name: str, suffix: str = "") -> str:
    return ", ".join(f"round({f}({value}), {4 if k == 'std' else 6}) AS {name}_{k}{suffix}" for k, f in (("min", "min"), ("max", "max"), ("avg", "avg"), ("median", "median"), ("std", "stddev_samp")))


_PRICE = _block("l_extendedprice", "price", "_usd")
_ITEMS = "(SELECT *, strftime(l_shipdate, '%Y-%m') AS year_month FROM lineitem JOIN part ON l_partkey = p_partkey)"


def oracle_sql() -> dict[str, str]:
    profile = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) FILTER (WHERE {c} IS NULL OR trim({c}::VARCHAR) = '') AS missing, count(DISTINCT {c}) AS n_unique, count(DISTINCT {c}) > 1 AS varies FROM customer"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    )
    return {
        "a1_price_stats": f"""
            SELECT n_name, c_mktsegment, strftime(o_orderdate, '%Y-%m') AS year_month, l_returnflag, {_PRICE}, count(*) AS qty
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5""",
        "a2_price_per_unit": f"""
            SELECT p_brand, year_month, {_PRICE}, {_block("l_extendedprice / l_quantity", "price_per_m2")}, count(*) AS qty
            FROM {_ITEMS} WHERE year_month LIKE '1995-%' AND l_quantity > 0 GROUP BY 1, 2 HAVING count(*) >= 5""",
        "a3_flexible_ratios": f"""
            SELECT p_brand, l_returnflag, {_PRICE},
                   {_block("CASE WHEN p_size > 25 THEN l_extendedprice / (p_size - 25) END", "price_per_m2")},
                   {_block("CASE WHEN p_size > 10 THEN l_linenumber::DOUBLE / (p_size - 10) END", "beds_per_area")}, count(*) AS qty
            FROM {_ITEMS} GROUP BY 1, 2 HAVING count(*) >= 5""",
        "a4_by_bedrooms": f"""
            SELECT p_brand, CASE WHEN l_linenumber - 1 >= 5 THEN '5+' ELSE (l_linenumber - 1)::VARCHAR END AS bedrooms_norm, {_PRICE},
                   {_block("CASE WHEN l_linenumber > 1 THEN l_extendedprice / (l_linenumber - 1) END", "price_per_bed")}, count(*) AS qty
            FROM {_ITEMS} GROUP BY 1, 2 HAVING count(*) >= 20""",
        "a5_value_counts": "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1",
        "a7_missing_report": """
            SELECT 'lang' AS field, count(*) FILTER (WHERE nullif(lang, 'en') IS NULL OR trim(lang) = '') AS missing FROM documents
            UNION ALL SELECT 'source', count(*) FILTER (WHERE NOT coalesce(n_chars > 500, false) OR source IS NULL OR trim(source) = '') FROM documents
            UNION ALL SELECT 'text', count(*) FILTER (WHERE text IS NULL OR trim(text) = '') FROM documents""",
        "a8_zone_rollup": """
            SELECT n_regionkey, string_agg(DISTINCT n_name, '; ' ORDER BY n_name) AS zones,
                   'DC-' || upper(substr(md5(n_regionkey::VARCHAR), 1, 6)) AS uid FROM nation GROUP BY 1""",
        "a9_column_profile": profile,
        "a10_mode": """
            WITH c AS (SELECT year(o_orderdate)::INTEGER AS year, o_orderstatus, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1, 2, 3),
                 r AS (SELECT *, sum(n) OVER (PARTITION BY year, o_orderstatus) AS total,
                              row_number() OVER (PARTITION BY year, o_orderstatus ORDER BY n DESC, v) AS k FROM c)
            SELECT year, o_orderstatus, CASE WHEN n >= 0.205 * total THEN v ELSE 'VARIES' END AS o_orderpriority FROM r WHERE k = 1""",
    }

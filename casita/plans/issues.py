"""The listing pipeline over issues written from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casita.plans.listings import Context, Pipeline
from casita.sources.tables import table


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An issue for each brand and size of parts, two sections of advertisements."""
    p = table(spark, sf_dir, "part")
    sale = F.col("p_partkey") % 2 == 0
    price = F.format_number(F.when(sale, F.col("p_retailprice") * 100).otherwise(F.col("p_retailprice")).cast("int"), 0)
    place = F.concat(F.lit("Colonia "), F.get(F.split("p_name", " "), 0))
    kind = F.when(F.col("p_partkey") % 3 == 0, "casa").otherwise("apartamento")
    line = F.concat(F.lit("* "), place, F.lit(", "), kind, F.lit(" de "), (F.col("p_size") % 5 + 1).cast("string"), F.lit(" hab 2 baños, "), (F.col("p_size") + 60).cast("string"), F.lit(" m2, $"), price)
    rows = p.select("p_brand", sale.alias("sale"), "p_partkey", line.alias("line"))
    section = rows.groupBy("p_brand", "sale").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "line"))).alias("x"))
    head = F.when(F.col("sale"), "#VENTA DE CASAS").otherwise("#ALQUILER DE CASAS")
    section = section.select("p_brand", "sale", F.concat_ws("\n", head, F.transform("x", lambda r: r.line)).alias("body"))
    whole = section.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("sale", "body"))).alias("s"))
    agency = F.regexp_replace("p_brand", "#", "")
    return whole.select(F.concat(F.lower(agency), F.lit("_20100312.txt")).alias("file"), agency.alias("agency"), F.to_date(F.lit("2010-03-12")).alias("date"), F.concat_ws("\n", F.transform("s", lambda r: r.body)).alias("value"))


def context(spark: SparkSession, sf_dir: str) -> Context:
    words = table(spark, sf_dir, "part").select(F.upper(F.get(F.split("p_name", " "), 0)).alias("w")).distinct()
    catalog = words.select(F.concat(F.lit("COL "), "w").alias("alias"), F.crc32("w").alias("ord"), F.concat(F.lit("P-"), "w").alias("uid"), F.concat(F.lit("G-"), "w").alias("GISID"), F.initcap("w").alias("label"))
    rates = spark.createDataFrame([("2010-03", "HNL", "USD", 0.05)], "year_month string, base string, quote string, rate double")
    return Context(catalog=catalog, rates=rates, min_n=1)


def p1_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps 1 to 13: each advertisement with type, place, price and decision."""
    steps = ["parse", "merge", "deduplicate", "word_filter", "uid", "clean_neighborhoods", "ptype_fix", "filter_records", "gis_match", "unmatched_check", "price_standardize", "transaction_validate", "area_standardize"]
    got = Pipeline(steps).run(issues(spark, sf_dir), context(spark, sf_dir))["area_standardize"].main
    return got.select("agency", "listing_id", "transaction", "bedrooms", "bathrooms", "area", "price_usd", "neighborhood_label", "property_type_new", "transaction_flag")


def p2_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fourteen steps: prices by place and month."""
    got = Pipeline().run(issues(spark, sf_dir), context(spark, sf_dir))["aggregate"].main
    return got.select("neighborhood_label", "transaction", "property_type_new", "year_month", F.round("price_min_usd", 6).alias("price_min"), F.round("price_median_usd", 6).alias("price_median"), "qty")


def queries() -> dict:
    return {f.__name__: f for f in (p1_listings, p2_statistics)}


#: What the advertisements say, from the parts they are written from. Rows equal in all that a key holds count once.
_LISTED = """
    WITH a AS (SELECT replace(p_brand, '#', '') AS agency, p_partkey, p_partkey % 2 = 0 AS sale, upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] AS label, p_partkey % 3 = 0 AS house, (p_size % 5 + 1)::INTEGER AS beds,
                      (p_size + 60)::VARCHAR AS area, trunc(CASE WHEN p_partkey % 2 = 0 THEN p_retailprice * 100 ELSE p_retailprice END)::DOUBLE AS price FROM part),
         n AS (SELECT *, (row_number() OVER (PARTITION BY agency ORDER BY sale, p_partkey) + dense_rank() OVER (PARTITION BY agency ORDER BY sale))::INTEGER AS listing_id FROM a),
         k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY label, house, beds, area, price, sale ORDER BY lower(agency) || '_20100312.txt', listing_id) = 1)"""


def oracle_sql() -> dict[str, str]:
    kind = "CASE WHEN sale THEN 'Sale' ELSE 'Rent' END AS transaction", "CASE WHEN house THEN 'House' ELSE 'Apartment' END AS property_type_new"
    return {
        "p1_listings": f"""{_LISTED}
            SELECT agency, listing_id, {kind[0]}, beds AS bedrooms, 2.0::DOUBLE AS bathrooms, area, price AS price_usd, label AS neighborhood_label, {kind[1]}, 'OK_DECLARED' AS transaction_flag FROM k""",
        "p2_statistics": f"""{_LISTED}
            SELECT label AS neighborhood_label, {kind[0]}, {kind[1]}, '2010-03' AS year_month, min(price) AS price_min, median(price) AS price_median, count(*) AS qty FROM k GROUP BY 1, 2, 3""",
    }

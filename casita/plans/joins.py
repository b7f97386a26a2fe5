"""Lookups, as-of joins, matching, unions, keys and ids over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casita.functions.text import hash_of, label_tokens, slug
from casita.operators import dedup, fuzzy, lookup, segment
from casita.operators.asof import asof, resolve_rates
from casita.operators.rules import listed, with_causes
from casita.sources.tables import table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_custkey")
    return o.withColumns({"currency": F.when(F.col("o_orderkey") % 3 == 0, "USD").otherwise("HNL"), "year_month": F.date_format("o_orderdate", "yyyy-MM"), "day": F.col("o_orderdate").cast("date")})


def _rates(spark: SparkSession, sf_dir: str, on: str) -> DataFrame:
    """Rates made of shipped quantities: whole numbers over 4096, so that sums are exact."""
    item = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("year_month"), F.col("l_shipdate").cast("date").alias("day"), "l_quantity")
    return item.where("l_quantity > 10").groupBy(on).agg((F.sum("l_quantity") / 4096).alias("rate")).withColumns({"base": F.lit("HNL"), "quote": F.lit("USD")})


def j1_monthly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lookup.rate_join(_orders(spark, sf_dir), _rates(spark, sf_dir, "year_month"), "year_month", price="o_totalprice")
    return got.select("o_orderkey", "price_usd", "fx_rate_used", "fx_method")


def j2_daily_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lookup.rate_join(_orders(spark, sf_dir), _rates(spark, sf_dir, "day").where("day < '1997-01-01'"), "day", price="o_totalprice")
    return got.select("o_orderkey", "price_usd", "fx_rate_used", "fx_method")


def j3_catalog_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation name against a catalog with repeated names, of which the last row counts."""
    nation = table(spark, sf_dir, "nation")
    names = nation.select(F.lower("n_name").alias("place"), "n_nationkey")
    catalog = nation.where("n_nationkey % 5 <> 0").select(F.concat(F.lit(" "), "n_name").alias("alias"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k"), F.col("n_nationkey").alias("n"))
    catalog = catalog.select("alias", (F.col("k") * 100 + F.col("n")).alias("ord"), F.format_string("P-%d-%d", "n", "k").alias("place_uid"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(names, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "place")
    return lookup.catalog_match(rows, "place", catalog, "alias", "ord", ["place_uid"]).select("c_custkey", "place_uid", "matched")


def j4_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order price of a class at or before each line's shipping."""
    quotes = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 7).alias("k"), F.col("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("rate"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 7).alias("k"), F.col("l_shipdate").alias("at"))
    return asof(rows, quotes, ["k"], "at", "date", ["rate"]).select("l_orderkey", "l_linenumber", F.col("date").alias("quoted"), "rate")


def j4_resolve_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct, inverse and pivot rates by as-of."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    names = F.array(*[F.lit(x) for x in ("HNL", "USD", "EUR", "GTQ")])
    rows = o.select("o_orderkey", F.get(names, (F.col("o_orderkey") % 4).cast("int")).alias("base"), F.get(names, (F.col("o_custkey") % 4).cast("int")).alias("quote"), F.col("o_orderdate").alias("at"))
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("base"), F.lit(b).alias("quote"), F.lit(k).alias("k")) for k, (a, b) in enumerate((("HNL", "USD"), ("USD", "EUR"), ("GTQ", "HNL")))]))
    quotes = o.where("o_custkey % 9 = 0").groupBy(F.col("o_orderdate").alias("date")).agg(F.count("*").alias("n")).select("date", "n", pairs.alias("p")).select("p.base", "p.quote", "date", ((F.col("n") + F.col("p.k")) / 8).alias("rate"))
    return resolve_rates(rows, quotes, "o_orderkey", "base", "quote", "at").select("o_orderkey", "method", "rate_date", "rate")


def j5_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a part is left out, in one pass."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice", "p_size")
    banned = part.where("p_size = 1").select(F.upper("p_type")).distinct()
    rows = listed(part, "p_type", banned, "is_banned")
    got = with_causes(rows, {"excluded_type": F.col("is_banned"), "low_price": F.col("p_retailprice") < 950, "size": F.col("p_size").between(40, 45)})
    return got.select("p_partkey", "causes", (F.col("causes") == "").alias("accepted"))


def j6_contained_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [(0, "public license"), (1, "the of"), (2, "in that"), (3, "de la"), (4, "der"), (5, "et"), (6, "THE")]
    aliases = spark.createDataFrame(names, "ord int, alias string")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return lookup.contained_alias(items, "text", aliases).select("item_id", "alias_ord")


def j8_token_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts with a number divisible by 100, each with the name of another part that shares most tokens."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("raw"))
    official = part.where("p_partkey % 100 <> 0").select(F.col("p_partkey").alias("gid"), F.col("p_partkey").alias("ord"), F.col("raw").alias("glabel"))
    cand = part.where("p_partkey % 100 = 0").select("raw").distinct().withColumn("toks", label_tokens(F.col("raw")))
    return fuzzy.best_by_tokens(cand, official).select("raw", "gid", F.round("confidence", 9).alias("confidence"))


def j7_match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names, some shortened or with words added, against the list."""
    n = table(spark, sf_dir, "nation")
    shape = F.when(F.col("n_nationkey") % 4 == 0, F.col("n_name")).when(F.col("n_nationkey") % 4 == 1, F.expr("left(n_name, length(n_name) - 1)")).when(F.col("n_nationkey") % 4 == 2, F.concat(F.lit("Col. "), "n_name")).otherwise(F.concat(F.lit("old "), "n_name"))
    gazetteer = n.select(F.col("n_nationkey").alias("gid"), F.col("n_nationkey").alias("ord"), F.col("n_name").alias("glabel"), F.lit(None).cast("string").alias("alias"))
    gazetteer = gazetteer.unionByName(gazetteer.where("gid % 8 = 3").withColumn("alias", F.concat(F.lit("OLD "), "glabel")))
    return fuzzy.match_cascade(n.select(shape.alias("name")), "name", gazetteer).select("name", "gid", "confidence", "method")


def j10_link_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier and customer names."""
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("idx"), F.regexp_replace("s_name", "#0*", " ").alias("name"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("idx"), F.regexp_replace(F.regexp_replace("c_name", "#0*", " "), "Customer", "Supplier").alias("name"))
    return fuzzy.link_records(a, b)


def j11_without_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order that is still open."""
    open_ = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").withColumnRenamed("o_custkey", "k")
    return lookup.without_partner(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k"), open_, "k")


def j13_mnemonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(slug(F.col("n_name")).alias("key"), F.lower(F.substring("n_name", 1, 3)).alias("mnemonic"))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return lookup.mnemonic(rows, slug(F.col("n_name")), names, slug(F.col("n_name"))).select("n_nationkey", "mnemonic")


def u1_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"), F.lit("supplier").alias("source_file"))
    return dedup.union_by_name([c, s], ["source_file", "name"], fill="")


def u3_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedup.first_by(rows, ["user_id", "event_type"], ["ts", "event_id"])


def w3_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by a digest of their text; the least doc_id is canonical."""
    docs = table(spark, sf_dir, "documents").select("doc_id", hash_of([F.lower(F.trim("text")), F.col("lang")]).alias("dedup_key"))
    return dedup.with_roles(docs, "dedup_key", [F.col("doc_id")]).select("doc_id", "dedup_key", F.col("group_id").cast("long").alias("group_id"), "role")


def t3_listing_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, N9, N19, N29, T3."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return dedup.listing_uid(o, slug(F.col("o_orderpriority")), F.col("date"), ["o_orderkey"]).select("listing_uid", "o_orderkey")


def t5_place_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N30, T5, W4."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    return dedup.place_uid(n, "n_regionkey", "n_name", ["n_nationkey"]).select("n_nationkey", "uid")


def w5_child_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return dedup.child_order(item, "l_orderkey", ["l_extendedprice", "l_linenumber"]).select("l_orderkey", "l_linenumber", "child_idx", "children_count", "child_fraction")


def w7_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last user turn before each turn, and the role before it."""
    c = segment.carried(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], {"user_turn": F.when(F.col("role") == "user", F.col("turn"))})
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    return c.select("conv_id", "turn", "user_turn", before.alias("role_before"))


EVERY = (
    j1_monthly_rate, j2_daily_rate, j3_catalog_match, j4_asof, j4_resolve_rates, j5_causes, j6_contained_alias, j7_match_cascade, j8_token_match, j10_link_records, j11_without_orders, j13_mnemonic,
    u1_union_by_name, u3_first_wins, w3_roles, t3_listing_uid, t5_place_uid, w5_child_order, w7_forward_fill,
)


def queries() -> dict:
    return {f.__name__: f for f in EVERY}


def _rate_sql(on: str, extra: str = "") -> str:
    keys = {"year_month": ("strftime(o_orderdate, '%Y-%m')", "strftime(l_shipdate, '%Y-%m')"), "day": ("o_orderdate::DATE", "l_shipdate::DATE")}[on]
    return f"""
        WITH r AS (SELECT {keys[1]} AS k, sum(l_quantity) / 4096 AS rate FROM lineitem WHERE l_quantity > 10 {extra} GROUP BY 1)
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1.0::DOUBLE ELSE rate END AS fx_rate_used,
               round_even(o_totalprice * CASE WHEN o_orderkey % 3 = 0 THEN 1.0::DOUBLE ELSE rate END * 100, 0) / 100 AS price_usd,
               CASE WHEN o_orderkey % 3 = 0 THEN 'identity' WHEN rate IS NOT NULL THEN '{on}' END AS fx_method
        FROM orders LEFT JOIN r ON {keys[0]} = k"""


_LABEL = "trim(regexp_replace(upper({0}), '[^A-Z0-9_ .]', ' ', 'g'))"


def oracle_sql() -> dict[str, str]:
    tokens = "[x for x in list_distinct(string_split_regex(" + _LABEL.format("{0}") + ", ' +')) if x <> '' AND NOT regexp_full_match(x, '[0-9]+')]"
    return {
        "j1_monthly_rate": _rate_sql("year_month").replace("o_totalprice * CASE", "(o_totalprice * CASE").replace("END * 100, 0)", "END) * 100, 0)"),
        "j2_daily_rate": _rate_sql("day", "AND l_shipdate < TIMESTAMP '1997-01-01'").replace("o_totalprice * CASE", "(o_totalprice * CASE").replace("END * 100, 0)", "END) * 100, 0)"),
        "j3_catalog_match": """
            SELECT c_custkey, CASE WHEN n_nationkey % 5 <> 0 THEN 'P-' || n_nationkey || '-1' END AS place_uid, n_nationkey % 5 <> 0 AS matched
            FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "j4_asof": """
            WITH q AS (SELECT o_custkey % 7 AS k, o_orderdate AS date, max(o_totalprice) AS rate FROM orders GROUP BY 1, 2),
                 l AS (SELECT l_orderkey, l_linenumber, l_suppkey % 7 AS k, l_shipdate AS at FROM lineitem)
            SELECT l_orderkey, l_linenumber, date AS quoted, rate FROM l ASOF LEFT JOIN q ON l.k = q.k AND l.at >= q.date""",
        "j4_resolve_rates": """
            WITH o AS (SELECT o_orderkey, ['HNL','USD','EUR','GTQ'][(o_orderkey % 4 + 1)::INT] AS base, ['HNL','USD','EUR','GTQ'][(o_custkey % 4 + 1)::INT] AS quote, o_orderdate AS at FROM orders),
                 n AS (SELECT o_orderdate AS date, count(*) AS n FROM orders WHERE o_custkey % 9 = 0 GROUP BY 1),
                 q AS (SELECT 'HNL' AS base, 'USD' AS quote, date, n / 8 AS rate FROM n UNION ALL SELECT 'USD', 'EUR', date, (n + 1) / 8 FROM n UNION ALL SELECT 'GTQ', 'HNL', date, (n + 2) / 8 FROM n),
                 d AS (SELECT o.o_orderkey, q.rate, q.date FROM o ASOF JOIN q ON o.base = q.base AND o.quote = q.quote AND o.at >= q.date),
                 i AS (SELECT o.o_orderkey, q.rate, q.date FROM o ASOF JOIN q ON o.base = q.quote AND o.quote = q.base AND o.at >= q.date),
                 p1 AS (SELECT o.o_orderkey, q.rate, q.date FROM o ASOF JOIN (SELECT * FROM q WHERE quote = 'USD') q ON o.base = q.base AND o.at >= q.date),
                 p2 AS (SELECT o.o_orderkey, q.rate, q.date FROM o ASOF JOIN (SELECT * FROM q WHERE base = 'USD') q ON o.quote = q.quote AND o.at >= q.date)
            SELECT o.o_orderkey,
                   CASE WHEN o.base = o.quote THEN 'parity' WHEN d.rate IS NOT NULL THEN 'direct' WHEN i.rate IS NOT NULL THEN 'inverse'
                        WHEN o.base <> 'USD' AND o.quote <> 'USD' AND p1.rate IS NOT NULL AND p2.rate IS NOT NULL THEN 'pivot' END AS method,
                   CASE WHEN o.base = o.quote THEN o.at WHEN d.rate IS NOT NULL THEN d.date WHEN i.rate IS NOT NULL THEN i.date
                        WHEN o.base <> 'USD' AND o.quote <> 'USD' AND p1.rate IS NOT NULL AND p2.rate IS NOT NULL THEN greatest(p1.date, p2.date) END AS rate_date,
                   CASE WHEN o.base = o.quote THEN 1.0::DOUBLE WHEN d.rate IS NOT NULL THEN d.rate WHEN i.rate IS NOT NULL THEN 1.0::DOUBLE / i.rate
                        WHEN o.base <> 'USD' AND o.quote <> 'USD' AND p1.rate IS NOT NULL AND p2.rate IS NOT NULL THEN p1.rate * p2.rate END AS rate
            FROM o LEFT JOIN d USING (o_orderkey) LEFT JOIN i USING (o_orderkey) LEFT JOIN p1 USING (o_orderkey) LEFT JOIN p2 USING (o_orderkey)""",
        "j5_causes": """
            WITH b AS (SELECT DISTINCT lower(p_type) AS t FROM part WHERE p_size = 1),
                 c AS (SELECT p_partkey, CASE WHEN lower(p_type) IN (SELECT t FROM b) THEN 'excluded_type;' ELSE '' END
                              || CASE WHEN p_retailprice < 950 THEN 'low_price;' ELSE '' END || CASE WHEN p_size BETWEEN 40 AND 45 THEN 'size;' ELSE '' END AS causes FROM part)
            SELECT p_partkey, causes, causes = '' AS accepted FROM c""",
        "j6_contained_alias": """
            WITH a(ord, alias) AS (VALUES (0, 'PUBLIC LICENSE'), (1, 'THE OF'), (2, 'IN THAT'), (3, 'DE LA'), (4, 'DER'), (5, 'ET'), (6, 'THE')),
                 t AS (SELECT item_id, ' ' || array_to_string([x for x in string_split_regex(upper(text), '[^\\p{L}\\p{N}]+') if x <> ''], ' ') || ' ' AS w FROM benchmark)
            SELECT item_id, (SELECT min(ord) FROM a WHERE contains(w, ' ' || alias || ' '))::INTEGER AS alias_ord FROM t""",
        "j7_match_cascade": """
            WITH n AS (SELECT DISTINCT CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN left(n_name, length(n_name) - 1) WHEN 2 THEN 'Col. ' || n_name ELSE 'old ' || n_name END AS name FROM nation),
                 g AS (SELECT n_nationkey AS gid, n_name FROM nation)
            SELECT name, coalesce(e.gid, c.gid, o.gid) AS gid, CASE WHEN e.gid IS NOT NULL OR c.gid IS NOT NULL THEN 1.0 WHEN o.gid IS NOT NULL THEN 0.98 ELSE 0.0 END::DOUBLE AS confidence,
                   CASE WHEN e.gid IS NOT NULL THEN 'exact' WHEN o.gid IS NOT NULL THEN 'alias_exact' WHEN c.gid IS NOT NULL THEN 'token_jaccard' ELSE 'none' END AS method
            FROM n LEFT JOIN g e ON name = e.n_name LEFT JOIN g c ON name = 'Col. ' || c.n_name LEFT JOIN g o ON name = 'old ' || o.n_name AND o.gid % 8 = 3""",
        "j8_token_match": f"""
            WITH c AS (SELECT DISTINCT p_name AS raw, {tokens.format("p_name")} AS toks FROM part WHERE p_partkey % 100 = 0),
                 g AS (SELECT p_partkey AS gid, {tokens.format("p_name")} AS g_toks FROM part WHERE p_partkey % 100 <> 0),
                 s AS (SELECT raw, gid, len(list_intersect(toks, g_toks)) / len(list_distinct(list_concat(toks, g_toks))) AS confidence
                       FROM c, g WHERE len(list_intersect(toks, g_toks)) > 0)
            SELECT raw, gid, round(confidence, 9) AS confidence FROM s QUALIFY row_number() OVER (PARTITION BY raw ORDER BY confidence DESC, gid) = 1""",
        "j11_without_orders": "SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')",
        "j13_mnemonic": """
            SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN lower(substr(n_name, 1, 3))
                   ELSE trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-') END AS mnemonic FROM nation""",
        "u1_union_by_name": """
            SELECT '' AS source_file, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
            UNION ALL SELECT 'supplier', s_name, s_nationkey, '' FROM supplier""",
        "u3_first_wins": "SELECT event_id, user_id, event_type, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
        "w3_roles": """
            WITH k AS (SELECT doc_id, md5(lower(trim(text)) || '|' || coalesce(lang, '')) AS dedup_key FROM documents)
            SELECT doc_id, dedup_key, dense_rank() OVER (ORDER BY dedup_key) - 1 AS group_id,
                   CASE WHEN row_number() OVER (PARTITION BY dedup_key ORDER BY doc_id) = 1 THEN 'CANONICAL' ELSE 'DUPLICATE' END AS role FROM k""",
        "t3_listing_uid": """
            WITH s AS (SELECT o_orderkey, trim(regexp_replace(lower(trim(o_orderpriority)), '[^a-z0-9]+', '-', 'g'), '-') AS m, strftime(o_orderdate, '%Y%m%d') AS d FROM orders)
            SELECT m || '-' || d || '-' || lpad((row_number() OVER (PARTITION BY m, d ORDER BY o_orderkey))::VARCHAR, 4, '0') AS listing_uid, o_orderkey FROM s""",
        "t5_place_uid": """
            WITH w AS (SELECT n_nationkey, n_regionkey, string_split(n_name, ' ') AS w FROM nation),
                 c AS (SELECT n_nationkey, n_regionkey, rpad(substr(w[1], 1, 3), 3, 'X') || rpad(coalesce(substr(w[2], 1, 3), ''), 3, 'X') AS code FROM w)
            SELECT n_nationkey, n_regionkey || '-' || code || '-' || lpad((row_number() OVER (PARTITION BY n_regionkey, code ORDER BY n_nationkey))::VARCHAR, 3, '0') AS uid FROM c""",
        "w5_child_order": """
            WITH c AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_linenumber)::INTEGER AS child_idx,
                              count(*) OVER (PARTITION BY l_orderkey)::INTEGER AS children_count FROM lineitem)
            SELECT *, child_idx || '/' || children_count AS child_fraction FROM c""",
        "w7_forward_fill": """
            SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS user_turn,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS role_before FROM conversations""",
    }

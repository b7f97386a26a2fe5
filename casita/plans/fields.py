"""Queries over the driver's tables for cell, line, candidate, sanitizer, splitting and id operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casita.functions import listing as X
from casita.functions import text as N
from casita.operators import asof, candidates, dedup, explode, fuzzy, lookup, rules, sanitize, segment, simple, unmarked
from casita.sources import files
from casita.sources.tables import new_path, table


def _pick(*options, by: str = "p_partkey"):
    return F.get(F.array(*[F.lit(o) if isinstance(o, str) or o is None else o for o in options]), (F.col(by) % len(options)).cast("int"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice", F.upper("p_name").alias("up"))


def n7_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean names, keys and modes of candidates with noise."""
    p = _parts(spark, sf_dir)
    said = _pick(F.concat(F.lit("Colonia "), "up"), F.concat("up", F.lit(" venta $ 1,200")), F.concat("up", F.lit(" 3 hab | 120 m2")), F.col("up"))
    raw = F.when(F.col("p_partkey") % 8 == 3, F.concat(F.lit("sobre blvd. morazan, "), "up"))
    got = candidates.clean_candidate(said, raw)
    months = candidates.prepared_key(_pick("5 ene. 2010", "dic 31", "SEPTIEMBRE.XY 4", "Año nuevo"))
    return p.withColumn("c", got).select("p_partkey", "c.clean", "c.norm", "c.mode", months.alias("key"))


def x11e_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11e: strategy, catalog, heads."""
    p = _parts(spark, sf_dir)
    catalog = [("Blue Hills", ["blue", "cold"]), ("Red Valley", ["hot rod"])]
    by_strategy = candidates.match_place(F.concat("p_name", F.lit(", casa")), catalog, "first_comma")
    by_name = candidates.match_place(F.concat(F.lit("casa: "), "p_name"), catalog)
    by_head = candidates.match_place(_pick("una casa en Loma Verde", "casa", "Altos de Miramar 3", "de San Jose, 2"), catalog)
    return p.select("p_partkey", by_strategy.alias("by_strategy"), by_name.alias("by_name"), by_head.alias("by_head"))


def x3c_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3c, X3d, X4a, X4d, X18."""
    p = _parts(spark, sf_dir)
    amount = F.format_number(F.col("p_size") * 1000, 0)
    es = F.translate(F.format_number(F.col("p_size").cast("decimal(10,2)") * 1000, 2), ",.", ".,")
    text = F.concat(F.lit("casa 120 vrs2, 3 hab (2) baños, L. "), amount)
    return p.select(
        "p_partkey", X.mask_other_numbers(text, ("vrs2", "m2"), ("hab", "baños")).alias("masked"), X.es_amount(F.concat(F.lit("a "), es), F.lit(1.0)).alias("es"), X.price_number(es).alias("es_number"),
        X.price_number(_pick("45,000.50", "45.000,50", "1.200.300", "2,5")).alias("number"), X.first_currency(text).alias("currency"), X.contains_currency(F.lit("casa")).alias("none"),
        X.dot_after_currency(F.concat(F.lit("Lps. .900 y $."), amount)).alias("dots"),
    )


def n14_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N14, N15, N16, N18, N22, N31."""
    p = _parts(spark, sf_dir)
    cell = F.concat(F.lit("​“ÁRBOL”  – "), "p_name", F.lit("…"))
    area = X.clean_area(F.concat(F.format_number(F.col("p_size") * 100, 0), _pick(" vr2", " m2", " mts2", "")))
    web = N.web_text(F.concat(F.lit("<p>"), "p_name", F.lit("</p>&nbsp;<b>&amp; más\U0001f3e0</b>")))
    return p.select("p_partkey", N.sanitize(cell).alias("plain"), N.plain_key(cell).alias("key"), N.currency(_pick("dólares", "Lps.", "eur", "pesos")).alias("currency"), area.value.alias("area"), area.unit.alias("unit"), F.round(area.m2, 6).alias("m2"), web.alias("web"))


def n27_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of nine parts; the first listing of each key."""
    p = _parts(spark, sf_dir)
    none = F.lit(None).cast("double")
    row = {"title": F.concat(F.lit(" CASÁ "), F.get(F.split("up", " "), 0)), "neighborhood": F.lit(None).cast("string"), "bedrooms": F.col("p_size") % 4, "bathrooms": none, "area_m2": none, "AT": none, "price": F.col("p_size") % 3, "transaction": F.lit("Sale")}
    keyed = p.select("p_partkey", dedup.listing_key(row, F.lit("2010-01")).alias("key"))
    return dedup.first_by(keyed, ["key"], ["p_partkey"])


def l1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1, L7, L9 to L13, X21."""
    p = _parts(spark, sf_dir)
    n = F.col("p_partkey").cast("string")
    bullets = X.bullet_counts(_pick("12. casa", "* casa", "casa"))
    return p.select(
        "p_partkey", X.colon_before_currency(F.concat("p_name", F.lit(" $ "), n)).alias("colon"), X.strip_number_letter(_pick(F.concat(F.lit("12A. "), "p_name"), F.concat(F.lit("3-B) "), "p_name"), F.concat(F.lit("# 4. "), "p_name"))).alias("bare"),
        X.mark_any(_pick("+ casa", "•• casa", "casa - lote")).alias("marked"), X.upper_star(F.concat(F.lit("* "), _pick(F.col("up"), F.col("p_name")))).alias("star"), X.colon_after_upper(F.concat("up", F.lit(", casa de lujo"))).alias("title"),
        bullets.numbered.alias("numbered"), bullets.starred.alias("starred"), X.strip_bullet(_pick("* casa", "4) casa", "casa * 2")).alias("stripped"),
    )


def x9_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2, X9, X10, X13."""
    p = _parts(spark, sf_dir)
    kind = X.by_keywords(F.col("p_name"), {"A": ["rod", "gear"], "B": ["blue", "hot"]}, "other")
    fixed = X.normalize_ocr(F.concat(F.lit("ba√±o  bafios $.5 Lps.7 y 3 mts2, 4 vr2 de "), "p_name"))
    missing = X.missing_fields({"name": F.when(F.col("p_size") > 10, F.col("p_name")), "blank": F.lit(" "), "size": F.col("p_size")})
    return p.select("p_partkey", kind.alias("kind"), fixed.alias("fixed"), F.array_join(missing, "|").alias("missing"))


def f6_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, F9 to F13."""
    p = rules.require_all(rules.require_columns(_parts(spark, sf_dir), ["p_name"]), F.col("p_partkey") >= 0, "no key")
    said = _pick("No", "yes", "0", "sí", "maybe", None)
    notes = _pick("Torre Alfa: $ 1; Torre Beta: $ 2", "una casa", "MLS: AB1234 y ID# XY9876")
    rows = rules.valid_rows(p.withColumn("size", F.col("p_size")), F.col("p_size") <= 40, "null", ["size"])
    rows = rules.valid_rows(rows, F.col("p_size") > 2, "skip")
    return rows.select("p_partkey", "size", rules.is_no(said).alias("no"), rules.is_yes(said).alias("yes"), explode.is_multi(explode.anchors(explode.normalize_notes(notes))).alias("multi"))


def _lines(spark: SparkSession, sf_dir: str, line) -> DataFrame:
    """A line a part; files of 16 parts."""
    return _parts(spark, sf_dir).select(F.floor(F.col("p_partkey") / 16).alias("file"), (F.col("p_partkey") % 16).cast("int").alias("line_no"), line.alias("line"), "p_partkey")


def g2_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2, G6, G6a, G6b, G6d: starts by the mode that a marker names."""
    lines = _lines(spark, sf_dir, _pick("Las Uvas: casa $ 1,200", "12. Lomas, casa $ 5", "* El Prado", "RES MIRAMAR. casa", "$ 5: casa"))
    out = lines
    for name, marker in (("literal", "*"), ("numbered", "#NUMDOT"), ("colon", "CUE:COLON"), ("comma", "CUE:COMMA"), ("upper", "UPPERCASE")):
        out = out.join(segment.with_starts(lines.select("file", "line_no", "line"), marker).select("file", "line_no", F.col("start").alias(name)), ["file", "line_no"])
    return out.select("p_partkey", "literal", "numbered", "colon", "comma", "upper")


def g6c_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-on lines cut before later heads."""
    heads = F.concat(F.lit("Las Uvas: casa $ 1,200 "), _pick("El Prado: lote L 900", "y patio", "Col. Kennedy: apto $ 5 Res. Honduras: x"))
    titles = F.concat(F.lit("RES LOMAS. casa amplia "), _pick("COL CENTRO. lote", "JARDIN GRANDE. patio", "fin"))
    both = F.struct(segment.split_after_price(heads).alias("h"), segment.split_titles(titles, ("jardin grande",)).alias("t"))
    return _parts(spark, sf_dir).withColumn("x", both).select("p_partkey", F.array_join("x.h", "|").alias("heads"), F.size("x.h").alias("n_heads"), F.array_join("x.t", "|").alias("titles"))


def g10_masquerade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered files, prices and areas glued; files with too few numbers stay."""
    line = F.when(F.col("p_partkey") % 32 >= 16, "casa").otherwise(_pick("7. Casa bonita $", "1,200.00", "8. Lote de 300 vrs2", "con agua"))
    return segment.masquerade(_lines(spark, sf_dir, line).drop("p_partkey"), "numbered")


def g11_masquerade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that score as starts, with what follows them."""
    line = _pick("Las Lomas casa 3 hab $ 1,200", "con patio y agua", "# VENTA", "Lote de 300 vrs2 a $ 5,000 y 120 m2", "12.")
    return segment.masquerade(_lines(spark, sf_dir, line).drop("p_partkey"), "freeform")


def n33_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates sanitized, with counters."""
    p = _parts(spark, sf_dir)
    rows = p.select("p_partkey", _pick("2010/1/5", "05-01-2010", "soon").alias("date"), _pick("hnl", "usd ").alias("from"), _pick("USD", "us$", "EUR", "GTQ").alias("to"), F.concat(F.lit("L. "), F.col("p_size").cast("string"), F.lit(".50")).alias("rate"))
    clean = sanitize.sanitize_rates(rows)
    return clean.select("p_partkey", "date", "base", "quote", "rate", "valid")


def a12_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sanitizing rates and listings counts, a row each."""
    p = _parts(spark, sf_dir)
    rates = sanitize.sanitize_rates(p.select(_pick("2010/1/5", "soon").alias("date"), F.lit("hnl").alias("base"), F.lit("usd").alias("quote"), F.lit("2").alias("rate")))
    listed = sanitize.sanitize_listings(p.select(_pick("usd", "USD", "x").alias("currency"), F.lit("2010-01-05").alias("date"), F.lit("5").alias("price")))
    return sanitize.counters(rates).unionByName(sanitize.counters(listed), allowMissingColumns=True)


def n33_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings sanitized; none is invalid."""
    p = _parts(spark, sf_dir)
    rows = p.select("p_partkey", _pick("Dólares", "HNL", "pesos").alias("currency"), _pick("2010/1/5", "2010-01-05", "soon").alias("date"), F.concat(F.lit("$ "), F.format_number("p_size", 0)).alias("price"), F.concat(F.lit("Peña é "), "p_name").alias("place"))
    got = sanitize.sanitize_listings(rows, accentless=("place",))
    return got.select("p_partkey", "currency", "date", "price", "place_key", F.col("changed.currency").alias("new_currency"), F.col("changed.date").alias("new_date"), F.col("changed.amount").alias("new_amount"))


def t4_sequence_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from numbers that the rows bring, by the configuration of the nation's agency."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    configs = n.where("n_nationkey % 2 = 0").select(F.concat(F.lit("agency_"), F.lower("n_name")).alias("name"), F.lower(F.substring("n_name", 1, 3)).alias("mnemonic"))
    configs = configs.unionByName(n.where("n_nationkey % 2 = 1").select(F.lower("n_name").alias("name"), F.lower(F.substring("n_name", 1, 4)).alias("mnemonic")))
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select("c_custkey", F.concat(F.lit("Inmobiliaria  "), F.initcap("n_name")).alias("agency"), F.lit("5/1/2010").alias("date"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey")).alias("seq"))
    return lookup.sequence_uid(rows, "agency", "date", "seq", configs).select("c_custkey", "listing_uid")


def j14_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of orders in dollars by the last quote, half up to cents."""
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", F.when(F.col("o_orderkey") % 10 > 0, F.floor("o_totalprice")).alias("price"), F.when(F.col("o_orderkey") % 3 == 0, "USD").otherwise("HNL").alias("currency"), F.col("o_orderdate").cast("date").alias("date"))
    quotes = o.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg((F.count("*") / 8).alias("rate")).where("date >= '1993-01-01'").select(F.lit("HNL").alias("base"), F.lit("USD").alias("quote"), "date", "rate", F.lit("bank").alias("source"))
    got = asof.enrich_prices(rows, quotes, "o_orderkey")
    return got.select("o_orderkey", "std_price", "std_currency", "fx_rate_used", "fx_base_date", "fx_pair", "fx_method", "fx_source")


def s1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as CSV with quotes and line breaks, read back alone and united by name."""
    p = _parts(spark, sf_dir)
    rows = p.select("p_partkey", F.concat("p_name", F.lit(', "so"\nñ')).alias("name"), "p_size")
    one, two = f"{new_path(spark, 'one')}.csv", f"{new_path(spark, 'two')}.csv"
    files.write_csv(rows, one, ["p_partkey", "name"])
    files.write_csv(rows.withColumnRenamed("p_size", "size"), two, ["size", "p_partkey"])
    both = files.read_csv_folder(spark, [one, two])
    return both.groupBy(F.col("p_partkey").cast("int").alias("p_partkey")).agg(F.max("name").alias("name"), F.max(F.col("size").cast("int")).alias("size"), F.count("*").alias("n"), F.first(F.lit(files.read_table(spark, one).columns[0])).alias("head"))


def k4_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, K5, K7, K9: parts split by conditions and by year, lines, a summary, all read back."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    split, years, lines = new_path(spark, "split"), new_path(spark, "years"), new_path(spark, "lines")
    files.write_split(o, {"low": F.col("o_totalprice") < 1000, "high": F.col("o_totalprice") > 100_000}, split)
    files.write_years(o, F.year("o_orderdate"), [1995, 1996], years)
    files.write_lines(o, "o_orderkey", lines)
    total = files.summary_json(spark.read.text(lines), {"n": F.count("*")})
    by_part = spark.read.parquet(split).groupBy(F.col("part").cast("string").alias("of")).agg(F.count("*").alias("n"))
    by_year = spark.read.parquet(years).groupBy(F.col("year").cast("string").alias("of")).agg(F.count("*").alias("n"))
    return by_part.unionByName(by_year).withColumn("lines", F.get_json_object(F.lit(total), "$.n").cast("long"))


def k8_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a log that grows by a row for each region, read back."""
    path = new_path(spark, "log")
    for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect():
        files.append_log(spark, path, [{"step": r.r_name, "n": r.r_regionkey}], "step string, n int")
    return spark.read.parquet(path)


def s14_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and aliases, a row each."""
    p = _parts(spark, sf_dir)
    return files.alias_rows(p.withColumn("aliases", F.when(F.col("p_partkey") % 3 > 0, F.concat("up", F.lit(" | x, y")))), "p_partkey", "p_name", "aliases")


def s19_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hand-made table as listings."""
    p = _parts(spark, sf_dir)
    rows = p.select(F.col("p_partkey").cast("string").alias("No"), F.concat(F.lit(" “"), "p_name", F.lit("” ")).alias("Title"), F.concat(F.lit("$ "), F.format_number("p_size", 0)).alias("Asked"), F.lit("Lps.").alias("Money"), F.lit("5/1/2010").alias("Day"))
    got = files.typed_ingest(rows, {"No": "Listing ID", "Title": "title", "Asked": "price", "Money": "currency", "Day": "date", "Beds": "bedrooms"}, "ocr_manual", "v1")
    return got.select(F.col("Listing ID").alias("listing"), "title", "price", "currency", "date", "bedrooms", "source_type", "ingestion_id", "pipeline_version")


def g12_unmarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings without marks, by gates; those without a price go."""
    line = _pick("Res. Las Uvas casa amplia", "con patio y $ 1,200.00", "# VENTA", "area de 300 vrs2", "El Hatillo Real lote Lps. 900", "300 m2 de patio", "10 de Septiembre, casa sin precio")
    got = unmarked.unmarked_listings(_lines(spark, sf_dir, line).drop("p_partkey"))
    return got.select("file", F.col("block_no").cast("long").alias("block_no"), "kind", "text", F.array_join(F.transform("line_numbers", lambda n: n.cast("string")), ",").alias("lines"), "change")


def g17_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bullets with prices, areas and rooms, as listings."""
    n = F.col("p_size").cast("string")
    line = _pick("# Alquiler de casas", F.concat(F.lit("* C A S A LOMAS $ "), n, F.lit(",000.00 con 3 HAB 2 BAÑOS")), "sigue la nota", F.concat(F.lit("- APTO PALMIRA L. "), n, F.lit("00 LA V2, 1/2 MANZANA")))
    got = simple.simple_rows(simple.simple_listings(_lines(spark, sf_dir, line).drop("p_partkey")), "a", "2010-01-05")
    return got.withColumn("ListingID", F.col("ListingID").cast("long"))


def u5_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct headers of a file in order."""
    lines = _lines(spark, sf_dir, F.concat(F.lit("# "), _pick("Venta", "VENTA", "Lotes", "alquiler"))).drop("p_partkey")
    return segment.unique_headers(lines).select("file", "header", F.col("place").cast("long").alias("place"))


def g21_scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G21, K11, M4, N37."""
    p = _parts(spark, sf_dir)
    text = F.concat(F.lit("Casa de 3 bafios, 200 vr2 y dos ba-\n  nos US$5 \u2022 "), "p_name", F.lit("\r\n"))
    tokens = lambda *w: F.array(*[F.lit(x) for x in w])
    score = fuzzy.fuzzy_token_score(tokens("OBELISCO", "NORTE"), F.when(F.col("p_size") % 2 == 0, tokens("OBELISCOS", "NORTE")).otherwise(tokens("SUR")))
    return p.select("p_partkey", N.scanned(text).alias("scanned"), N.zone_text(F.concat(F.lit(" zona\n"), "p_name")).alias("zone"), files.agency_of(F.concat(F.lit("output/"), "p_name", F.lit("/2010/x.csv"))).alias("agency"), F.round(score, 9).alias("score"))


EVERY = (
    n7_candidates, x11e_match, x3c_prices, n14_cells, n27_keys, l1_lines, x9_keywords, f6_flags, g2_modes, g6c_splits, g10_masquerade, g11_masquerade, n33_rates, n33_listings, a12_counters, t4_sequence_uid, j14_enrich,
    g12_unmarked, g17_simple, u5_headers, g21_scanned, s1_files, k4_splits, k8_log, s14_aliases, s19_ingest,
)


def queries() -> dict:
    return {f.__name__: f for f in EVERY}


def _by(n: int, *options: str) -> str:
    """SQL for _pick: options are SQL, or text in quotes."""
    return f"[{', '.join(options)}][(p_partkey % {n} + 1)::INTEGER]"


def oracle_sql() -> dict[str, str]:
    return {
        "n7_candidates": f"""
            SELECT p_partkey, CASE WHEN p_partkey % 8 = 3 THEN 'BLVD MORAZAN' ELSE upper(p_name) END AS clean, CASE WHEN p_partkey % 8 = 3 THEN 'BLVD MORAZAN' ELSE upper(p_name) END AS norm,
                   CASE WHEN p_partkey % 8 = 3 THEN 'blvd' WHEN p_partkey % 4 IN (1, 2) THEN 'heavy' ELSE 'light' END AS mode,
                   {_by(4, "'5 ENERO. 2010'", "'DICIEMBRE 31'", "'SEPTIEMBRE 4'", "'AÑO NUEVO'")} AS key FROM part""",
        "x11e_match": """
            WITH h AS (SELECT *, contains(p_name, 'blue') OR contains(p_name, 'cold') AS g, contains(p_name, 'hot rod') AS r FROM part)
            SELECT p_partkey, upper(p_name) AS by_strategy, CASE WHEN g THEN 'BLUE HILLS' WHEN r THEN 'RED VALLEY' ELSE '' END AS by_name,
                   ['LOMA VERDE', '', 'ALTOS DE MIRAMAR', 'SAN JOSE'][(p_partkey % 4 + 1)::INTEGER] AS by_head FROM h""",
        "x3c_prices": f"""
            SELECT p_partkey, 'casa  ###AREA### ,  ###ROOM###   ###ROOM### , L. ' || format('{{:,}}', p_size * 1000) AS masked, (p_size * 1000)::DOUBLE AS es, (p_size * 1000)::DOUBLE AS es_number,
                   {_by(4, '45000.5::DOUBLE', '45000.5::DOUBLE', '1200300::DOUBLE', '2.5::DOUBLE')} AS number, 'HNL' AS currency, false AS none, 'Lps. 900 y $ ' || format('{{:,}}', p_size * 1000) AS dots FROM part""",
        "n14_cells": f"""
            SELECT p_partkey, '"ÁRBOL" - ' || p_name || '.' AS plain, '"arbol" - ' || p_name || '.' AS key, {_by(4, "'USD'", "'HNL'", "'EUR'", "NULL")} AS currency, (p_size * 100)::DOUBLE AS area,
                   {_by(4, "'vr2'", "'m2'", "'m2'", "'vr2'")} AS unit, round(p_size * 100 * {_by(4, '0.698896::DOUBLE', '1::DOUBLE', '1::DOUBLE', '0.698896::DOUBLE')}, 6) AS m2, p_name || ' & más' AS web FROM part""",
        "n27_keys": """
            SELECT min(p_partkey) AS p_partkey, md5('casa ' || lower(string_split(p_name, ' ')[1]) || '||' || (p_size % 4) || '|nan|nan|nan|' || (p_size % 3) || '|sale|2010-01') AS key FROM part GROUP BY 2""",
        "l1_lines": f"""
            SELECT p_partkey, p_name || ': $ ' || p_partkey AS colon, {_by(3, 'p_name', 'p_name', "'# 4. ' || p_name")} AS bare, {_by(3, "'* casa'", "'* casa'", "'casa - lote'")} AS marked,
                   {_by(2, "'* ' || upper(p_name)", 'p_name')} AS star, upper(p_name) || ':, casa de lujo' AS title, (p_partkey % 3 = 0)::INTEGER AS numbered, (p_partkey % 3 = 1)::INTEGER AS starred,
                   {_by(3, "'casa'", "'casa'", "'casa * 2'")} AS stripped FROM part""",
        "x9_keywords": """
            SELECT p_partkey, CASE WHEN contains(p_name, 'rod') OR contains(p_name, 'gear') THEN 'A' WHEN contains(p_name, 'blue') OR contains(p_name, 'hot') THEN 'B' ELSE 'other' END AS kind,
                   'baño baños $ 5 Lps. 7 y 3 m², 4 vrs² de ' || p_name AS fixed, CASE WHEN p_size > 10 THEN 'blank' ELSE 'name|blank' END AS missing FROM part""",
        "f6_flags": """
            SELECT p_partkey, CASE WHEN p_size <= 40 THEN p_size END AS size, p_partkey % 6 IN (0, 2) AS no, p_partkey % 6 IN (1, 3) AS yes, p_partkey % 3 IN (0, 2) AS multi FROM part WHERE p_size > 2""",
        "g2_modes": """
            SELECT p_partkey, k = 2 AS literal, k = 1 AS numbered, k = 0 AS colon, k = 1 AS comma, k = 3 AS upper FROM (SELECT p_partkey, p_partkey % 5 AS k FROM part)""",
        "g6c_splits": f"""
            SELECT p_partkey, {_by(3, "'Las Uvas: casa $ 1,200|El Prado: lote L 900'", "'Las Uvas: casa $ 1,200 y patio'", "'Las Uvas: casa $ 1,200|Col. Kennedy: apto $ 5|Res. Honduras: x'")} AS heads,
                   {_by(3, '2', '1', '3')} AS n_heads, {_by(3, "'RES LOMAS. casa amplia|COL CENTRO. lote'", "'RES LOMAS. casa amplia JARDIN GRANDE. patio'", "'RES LOMAS. casa amplia fin'")} AS titles FROM part""",
        "g10_masquerade": """
            WITH l AS (SELECT p_partkey // 16 AS file, (p_partkey % 16)::INTEGER AS line_no, p_partkey % 32 < 16 AS numbered,
                              CASE WHEN p_partkey % 32 >= 16 THEN 'casa' ELSE ['* Casa bonita $', '1,200.00', '* Lote de 300 vrs2', 'con agua'][(p_partkey % 4 + 1)::INTEGER] END AS line FROM part),
                 u AS (SELECT *, numbered AND count(CASE WHEN line_no % 2 = 0 THEN 1 END) OVER (PARTITION BY file) >= 5 AS used FROM l),
                 b AS (SELECT *, sum(CASE WHEN used AND line_no % 2 = 1 AND line_no > first THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY line_no) AS block
                       FROM (SELECT *, min(line_no) OVER (PARTITION BY file) AS first FROM u))
            SELECT file, min(line_no) AS line_no, string_agg(CASE WHEN used OR NOT numbered THEN line ELSE replace(replace(line, '* Casa', '7. Casa'), '* Lote', '8. Lote') END, ' ' ORDER BY line_no) AS line, bool_and(used) AS used
            FROM b GROUP BY file, block""",
        "g11_masquerade": """
            WITH l AS (SELECT p_partkey // 16 AS file, (p_partkey % 16)::INTEGER AS line_no, p_partkey % 5 AS k FROM part),
                 u AS (SELECT *, count(CASE WHEN k IN (0, 3) THEN 1 END) OVER (PARTITION BY file) >= 5 AS used, min(line_no) OVER (PARTITION BY file) AS first FROM l),
                 t AS (SELECT *, ['Las Lomas casa 3 hab $ 1,200', 'con patio y agua', '# VENTA', 'Lote de 300 vrs2 a $ 5,000 y 120 m2', '12.'][(k + 1)::INTEGER] AS line,
                              CASE WHEN NOT used OR k IN (2, 3) OR line_no = first THEN 1 WHEN k = 0 THEN 1 ELSE 0 END AS opens FROM u),
                 b AS (SELECT *, sum(opens) OVER (PARTITION BY file ORDER BY line_no) AS block FROM t)
            SELECT file, min(line_no) AS line_no, string_agg(CASE WHEN used AND k IN (0, 3) THEN '* ' ELSE '' END || line, ' ' ORDER BY line_no) AS line, bool_and(used) AS used FROM b GROUP BY file, block""",
        "n33_rates": """
            WITH r AS (SELECT *, p_partkey % 3 < 2 AND p_partkey % 4 <> 1 AS valid FROM part)
            SELECT p_partkey, CASE WHEN valid THEN '2010-01-05' ELSE ['2010/1/5', '05-01-2010', 'soon'][(p_partkey % 3 + 1)::INTEGER] END AS date, CASE WHEN valid THEN ['HNL', 'USD'][(p_partkey % 2 + 1)::INTEGER] ELSE ['hnl', 'usd '][(p_partkey % 2 + 1)::INTEGER] END AS base,
                   ['USD', 'us$', 'EUR', 'GTQ'][(p_partkey % 4 + 1)::INTEGER] AS quote, CASE WHEN valid THEN (('.' || p_size || '50')::DOUBLE)::VARCHAR ELSE 'L. ' || p_size || '.50' END AS rate,
                   valid FROM r""",
        "a12_counters": """
            SELECT count(*) AS rows, count(CASE WHEN p_partkey % 2 = 1 THEN 1 END) AS errors, NULL::BIGINT AS changed_currency, NULL::BIGINT AS changed_date, NULL::BIGINT AS changed_amount FROM part
            UNION ALL SELECT count(*), NULL, count(CASE WHEN p_partkey % 3 = 0 THEN 1 END), 0, count(*) FROM part""",
        "n33_listings": """
            SELECT p_partkey, ['USD', 'HNL', 'pesos'][(p_partkey % 3 + 1)::INTEGER] AS currency, ['2010-01-05', '2010-01-05', 'soon'][(p_partkey % 3 + 1)::INTEGER] AS date, p_size || '.0' AS price, 'PEÑA E ' || upper(p_name) AS place_key,
                   p_partkey % 3 = 0 AS new_currency, p_partkey % 3 = 0 AS new_date, true AS new_amount FROM part""",
        "t4_sequence_uid": """
            SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE upper(substr(n_name, 1, CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 4 END)) || '-20100105-' || c_custkey END AS listing_uid
            FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "g12_unmarked": """
            WITH l AS (SELECT p_partkey // 16 AS file, (p_partkey % 16)::INTEGER AS n, p_partkey % 7 AS k,
                              ['Res. Las Uvas casa amplia', 'con patio y $ 1,200.00', '# VENTA', 'area de 300 vrs2', 'El Hatillo Real lote Lps. 900', '300 m2 de patio', '10 de Septiembre, casa sin precio'][(p_partkey % 7 + 1)::INTEGER] AS line FROM part),
                 h AS (SELECT *, sum((k = 2)::INTEGER) OVER (PARTITION BY file ORDER BY n) AS section FROM l),
                 o AS (SELECT *, sum((k IN (0, 4, 6))::INTEGER) OVER (PARTITION BY file, section ORDER BY n) AS own FROM h),
                 b AS (SELECT *, sum((k IN (0, 2, 4, 6))::INTEGER) OVER (PARTITION BY file ORDER BY n) AS block FROM o WHERE k = 2 OR own > 0),
                 g AS (SELECT file, block, min(n) AS first, arg_min(k, n) AS k, bool_or(k IN (1, 4)) AS priced, string_agg(line, ' ' ORDER BY n) AS text, string_agg(n::VARCHAR, ',' ORDER BY n) AS lines, count(*) AS c FROM b GROUP BY 1, 2)
            SELECT file, row_number() OVER (PARTITION BY file ORDER BY block) AS block_no, CASE WHEN k = 2 THEN 'header' ELSE 'listing' END AS kind, text, lines,
                   CASE WHEN k = 2 THEN 'header_verbatim' WHEN c > 1 THEN 'glued_lines' ELSE 'whitespace_collapsed_only' END AS change FROM g WHERE k = 2 OR priced""",
        "g17_simple": """
            SELECT p_partkey // 16 AS file, row_number() OVER (PARTITION BY p_partkey // 16 ORDER BY p_partkey) AS ListingID, CASE WHEN k = 1 THEN 'CASALOMAS' ELSE 'APTO PALMIRA' END AS title, CASE WHEN k = 1 THEN 'CASALOMAS' ELSE 'PALMIRA' END AS neighborhood,
                   CASE WHEN k = 1 THEN '3' END AS bedrooms, CASE WHEN k = 1 THEN '2' END AS bathrooms, CASE WHEN k = 3 THEN p_size * 100 END::DOUBLE AS AT, CASE WHEN k = 3 THEN 'V2' END AS AT_unit, CASE WHEN k = 3 THEN 0.5 END::DOUBLE AS area,
                   CASE WHEN k = 3 THEN 'MANZANA' END AS area_unit, CASE WHEN k = 3 THEN 3493.5 END::DOUBLE AS area_m2, CASE WHEN k = 1 THEN p_size * 1000 ELSE p_size * 100 END::DOUBLE AS price, CASE WHEN k = 1 THEN 'USD' ELSE 'HNL' END AS currency, 'Rent' AS transaction,
                   CASE WHEN k = 3 THEN 'Apartment' ELSE '' END AS property_type, 'a' AS agency, '2010-01-05' AS date,
                   CASE WHEN k = 1 THEN 'CASALOMAS $ ' || p_size || ',000.00 con 3 HAB 2 BAÑOS' || CASE WHEN lead(p_partkey) OVER (PARTITION BY p_partkey // 16 ORDER BY p_partkey) IS NOT NULL OR last > p_partkey THEN ' sigue la nota' ELSE '' END
                        ELSE 'APTO PALMIRA L. ' || p_size || '00 LA V2, 1/2 MANZANA' END AS notes
            FROM (SELECT *, p_partkey % 4 AS k, max(p_partkey) OVER (PARTITION BY p_partkey // 16) AS last FROM part) WHERE k IN (1, 3)""",
        "u5_headers": """
            WITH l AS (SELECT p_partkey // 16 AS file, p_partkey AS n, ['Venta', 'VENTA', 'Lotes', 'alquiler'][(p_partkey % 4 + 1)::INTEGER] AS h FROM part),
                 f AS (SELECT file, min(n) AS n, arg_min(h, n) AS header FROM l GROUP BY file, upper(h))
            SELECT file, header, row_number() OVER (PARTITION BY file ORDER BY n) AS place FROM f""",
        "g21_scanned": """
            SELECT p_partkey, 'Casa de 3 baños, 200 vrs² y dos banos US$ 5 * ' || p_name AS scanned, 'zona ' || p_name AS zone, p_name AS agency, CASE WHEN p_size % 2 = 0 THEN round(2 / 2, 9) ELSE 0 END::DOUBLE AS score FROM part""",
        "s1_files": """SELECT p_partkey, p_name || ', "so"' || chr(10) || 'ñ' AS name, p_size AS size, 2 AS n, 'p_partkey' AS head FROM part""",
        "k4_splits": """
            WITH s AS (SELECT CASE WHEN o_totalprice < 1000 THEN 'low' WHEN o_totalprice > 100000 THEN 'high' ELSE 'other' END AS part, year(o_orderdate) AS y FROM orders),
                 c AS (SELECT part AS of, count(*) AS n FROM s GROUP BY 1 UNION ALL SELECT y::VARCHAR, count(*) FROM s WHERE y IN (1995, 1996) GROUP BY 1)
            SELECT *, (SELECT count(*) FROM orders) AS lines FROM c""",
        "k8_log": "SELECT r_name AS step, r_regionkey AS n FROM region",
        "s14_aliases": """
            SELECT p_partkey, p_name, unnest(CASE WHEN p_partkey % 3 > 0 THEN [NULL, upper(p_name), 'x', 'y'] ELSE [NULL] END) AS alias FROM part""",
        "s19_ingest": """
            SELECT p_partkey::VARCHAR AS listing, '"' || p_name || '"' AS title, p_size::DOUBLE AS price, 'HNL' AS currency, DATE '2010-01-05' AS date, NULL::INTEGER AS bedrooms, 'ocr_manual' AS source_type,
                   substr(md5(p_partkey || '| “' || p_name || '” |$ ' || p_size || '|Lps.|5/1/2010'), 1, 10) AS ingestion_id, 'v1' AS pipeline_version FROM part""",
        "j14_enrich": """
            WITH q AS (SELECT o_orderdate::DATE AS date, count(*) / 8 AS rate FROM orders WHERE o_orderdate >= TIMESTAMP '1993-01-01' GROUP BY 1),
                 r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN floor(o_totalprice) END AS price, o_orderkey % 3 = 0 AS own, o_orderdate::DATE AS day FROM orders),
                 j AS (SELECT r.*, q.date AS qd, q.rate AS qr FROM r ASOF LEFT JOIN q ON r.day >= q.date),
                 x AS (SELECT *, price IS NOT NULL AND (own OR qr IS NOT NULL) AS found FROM j)
            SELECT o_orderkey, CASE WHEN found THEN round(price::DECIMAL(18, 2) * CASE WHEN own THEN 1 ELSE qr::DECIMAL(18, 3) END, 2)::DOUBLE END AS std_price, CASE WHEN found THEN 'USD' END AS std_currency,
                   CASE WHEN found THEN CASE WHEN own THEN 1.0::DOUBLE ELSE qr END END AS fx_rate_used, CASE WHEN found THEN CASE WHEN own THEN day ELSE qd END END AS fx_base_date,
                   CASE WHEN found THEN CASE WHEN own THEN 'USD/USD' ELSE 'HNL/USD' END END AS fx_pair, CASE WHEN found THEN CASE WHEN own THEN 'parity' ELSE 'direct' END END AS fx_method, CASE WHEN found AND NOT own THEN 'bank' END AS fx_source FROM x""",
    }

"""Text, field, rule, segment and page queries over the driver's tables."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casita.functions import listing as X
from casita.functions import text as N
from casita.operators import explode, html, rules, segment
from casita.sources.tables import table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")


def _file() -> Column:
    """Documents as files of lines: a source has one for each 50 numbers, so that files stay small however large it is."""
    return F.concat_ws("/", "source", F.floor(F.col("doc_id") / 50).cast("string")).alias("file")


def n1_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded texts, by digest."""
    t = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", F.md5(N.fold_lower(t)).alias("lower"), F.md5(N.fold_upper(t)).alias("upper"), F.md5(N.fold_upper_keep_n(t)).alias("upper_n"), F.md5(N.cell(t)).alias("cell"))


def n4_join_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N4, N9, N10."""
    t = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", F.md5(N.join_key(t)).alias("key"), F.md5(N.slug(t)).alias("slug"), F.md5(N.agency_key(t)).alias("agency"))


def n5_mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts made wrong, then repaired."""
    broken = F.replace(F.replace(F.col("text"), F.lit("ñ"), F.lit("Ã±")), F.lit("ó"), F.lit("Ã³"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(N.fix_mojibake(broken)).alias("repaired"))


def n6_preclean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places dressed up with offers, prices, brackets and descriptions come back bare."""
    p = table(spark, sf_dir, "part")
    name = F.initcap("p_name")
    shown = F.get(F.array(*[F.concat(name, F.lit(s)) for s in (" - casa en venta", ": 3 hab", " (centro)", " $ 1,200", " Lps. 900 mensual", ".- amplia", " / condo bonito", "  ALQUILER")]), (F.col("p_partkey") % 8).cast("int"))
    return p.select("p_partkey", N.preclean_place(shown).alias("place"))


def n11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of benchmark items."""
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(N.label_tokens(F.col("text"), ("THE", "OF", "IN")), " ").alias("tokens"), F.array_join(N.base_tokens(F.regexp_replace("text", r"\.", " "), ("THE", "OF", "IN")), " ").alias("base"))


def n13_remove_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and phrases go from folded texts."""
    text = F.replace(N.fold_n(F.col("text")), F.lit("ß"), F.lit("ss"))
    t = N.remove_words(text, ["the", "of the", "in", "and that", "de la", "der"])
    return _docs(spark, sf_dir).select("doc_id", F.md5(t).alias("cleaned"), (t != N.squeeze(text)).alias("changed"))


def n17_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in many layouts."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    layouts = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "dd/MM/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "dd/MM/yy")
    said = F.get(F.array(*[F.date_format("o_orderdate", x) for x in layouts], F.lit("soon"), F.lit("2001-13-45")), (F.col("o_orderkey") % (len(layouts) + 2)).cast("int"))
    return o.select("o_orderkey", N.date(said).alias("date"), N.yyyymmdd(said).alias("compact"))


def n20_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in several spellings."""
    p = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("v"))
    us = F.format_number("v", 2)
    es = F.translate(us, ",.", ".,")
    plain = F.col("v").cast("string")
    return p.select("l_orderkey", "l_linenumber", X.parse_number(us).alias("us"), X.parse_number(es).alias("es"), X.locale_number(us).alias("us_locale"), X.locale_number(es).alias("es_locale"), N.amount(F.concat(F.lit("US$ -"), plain, F.lit(" only"))).alias("amount"), N.number(F.when(F.col("l_linenumber") == 1, F.concat(plain, F.lit("d"))).otherwise(plain)).alias("strict"))


def _advert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertisements written from parts: what is read from them is known."""
    p = table(spark, sf_dir, "part")
    beds, baths = (F.col("p_size") % 6).cast("int"), (F.col("p_size") % 4 + 1).cast("int")
    cents = F.format_number(F.col("p_retailprice").cast("decimal(12,2)"), 2)
    kind = F.get(F.array(F.lit("casa"), F.lit("apartamento"), F.lit("terreno"), F.lit("bodega, local comercial")), (F.col("p_partkey") % 4).cast("int"))
    text = F.concat(F.lit("Colonia "), F.initcap("p_name"), F.lit(", "), kind, F.lit(" de "), beds.cast("string"), F.lit(" hab, "), baths.cast("string"), F.lit(" baños, "), (F.col("p_size") * 3).cast("string"), F.lit(" vrs2 y "), (F.col("p_size") + 40).cast("string"), F.lit(" mt2, $ "), cents)
    return p.select("p_partkey", "p_name", "p_size", "p_retailprice", beds.alias("beds"), baths.alias("baths"), text.alias("text"), kind.alias("kind"))


def x3_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3, X4, X4e: price and currency of advertisements."""
    a = _advert(spark, sf_dir)
    p, last = X.best_price(F.col("text")), X.last_price(F.col("text"))
    return a.select("p_partkey", p.amount.alias("price"), p.currency.alias("currency"), last.amount.alias("last_price"))


def x5_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5, X6, X12, X19."""
    a = _advert(spark, sf_dir)
    t = F.col("text")
    words = F.when(F.col("beds").between(1, 5), F.regexp_replace(t, r"de \d hab", F.concat(F.lit("de "), F.get(F.array(*[F.lit(w) for w in ("cero", "una", "dos", "tres", "cuatro", "cinco")]), "beds"), F.lit(" hab")))).otherwise(t)
    return a.select("p_partkey", X.bedrooms(t).alias("bedrooms"), X.bedrooms(words).alias("bedrooms_said"), X.bathrooms(t).alias("bathrooms"), X.multi_offer(t).multi.alias("multi"))


def x7_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7, X8, N23, X17, X20."""
    a = _advert(spark, sf_dir)
    a = a.withColumn("areas", X.areas(F.col("text")))
    got, dual = F.col("areas"), X.dual_areas(F.col("text"))
    std = X.standard_area(F.lit(None).cast("double"), X.locale_number(got["at"]), got.at_unit)
    return a.select("p_partkey", got["at"].alias("at_raw"), got.at_unit.alias("at_unit"), got.ac.alias("ac"), dual.built.alias("built"), dual.land.alias("land"), F.round(std.m2, 6).alias("m2"), std.method.alias("method"))


def x11_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place by several strategies."""
    a = _advert(spark, sf_dir)
    return a.select("p_partkey", X.place(F.col("text"), "first_comma").alias("by_comma"), X.place(F.col("text"), "before_comma_or_colon", ("col",)).alias("bare"), X.place(F.concat(F.upper("p_name"), F.lit(": resto")), "uppercase").alias("upper"))


def l4_line_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks on conversation lines."""
    c = table(spark, sf_dir, "conversations")
    line = F.regexp_replace("text", r"\s+", " ")
    return c.select("conv_id", "turn", F.md5(X.mark_colon(F.concat(F.col("role"), F.lit(": "), line))).alias("colon"), F.md5(X.mark_numbered(F.concat(F.col("turn").cast("string"), F.lit(". "), line))).alias("numbered"), F.md5(X.mark_any(F.concat(F.lit("-- "), line))).alias("any"), F.md5(X.dot_to_colon(line, prefix=True)).alias("dot"))


def g1_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation as an issue: a user's line starts a listing, the system's is a header."""
    c = table(spark, sf_dir, "conversations")
    line = F.regexp_replace("text", r"\s+", " ")
    marked = F.when(F.col("role") == "system", F.concat(F.lit("#"), line)).when(F.col("role") == "user", F.concat(F.lit("* "), line)).otherwise(line)
    lines = c.select(F.col("conv_id").alias("file"), F.col("turn").alias("line_no"), marked.alias("line"))
    return segment.listings(lines, segment.literal_start(F.col("line"))).select("file", F.col("listing_no").cast("long").alias("listing_no"), "kind", F.md5("text").alias("text"))


def g15_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header context carried forward over the lines of a file: 50 numbers of a source."""
    d = _docs(spark, sf_dir).select(_file(), F.col("doc_id").alias("line_no"), "n_chars")
    head = F.when(F.col("n_chars") % 7 == 0, "# ALQUILER DE CASAS").when(F.col("n_chars") % 7 == 1, "# VENTA DE CASAS NUEVAS").when(F.col("n_chars") % 7 == 2, "# LOTES FOR SALE").otherwise(F.concat(F.lit("* item "), F.col("line_no").cast("string")))
    headers = [{"pattern": "VENTA", "transaction": "Sale"}, {"pattern": "VENTA DE CASAS", "transaction": "Sale", "type": "House"}, {"pattern": "ALQUILER DE CASAS", "transaction": "Rent", "type": "House"}]
    blocks = segment.listings(d.select("file", "line_no", head.alias("line")), segment.literal_start(F.col("line")))
    return segment.with_context(blocks, headers).select("file", "text", "transaction", "type", "category")


def g4_uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts by upper-case titles (every second of a chain of open ones is not) and by jumps in length."""
    d = _docs(spark, sf_dir).select(_file(), F.col("doc_id").alias("line_no"), "n_chars")
    line = F.when(F.col("n_chars") % 3 == 0, "RES LOMAS").when(F.col("n_chars") % 3 == 1, "COL CENTRO. casa").otherwise("casa amplia con todo lo que hace falta")
    lines = d.select("file", "line_no", line.alias("line"))
    up = segment.with_uppercase_starts(lines).select("file", "line_no", F.col("start").alias("upper_start"))
    return up.join(segment.with_ocr_starts(lines).select("file", "line_no", F.col("start").alias("ocr_start")), ["file", "line_no"])


def g11_freeform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and starts of lines of several kinds."""
    a = _advert(spark, sf_dir)
    pick = lambda *x: F.get(F.array(*[F.lit(o) if isinstance(o, str) else o for o in x]), (F.col("p_partkey") % len(x)).cast("int"))
    line = pick(F.col("text"), "VENTA DE CASAS BONITAS", "casa de 3 hab", "Tel. 2232-1234", "y con patio")
    number = F.concat(F.col("p_size").cast("string"), pick(". ", ") ", "- ", " "), F.lit("Lomas"))
    return a.select(
        "p_partkey", segment.freeform_score(line, ("col", "res")).alias("score"), segment.numbered_start(number).alias("numbered"), segment.cue_start(F.concat(pick(F.col("p_name"), "$ 5 casa", "una casa que tiene un nombre muy largo", "12 casas"), F.lit(": "), F.col("text"))).alias("cue"),
        segment.comma_or_dot_start(pick("Las Uvas, casa $ 5", "Las Uvas. Casa", "Col. Casa", "Lomas 1,200")).alias("comma"),
    )


def f14_property_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scores and decision for advertisements."""
    original = F.get(F.array(F.lit("House"), F.lit("apartment "), F.lit(None), F.lit("Land"), F.lit("dorms")), (F.col("p_size") % 5).cast("int"))
    got = rules.property_scores(_advert(spark, sf_dir), F.col("text"), original)
    return got.select("p_partkey", "property_type_new", "property_type_reason", "property_type_changed", "score_house", "score_apartment", "score_commercial", "score_land", "margin", "tie")


def f16_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: the decision table over lines."""
    item = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_suppkey", "l_partkey")
    kind = F.get(F.array(F.lit("house"), F.lit(" Apartment"), F.lit("LAND")), (F.col("l_suppkey") % 3).cast("int"))
    said = F.when(F.col("l_returnflag") == "R", "Sale").when(F.col("l_returnflag") == "A", " rent ")
    notes = F.get(F.array(F.lit("se vende ya"), F.lit("en renta"), F.lit("venta o renta"), F.lit("nada"), F.lit("rentable")), (F.col("l_partkey") % 5).cast("int"))
    price = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice") / 4)
    return item.withColumn("d", rules.transaction_decision(kind, said, notes, price)).select("l_orderkey", "l_linenumber", "d.final", "d.flag", "d.polarity", "d.source", "d.confidence")


def t1_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several offers of one advertisement."""
    p = table(spark, sf_dir, "part")
    a, b = (F.format_number((F.col("p_retailprice") * k).cast("int"), 0) for k in (1, 2))
    notes = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Torre Alfa: $ "), a, F.lit(" / "), b, F.lit("; Torre Beta: $ "), b)).otherwise(F.concat(F.lit("2, 3 hab en residencial Alfa por "), a, F.lit(", "), b, F.lit(" usd")))
    got = explode.explode_listings(p.select("p_partkey", notes.alias("notes")), "p_partkey", "notes")
    return got.select("p_partkey", "child_idx", "children_count", "child_fraction", "neighborhood", "child_bedrooms", "raw_price")


def h1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, structured data and canonical addresses of pages."""
    h = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", html.title(h).alias("title"), F.size(html.json_ld(h)).alias("n_json_ld"), F.length(h).cast("long").alias("n_chars"))


def h1_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: visible text by a parser; no SQL."""
    return html.extract_pages(table(spark, sf_dir, "pages"))


def h1_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: fields of pages by selectors."""
    p = table(spark, sf_dir, "pages")
    found = html.selected(F.col("html"), {"title": "article h1", "first": "nav ul a@href", "ad": "div.ad"})
    got = p.withColumn("x", found)
    return got.select("page_id", F.col("x")["title"].alias("title"), F.col("x")["first"].alias("first"), F.col("x")["ad"].alias("ad"))


EVERY = (
    n1_fold, n4_join_key, n5_mojibake, n6_preclean, n11_tokens, n13_remove_words, n17_dates, n20_numbers, x3_price, x5_rooms, x7_areas, x11_places, l4_line_markers, g1_listings, g15_context, g4_uppercase,
    g11_freeform, f14_property_type, f16_transaction, t1_explode, h1_pages, h1_fields, h1_visible_text,
)


def queries() -> dict:
    return {f.__name__: f for f in EVERY}


_FOLD = "translate({0}, 'áàâäãåéèêëíìîïóòôöõúùûüçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇ', 'aaaaaaeeeeiiiiooooouuuucAAAAAAEEEEIIIIOOOOOUUUUC')"
_FOLD_N = f"translate({_FOLD}, 'ñÑ', 'nN')"
_SQUEEZE = "trim(regexp_replace({0}, '[ \\t\\n\\v\\f\\r]+', ' ', 'g'))"


def _score_sql() -> str:
    """The points of the rules, as SQL over RE2."""
    q = lambda p: p.replace("'", "''")
    found = {**{k: rules._any_word(v) for k, v in rules.TERMS.items()}, **rules.PATTERNS}
    cues = ", ".join(f"regexp_matches(t, '{q(p)}') AS c_{k}" for k, p in found.items())
    prior = {"House": 6, "Apartment": 11, "Commercial": 6, "Land": 6}
    cols = []
    for i, kind in enumerate(rules.TYPES):
        own = [f"CASE WHEN c_{k} THEN {p[i]} ELSE 0 END" for k, p in rules.POINTS.items() if p[i]] + [f"CASE WHEN c_{a} AND c_{b} THEN {p[i]} ELSE 0 END" for (a, b), p in rules.JOINT_POINTS.items() if p[i]]
        own += {"House": ["CASE WHEN (c_area OR c_area_m2) AND c_house THEN 5 ELSE 0 END"], "Land": ["CASE WHEN c_area AND NOT c_house THEN 5 ELSE 0 END"]}.get(kind, [])
        first = f"(CASE WHEN o = '{kind}' THEN {prior[kind]} ELSE 0 END + CASE WHEN c_price_m2 THEN {(-5, -2, 3, 2)[i]} ELSE 0 END)"
        cols.append(f"({f'CASE WHEN c_plantel THEN 0 ELSE {first} END' if i < 2 else first} + {' + '.join(own)})::INTEGER AS score_{kind.lower()}")
    names = [f"score_{k.lower()}" for k in rules.TYPES]
    winners = "[x for x in [" + ", ".join(f"CASE WHEN {n} = best THEN '{k}' END" for n, k in zip(names, rules.TYPES, strict=True)) + "] if x IS NOT NULL]"
    return f"""
        WITH a AS ({_ADVERT}),
             b AS (SELECT p_partkey, {_SQUEEZE.format(f"lower({_FOLD_N.format('text')})")} AS t, ['House', 'Apartment', '', 'Land', 'Dorms'][p_size % 5 + 1] AS o FROM a),
             c AS (SELECT *, {cues} FROM b), s AS (SELECT *, {', '.join(cols)} FROM c),
             r AS (SELECT *, greatest({', '.join(names)}) AS best, list_sort([{', '.join(names)}])[3] AS second FROM s), w AS (SELECT *, {winners} AS w FROM r),
             d AS (SELECT *, CASE WHEN o = 'Dorms' OR best = 0 OR len(w) > 1 THEN o ELSE w[1] END AS property_type_new FROM w)
        SELECT p_partkey, property_type_new,
               CASE WHEN o = 'Dorms' THEN 'KEEP:ORIGINAL_DORMS' WHEN best = 0 THEN 'KEEP:NO_CUES' WHEN len(w) > 1 THEN 'KEEP:TIE(' || array_to_string(w, '|') || ')'
                    ELSE 'POINTS:' || w[1] || '(' || best || ')' END AS property_type_reason,
               property_type_new <> o AS property_type_changed, {', '.join(names)}, best - second AS margin, len(w) > 1 AS tie FROM d"""


_ADVERT = """
    SELECT p_partkey, p_name, p_size, p_retailprice, (p_size % 6)::INTEGER AS beds, (p_size % 4 + 1)::INTEGER AS baths,
           'Colonia ' || array_to_string([upper(x[1]) || x[2:] for x in string_split(p_name, ' ')], ' ') || ', ' || ['casa', 'apartamento', 'terreno', 'bodega, local comercial'][(p_partkey % 4 + 1)::INTEGER]
           || ' de ' || (p_size % 6) || ' hab, ' || (p_size % 4 + 1) || ' baños, ' || (p_size * 3) || ' vrs2 y ' || (p_size + 40) || ' mt2, $ ' || format('{:,.2f}', p_retailprice) AS text FROM part"""


def oracle_sql() -> dict[str, str]:
    initcap = "array_to_string([upper(x[1]) || x[2:] for x in string_split(p_name, ' ')], ' ')"
    folded = f"upper(replace({_FOLD_N.format('text')}, 'ß', 'ss'))"
    label = lambda x: _SQUEEZE.format(f"regexp_replace(regexp_replace({x}, '[ \\t\\n,;:/|\\-]*$', ''), '[^A-Z0-9_\\s.]', ' ', 'g')")
    kept = "x <> '' AND x NOT IN ('THE', 'OF', 'IN')"
    words = f"[x for x in string_split({label(folded)}, ' ') if {kept} AND NOT regexp_full_match(x, '[0-9]+')]"
    dotless = "replace(text, '.', ' ')"
    base = f"[x for x in string_split({label(folded.replace('(text', '(' + dotless))}, ' ') if {kept} AND (length(x) > 1 OR regexp_full_match(x, '[0-9]'))]"
    repaired = "replace(replace(text, 'ñ', 'Ã±'), 'ó', 'Ã³')"
    for bad, good in (("√±", "ñ"), ("√ë", "Ñ"), ("Ã±", "ñ"), ("Ã‘", "Ñ"), ("Ã¡", "á"), ("Ã©", "é"), ("Ãí", "í"), ("Ã³", "ó"), ("Ãú", "ú"), ("ÃÁ", "Á"), ("Ã‰", "É"), ("ÃÍ", "Í"), ("Ã“", "Ó"), ("Ãš", "Ú"), ("Â", "")):
        repaired = f"replace({repaired}, '{bad}', '{good}')"
    plain = lambda x: f"nullif(trim(regexp_replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '\\s+', ' ', 'g')), '')"
    decision = """
        WITH l AS (SELECT l_orderkey, l_linenumber, ['HOUSE', 'APARTMENT', 'LAND'][(l_suppkey % 3 + 1)::INTEGER] AS k, CASE l_returnflag WHEN 'R' THEN 'SALE' WHEN 'A' THEN 'RENT' END AS said,
                          ['SALE', 'RENT', NULL, NULL, NULL][(l_partkey % 5 + 1)::INTEGER] AS noted, CASE WHEN l_linenumber <> 7 THEN l_extendedprice / 4 END AS price FROM lineitem),
             h AS (SELECT *, coalesce(said, noted) AS hint, price <= CASE k WHEN 'HOUSE' THEN 20000 ELSE 10000 END AS rent_ok, price >= 15000 AS sale_ok,
                          CASE WHEN k = 'LAND' THEN 1 WHEN price IS NULL OR price < CASE k WHEN 'HOUSE' THEN 60 ELSE 50 END THEN 2 END AS stop FROM l),
             r AS (SELECT *, coalesce(stop, CASE WHEN hint = 'RENT' AND rent_ok OR hint = 'SALE' AND sale_ok THEN 3 WHEN hint = 'SALE' AND rent_ok THEN 4 WHEN hint = 'RENT' AND sale_ok THEN 5 ELSE 6 END) AS rule FROM h)
        SELECT l_orderkey, l_linenumber, CASE rule WHEN 3 THEN hint WHEN 4 THEN 'RENT' WHEN 5 THEN 'SALE' END AS final,
               ['FLAG_OUT_OF_SCOPE', 'REMOVED_INVALID_PRICE', 'OK_DECLARED', 'CORRECTED_PRICE_BOUNDARY', 'CORRECTED_PRICE_BOUNDARY', 'REMOVED_PRICE_OUT_OF_RANGE'][rule] AS flag,
               CASE WHEN rule IN (3, 4, 5) THEN 'POSITIVE' ELSE 'NEGATIVE' END AS polarity,
               CASE rule WHEN 1 THEN 'scope' WHEN 2 THEN 'price_min' WHEN 3 THEN CASE WHEN said IS NOT NULL THEN 'declared' ELSE 'notes' END ELSE 'price+ptype' END AS source,
               CASE WHEN rule < 3 THEN 'NONE' WHEN rule = 3 AND said IS NULL THEN 'MEDIUM' ELSE 'HIGH' END AS confidence FROM r"""
    return {
        "n1_fold": f"""
            SELECT doc_id, md5({_SQUEEZE.format(f"lower({_FOLD_N.format('text')})")}) AS lower, md5(upper(replace({_FOLD_N.format('text')}, 'ß', 'ss'))) AS upper, md5(upper(replace({_FOLD.format('text')}, 'ß', 'ss'))) AS upper_n,
                   md5({_SQUEEZE.format('lower(text)')}) AS cell FROM documents""",
        "n4_join_key": f"""
            WITH s AS (SELECT doc_id, regexp_replace(lower(trim(text)), '[^a-z0-9]+', '-', 'g') AS s, text FROM documents)
            SELECT doc_id, md5({_SQUEEZE.format("regexp_replace(upper(replace(" + _FOLD_N.format('text') + ", 'ß', 'ss')), '[^A-ZÑ0-9\\s/.\\-&'']', ' ', 'g')")}) AS key, md5(coalesce(nullif(trim(s, '-'), ''), 'na')) AS slug,
                   md5(regexp_replace(lower({_FOLD_N.format('text')}), '[^a-z0-9]', '', 'g')) AS agency FROM s""",
        "n5_mojibake": f"SELECT doc_id, md5({repaired}) AS repaired FROM documents",
        "n6_preclean": "SELECT p_partkey, upper(p_name) AS place FROM part",
        "n11_tokens": f"""
            WITH w AS (SELECT item_id, {words} AS w, {base} AS b FROM benchmark)
            SELECT item_id, array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ') AS tokens, array_to_string(list_sort(list_distinct(b)), ' ') AS base FROM w""",
        "n13_remove_words": f"""
            WITH f AS (SELECT doc_id, replace({_FOLD_N.format('text')}, 'ß', 'ss') AS x FROM documents),
                 c AS (SELECT doc_id, {_SQUEEZE.format("regexp_replace(x, '(?i)\\b(and[\\s,.]*that|of[\\s,.]*the|de[\\s,.]*la|der|the|in)\\b', '', 'g')")} AS t, {_SQUEEZE.format('x')} AS s FROM f)
            SELECT doc_id, md5(t) AS cleaned, t <> s AS changed FROM c""",
        "n17_dates": """
            SELECT o_orderkey, CASE WHEN o_orderkey % 9 < 7 THEN o_orderdate::DATE END AS date,
                   CASE WHEN o_orderkey % 9 = 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE '00000000' END AS compact FROM orders""",
        "n20_numbers": """
            WITH p AS (SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2)::DECIMAL(12, 2)::DOUBLE AS v FROM lineitem)
            SELECT l_orderkey, l_linenumber, v AS us, v AS es, v AS us_locale, v AS es_locale, -v AS amount, CASE WHEN l_linenumber <> 1 THEN v END AS strict FROM p""",
        "x3_price": "SELECT p_partkey, round(p_retailprice, 2) AS price, 'USD' AS currency, round(p_retailprice, 2) AS last_price FROM part",
        "x5_rooms": "SELECT p_partkey, (p_size % 6)::INTEGER AS bedrooms, (p_size % 6)::INTEGER AS bedrooms_said, (p_size % 4 + 1)::DOUBLE AS bathrooms, false AS multi FROM part",
        "x7_areas": """
            SELECT p_partkey, (p_size * 3)::VARCHAR AS at_raw, 'vrs2' AS at_unit, (p_size + 40)::VARCHAR AS ac, (p_size + 40)::DOUBLE AS built, (p_size * 3)::DOUBLE AS land,
                   round(p_size * 3 * 0.6987::DOUBLE, 6) AS m2, 'terrain_vara_to_m2' AS method FROM part""",
        "x11_places": f"SELECT p_partkey, 'COL ' || {initcap} AS by_comma, {initcap} AS bare, upper(p_name) AS upper FROM part",
        "l4_line_markers": f"""
            WITH l AS (SELECT conv_id, turn, role, regexp_replace(text, '[ \\t\\n\\v\\f\\r]+', ' ', 'g') AS line FROM conversations),
                 d AS (SELECT *, ltrim(line, ' ') AS t, strpos(ltrim(line, ' '), '.') AS dot_at FROM l),
                 c AS (SELECT *, CASE WHEN dot_at BETWEEN 6 AND 31 AND NOT regexp_matches(substr(t, 1, dot_at + 2), '(?i)US\\$|USD|\\$|(?:^|[^\\p{{L}}])L(?:PS?)?(?:[^\\p{{L}}]|$)') THEN substr(t, 1, dot_at - 1) || ':' || substr(t, dot_at + 1) ELSE t END AS dotted FROM d)
            SELECT conv_id, turn, md5('* ' || role || ': ' || line) AS colon,
                   md5(CASE WHEN regexp_matches(line, '^\\s*\\p{{L}}') THEN '* ' || ltrim(line, ' ') ELSE turn || '. ' || line END) AS numbered,
                   md5(CASE WHEN regexp_matches(line, '[^ ]') THEN '* ' || ltrim(line, ' ') ELSE '-- ' || line END) AS any,
                   md5(CASE WHEN starts_with(dotted, '*') THEN dotted ELSE '* ' || dotted END) AS dot FROM c""",
        "g1_listings": """
            WITH l AS (SELECT conv_id AS file, turn, role, trim(CASE role WHEN 'system' THEN '#' WHEN 'user' THEN '* ' ELSE '' END || regexp_replace(text, '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) AS line FROM conversations),
                 b AS (SELECT *, sum(CASE WHEN role IN ('system', 'user') THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY turn) AS block FROM l),
                 t AS (SELECT file, block, arg_min(role, turn) AS first, CASE WHEN arg_min(role, turn) = 'system' THEN arg_min(line, turn) ELSE string_agg(line, ' ' ORDER BY turn) END AS text
                       FROM b WHERE block > 0 AND line <> '' GROUP BY 1, 2)
            SELECT file, row_number() OVER (PARTITION BY file ORDER BY block) AS listing_no, CASE WHEN first = 'system' THEN 'header' ELSE 'listing' END AS kind, md5(text) AS text FROM t""",
        "g15_context": """
            WITH l AS (SELECT concat_ws('/', source, (doc_id // 50)::VARCHAR) AS file, doc_id, n_chars % 7 AS k FROM documents),
                 c AS (SELECT *, CASE k WHEN 0 THEN 'Rent' WHEN 1 THEN 'Sale' WHEN 2 THEN 'venta' END AS tx, CASE WHEN k < 2 THEN 'House' END AS ty,
                              CASE k WHEN 0 THEN 'ALQUILER DE CASAS' WHEN 1 THEN 'VENTA DE CASAS' WHEN 2 THEN 'LOTES FOR SALE' END AS ca FROM l),
                 f AS (SELECT file, doc_id, k, last_value(tx IGNORE NULLS) OVER w AS transaction, last_value(ty IGNORE NULLS) OVER w AS type, last_value(ca IGNORE NULLS) OVER w AS category
                       FROM c WINDOW w AS (PARTITION BY file ORDER BY doc_id ROWS UNBOUNDED PRECEDING))
            SELECT file, '* item ' || doc_id AS text, transaction, type, category FROM f WHERE k > 2""",
        "g4_uppercase": """
            WITH l AS (SELECT concat_ws('/', source, (doc_id // 50)::VARCHAR) AS file, doc_id AS line_no, n_chars % 3 AS k FROM documents),
                 p AS (SELECT *, lag(k) OVER (PARTITION BY file ORDER BY line_no) AS before FROM l),
                 j AS (SELECT *, k < 2 AND coalesce(before = 0, false) AS joined FROM p),
                 c AS (SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY file ORDER BY line_no) AS chain FROM j),
                 r AS (SELECT *, row_number() OVER (PARTITION BY file, chain ORDER BY line_no) AS place FROM c)
            SELECT file, line_no, k < 2 AND NOT (joined AND place % 2 = 0) AS upper_start, k = 2 AND coalesce(before < 2, true) AS ocr_start FROM r""",
        "g11_freeform": """
            SELECT p_partkey, [7, 2, 1, 2, 0][(p_partkey % 5 + 1)::INTEGER] AS score, p_partkey % 4 < 2 AS numbered, p_partkey % 4 = 0 AS cue, p_partkey % 4 < 2 AS comma FROM part""",
        "f14_property_type": _score_sql(),
        "f16_transaction": decision,
        "t1_explode": """
            WITH p AS (SELECT p_partkey, format('{:,}', p_retailprice::DECIMAL(18, 6)::DOUBLE::BIGINT) AS unused, format('{:,}', trunc(p_retailprice)::BIGINT) AS a, format('{:,}', trunc(p_retailprice * 2)::BIGINT) AS b FROM part),
                 c AS (SELECT p_partkey, 'Torre Alfa' AS neighborhood, NULL::INTEGER AS child_bedrooms, '$ ' || a AS raw_price FROM p WHERE p_partkey % 2 = 0
                       UNION ALL SELECT p_partkey, 'Torre Alfa', NULL, '$ ' || b FROM p WHERE p_partkey % 2 = 0
                       UNION ALL SELECT p_partkey, 'Torre Beta', NULL, '$ ' || b FROM p WHERE p_partkey % 2 = 0
                       UNION ALL SELECT p_partkey, 'Alfa por', 2, '$ ' || a FROM p WHERE p_partkey % 2 = 1
                       UNION ALL SELECT p_partkey, 'Alfa por', 3, '$ ' || b FROM p WHERE p_partkey % 2 = 1),
                 r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY replace(replace(raw_price, ' ', ''), ',', ''), child_bedrooms, neighborhood)::INTEGER AS child_idx,
                              count(*) OVER (PARTITION BY p_partkey)::INTEGER AS children_count FROM c)
            SELECT p_partkey, child_idx, children_count, child_idx || '/' || children_count AS child_fraction, neighborhood, child_bedrooms, raw_price FROM r""",
        "h1_fields": f"""
            WITH p AS (SELECT page_id, regexp_extract(html, '(?s)<article>.*?<h1>(.*?)</h1>', 1) AS title, regexp_extract(html, '(?s)<nav>.*?<a href="([^"]*)"', 1) AS first, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS ad FROM pages)
            SELECT page_id, {plain('title')} AS title, {plain('first')} AS first, {plain('ad')} AS ad FROM p""",
        "h1_pages": """
            SELECT page_id, nullif(trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', ' ', 'g'), '&nbsp;|&#160;', ' ', 'g'), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS title,
                   len(regexp_extract_all(html, '(?is)<script[^>]*application/ld\\+json[^>]*>'))::INTEGER AS n_json_ld, length(html) AS n_chars FROM pages""",
    }



"""Scalars on tables of cases, nulls included."""

import datetime

import pytest
from pyspark.sql import functions as F

from casita.functions import listing as X
from casita.functions import text as N
from casita.operators import aggregate, candidates, config, dedup, explode, fuzzy, lookup, rules, segment, unmarked


def run(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


CASES = {
    "parse_number": (X.parse_number, {"600,5": 600.5, "1,200,000": 1200000.0, "800,1000": None, "1.200,50": 1200.5, "1,200.50": 1200.5, "500.000": 500000.0, "1.5": 1.5, "": None, None: None}),
    "locale_number": (X.locale_number, {"170,000": 170000.0, "1,200.50": 1200.5, "1.200,50": 1200.5, "2,5": 2.5, "1.200": 1200.0, None: None}),
    "close_digit_runs": (X.close_digit_runs, {"1, 000": "1,000", "650 ,000": "650,000"}),
    "mark_any": (X.mark_any, {"-- Casa amplia": "* Casa amplia", "Casa 2-3 hab": "Casa 2-3 hab"}),
    "unit_token": (X.unit_token, {"vrs ²": "vrs2", "metros cuadrados": "metroscuadrados", None: None}),
    "bedrooms": (X.bedrooms, {"3 hab": 3, "tres habitaciones": 3, "beds=4": 4, "3H amplia": 3, "dormitorios: 2": 2, "3/2": 3, "9 hab": None, "casa": None, None: None}),
    "bathrooms": (X.bathrooms, {"casa de 2 baños": 2.0, "3/2": 2.0, "2 baños y medio": 2.5, "½ baño": 0.5, "sin datos": None, None: None}),
    "slug": (N.slug, {" Casa Mágica ": "casa-m-gica", "": "na", None: "na"}),
    "number": (N.number, {"5d": None, "inf": None, "nan": None, "-1.5": -1.5, " 7 ": 7.0, None: None}),
    "amount": (N.amount, {"US$ -1,200.50": -1200.5, "L. ": None, None: None}),
    "date": (N.date, {"2010-03-12": datetime.date(2010, 3, 12), "12/03/2010": datetime.date(2010, 3, 12), "12 03 69": datetime.date(2069, 3, 12), "2001-13-45": None, None: None}),
    "yyyymmdd": (N.yyyymmdd, {"2010-03-12": "20100312", "12/03/2010": "00000000", None: "00000000"}),
    "currency": (N.currency, {"lempiras": "HNL", "$": "USD", "eur": "EUR", "?": None, None: None}),
    "preclean": (N.preclean_place, {"BLVD MORAZAN frente a": "BLVD MORAZAN", "Col. Lomas: casa": "COL. LOMAS", "Lomas (centro) x": "LOMAS", "Lomas $ 1,200": "LOMAS", None: ""}),
    "fold_upper_keep_n": (N.fold_upper_keep_n, {"Año é": "AÑO E", None: None}),
    "null_text": (N.null_text, {"nan": None, "NONE": None, " ": None, "x": "x"}),
    "date_from_name": (dedup.date_from_name, {"qs_20201025.csv": datetime.date(2020, 10, 25), "none.csv": None}),
    "place": (lambda c: X.place(c, "first_comma"), {"* Colonia Lomas, casa": "COL Lomas", "Centro de Aldea, x": "Centro de Aldea"}),
    "ocr": (X.normalize_ocr, {"3 banos  65 m2, $480": "3 baños 65 m², $ 480", None: ""}),
    "price": (lambda c: X.price(c).amount, {"$480 mensuales": 480.0, "precio $66,000": 66000.0, "L. 1.5 millones": 1500000.0, "nada": None, None: None}),
    "best_price": (lambda c: X.best_price(c).amount, {"$ 900 por m2, total $ 90,000": 90000.0}),
    "bedrooms_bucket": (lambda c: aggregate.bedrooms_bucket(c.cast("double")), {"0": "0", "4": "4", "7": "5+", "-1": None, None: None}),
    "upper_star": (X.upper_star, {"* RES LOMAS casa": "* RES LOMAS casa", "* casa amplia": "casa amplia"}),
    "offers": (explode.offers, {"$ 900 / 1,200": ["$ 900", "$ 1,200"], "900 / 1,200": [], "$ 900 casa 3": ["$ 900"]}),
    "price_token": (explode.price_token, {"$ 1,800.00": "$1800", "L. 1,400,000": "l1400000"}),
    "is_no": (rules.is_no, {"False": True, "0": True, "yes": False, None: False}),
    "cue": (segment.cue_start, {"Centro: casa": True, "$ 900: x": False, None: None}),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_cases(spark, name):
    f, cases = CASES[name]
    assert run(spark, f, list(cases)) == list(cases.values())


def test_half_even(spark):
    assert run(spark, N.half_even, [0.125, 2.675, None], "double") == [0.12, 2.68, None]


def test_areas(spark):
    pick = lambda r: {k: v for k, v in r.asDict().items() if v is not None}
    got = run(spark, X.areas, ["500 vrs2 y 120 mt2", "65 m2 solo", "terreno de 300 m2", "2 manzanas", "casa 90 m2, lote 200 vrs2", None])
    assert [pick(r) for r in got] == [
        {"at": "500", "at_unit": "vrs2", "ac": "120", "ac_unit": "mt2"},
        {"area": "65", "area_unit": "m2"},
        {"at": "300", "at_unit": "m2"},
        {"mz": "2", "mz_unit": "manzanas"},
        {"at": "200", "at_unit": "vrs2", "ac": "90", "ac_unit": "m2"},
        {},
    ]


def test_scores(spark):
    rows = [
        ("Centro, apartamento 2 hab 1 baño, 65 m2, balcón pequeño, sin garaje, ambiente tranquilo, $480", "House"),
        ("nada", "Land"),
        ("en dorms", "dorms"),
        ("casa en obra gris", "House"),
        ("casa apartamento", ""),
        ("plantel con bodega", "House"),
        (None, None),
    ]
    got = rules.property_scores(spark.createDataFrame(rows, "t string, o string"), F.col("t"), F.col("o")).collect()
    assert [got[0][f"score_{k.lower()}"] for k in rules.TYPES] == [13, 22, -6, -15]
    assert [r.property_type_reason for r in got] == ["POINTS:Apartment(22)", "POINTS:Land(6)", "KEEP:ORIGINAL_DORMS", "KEEP:PARTIAL_CONSTRUCTION", "KEEP:TIE(House|Apartment)", "POINTS:Commercial(18)", "KEEP:NO_CUES"]
    assert got[0].margin == 9


def test_transaction(spark):
    rows = [("House", "Sale", "", 90_000.0), ("House", "Sale", "", 500.0), ("House", None, "se alquila", 500.0), ("Land", "Sale", "", 9.0), ("House", "Rent", "", None), ("Apartment", "Rent", "", 12_000.0), ("House", None, "venta o renta", 500.0)]
    df = spark.createDataFrame(rows, "p string, d string, n string, x double")
    got = [tuple(r[0]) for r in df.select(rules.transaction_decision(F.col("p"), F.col("d"), F.col("n"), F.col("x"))).collect()]
    assert [g[:2] for g in got] == [("SALE", "OK_DECLARED"), ("RENT", "CORRECTED_PRICE_BOUNDARY"), ("RENT", "OK_DECLARED"), (None, "FLAG_OUT_OF_SCOPE"), (None, "REMOVED_INVALID_PRICE"), (None, "REMOVED_PRICE_OUT_OF_RANGE"), (None, "REMOVED_PRICE_OUT_OF_RANGE")]
    assert got[2][3:] == ("notes", "MEDIUM")


def test_listing_key_counts_null_numbers_as_nan(spark):
    import hashlib

    df = spark.createDataFrame([("Río ", "Centro", 2, None, None, None, 480.0, "Rent")], "title string, neighborhood string, bedrooms int, bathrooms double, area_m2 double, AT string, price double, transaction string")
    got = df.select(dedup.listing_key({c: F.col(c) for c in df.columns}, F.lit("2010-03"))).first()[0]
    assert got == hashlib.md5(b"rio|centro|2|nan|nan|nan|480.0|rent|2010-03").hexdigest()


def test_config():
    a, b = {"x": {"y": [1, 2]}, "z": "Q"}, {"x": {"y": [1, 3]}, "z": "Q"}
    assert config.flatten(a) == {"x.y[0]": 1, "x.y[1]": 2, "z": "Q"}
    assert config.common_config([a, b], 0.9) == {"x.y[0]": 1, "z": "Q"}
    assert config.overrides(a, config.common_config([a, b], 0.9)) == {"x.y[1]": 2}
    assert config.infer_schema([a]) == {"x.y[]": "int", "z": "str"}
    assert config.matrix({"a": a}, include="z", transforms={"z": "lower"}) == [{"config": "a", "z": "q"}]
    assert config.merge_aliases([{"$": "USD"}, {"$": "X", "L": "HNL"}]) == {"$": "USD", "L": "HNL"}
    assert config.column_list("a, b") == ["a", "b"]
    assert config.guess_header("＃ALQUILER DE CASAS")["transaction"] == "Rent"
    assert config.mnemonics([{"agency": "Acme", "nemonic": " acm"}]) == {"Acme": "acm"}


def test_long_cells_do_not_recurse(spark):
    """Cells of 100,000 characters pass every pattern that reads up to a mark."""
    long = "Colonia " + "x y" * 33_000
    df = spark.createDataFrame([(long,), (long + " $ 5 resto",)], "v string")
    got = df.select(
        F.length(N.preclean_place(F.col("v"))).alias("a"), F.length(X.before_currency(F.col("v"))).alias("b"), F.length(X.place(F.col("v"), "before_currency", span=200_000)).alias("c"),
        F.length(X.colon_after_upper(F.upper("v"))).alias("d"), F.length(X.colon_before_currency(F.col("v"))).alias("e"),
    ).collect()
    assert [r.b for r in got] == [len(long)] * 2 and all(r.a > 90_000 for r in got) and got[1].e > got[0].e


def test_numbers_by_their_separators(spark):
    want = {"1,234.5": 1234.5, "1.234,5": 1234.5, "12,": 12.0, "1.234.56": 1234.56, "1.234.5678": 12345678.0, "12.500": 12500.0, "12.50": 12.5, "1,2,3": 123.0, "(5": -5.0, "(5)": None, "- 7": -7.0, "1 200,50": 1200.5, "x": None}
    assert run(spark, X.parse_number, list(want)) == list(want.values())
    other = {"1,234": 1234.0, "1,2,3": None, "12.50": 12.5, "1.234.567": 1234567.0, "5": 5.0, "": None}
    assert run(spark, X.locale_number, list(other)) == list(other.values())
    plain = {"45,000": 45.0, "45.000": 45.0, "45,000.50": 45000.5, "1.2.3": 123.0, None: None}
    assert run(spark, X.price_number, list(plain)) == list(plain.values())


def test_roles_of_equal_rows(spark):
    """Of rows equal in all columns one is canonical; rows without a date come last."""
    rows = [("k", None, 1), ("k", "2010", 2), ("k", "2010", 2), ("j", "2011", 3), (None, "2012", 4)]
    df = spark.createDataFrame(rows, "key string, day string, n int")
    got = sorted(((r.key or "", r.day or "", r.n, r.group_id, r.role) for r in dedup.with_roles(df, "key", [F.col("day"), F.col("n")]).collect()))
    assert [(k, d, n, role) for k, d, n, _, role in got] == [("", "2012", 4, "CANONICAL"), ("j", "2011", 3, "CANONICAL"), ("k", "", 1, "DUPLICATE"), ("k", "2010", 2, "CANONICAL"), ("k", "2010", 2, "DUPLICATE")]
    assert len({(k, g) for k, _, _, g, _ in got}) == 3


def test_long_aliases_and_linkage_in_both_directions(spark):
    texts = spark.createDataFrame([("casa en residencial las lomas del norte alto, piso 2",), ("nada",)], "t string")
    aliases = spark.createDataFrame([(0, "las lomas del norte alto"), (1, "nada mas")], "ord int, alias string")
    assert {r.t[:4]: r.alias_ord for r in lookup.contained_alias(texts, "t", aliases).collect()} == {"casa": 0, "nada": None}
    a = spark.createDataFrame([(0, "LOMAS VERDES"), (1, "JARDIN CENTRAL")], "idx int, name string")
    b = spark.createDataFrame([(0, "VERDES LOMAS"), (1, "CENTRAL JARDIN"), (2, "OTRA")], "idx int, name string")
    got = {(r.a_name, r.b_name): r.decision for r in fuzzy.link_records(a, b).collect()}
    assert got[("LOMAS VERDES", "VERDES LOMAS")] == "auto" and got[(None, "OTRA")] == "no_match"


def test_places_by_strategy_catalog_and_heads(spark):
    catalog = [("Lomas del Guijarro", ["guijarro"]), ("Palmira", [])]
    f = lambda c: candidates.match_place(c, catalog)
    assert run(spark, f, ["apto en El Guijarro, $ 5", "PALMIRA: casa", "bonita Col. Miramonte", "casa", None]) == ["LOMAS DEL GUIJARRO", "PALMIRA", "COL. MIRAMONTE", "", ""]


def test_masquerade_and_unmarked_lines(spark):
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(["orphan", "# VENTA", "Res. Las Uvas, casa", "Lps. 5,000", "$ 7", "Palmira Norte sin precio", "# RENTA", "y lote a $ 5 en Miramar"])], "file string, line_no int, line string")
    got = [(r.kind, r.text, r.line_numbers) for r in unmarked.unmarked_listings(lines).orderBy("block_no").collect()]
    assert got == [("header", "# VENTA", [1]), ("listing", "Res. Las Uvas, casa Lps. 5,000 $ 7", [2, 3, 4]), ("header", "# RENTA", [6]), ("listing", "y lote a $ 5 en Miramar", [7])]
    assert segment.decode_cue("cue:comma") == "," and segment.decode_cue(":") == ":"
    with pytest.raises(ValueError):
        segment.decode_cue("CUE:X")


def test_fields_keep_references_without_a_semicolon(spark):
    from casita.operators import html

    page = '<!-- <script> & --><article><h1>a &amp;&lt; b&amp</h1><p id="x" title="?a=1&copy=2">&#233;&#xE9; &eacute; &copy 1 & 2</p></article><script>if (a && b) {}</script>'
    got = run(spark, lambda c: html.selected(c, {"title": "h1", "p": "p", "at": "p@title", "code": "script"}), [page])[0]
    assert got == {"title": "a &< b&amp", "p": "éé é &copy 1 & 2", "at": "?a=1&copy=2", "code": "if (a && b) {}"}


def test_linkage_meets_what_a_plain_comparison_meets(spark):
    """Pairs of at least 0.8 among all pairs are those met by rare tokens and substrings; rows repeated are linked once each."""
    import random

    rng = random.Random(8)
    name = lambda: " ".join(rng.choice(["ALTO", "LOMAS", "SAN", "RIO", "SANTA", "VERDE", str(rng.randrange(10, 400))]) for _ in range(rng.randrange(1, 5)))
    side = lambda n: spark.createDataFrame([(i, name()) for i in range(n)], "idx int, name string")
    a, b = side(80), side(120)
    met = lambda df: {(r.a_idx, r.b_idx): (round(r.score, 9), r.for_a, r.for_b) for r in df.where("score >= 0.8").collect()}
    got = met(fuzzy.pair_scores(a, b, 0.8))
    assert got == met(fuzzy.pair_scores(a, b)) and len(got) > 20
    twice = spark.createDataFrame([(1, "LOMAS VERDES"), (1, "LOMAS VERDES")], "idx int, name string")
    assert sorted(r.b_idx for r in fuzzy.link_records(twice, twice).collect()) == [1, 1]

"""The fourteen steps over a small issue, files in and out, streams."""

import datetime

import pytest
from pyspark.sql import functions as F

from casita.operators import dedup, fuzzy, lookup, rules, segment
from casita.operators.explode import explode_listings
from casita.plans.listings import Context, Pipeline
from casita.sources import files
from casita.streaming import incremental

ISSUE = """prelude that no one needs
#ALQUILER DE CASAS
* Centro de Aldea, apartamento 2 hab 1 baño, 65 m2, balcón pequeño, sin garaje, $480 mensuales
* Barrio Bolsa, casa de 2 habitaciones,
  1 baño, 120 m2, patio frontal, L. 12,000 al mes

#VENTA DE CASAS
* Centro de Aldea, casa de 3 hab 2 baños, 140 m2, patio, precio $112,000
* Lejos, casa de 3 hab 2 baños, 140 m2, patio, precio $90,000
* Barrio Bolsa, casa sin precio
"""


@pytest.fixture(scope="module")
def results(spark):
    issues = spark.createDataFrame([("aldea_20100312.txt", "Aldea", datetime.date(2010, 3, 12), ISSUE)], "file string, agency string, date date, value string")
    catalog = spark.createDataFrame([(0, "Centro de Aldea", "old", "G0", "Old"), (1, "centro de aldea ", "U1", "G1", "Centro"), (2, "BO BOLSA", "U2", "G2", "Bolsa")], "ord int, alias string, uid string, GISID string, label string")
    rates = spark.createDataFrame([("2010-03", "HNL", "USD", 0.05)], "year_month string, base string, quote string, rate double")
    context = Context(mnemonics=spark.createDataFrame([("aldea", "ald")], "key string, mnemonic string"), catalog=catalog, rates=rates, min_n=1, remove=["sin garaje"])
    return Pipeline().run(issues, context)


def test_parse(results):
    got = {r.listing_id: r for r in results["parse"].main.collect()}
    assert sorted(got) == [2, 3, 5, 6, 7]
    a = got[2]
    assert (a.neighborhood, a.bedrooms, a.bathrooms, a.area, a.area_unit, a.price, a.currency, a.transaction, a.property_type) == ("Centro de Aldea", 2, 1.0, "65", "m²", 480.0, "USD", "Rent", "House")
    assert a.title == "Centro de Aldea, apartamento 2 hab 1 baño, 65 m², balcón peq"
    assert (got[3].price, got[3].currency, got[3].area) == (12000.0, "HNL", "120")
    assert got[7].price is None and got[5].transaction == "Sale"


def test_steps(results):
    assert results["deduplicate"].sides["duplicates"].count() == 0
    uids = sorted(r.listing_uid for r in results["uid"].main.select("listing_uid").collect())
    assert uids == [f"ald-20100312-000{k}" for k in range(1, 6)]
    assert results["uid"].sides["without_mnemonic"].count() == 0
    types = {r.listing_id: r.property_type_reason for r in results["ptype_fix"].main.select("listing_id", "property_type_reason").collect()}
    assert types[2].startswith("POINTS:Apartment")
    assert [r.causes for r in results["filter_records"].sides["rejected"].collect()] == ["no_price;"]
    places = {r.listing_id: (r.neighborhood_uid, r.matched) for r in results["gis_match"].main.select("listing_id", "neighborhood_uid", "matched").collect()}
    assert places == {2: ("U1", True), 3: ("U2", True), 5: ("U1", True), 6: (None, False)}


def test_results(results):
    got = {r.listing_id: (r.price_usd, r.transaction_flag) for r in results["area_standardize"].main.select("listing_id", "price_usd", "transaction_flag").collect()}
    assert got == {2: (480.0, "OK_DECLARED"), 3: (600.0, "OK_DECLARED"), 5: (112000.0, "OK_DECLARED")}


def test_order_of_steps():
    with pytest.raises(ValueError):
        Pipeline(["merge", "parse"])
    with pytest.raises(ValueError):
        Pipeline(["cook"])


def test_cascade(spark):
    g = spark.createDataFrame([(1, 0, "Lomas del Valle", None), (2, 1, "Miraflores Norte", None), (2, 1, "Miraflores Norte", "Mira")], "gid int, ord int, glabel string, alias string")
    names = spark.createDataFrame([(n,) for n in ("LOMAS DEL VALLE", "mira", "Miraflores Nort", "Norte Miraflores", "Otro", None)], "name string")
    got = {r.name: (r.gid, r.method) for r in fuzzy.match_cascade(names, "name", g).collect()}
    assert got == {"LOMAS DEL VALLE": (1, "exact"), "mira": (2, "alias_exact"), "Miraflores Nort": (2, "prefix_name"), "Norte Miraflores": (2, "token_jaccard"), "Otro": (None, "none"), None: (None, "none")}


def test_linkage(spark):
    a = spark.createDataFrame([(1, "Lomas del Valle"), (2, "Miraflores"), (3, "Zeta")], "idx int, name string")
    b = spark.createDataFrame([(1, "Valle Lomas del"), (2, "Miraflorez"), (3, "Omega")], "idx int, name string")
    got = {(r.a_idx, r.b_idx): r.decision for r in fuzzy.link_records(a, b).collect()}
    assert got[(1, 1)] == "auto" and (3, None) in got and (None, 3) in got


def test_linkage_reads_whole_tables(spark, sf_dir):
    from casita.plans.joins import j10_link_records

    got = j10_link_records(spark, sf_dir).collect()
    keys = lambda t, k: {r[0] for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select(k).collect()}
    assert {r.a_idx for r in got} - {None} == keys("supplier", "s_suppkey")
    assert {r.b_idx for r in got} - {None} == keys("customer", "c_custkey")


def test_linkage_of_high_numbers(spark, tmp_path):
    from casita.plans.joins import j10_link_records

    spark.createDataFrame([(k, f"Supplier#{k:09d}") for k in (7, 150)], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, f"Customer#{k:09d}") for k in (7, 150, 900)], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    got = {(r.a_idx, r.b_idx): r.decision for r in j10_link_records(spark, str(tmp_path)).collect()}
    assert got == {(7, 7): "auto", (150, 150): "auto", (None, 900): "no_match"}


def test_explode(spark):
    notes = ["Torre Alfa: $ 900 / 1,200 / 1,500; Torre Beta: $ 700", "Uno: $ 100 / L. 2,000", "nada", None, "2, 3 hab en Lomas por 400 y 500 usd"]
    got = explode_listings(spark.createDataFrame(list(enumerate(notes)), "id int, notes string"), "id", "notes").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.id, r.child_idx)):
        by.setdefault(r.id, []).append((r.neighborhood, r.child_bedrooms, r.raw_price, r.child_fraction))
    assert [x[2] for x in by[0]] == ["$ 1,200", "$ 1,500", "$ 700", "$ 900"]
    assert by[1] == [("Uno", None, "$ 100 / L. 2,000", "1/1")]
    assert [x[1] for x in by[4]] == [2, 3] and sorted(by) == [0, 1, 4]


def test_segment_extras(spark):
    lines = segment.lines_of(spark.createDataFrame([("f", "RES LOMAS\nDEL VALLE\nCOL SUR. casa\nalgo\n# CABEZA\nNORTE: x")], "file string, value string"))
    got = [r.start for r in segment.with_uppercase_starts(lines).orderBy("line_no").collect()]
    assert got == [True, False, True, False, False, True]
    marked = spark.createDataFrame([("f", "# B\n* x\n* a\n* a\n# A\n* z\nend")], "file string, value string")
    unique = [(r.header, r.line) for r in segment.unique_lines(segment.lines_of(marked), segment.literal_start(F.col("line"))).collect()]
    assert unique == [("# A", "* z"), ("# B", "* a"), ("# B", "* x")]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        lookup.unique_by(df, ["k"])
    with pytest.raises(ValueError):
        rules.require_columns(df, ["w"])
    with pytest.raises(ValueError):
        rules.require_all(df, F.col("v") == "a", "not a")
    assert rules.valid_rows(df, F.col("v") == "a").count() == 1
    assert [r.v for r in rules.valid_rows(df, F.col("v") == "a", "nulls", ["v"]).collect()] == ["a", None]
    assert [r.v for r in dedup.first_by(df, ["k"], ["v"]).collect()] == ["a"]
    listed = rules.listed(df, "v", spark.createDataFrame([(" A ",), (None,)], "b string"), "hit")
    assert sorted((r.v, r.hit) for r in listed.collect()) == [("a", True), ("b", False)]


def test_files(spark, tmp_path):
    (tmp_path / "raw/Aldea/2010").mkdir(parents=True)
    (tmp_path / "raw/Aldea/2010/aldea_20100312.txt").write_bytes("* Año nuevo".encode("cp1252"))
    got = files.read_issues(spark, f"{tmp_path}/raw").collect()
    assert [(r.agency, r.date, r.value) for r in got] == [("Aldea", datetime.date(2010, 3, 12), "* Año nuevo")]
    (tmp_path / "a.csv").write_text('﻿id,note\n1,"two\nlines"\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("note,extra\nx,y\n")
    rows = files.read_csv_folder(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"])
    assert set(rows.columns) == {"id", "note", "extra", "source_file"} and rows.where("note = 'two\\nlines'").count() == 1
    assert files.dated_files(["z/b_20100312.csv", "z/a_2010.csv", "z/c_20110101.csv", "z/d_120100312.csv"], year=2010) == ["z/a_2010.csv", "z/b_20100312.csv"]
    files.write_split(rows, {"has": F.col("id").isNotNull()}, f"{tmp_path}/split")
    assert {r.part for r in spark.read.parquet(f"{tmp_path}/split").collect()} == {"has", "other"}
    files.append_log(spark, f"{tmp_path}/log", [{"run": "a", "n": 1}], "run string, n int")
    files.append_log(spark, f"{tmp_path}/log", [{"run": "b", "n": 2}], "run string, n int")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 2
    made = files.typed_ingest(spark.createDataFrame([("$ 1,200", "12/03/2010", "lempiras")], "Precio string, Fecha string, Moneda string"), {"Precio": "price", "Fecha": "date", "Moneda": "currency"}, "manual", "v1").first()
    assert (made.price, made.date, made.currency, made.source_type) == (1200.0, datetime.date(2010, 3, 12), "HNL", "manual")


def test_streams(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    rows = incremental.read_tables(spark, f"{tmp_path}/in", "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    incremental.run_batches(incremental.first_seen(rows, ["user_id", "event_type"], "ts"), lambda b: b, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert spark.read.parquet(f"{tmp_path}/out").count() == events.select("user_id", "event_type").distinct().count()
    stats = incremental.windowed_stats(rows, ["event_type"], "value", "ts")
    query = stats.writeStream.outputMode("complete").format("memory").queryName("stats").start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("SELECT sum(qty) FROM stats").first()[0] == events.count()

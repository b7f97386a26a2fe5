"""The fourteen steps from raw issues to published statistics, as functions of DataFrames (2.16).

A step takes a DataFrame and a Context and returns a StepResult: the main table, and side tables (duplicates, rejected
rows, unmatched rows, reports). Pipeline checks the order of steps before it starts; between steps nothing is written but
checkpoints after the costly ones (`cuts`), so that a plan stays small and a lost executor repeats little. Observed columns are never overwritten.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casita.functions import listing as X
from casita.functions import text as N
from casita.operators import aggregate, dedup, lookup, rules, segment
from casita.operators.profile import value_counts
from casita.sources.tables import cut

HEADERS = [
    {"pattern": "ALQUILER DE APARTAMENTOS", "transaction": "Rent", "type": "Apartment"},
    {"pattern": "ALQUILER DE CASAS", "transaction": "Rent", "type": "House"},
    {"pattern": "VENTA DE APARTAMENTOS", "transaction": "Sale", "type": "Apartment"},
    {"pattern": "VENTA DE CASAS", "transaction": "Sale", "type": "House"},
    {"pattern": "VENTA DE TERRENOS", "transaction": "Sale", "type": "Land"},
]


@dataclass
class Context:
    """What steps look up; tables are DataFrames, lists are plain."""

    marker: str = "*"
    strategy: str = "first_comma"
    headers: list[dict] = field(default_factory=lambda: list(HEADERS))
    remove: list[str] = field(default_factory=list)
    mnemonics: DataFrame | None = None  # key, mnemonic
    excluded_types: DataFrame | None = None  # one column
    excluded_places: DataFrame | None = None  # one column
    catalog: DataFrame | None = None  # ord, alias, uid, GISID, label
    rates: DataFrame | None = None  # year_month, base, quote, rate
    on_missing_rate: str = "null"
    min_n: int = 5
    version: str = "v1"
    source_type: str = "text"


@dataclass
class StepResult:
    main: DataFrame
    sides: dict[str, DataFrame] = field(default_factory=dict)


def parse(issues: DataFrame, c: Context) -> StepResult:
    """issues (file, agency, date, value) to listings: segments, context of headers, fields."""
    lines = segment.lines_of(issues.select("file", "value"))
    blocks = segment.listings(lines, segment.literal_start(F.col("line"), c.marker))
    rows = segment.with_context(blocks, c.headers).join(issues.select("file", "agency", "date"), "file")
    raw = X.strip_bullet(F.col("text"))
    rows = rows.withColumn("notes", raw).withColumn("__t", X.normalize_ocr(F.col("notes")))
    rows = rows.withColumn("__p", X.best_price(F.col("__t"))).withColumn("__a", X.areas(F.col("__t"))).withColumn("bedrooms", X.bedrooms(F.col("__t")))
    main = rows.select(
        F.col("listing_no").alias("listing_id"), F.substring("__t", 1, 60).alias("title"), X.place(F.col("__t"), c.strategy).alias("neighborhood"), "bedrooms", X.bathrooms(F.col("__t"), F.col("bedrooms")).alias("bathrooms"),
        F.col("__a")["at"].alias("AT"), F.col("__a.at_unit").alias("AT_unit"), F.col("__a.area").alias("area"), F.col("__a.area_unit").alias("area_unit"), F.lit(None).cast("double").alias("area_m2"),
        F.col("__p.amount").alias("price"), F.col("__p.currency").alias("currency"), "transaction", F.coalesce("type", F.lit("other")).alias("property_type"), "agency", "date", "notes",
        F.lit(c.source_type).alias("source_type"), F.col("file").alias("ingestion_id"), F.lit(c.version).alias("pipeline_version"),
    )
    return StepResult(main)


def merge(df: DataFrame, c: Context) -> StepResult:
    """The first row of agency, file and number."""
    rows = df.withColumn("source_file", F.col("ingestion_id")).withColumn("source_agency", F.col("agency"))
    return StepResult(dedup.first_by(rows, [F.trim("agency"), F.trim("ingestion_id"), "listing_id"], ["source_file", "listing_id"]))


def deduplicate(df: DataFrame, c: Context) -> StepResult:
    """Canonical rows go on, the others are kept aside."""
    ym = N.year_month(F.col("date"))
    key = dedup.listing_key({n: F.col(n) for n in ("title", "neighborhood", "bedrooms", "bathrooms", "area_m2", "AT", "price", "transaction")}, ym)
    rows = df.withColumn("year_month", ym).withColumn("dedup_key", key)
    rows = dedup.with_roles(rows, "dedup_key", [F.col("date"), F.col("source_file"), F.col("listing_id")]).withColumnsRenamed({"group_id": "dedup_group_id", "role": "dedup_role"})
    first = dedup.first_by(rows, ["dedup_key", "source_file", "ingestion_id"], ["dedup_role", "listing_id"])
    return StepResult(first.where("dedup_role = 'CANONICAL'"), {"duplicates": first.where("dedup_role = 'DUPLICATE'")})


def word_filter(df: DataFrame, c: Context) -> StepResult:
    """N13, beside the observed column."""
    return StepResult(df.withColumn("neighborhood_filtered", N.remove_words(F.col("neighborhood"), c.remove)))


def uid(df: DataFrame, c: Context) -> StepResult:
    """J11, J13, T3."""
    key = N.agency_key(F.col("agency"))
    known = lookup.mnemonic(df, key, c.mnemonics, N.slug(F.col("agency"))) if c.mnemonics is not None else df.withColumn("mnemonic", N.slug(F.col("agency")))
    out = dedup.listing_uid(known, F.col("mnemonic"), F.date_format("date", "yyyy-MM-dd"), ["source_file", "listing_id"]).drop("mnemonic")
    if c.mnemonics is None:
        return StepResult(out)
    return StepResult(out, {"without_mnemonic": lookup.without_partner(df.withColumn("key", key), c.mnemonics, "key")})


def clean_neighborhoods(df: DataFrame, c: Context) -> StepResult:
    """N6, N4."""
    rows = df.withColumn("neighborhood_clean", N.preclean_place(F.col("neighborhood_filtered")))
    return StepResult(rows.withColumn("neighborhood_clean_norm", N.join_key(F.col("neighborhood_clean"))))


def ptype_fix(df: DataFrame, c: Context) -> StepResult:
    """F14, F15; a missing title or text counts as the word nan, as in the published tables."""
    text = F.concat_ws(" ", F.coalesce("title", F.lit("nan")), F.coalesce("notes", F.lit("nan")))
    rows = rules.property_scores(df.withColumn("property_type_original", F.col("property_type")), text, F.col("property_type"))
    scores = [f"score_{k.lower()}" for k in rules.TYPES]
    report = rows.select("listing_uid", *scores, "margin", "tie", F.substring("notes", 1, 100).alias("sample"))
    return StepResult(rows.drop(*scores, "margin", "tie"), {"scores": report})


def filter_records(df: DataFrame, c: Context) -> StepResult:
    """One pass; rejected rows name their causes."""
    rows, checks = df, {"no_price": F.col("price").isNull()}
    for name, column, banned in (("excluded_type", "property_type_new", c.excluded_types), ("excluded_place", "neighborhood_clean_norm", c.excluded_places)):
        if banned is not None:
            rows = rules.listed(rows, column, banned, f"__{name}")
            checks[name] = F.col(f"__{name}")
    rows = rules.with_causes(rows, checks).drop("__excluded_type", "__excluded_place")
    return StepResult(rows.where("causes = ''").drop("causes"), {"rejected": rows.where("causes <> ''")})


def gis_match(df: DataFrame, c: Context) -> StepResult:
    """J3, K4."""
    valid = F.col("neighborhood_clean_norm").isNotNull() & (F.trim("neighborhood_clean_norm") != "")
    rows = lookup.catalog_match(df.withColumn("neighborhood_input_valid", valid), "neighborhood_clean_norm", c.catalog, "alias", "ord", ["uid", "GISID", "label"])
    rows = rows.withColumnsRenamed({"uid": "neighborhood_uid", "label": "neighborhood_label"})
    return StepResult(rows, {"unmatched_places": value_counts(rows.where(~F.col("matched")), "neighborhood_clean_norm", "place")})


def unmatched_check(df: DataFrame, c: Context) -> StepResult:
    """F6."""
    gone = rules.is_no(F.col("matched"))
    return StepResult(df.where(~gone), {"rejected": df.where(gone)})


def price_standardize(df: DataFrame, c: Context) -> StepResult:
    """J1, N24, F9."""
    rows = lookup.rate_join(df, c.rates, "year_month", on_missing=c.on_missing_rate)
    return StepResult(rows, {"currencies": value_counts(rows, "currency")})


def transaction_validate(df: DataFrame, c: Context) -> StepResult:
    """F16."""
    rows = df.withColumn("__d", rules.transaction_decision(F.col("property_type_new"), F.col("transaction"), F.col("notes"), F.col("price_usd")))
    names = {"final": "transaction_final", "flag": "transaction_flag", "polarity": "flag_polarity", "source": "transaction_decision_source", "confidence": "transaction_confidence"}
    rows = rows.select("*", *[F.col(f"__d.{a}").alias(b) for a, b in names.items()]).drop("__d")
    return StepResult(rows, {"flags": value_counts(rows, "transaction_flag")})


def area_standardize(df: DataFrame, c: Context) -> StepResult:
    """N23."""
    rows = df.withColumn("__s", X.standard_area(F.col("area_m2"), X.locale_number(F.col("AT")), F.col("AT_unit")))
    rows = rows.select("*", F.col("__s.m2").alias("area_m2_std"), F.col("__s.method").alias("area_std_method")).drop("__s")
    return StepResult(rows, {"methods": value_counts(rows, "area_std_method")})


GROUP = ["neighborhood_label", "transaction", "neighborhood_clean", "neighborhood_uid", "GISID", "year_month", "property_type_new"]
ORDER = ["year_month", "neighborhood_label", "transaction", "property_type_new"]


def statistics(df: DataFrame, c: Context) -> StepResult:
    """A1 to A4: monthly prices, prices per area, with rooms per area, and by bedrooms."""
    price, area = F.col("price_usd"), X.locale_number(F.col("area"))
    per_m2, per_area = aggregate.ratio(price, area), aggregate.ratio(F.col("bedrooms").cast("double"), area)
    rows = df.withColumn("bedrooms_norm", aggregate.bedrooms_bucket(F.col("bedrooms")))
    of = lambda keys, **kw: aggregate.price_summary(rows, keys, price, c.min_n, order=[k for k in [*ORDER, "bedrooms_norm"] if k in keys], **kw)
    sides = {
        "by_area": of(GROUP, ratios={"price_per_m2": per_m2}, require=area > 0),
        "by_area_and_beds": of(GROUP, ratios={"price_per_m2": per_m2, "beds_per_area": per_area}),
        "by_bedrooms": of([*GROUP, "bedrooms_norm"], ratios={"price_per_bed": aggregate.ratio(price, F.col("bedrooms").cast("double"))}),
    }
    return StepResult(of(GROUP), sides)


STEPS: dict[str, Callable[[DataFrame, Context], StepResult]] = {
    "parse": parse, "merge": merge, "deduplicate": deduplicate, "word_filter": word_filter, "uid": uid, "clean_neighborhoods": clean_neighborhoods, "ptype_fix": ptype_fix, "filter_records": filter_records,
    "gis_match": gis_match, "unmatched_check": unmatched_check, "price_standardize": price_standardize, "transaction_validate": transaction_validate, "area_standardize": area_standardize, "aggregate": statistics,
}


class Pipeline:
    """A run of steps in registry order; `run` gives the results by step."""

    #: Steps whose main table is checkpointed: field extraction, scores and decisions are costly to plan and to repeat.
    CUTS = ("parse", "deduplicate", "clean_neighborhoods", "ptype_fix", "gis_match", "transaction_validate", "area_standardize")

    def __init__(self, steps: list[str] | None = None, cuts: tuple[str, ...] = CUTS):
        self.cuts = cuts
        self.steps = list(STEPS) if steps is None else steps
        if unknown := [s for s in self.steps if s not in STEPS]:
            raise ValueError(f"no such steps: {', '.join(unknown)}")
        if [s for s in STEPS if s in self.steps] != self.steps:
            raise ValueError("steps are out of order")

    def run(self, df: DataFrame, context: Context) -> dict[str, StepResult]:
        out = {}
        for name in self.steps:
            out[name] = STEPS[name](df, context)
            if name in self.cuts:
                out[name].main = cut(out[name].main)
            df = out[name].main
        return out


def run_log(results: dict[str, StepResult], run_id: str) -> list[dict]:
    """Rows in each step's main and side tables; runs the plans."""
    return [{"run_id": run_id, "step": step, "table": t, "rows": df.count()} for step, r in results.items() for t, df in {"main": r.main, **r.sides}.items()]

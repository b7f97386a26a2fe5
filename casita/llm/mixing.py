"""Mixing sources to target weights as a time-varying curriculum (built-in functions only).

Each source has a weight schedule w(t) = w * (1 + c * (2t - 1)) over the training time t from 0 to 1. Its integral, w, sets
the words the mix takes from it: a share of all words is dealt by weight, targets stop at `max_passes` times a source's
size, and the excess goes to the others by weight. A source's documents stand in a fixed order (hash of doc_id) and are
read in passes; what lies at u of its demand is trained on at the time t where the integral of the schedule from 0 to t
is u of the whole, found by inverting the integral, a quadratic. The occurrences of all sources, range-sorted by t, are
the training order.

Scale: running sums inside a source never need the source in one task. Documents fall into hash buckets of about
`bucket_rows` rows; bucket sizes, added up on the map side, give each bucket's offset, and rows are ordered only within
their bucket. Source totals are one row per source; the offsets of a source's buckets are one row per bucket. Documents
that hold over 1/64 of their source (63 at most) are a stratum of their own: in a pass that ends early they are taken in
proportion first, and the small ones fill up to the target, so the words taken come near it. All this is done on row
numbers and sizes; the documents themselves meet their plan at the end (by a broadcast while the plan is small, its rows
counted first, else by a shuffle) and move once more for the range sort.

Defined results: a null text has size 0; a null source is a source of its own, last in order; equal rows (same doc_id and
size) are taken one after the other; a source of size 0 has target 0; an empty table gives an empty table. Columns of the
input are kept in a struct, so extra columns may have any name. All ties break by doc_id and size: reruns agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, packed, scratch, word_array


@dataclass(frozen=True)
class Mix:
    #: Dealt to the sources in code-point order, again and again.
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    #: c of each schedule, dealt likewise: over 0 the source comes late, under 0 early; strictly between -1 and 1.
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5)
    share: float = 1.5
    max_passes: int = 2
    bucket_rows: int = 1024
    seed: str = "mix"


def _dealt(values: tuple[float, ...], rank: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), (rank % len(values)).cast("int"))


def targets(totals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """totals (source, source_size), one row a source, with target, slope and rank.

    The level at which uncapped sources are filled is the largest over all prefixes of the sources in order of cap per
    weight: the words left when the prefix is capped, over the weight left. Windows over one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    df = totals.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", _dealt(mix.weights, F.col("rank")))
    df = df.withColumn("cap", F.col("source_size") * float(mix.max_passes)).withColumn("per", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    upto = Window.orderBy("per", "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * mix.share - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    df = df.withColumn("level", left / weight_left)
    df = df.withColumn("target", F.least("cap", F.col("weight") * F.max("level").over(everything)))
    return df.select("source", "source_size", "target", "rank", _dealt(mix.slopes, F.col("rank")).alias("slope"))


def training_time(share: Column, slope: Column) -> Column:
    """t at which the integral of 1 + slope * (2t - 1) reaches share, both from 0 to 1."""
    b = F.lit(1.0) - slope
    return F.least(F.lit(1.0), 2 * share / (b + F.sqrt(b * b + 4 * slope * share)))


def plan(docs: DataFrame, mix: Mix = Mix(), carry: list[str] | None = None) -> DataFrame:
    """doc (a struct of the input's columns or of carry), size, source_size, target, taken (words), times (t of each pass taken).

    A row for each row of docs, taken or not. A pass that ends early takes a document when its middle lies within what its
    stratum is due.
    """
    kept = [F.col(f"doc.`{c}`").alias(c) for c in (carry or docs.columns)]
    key = F.conv(F.substring(F.md5(F.concat(F.lit(mix.seed), F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")
    sized = packed(docs).select(
        F.struct(*kept).alias("doc"), F.monotonically_increasing_id().alias("row"), F.col("doc.doc_id").cast("long").alias("id"), F.col("doc.source").cast("string").alias("source"), F.size(word_array(F.col("doc.text").cast("string"))).cast("long").alias("size"), key.alias("key")
    )
    whole = scratch(sized, "sized")  # row numbers are settled here
    sized = whole.drop("doc")
    n_rows = sized.agg(F.count("*")).first()[0]
    bits = max(0, min(40, math.ceil(math.log2(max(1, n_rows / mix.bucket_rows)))))
    source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), mix).withColumnRenamed("source", "of")
    source = source.withColumn("full", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("int"))
    source = scratch(source.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")), "targets")

    rows = sized.join(source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("big", F.col("size") * 64 > F.col("source_size")).withColumn("bucket", F.shiftright("key", 60 - bits))
    half = F.col("size") / 2
    order = Window.orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda *by: F.coalesce(F.sum("size").over(order.partitionBy(*by)), F.lit(0))

    # at most 63 documents of a source are big
    large = rows.where("big").withColumn("before", before("source")).withColumn("all", F.sum("size").over(Window.partitionBy("source")))
    large = large.withColumn("in", F.col("before") + half <= F.col("rest") * F.col("all") / F.col("source_size"))
    large = large.groupBy(F.col("source").alias("of"), F.lit(True).alias("of_big")).agg(F.max("all").alias("all"), F.max(F.col("rest") * F.col("all") / F.col("source_size")).alias("limit"), F.sum(F.when(F.col("in"), F.col("size")).otherwise(0)).alias("large_taken"))
    words = source.join(large.select(F.col("of").alias("l_of"), "all", "large_taken"), F.col("of").eqNullSafe(F.col("l_of")), "left")
    small_limit = F.greatest(F.col("rest") - F.coalesce("large_taken", F.lit(0)), F.lit(0.0))
    small = words.select("of", F.lit(False).alias("of_big"), (F.col("source_size") - F.coalesce("all", F.lit(0))).alias("all"), small_limit.alias("limit"))
    strata = scratch(small.unionByName(large.select("of", "of_big", "all", "limit")), "strata")

    offset = rows.groupBy("source", "big", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source", "big").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = offset.select("source", "big", F.col("bucket").alias("at"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    offset = offset.join(strata, F.col("source").eqNullSafe(F.col("of")) & (F.col("big") == F.col("of_big"))).select("of", "of_big", "at", "offset", "all", "limit")

    rows = rows.withColumn("inner", before("source", "big", "bucket"))
    rows = rows.join(offset, F.col("source").eqNullSafe(F.col("of")) & (F.col("big") == F.col("of_big")) & (F.col("bucket") == F.col("at")))
    middle = F.col("offset") + F.col("inner") + half
    at = lambda p, of, words: F.coalesce(training_time(F.least(F.lit(1.0), (p * F.col("source_size") + middle / F.nullif(of, F.lit(0)) * words) / F.nullif(F.col("target"), F.lit(0.0))), F.col("slope")), F.lit(0.0))
    full = [F.when(F.col("full") > p, at(F.lit(p), F.col("all"), F.col("source_size"))) for p in range(mix.max_passes)]
    last = F.when((F.col("rest") > 0) & (middle <= F.col("limit")), at(F.col("full"), F.col("limit"), F.col("rest")))
    rows = rows.withColumn("times", F.array_compact(F.array(*full, last)))
    planned = rows.select("row", "id", "key", "size", "source_size", "target", (F.col("size") * F.size("times")).alias("taken"), "times", "rank")
    return whole.select("row", "doc").join(bounded(scratch(planned, "plan"), 120), "row").drop("row")


def training_order(planned: DataFrame) -> DataFrame:
    """The occurrences: doc, t and pass, range-sorted by training time over the output's partitions."""
    each = planned.select("doc", "rank", "key", "id", "size", F.posexplode("times").alias("pass", "t"))
    return each.orderBy("t", "rank", "key", "id", "size", "pass").select("doc", "t", "pass")

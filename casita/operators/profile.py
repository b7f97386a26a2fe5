"""Counts and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """Values (null included) and how often, most frequent first, then by value."""
    c = F.col(column) if isinstance(column, str) else column
    return df.groupBy(c.alias(name)).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col(name).asc_nulls_first())


def column_profile(df: DataFrame) -> DataFrame:
    """A row for each column: non_null, missing (null or empty text), n_unique, varies. One pass over the data."""
    aggs = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        filled = v.isNotNull() & (F.trim(v.cast("string")) != "")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(v).alias("non_null"), F.sum(F.when(filled, 0).otherwise(1)).cast("long").alias("missing"), F.count_distinct(v.cast("string")).alias("n_unique")).alias(f"c{i}"))
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(aggs))]))).withColumn("varies", F.col("n_unique") > 1)


def mode_or_varies(df: DataFrame, by: list[str], column: str, share: float = 0.5) -> DataFrame:
    """A10: per group the commonest value if it has at least the share of the rows, else VARIES; ties to the least value."""
    counts = df.groupBy(*by, F.col(column).cast("string").alias("v")).agg(F.count("*").alias("n"))
    top = counts.groupBy(*by).agg(F.sum("n").alias("all"), F.min(F.struct((-F.col("n")).alias("neg"), "v")).alias("m"))
    return top.select(*by, F.when(-F.col("m.neg") >= share * F.col("all"), F.col("m.v")).otherwise("VARIES").alias(column))


def missing_report(df: DataFrame, fields: list[str]) -> DataFrame:
    """A row for each field: how many rows lack it."""
    count = lambda c: F.sum(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1).otherwise(0)).cast("long")
    one = df.agg(*[count(c).alias(f"m{i}") for i, c in enumerate(fields)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(f"m{i}"), F.lit(0)).alias("missing")) for i, c in enumerate(fields)])))

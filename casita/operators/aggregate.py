"""Grouped price statistics with a minimum sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Numerator / denominator where the denominator is positive, else null."""
    return F.when(denominator > 0, numerator / F.nullif(denominator, F.lit(0)))


def bedrooms_bucket(bedrooms: Column) -> Column:
    """N25: '0' to '4', '5+', or null for a missing or negative count."""
    n = F.floor(bedrooms).cast("int")
    return F.when(bedrooms >= 5, "5+").when((bedrooms >= 0) & (bedrooms < 5), n.cast("string"))


def stats_of(value: Column, prefix: str, suffix: str = "") -> list[Column]:
    """min, max, average, exact median and sample deviation; nulls are skipped, a single row has no deviation."""
    kinds = {"min": F.min, "max": F.max, "avg": F.avg, "median": F.median, "std": F.stddev_samp}
    return [f(value).alias(f"{prefix}_{k}{suffix}") for k, f in kinds.items()]


def price_summary(
    df: DataFrame,
    keys: list[str],
    price: Column,
    min_n: int = 5,
    ratios: dict[str, Column] | None = None,
    require: Column | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """A1 to A4: price statistics by keys, groups of at least min_n rows.

    Rows with a null price or a null key are left out (a group key must be known). `ratios` adds a block of statistics
    for each named expression, null-skipping; `require` filters rows first (A2's positive area). Sorted when order is
    given. One shuffle on the keys; all but the median combine on the map side.
    """
    rows = df.withColumn("__price", price).where(F.col("__price").isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    if require is not None:
        rows = rows.where(require)
    aggs = stats_of(F.col("__price"), "price", "_usd")
    for name, value in (ratios or {}).items():
        aggs += stats_of(value, name)
    out = rows.groupBy(*keys).agg(*aggs, F.count("*").alias("qty")).where(F.col("qty") >= min_n)
    return out.orderBy(*order) if order else out

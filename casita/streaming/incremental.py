"""Structured Streaming over arriving issues and events: an extension, for runs that go on.

The batch operators work on each micro-batch as they are; what needs state is here: first-wins dedup within a month by a
watermark, monthly statistics in windows, and a sink that appends idempotently by batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tables(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def first_seen(rows: DataFrame, keys: list[str], at: str, late: str = "31 days") -> DataFrame:
    """U3 on a stream: one row a key; state is dropped once the watermark has passed it."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def windowed_stats(rows: DataFrame, keys: list[str], value: str, at: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """A1 on a stream: count, least, greatest and mean in windows of event time (what combines in state; no median)."""
    v = F.col(value)
    grouped = rows.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *keys)
    return grouped.agg(F.count("*").alias("qty"), F.min(v).alias("price_min"), F.max(v).alias("price_max"), F.avg(v).alias("price_avg")).select(F.col("w.start").alias("start"), *keys, "qty", "price_min", "price_max", "price_avg")


def run_batches(rows: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Applies a batch function to each micro-batch and writes it under batch=<id>; a repeated batch overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

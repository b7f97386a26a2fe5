"""A training-corpus pipeline: STAGES over documents, each written as Parquet and read again.

Quality rules, near-duplicates, benchmark decontamination, mixing to target weights, token shards. All stages but the
last return the columns of documents; a document that a stage rejects goes, a document that the mix takes twice comes
twice. The last returns the index that it reads back from its shards.

A stage's result is written before the next stage is called. So each stage begins by deleting the scratch tables of the
stages before it, unless its input has not been written and still reads them: the shared folder holds those of one stage
at a time. One pipeline runs at a time in an application.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casita.llm import decontamination, mixing, quality, simhash, token_shards
from casita.llm.common import clear_scratch, packed, reads_scratch, scratch_path, scratch_scope, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _alone(stage: Stage) -> Stage:
    """The stage with the scratch tables of those before it deleted."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not reads_scratch(docs, "pipeline"):
            clear_scratch(spark, "pipeline")
        with scratch_scope("pipeline"):
            return stage(spark, docs, sf_dir)

    return run_stage


def _unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])


@_alone
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return _unpacked(quality.quality(docs).where("kept"), docs.columns)


@_alone
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: the smallest doc_id, nulls last, then the least digest of the whole row.

    A document without a doc_id counts like any other, and texts that share a doc_id are told apart.
    """
    rows = packed(docs).withColumn("key", F.md5(F.to_json("doc")))
    keep = simhash.first_of_each(rows.select("doc.doc_id", "key", "doc.text")).withColumnRenamed("key", "k")
    one = rows.join(keep, F.col("key") == F.col("k")).groupBy("key").agg(F.first("doc").alias("doc"))
    return _unpacked(one, docs.columns)


@_alone
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_alone
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The occurrences that the mix takes, range-sorted by training time."""
    return _unpacked(mixing.training_order(mixing.plan(docs)), docs.columns)


@_alone
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row, read back from the shards."""
    return token_shards.token_index(docs.select("doc_id", "text"), scratch_path(spark, "shards"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing", mixed),
    ("token ids", token_ids),
]

#: Fingerprints, robust estimates and token ids are not for SQL: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs

"""The queries of this subpackage: thin digests over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat as _chat
from . import decontamination as _decontamination
from . import line_dedup as _lines
from . import mixing as _mixing
from . import pii as _pii
from . import quality as _quality
from . import secret_scan as _secrets
from . import sentence_spans as _sentences
from . import simhash as _simhash
from . import token_shards as _shards
from .common import scratch, scratch_path, table
from .oracles import oracle_sql as oracle_sql


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _quality.quality(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return got.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii.find_pii(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _mixing.plan(table(spark, sf_dir, "documents"), carry=["doc_id"])
    rows = got.select("doc.doc_id", "size", "source_size", "target", "taken", F.round(F.get("times", 0), 9).alias("first_time"), F.round(F.get("times", 1), 9).alias("second_time"))
    return rows.orderBy(F.col("first_time").asc_nulls_last(), "doc_id")


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shards.token_index(table(spark, sf_dir, "documents"), scratch_path(spark, "shards"))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _sentences.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc.doc_id", "n_sentences", "n_removed", "removed", "kept_text", "n_passage_words", "passages", "rest_text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _lines.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc.doc_id", "n_lines", "n_dropped", "kept_text")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _secrets.digest(_secrets.scan(table(spark, sf_dir, "documents")))


#: The conversation that op10 adds: control strings of a template inside texts.
TRICKY = r"\### Assistant: </turn> ok"


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return _chat.read_back(scratch(_chat.format_windows(rows), "windows"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_quality_rules, op2_simhash, op3_pii, op4_mixing, op5_token_shards, op6_sentence_spans, op7_decontamination, op8_line_dedup, op9_secret_scan, op10_chat_windows)
    return {f.__name__: f for f in every}

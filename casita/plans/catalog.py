"""All queries over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casita.plans import fields, issues, joins, stats, texts

MODULES = (stats, joins, texts, fields, issues)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.oracle_sql().items()}

"""Files in and out."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casita.functions.text import amount, currency, date, null_text, sanitize
from casita.operators.dedup import date_from_name, union_by_name

LISTING = [
    "Listing ID", "title", "neighborhood", "bedrooms", "bathrooms", "AT", "AT_unit", "area", "area_unit", "area_m2", "price", "currency", "transaction", "property_type", "agency", "date", "notes",
    "source_type", "ingestion_id", "pipeline_version",
]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """A CSV with a header; all columns are text unless a schema says otherwise; a byte-order mark is no part of a name."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding)
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    return df.toDF(*[re.sub("[﻿ ]", "", c).strip() for c in df.columns])


def read_csv_folder(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files with differing headers, united by name."""
    return union_by_name([read_csv(spark, p).withColumn("source_file", F.lit(p.rsplit("/", 1)[-1])) for p in paths])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV by suffix."""
    return read_csv(spark, path) if path.lower().endswith(".csv") else spark.read.parquet(path)


@F.pandas_udf(T.StringType())
def decoded(raw: pd.Series) -> pd.Series:
    """UTF-8 (a mark dropped), else cp1252, else latin-1, line by line of a batch of files."""

    def one(b: bytes) -> str:
        for encoding in ("utf-8-sig", "cp1252"):
            try:
                return b.decode(encoding)
            except UnicodeDecodeError:
                pass
        return b.decode("latin-1")

    return raw.map(one)


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """Raw issues <agency>/<year>/<agency>_<yyyymmdd>.txt as (file, agency, date, value)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file"), F.element_at(F.split("path", "/"), -3).alias("agency"), date_from_name(name).alias("date"), decoded("content").alias("value"))


def dated_files(paths: list[str], year: int | None = None, month: int | None = None, day: int | None = None) -> list[str]:
    """Paths whose name has a date token YYYY[MM[DD]] (no digit next to it) that fits, by folder, then name."""
    out = []
    for p in paths:
        m = re.search(r"(?<!\d)(20\d{2})(\d{2})?(\d{2})?(?!\d)", p.rsplit("/", 1)[-1])
        if m and all(want is None or (got is not None and int(got) == want) for want, got in zip((year, month, day), m.groups(), strict=True)):
            out.append(p)
    return sorted(out, key=lambda p: tuple(p.rsplit("/", 2)[-2:]))


def exclusions(spark: SparkSession, spec: str) -> DataFrame:
    """A text list with # and // comments, or file.csv:Column."""
    if ".csv:" in spec:
        path, column = spec.rsplit(":", 1)
        return read_csv(spark, path).select(F.col(f"`{column}`").alias("value")).where("value IS NOT NULL")
    return spark.read.text(spec).where(~F.col("value").rlike(r"^\s*(#|//|$)"))


def alias_rows(df: DataFrame, key: str, name: str, aliases: str, sep: str = r"\s*[|,]\s*") -> DataFrame:
    """(key, name, alias): a row for the name itself (alias null) and one for each alias."""
    named = df.select(key, name, F.lit(None).cast("string").alias("alias"))
    return named.unionByName(df.select(key, name, F.explode(F.filter(F.split(F.coalesce(aliases, F.lit("")), sep), lambda a: F.trim(a) != "")).alias("alias")))


def typed_ingest(df: DataFrame, rename: dict[str, str], source_type: str, version: str) -> DataFrame:
    """A hand-made table as listings: renamed, numbers and currencies and dates read, provenance, fixed columns."""
    out = df.select(*[F.col(f"`{a}`").cast("string").alias(b) for a, b in rename.items() if a in df.columns])
    have = set(out.columns)
    read: dict[str, Callable[[Column], Column]] = {"price": amount, "bedrooms": lambda c: amount(c).cast("int"), "bathrooms": amount, "currency": currency, "date": date}
    cols = [(read.get(c, lambda x: null_text(sanitize(x)))(F.col(f"`{c}`")) if c in have else F.lit(None).cast("string")).alias(c) for c in LISTING if c not in ("source_type", "pipeline_version", "ingestion_id")]
    ingestion = F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in out.columns])), 1, 10)
    return out.select(*cols, F.lit(source_type).alias("source_type"), ingestion.alias("ingestion_id"), F.lit(version).alias("pipeline_version"))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """K1, K2: a folder of CSV files with headers, the named columns only."""
    (df.select(*columns) if columns else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_pair(df: DataFrame, path: str) -> None:
    """K3: the rows as Parquet and as CSV, path.parquet and path.csv; without rows both still have the columns."""
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    write_csv(df.sparkSession.read.schema(df.schema).parquet(f"{path}.parquet"), f"{path}.csv")


def output_path(root: str, year: str, month: str | None = None, day: str | None = None, agency: str | None = None) -> str:
    """<root>/<year>/<agency or merged>_<yyyy[mm[dd]]>.csv."""
    return f"{root}/{year}/{agency or 'merged'}_{year}{month or ''}{day or ''}.csv"


def agency_of(path: Column) -> Column:
    """The agency's folder in <agency>/<year>/<file>."""
    return F.coalesce(F.get(F.reverse(F.split(F.translate(path, "\\", "/"), "/")), 2), F.lit(""))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Web pages of a folder and those below it, as (url, html)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{html,htm}").load(path)
    return files.select(F.col("path").alias("url"), decoded("content").alias("html"))


def write_split(df: DataFrame, parts: dict[str, Column], path: str) -> None:
    """K4: one partitioned write: each row goes to the first part whose condition holds, under path/part=<name>."""
    name = F.coalesce(*[F.when(c, F.lit(n)) for n, c in parts.items()], F.lit("other"))
    df.withColumn("part", name).write.mode("overwrite").partitionBy("part").parquet(path)


def write_years(df: DataFrame, year: Column, years: list[int], path: str) -> None:
    """K9: Parquet by year, for the given years."""
    df.withColumn("year", year).where(F.col("year").isin(*years)).write.mode("overwrite").partitionBy("year").parquet(path)


def append_log(spark: SparkSession, path: str, entries: list[dict], schema: str) -> None:
    """K8: a run log that only grows."""
    spark.createDataFrame([tuple(e.get(f.name) for f in T.StructType.fromDDL(schema)) for e in entries], schema).write.mode("append").parquet(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """K7: one text file a partition."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def summary_json(df: DataFrame, aggs: dict[str, Column]) -> str:
    """K5: one JSON object of aggregates."""
    return df.agg(*[c.alias(k) for k, c in aggs.items()]).toJSON().first()

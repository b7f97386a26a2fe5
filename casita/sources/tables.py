"""Tables of a folder, one Parquet file or folder each."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one in spark.checkpoint.dir, our own temporary one in local runs."""
    sc = spark.sparkContext
    told = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not told:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        told = tempfile.mkdtemp(prefix="casita-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(told)
    return told


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_dir(spark)}/casita-files/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed to the shared folder: the plan above it starts anew."""
    shared_dir(df.sparkSession)
    return df.checkpoint()

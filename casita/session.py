"""The session that tests, bench and local runs use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int | None = None) -> SparkSession:
    """A local session: UTC, ANSI and AQE on, shuffle partitions sized to the cores."""
    n = os.cpu_count() or 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("casita")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.driver.memory", os.environ.get("CASITA_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Session settings shared by the bench, the tests and the command lines."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "rasterloom", cores: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine expects of a cluster: UTC, AQE, few shuffle partitions."""
    os.environ.setdefault("TZ", "UTC")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Tables that cut lineage, in the folder that driver and executors share, and other help for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rasterloom.functions import scratch as shared
from rasterloom.functions.scratch import delete, folder, root, swept

__all__ = ["bounded", "delete", "folder", "fresh", "root", "swept", "written"]


def written(df: DataFrame, name: str, batch: int | None = None, **options: str) -> tuple[DataFrame, str]:
    """The DataFrame written as a Parquet table in the shared folder and read back, with its path.

    batch: rows that go to Python at once while it is written, where they are wide.
    """
    spark = df.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        if batch:
            spark.conf.set(key, batch)
        return shared.written(df, name, **options)
    finally:
        spark.conf.set(key, before)


def bounded(spark: SparkSession) -> None:
    """Has texts go to Python about 8 MB at a time, unless the session sets a size of its own: long texts in batches
    counted by rows alone could take more memory than an executor has for Python. The setting stays, as results are
    planned when they are used."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, "64m"))
    if size == 64 << 20:
        spark.conf.set(key, "8m")


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of the DataFrame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

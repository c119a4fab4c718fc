"""A mosaic kept up to date while pixels of new tiles arrive.

Votes by (grow, gcol, value) add up, so each micro-batch adds its counts to the state; the state is a Parquet table of
versions, one for each batch, and a batch that runs again writes the same version. The mosaic is the mode of the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def counts(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("grow", "gcol", "value").agg(F.count("*").alias("n"))


def read_state(spark: SparkSession, folder: str) -> DataFrame | None:
    """The counts so far, or None before the first batch."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    added = spark.read.parquet(f"{folder}/batch=*")
    return added.groupBy("grow", "gcol", "value").agg(F.sum("n").alias("n"))


def start(stream: DataFrame, folder: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Counts of each micro-batch of pixels (grow, gcol, value) are added below the folder."""

    def add(batch: DataFrame, number: int) -> None:
        counts(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def mosaic(state: DataFrame) -> DataFrame:
    """The most frequent value of each pixel, the least of equals."""
    return state.groupBy("grow", "gcol").agg(F.max_by("value", F.struct("n", -F.col("value"))).alias("value"))


def compact(spark: SparkSession, folder: str, to: str) -> None:
    """All versions as one, in a new folder, as batch -1, which no stream writes: one that starts there adds to it."""
    state = read_state(spark, folder)
    if state is not None:
        state.write.mode("overwrite").parquet(f"{to}/batch=-1")

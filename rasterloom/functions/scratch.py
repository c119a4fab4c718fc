"""Written tables in a folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: For each `swept` block that is open, the paths written within it.
_open: list[list[str]] = []


def root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset, a local master (tests) gets one of its own; on a
    cluster that is an error, as executors would write to their own disks."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="rasterloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """The rows as a Parquet table read back, and its path."""
    path = folder(df.sparkSession, name)
    if _open:
        _open[-1].append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete(spark: SparkSession, *paths: str) -> None:
    """Removes tables that nothing needs any more."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def swept(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Deletes what `written` writes within the block at its end, but for the paths given to the function it yields."""
    mine: list[str] = []
    kept: set[str] = set()
    _open.append(mine)
    try:
        yield lambda *paths: kept.update(paths)
    finally:
        _open.remove(mine)
        delete(spark, *[p for p in mine if p not in kept])
        if _open:  # what stays belongs to the block around this one
            _open[-1].extend(p for p in mine if p in kept)

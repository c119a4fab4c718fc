"""Manifests, tile lists and URL lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "STRUCT<tile_id: STRING, orthophoto: STRING, classification_map: STRING, url: STRING>"
CATALOGUE = ["split", "tile_id", "orthophoto", "classification_map", "url"]


def parsed(texts: DataFrame, column: str = "value") -> DataFrame:
    """Catalogue rows of manifest texts: JSON objects of split to entries. `position` keeps the order."""
    one = texts.select(F.from_json(column, f"MAP<STRING, ARRAY<{ENTRY}>>").alias("m")).select(F.explode("m").alias("split", "entries"))
    return one.select("split", F.posexplode("entries").alias("position", "e")).select("split", "e.*", "position")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parsed(spark.read.text(path, wholetext=True))


def manifest_text(catalogue: DataFrame, position: str | None = None) -> DataFrame:
    """The catalogue as one JSON text, two blanks of indent. It is one document, so its rows meet in one task."""
    order = F.col(position) if position else F.col("tile_id")
    entry = F.struct(order.alias("_o"), F.struct(*[c for c in CATALOGUE if c != "split"]).alias("e"))
    lists = catalogue.groupBy("split").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias("entries"))
    whole = lists.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", "entries")))).alias("m"))
    return whole.select(F.to_json("m", {"pretty": "true"}).alias("value"))


def write_manifest(catalogue: DataFrame, path: str, position: str | None = None) -> None:
    manifest_text(catalogue, position).coalesce(1).write.mode("overwrite").text(path)


def read_tile_csv(spark: SparkSession, path: str) -> DataFrame:
    """`;`-separated nom and url; the url is trimmed, the name is not."""
    rows = spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).schema("nom string, url string").csv(path)
    return rows.select("nom", F.trim("url").alias("url"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL a line; blank lines and comments are skipped."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> '' AND NOT startswith(url, '#')")


def files(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    """Paths of a folder's files by pattern, in order, with their length."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length").orderBy("path")


def write_by_split(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """A folder for each split."""
    df.write.mode(mode).partitionBy("split").parquet(folder)

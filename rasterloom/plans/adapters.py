"""Inputs of the engine's operators derived from the general test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = 2.0
SIDE = 25  # pixels of a row of the score image


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cloud(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("tile_id"), (F.col("l_partkey") / 10.0).alias("x"), (F.col("l_suppkey") + F.col("l_quantity") / 50.0).alias("y"), F.when(F.col("l_linenumber") == 7, 8).otherwise(F.col("l_linenumber")).cast("smallint").alias("classification")
    )


CLOUD = "pts AS (SELECT l_returnflag AS tile_id, l_partkey / 10.0 AS x, l_suppkey + l_quantity / 50.0 AS y, CASE WHEN l_linenumber = 7 THEN 8 ELSE l_linenumber END AS classification FROM lineitem)"
BOX = f"box AS (SELECT tile_id, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, CAST(ceil((max(x) - min(x)) / {CELL}) AS INTEGER) AS cols, CAST(ceil((max(y) - min(y)) / {CELL}) AS INTEGER) AS rows FROM pts GROUP BY tile_id)"
BINNED = f"bin AS (SELECT tile_id, CAST(least(greatest(trunc((ymax - y) / {CELL}), 0), rows - 1) AS INTEGER) AS row, CAST(least(greatest(trunc((x - xmin) / {CELL}), 0), cols - 1) AS INTEGER) AS col, CASE classification WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 8 THEN 3 ELSE 0 END AS cls FROM pts JOIN box USING (tile_id) WHERE classification BETWEEN 2 AND 5 OR classification = 8)"
RASTER = "ras AS (SELECT tile_id, row, col, CAST(cls AS SMALLINT) AS value FROM (SELECT tile_id, row, col, cls, row_number() OVER (PARTITION BY tile_id, row, col ORDER BY count(*) DESC, cls) AS k FROM bin GROUP BY tile_id, row, col, cls) WHERE k = 1)"
RASTERIZED = f"{CLOUD}, {BOX}, {BINNED}, {RASTER}"


def model_map(raster: DataFrame) -> DataFrame:
    """A second class map on the raster's cells, with 255 among its values."""
    v = F.pmod(7 * F.col("row") + 13 * F.col("col"), F.lit(5))
    return raster.select("tile_id", "row", "col", F.when(v == 4, 255).otherwise(v).cast("smallint").alias("value"))


MODEL = "mdl AS (SELECT tile_id, row, col, CASE WHEN (7 * row + 13 * col) % 5 = 4 THEN 255 ELSE (7 * row + 13 * col) % 5 END AS value FROM ras)"


def scores(spark: SparkSession, d: str, n: int = 4) -> DataFrame:
    """The embeddings as an image of n scores a pixel: row, col, logits, target."""
    e = table(spark, d, "embeddings")
    return e.select(F.floor(F.col("vec_id") / SIDE).cast("int").alias("row"), (F.col("vec_id") % SIDE).cast("int").alias("col"), F.slice("embedding", 1, n).cast("array<double>").alias("logits"), (F.col("label") % 4).cast("int").alias("target"))


def scores_sql(n: int = 4) -> str:
    return f"img AS (SELECT CAST(vec_id // {SIDE} AS INTEGER) AS row, CAST(vec_id % {SIDE} AS INTEGER) AS col, CAST(embedding[1:{n}] AS DOUBLE[]) AS l, label % 4 AS target FROM embeddings)"


def height(spark: SparkSession, d: str) -> int:
    """Rows of the score image."""
    return int(table(spark, d, "embeddings").agg(F.max("vec_id")).first()[0]) // SIDE + 1


def tile_meta(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping 8 x 8 tiles, one for each supplier: 6 pixels apart, five in a row."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    left, top = (F.col("k") % 5 * 6).cast("double"), (F.lit(1000) - F.floor(F.col("k") / 5) * 6).cast("double")
    return s.select(
        F.col("k").cast("string").alias("tile_id"), F.concat(F.lit("tiles/t"), F.lpad(F.col("k").cast("string"), 7, "0"), F.lit(".tif")).alias("path"), left.alias("left"), (top - 8).alias("bottom"), (left + 8).alias("right"), top.alias("top"),
        F.lit(1.0).alias("a"), F.lit(-1.0).alias("e"), F.lit(8).alias("width"), F.lit(8).alias("height"), F.lit("EPSG:2154").alias("crs"), F.lit("uint8").alias("dtype"), F.lit(1).alias("band_count"),
    )


META = "meta AS (SELECT CAST(s_suppkey AS VARCHAR) AS tile_id, s_suppkey AS k, 'tiles/t' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') || '.tif' AS path, CAST(s_suppkey % 5 * 6 AS DOUBLE) AS lft, CAST(1000 - s_suppkey // 5 * 6 - 8 AS DOUBLE) AS btm, CAST(s_suppkey % 5 * 6 + 8 AS DOUBLE) AS rgt, CAST(1000 - s_suppkey // 5 * 6 AS DOUBLE) AS top FROM supplier)"


def tile_pixels(spark: SparkSession, d: str) -> DataFrame:
    m = tile_meta(spark, d).select("tile_id", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("row")).select("tile_id", "row", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("col"))
    v = F.pmod(F.floor(F.col("row") / 2) * 7 + F.floor(F.col("col") / 3) * 13 + F.col("tile_id").cast("int") * 5, F.lit(5))
    return m.select("tile_id", "row", "col", F.when(v == 4, 255).otherwise(v).cast("smallint").alias("value"))


PIXELS = "px AS (SELECT path, CAST(1000 - top + r AS INTEGER) AS grow, CAST(lft + c AS INTEGER) AS gcol, CASE WHEN (r // 2 * 7 + c // 3 * 13 + k * 5) % 5 = 4 THEN 255 ELSE (r // 2 * 7 + c // 3 * 13 + k * 5) % 5 END AS value FROM meta, generate_series(0, 7) a(r), generate_series(0, 7) b(c))"


def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """A tile catalogue with repeated keys, from customers: 40 by 25 tiles, numbered by customer."""
    c = table(spark, d, "customer")
    tile = F.concat(F.lpad((F.col("c_custkey") % 40).cast("string"), 4, "0"), F.lit("_"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"))
    split = F.when(F.col("c_custkey") % 5 == 0, "train").otherwise("test")
    return c.select(split.alias("split"), tile.alias("tile_id"), F.concat(split, F.lit("/orthophoto_"), tile, F.lit(".tif")).alias("orthophoto"), F.concat(split, F.lit("/classification_map_"), tile, F.lit(".tif")).alias("classification_map"), F.concat(F.lit("http://x.example.com/laz/"), F.col("c_name"), F.lit(".copc.laz")).alias("url"), F.col("c_custkey").alias("position"))


CATALOGUE = """cat AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN 'train' ELSE 'test' END AS split, lpad(CAST(c_custkey % 40 AS VARCHAR), 4, '0') || '_' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS tile_id, c_custkey % 40 AS tx, c_nationkey AS ty, 'http://x.example.com/laz/' || c_name || '.copc.laz' AS url, c_custkey AS position FROM customer)"""


def results(spark: SparkSession, d: str) -> DataFrame:
    """Process results from events: errors failed, views are of neither status."""
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("success")
    return table(spark, d, "events").select(F.concat(F.lit("e"), F.col("event_id")).alias("tile_id"), status.alias("status"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("code "), F.col("user_id"))).alias("error"))


def batches(spark: SparkSession, d: str) -> DataFrame:
    """Predictions and targets by batch: the pixels' rows stand for batches."""
    from rasterloom.functions import pixels

    return scores(spark, d).select(F.col("row").alias("batch"), "target", "logits", pixels.argmax(F.col("logits")).alias("pred"))

"""Registered queries that write files and read them back: point files, rasters, mosaics, tables, polygons, checkpoints."""

from __future__ import annotations

import json
import sqlite3
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from rasterloom.functions import names, pixels, scratch
from rasterloom.operators import mosaic, tiles, vector
from rasterloom.plans import adapters as A
from rasterloom.plans.catalog import ARGMAX, query
from rasterloom.sources import checkpoint, las, manifest, tiff, vectors
from rasterloom.sources.tiff import _saved

# text tables


@query("SELECT 'test' AS split, c_name AS tile_id, 'test/' || c_name || '_orthophoto.tif' AS orthophoto, 'test/' || c_name || '_classification_map.tif' AS classification_map, 'http://x.example.com/' || c_custkey || '.laz' AS url FROM customer")
def tile_csv(spark, d):
    """A `;` table with a byte order mark, blanks around its urls."""
    folder = scratch.folder(spark, "csv")
    url = F.concat(F.lit("  http://x.example.com/"), "c_custkey", F.lit(".laz "))
    A.table(spark, d, "customer").select(F.col("c_name").alias("﻿nom"), url.alias("url")).write.options(sep=";", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
    return tiles.entries(manifest.read_tile_csv(spark, folder), "test", F.col("nom"), suffixed=True)


@query("SELECT 'http://x.example.com/' || s_name AS url FROM supplier WHERE s_suppkey % 3 = 0")
def url_list(spark, d):
    """A list of URLs with comments and blank lines."""
    folder = scratch.folder(spark, "urls")
    k = F.col("s_suppkey") % 3
    line = F.when(k == 0, F.concat(F.lit(" http://x.example.com/"), "s_name")).when(k == 1, F.concat(F.lit("# "), "s_name")).otherwise("")
    A.table(spark, d, "supplier").select(line.alias("value")).write.text(folder)
    return manifest.read_url_list(spark, folder)


@query(f"WITH {A.CATALOGUE} SELECT split, tile_id, url, position FROM cat")
def split_folders(spark, d):
    folder = scratch.folder(spark, "splits")
    manifest.write_by_split(A.catalogue(spark, d).select("split", "tile_id", "url", "position"), folder)
    return spark.read.parquet(folder)


# points

_POINTS = "SELECT CAST('p' || (l_orderkey // 500) AS VARCHAR) AS tile_id, round(l_partkey / 10.0, 2) AS x, round(l_suppkey + l_quantity / 50.0, 2) AS y, CAST(l_linenumber AS SMALLINT) AS classification FROM lineitem"


@query(_POINTS)
def las_points(spark, d):
    """A file for each 500 orders."""
    folder = scratch.folder(spark, "las")
    pts = A.table(spark, d, "lineitem").select(F.concat(F.lit("p"), F.floor(F.col("l_orderkey") / 500)).alias("tile_id"), (F.col("l_partkey") / 10.0).alias("x"), (F.col("l_suppkey") + F.col("l_quantity") / 50.0).alias("y"), F.col("l_linenumber").cast("smallint").alias("classification"))

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        tile = pdf["tile_id"].iloc[0]
        return pd.DataFrame({"path": [_saved(folder, f"{tile}.las", las.encode(pdf))]})

    scratch.written(pts.groupBy("tile_id").applyInPandas(put, "path string"), "paths")
    back = las.read(spark, folder)
    return back.select("tile_id", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), "classification")


# rasters

_TILES = "t AS (SELECT CAST(k AS VARCHAR) AS tile_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, CASE WHEN (r // 2 * 7 + c // 3 * 13 + k * 5) % 5 = 4 THEN 255 ELSE (r // 2 * 7 + c // 3 * 13 + k * 5) % 5 END AS value FROM meta, generate_series(0, 7) a(r), generate_series(0, 7) b(c))"


def _grids(spark, d):
    return A.tile_meta(spark, d).select("tile_id", F.col("left").alias("x0"), F.col("top").alias("y1"), "a", "e", "width", "height", "crs")


@query(f"WITH {A.META}, {_TILES} SELECT tile_id, row, col, CAST(value AS DOUBLE) AS value FROM t")
def raster_files(spark, d):
    folder = scratch.folder(spark, "rasters")
    scratch.written(tiff.write(A.tile_pixels(spark, d), _grids(spark, d), folder), "paths")
    return tiff.read(spark, folder)


@query(f"WITH {A.META} SELECT 'prediction_' || tile_id AS tile_id, lft AS x0, top AS y1, CAST(1 AS DOUBLE) AS a, CAST(-1 AS DOUBLE) AS e, 8 AS width, 8 AS height, 'EPSG:2154' AS crs, 'uint8' AS dtype, 1 AS band_count, CAST(255 AS DOUBLE) AS nodata FROM meta")
def raster_metadata(spark, d):
    """Headers alone, of files with nodata."""
    folder = scratch.folder(spark, "rasters")
    scratch.written(tiff.write(A.tile_pixels(spark, d), _grids(spark, d), folder, prefix="prediction_", nodata=255, fill=255), "paths")
    return tiff.metadata(spark, folder, "prediction_*.tif").drop("path")


@query(f"WITH {A.META}, {_TILES} SELECT tile_id, row, col, CAST(value AS DOUBLE) AS r, CAST((value + row) % 256 AS DOUBLE) AS g, CAST((value + col) % 256 AS DOUBLE) AS b FROM t")
def image_files(spark, d):
    """Three bands, read by their numbers."""
    folder = scratch.folder(spark, "images")
    px = A.tile_pixels(spark, d).select("tile_id", "row", "col", F.col("value").alias("r"), ((F.col("value") + F.col("row")) % 256).alias("g"), ((F.col("value") + F.col("col")) % 256).alias("b"))
    scratch.written(tiff.write(px, _grids(spark, d), folder, ("b", "g", "r")), "paths")
    return tiff.read(spark, folder, (3, 2, 1), ("r", "g", "b"))


@query(f"WITH {A.META} SELECT 't' || tile_id || '.tif' AS name FROM meta")
def file_listing(spark, d):
    folder = scratch.folder(spark, "rasters")
    scratch.written(tiff.write(A.tile_pixels(spark, d), _grids(spark, d), folder, prefix="t"), "paths")
    return manifest.files(spark, folder).where("length > 0").select(names.basename(F.col("path")).alias("name"))


@query(f"WITH {A.scores_sql()}, dims AS (SELECT max(row) + 1 AS h FROM img), s AS (SELECT row, col, list_transform(l, lambda v: exp(v - list_max(l))) AS e FROM img), every AS (SELECT CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col FROM dims, LATERAL (SELECT unnest(generate_series(0, h - 1)) AS r) a, generate_series(0, {A.SIDE - 1}) b(c)) SELECT row, col, CAST(coalesce(CASE WHEN e[2] / list_sum(e) >= 0.3 THEN 1 END, 0) AS DOUBLE) AS value FROM every LEFT JOIN s USING (row, col)")
def mask_file(spark, d):
    """One class's mask as a raster file."""
    folder = scratch.folder(spark, "mask")
    mask = A.scores(spark, d).select(F.lit("mask").alias("tile_id"), "row", "col", pixels.postprocessed(F.col("logits"), "binary", 1, 0.3).alias("value"))
    grid = spark.createDataFrame([("mask", 0.0, 0.0, 1.0, -1.0, A.SIDE, A.height(spark, d), "EPSG:2154")], "tile_id string, x0 double, y1 double, a double, e double, width int, height int, crs string")
    scratch.written(tiff.write(mask, grid, folder), "paths")
    return tiff.read(spark, folder).drop("tile_id")


@query(f"WITH {A.scores_sql()} SELECT row, col, CAST({ARGMAX.format('l')} AS SMALLINT) AS value FROM img")
def postprocessed_argmax(spark, d):
    return A.scores(spark, d).select("row", "col", pixels.postprocessed(F.col("logits"), "argmax").alias("value"))


# mosaics

_VOTED = f"{A.META}, {A.PIXELS}, won AS (SELECT grow, gcol, value, row_number() OVER (PARTITION BY grow, gcol ORDER BY count(*) DESC, value) AS k FROM px GROUP BY grow, gcol, value)"


@query(
    f"""WITH {_VOTED}, box AS (SELECT min(lft) AS l, max(rgt) AS r, min(btm) AS b, max(top) AS t FROM meta),
v AS (SELECT grow - CAST(1000 - t AS INTEGER) AS grow, gcol - CAST(l AS INTEGER) AS gcol, value FROM won, box WHERE k = 1),
every AS (SELECT x.i AS grow, y.j AS gcol FROM box, LATERAL (SELECT unnest(generate_series(0, CAST(box.t - box.b AS INTEGER) - 1)) AS i) x, LATERAL (SELECT unnest(generate_series(0, CAST(box.r - box.l AS INTEGER) - 1)) AS j) y)
SELECT CAST(grow AS INTEGER) AS grow, CAST(gcol AS INTEGER) AS gcol, CAST(coalesce(value, 0) AS SMALLINT) AS value FROM every LEFT JOIN v USING (grow, gcol)"""
)
def mosaic_files(spark, d):
    """The mosaic written as rasters by block, and read as one again."""
    folder = scratch.folder(spark, "mosaic")
    meta = A.tile_meta(spark, d)
    merged = mosaic.merged(mosaic.global_pixels(A.tile_pixels(spark, d), mosaic.placed(meta)))
    inner, grids = mosaic.blocks(merged, mosaic.extent(meta).first(), "m", 16, 0)
    scratch.written(tiff.write(inner, grids, folder), "paths")
    back, _ = scratch.written(tiff.metadata(spark, folder), "headers")
    whole = back.withColumns({"left": F.col("x0"), "top": F.col("y1"), "right": F.col("x0") + F.col("a") * F.col("width"), "bottom": F.col("y1") + F.col("e") * F.col("height")})
    return mosaic.global_pixels(tiff.read(spark, folder), mosaic.placed(whole)).select("grow", "gcol", F.col("value").cast("smallint").alias("value"))


# polygons


def _polygons(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """class and area of the features of GeoPackage files."""
    for f in frames:
        rows = []
        for content in f["content"]:
            db = sqlite3.connect(":memory:")
            db.deserialize(bytes(content))
            for blob, cls in db.execute("SELECT geom, vegetation_class FROM vegetation"):
                at, total = 40 + 9, 0.0  # header and envelope, then the polygon's own
                for _ in range(struct.unpack_from("<L", blob, 40 + 5)[0]):
                    n, = struct.unpack_from("<L", blob, at)
                    p = struct.unpack_from(f"<{2 * n}d", blob, at + 4)
                    total += sum(p[2 * k] * p[2 * k + 3] - p[2 * k + 2] * p[2 * k + 1] for k in range(n - 1)) / 2
                    at += 4 + 16 * n
                rows.append((cls, abs(total)))
        yield pd.DataFrame(rows, columns=["vegetation_class", "area"])


@query(f"WITH {A.scores_sql()} SELECT CAST(target AS INTEGER) AS vegetation_class, CAST(count(*) AS DOUBLE) AS area FROM img GROUP BY target")
def polygon_files(spark, d):
    """Regions as GeoPackages, a file for each partition; areas by class of what is read back."""
    folder = scratch.folder(spark, "polygons")
    raster = A.scores(spark, d).select(F.col("row").alias("grow"), F.col("col").alias("gcol"), F.col("target").alias("value"))
    polys = vector.polygons(vector.components(raster)).withColumn("rings", vector.to_map(F.col("rings"), 0.0, 0.0, 1.0, -1.0))
    vectors.write(polys, f"{folder}/v.gpkg", "GPKG", "vegetation_class", single=False)
    back = spark.read.format("binaryFile").load(folder).select("content").mapInPandas(_polygons, "vegetation_class int, area double")
    return back.groupBy("vegetation_class").agg(F.round(F.sum("area"), 6).alias("area"))


# checkpoints


@query("SELECT p_name || p_partkey AS name, 'F32' AS dtype, CAST(p_size AS BIGINT) AS size FROM part WHERE p_partkey % 4 <> 0")
def checkpoint_table(spark, d):
    """Headers of parameter files; losses are left out, and the wrapper's prefix."""
    folder = scratch.folder(spark, "parameters")
    name = F.concat(F.when(F.col("p_partkey") % 4 == 0, "criterion.").otherwise("model."), "p_name", "p_partkey")
    parts = A.table(spark, d, "part").select(name.alias("name"), F.col("p_size").alias("size"), F.floor(F.col("p_partkey") / 100).alias("file"))

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        head = {n: {"dtype": "F32", "shape": [int(s)], "data_offsets": [0, 0]} for n, s in zip(pdf["name"], pdf["size"])}
        raw = json.dumps({"__metadata__": {"format": "pt"}, **head}).encode()
        return pd.DataFrame({"path": [_saved(folder, f"p{pdf['file'].iloc[0]}.safetensors", struct.pack("<Q", len(raw)) + raw)]})

    scratch.written(parts.groupBy("file").applyInPandas(put, "path string"), "paths")
    return checkpoint.read(spark, folder).select("name", "dtype", "size")


@query("SELECT c_custkey, c_custkey || '_' || c_nationkey AS parts FROM customer")
def block_parts(spark, d):
    url = F.concat(F.lit("http://x.example.com/LHD_FXX_"), "c_custkey", F.lit("_"), "c_nationkey", F.lit("_PTS.laz"))
    return A.table(spark, d, "customer").select("c_custkey", names.block_parts(url).alias("parts"))

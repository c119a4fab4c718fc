"""Tile catalogues: manifest rows, tile maps, neighbours and context mosaics.

A catalogue: split, tile_id, orthophoto, classification_map, url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import names

# The nine places around a tile, by row and column of the mosaic from the north-west; y grows north.
PLACES = [("NW", 0, 0, -1, 1), ("N", 0, 1, 0, 1), ("NE", 0, 2, 1, 1), ("W", 1, 0, -1, 0), ("C", 1, 1, 0, 0), ("E", 1, 2, 1, 0), ("SW", 2, 0, -1, -1), ("S", 2, 1, 0, -1), ("SE", 2, 2, 1, -1)]


def entries(urls: DataFrame, split: str, tile: Column | None = None, suffixed: bool = False) -> DataFrame:
    """Catalogue rows of a split from a column url. suffixed: names as `{id}_orthophoto.tif` instead of `orthophoto_{id}.tif`."""
    i = names.block_id(F.col("url")) if tile is None else tile
    path = (lambda kind: F.concat(F.lit(f"{split}/"), i, F.lit(f"_{kind}.tif"))) if suffixed else (lambda kind: F.concat(F.lit(f"{split}/{kind}_"), i, F.lit(".tif")))
    return urls.select(F.lit(split).alias("split"), i.alias("tile_id"), path("orthophoto").alias("orthophoto"), path("classification_map").alias("classification_map"), "url")


def tile_list(catalogue: DataFrame, splits: list[str], base: str = "") -> DataFrame:
    """The catalogue's rows of the splits, with each split's folder."""
    return catalogue.where(F.col("split").isin(*splits)).withColumn("folder", F.concat(F.lit(base.rstrip("/") + "/" if base else ""), F.col("split")))


def tile_map(catalogue: DataFrame, order: str, files: DataFrame | None = None) -> DataFrame:
    """One row for each parsed key (tx, ty): the last by `order`. files: only rows whose orthophoto is among these paths."""
    keyed = catalogue.withColumn("key", names.tile_key(F.col("tile_id"))).where("key IS NOT NULL")
    if files is not None:
        keyed = keyed.join(files.select(F.col("path").alias("have")).distinct(), F.col("orthophoto") == F.col("have"), "left_semi")
    keyed = keyed.withColumn("tx", F.col("key.tx")).withColumn("ty", F.col("key.ty")).drop("key")
    last = F.max_by(F.struct(*[c for c in keyed.columns if c not in ("tx", "ty")]), F.col(order))
    return keyed.groupBy("tx", "ty").agg(last.alias("r")).select("tx", "ty", "r.*")


def key_range(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.count("*").alias("n_tiles"), F.min("tx").alias("min_x"), F.max("tx").alias("max_x"), F.min("ty").alias("min_y"), F.max("ty").alias("max_y"))


def neighbours(tiles: DataFrame, step: int = 5) -> DataFrame:
    """Nine rows for each tile (tx, ty, tile_id): place, mosaic row and column, and the neighbour's id or null."""
    around = F.array(*[F.struct(F.lit(n).alias("place"), F.lit(r).alias("ri"), F.lit(c).alias("ci"), F.lit(dx * step).alias("dx"), F.lit(dy * step).alias("dy")) for n, r, c, dx, dy in PLACES])
    asked = tiles.select("tx", "ty", "tile_id", F.explode(around).alias("o")).select("tx", "ty", "tile_id", "o.place", "o.ri", "o.ci", (F.col("tx") + F.col("o.dx")).alias("nx"), (F.col("ty") + F.col("o.dy")).alias("ny"))
    other = tiles.select(F.col("tx").alias("nx"), F.col("ty").alias("ny"), F.col("tile_id").alias("neighbour"))
    return asked.join(other, ["nx", "ny"], "left").select("tx", "ty", "tile_id", "place", "ri", "ci", "neighbour")


def context_mosaic(around: DataFrame, pixels: DataFrame, size: int, bands: list[str], dense: bool = False, reach: int | None = None) -> DataFrame:
    """Pixels of each centre tile's 3 x 3 mosaic: tile_id, mrow, mcol and bands; dense: missing ones as 0; reach: only
    those at most so many pixels from the centre tile."""
    have = around.where("neighbour IS NOT NULL").select("tile_id", "ri", "ci", "neighbour")
    p = pixels.select(F.col("tile_id").alias("neighbour"), "row", "col", *bands)
    out = have.join(p, "neighbour").select("tile_id", (F.col("row") + F.col("ri") * size).cast("int").alias("mrow"), (F.col("col") + F.col("ci") * size).cast("int").alias("mcol"), *bands)
    low, high = (0, 3 * size - 1) if reach is None else (max(0, size - reach), min(3 * size, 2 * size + reach) - 1)
    if reach is not None:
        out = out.where(F.col("mrow").between(low, high) & F.col("mcol").between(low, high))
    if not dense:
        return out
    centres = around.where("place = 'C' AND neighbour IS NOT NULL").select("tile_id")
    line = F.sequence(F.lit(low), F.lit(high))
    cells = centres.select("tile_id", F.explode(line).alias("mrow")).select("tile_id", "mrow", F.explode(line).alias("mcol"))
    return cells.join(out, ["tile_id", "mrow", "mcol"], "left").select("tile_id", "mrow", "mcol", *[F.coalesce(b, F.lit(0)).alias(b) for b in bands])


def centre(mosaic: DataFrame, size: int, row: str = "mrow", col: str = "mcol") -> DataFrame:
    """The middle tile of a 3 x 3 mosaic; the filter reaches a Parquet scan."""
    inside = F.col(row).between(size, 2 * size - 1) & F.col(col).between(size, 2 * size - 1)
    return mosaic.where(inside).withColumn(row, F.col(row) - size).withColumn(col, F.col(col) - size)


def predictions_by_split(files: DataFrame) -> DataFrame:
    """How many `prediction_*.tif` each split has, of a column path ending in split/name."""
    parts = F.split("path", "/")
    named = files.where(names.basename(F.col("path")).rlike(r"^prediction_.*\.tif$"))
    return named.groupBy(F.element_at(parts, -2).alias("split")).agg(F.count("*").alias("n"))

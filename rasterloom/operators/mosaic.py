"""Mosaics of overlapping tiles: extents, checks, placement and conflict resolution.

meta: path, tile_id, left, bottom, right, top, a (pixel width), e (pixel height, below 0), width, height, crs, dtype,
band_count. Pixels: tile_id, row, col, value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import grid

STRATEGIES = ("mode", "last")
REFERENCE = ("a", "e", "crs", "dtype", "band_count")


def extent(meta: DataFrame) -> DataFrame:
    """One row: the union's bounds, and the first tile's (by path) resolution, CRS, type and band count as ref_*."""
    first = F.min_by(F.struct(*REFERENCE), "path").alias("r")
    box = meta.agg(F.min("left").alias("left"), F.min("bottom").alias("bottom"), F.max("right").alias("right"), F.max("top").alias("top"), first)
    out = box.select("left", "bottom", "right", "top", *[F.col(f"r.{c}").alias(f"ref_{c}") for c in REFERENCE])
    return out.withColumn("width", F.bround((F.col("right") - F.col("left")) / F.col("ref_a"), 0).cast("int")).withColumn("height", F.bround((F.col("top") - F.col("bottom")) / -F.col("ref_e"), 0).cast("int"))


def checked(meta: DataFrame, tolerance: float = 1e-3, resample: bool = False) -> DataFrame:
    """meta beside the mosaic's ref_* with needs_resample and dtype_differs; another CRS, band count or (unless resample)
    resolution raises an error when the row is computed."""
    ref = extent(meta).select(*[f"ref_{c}" for c in REFERENCE])
    both = meta.crossJoin(F.broadcast(ref))  # one row
    wide = grid.differs(F.col("a"), F.col("ref_a"), tolerance) | grid.differs(F.col("e"), F.col("ref_e"), tolerance)
    fault = F.when(F.col("crs") != F.col("ref_crs"), "CRS").when(F.col("band_count") != F.col("ref_band_count"), "band count")
    if not resample:
        fault = F.coalesce(fault, F.when(wide, F.lit("resolution")))
    # needs_resample is known wherever there is no fault
    guard = F.when(fault.isNotNull(), F.raise_error(F.concat(F.col("path"), F.lit(": another "), fault)).cast("boolean"))
    return both.withColumn("needs_resample", F.coalesce(guard, wide)).withColumn("dtype_differs", F.col("dtype") != F.col("ref_dtype"))


def verified(meta: DataFrame, tolerance: float = 1e-3, resample: bool = False) -> tuple[int, int]:
    """How many tiles need resampling and how many have another data type; raises what `checked` raises. One aggregate
    over all rows, so that no fault is skipped."""
    return tuple(checked(meta, tolerance, resample).agg(F.count_if("needs_resample"), F.count_if("dtype_differs")).first())


def on_grid(pixels: DataFrame, meta: DataFrame, tolerance: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """The pixels and meta with the tiles of another resolution brought to the mosaic's by nearest neighbour."""
    both = checked(meta, tolerance, resample=True)
    size = lambda d, r: F.bround(d / r, 0).cast("int")
    odd = both.where("needs_resample").select(
        "tile_id", F.col("width").alias("from_width"), F.col("height").alias("from_height"), size(F.col("right") - F.col("left"), F.col("ref_a")).alias("to_width"), size(F.col("top") - F.col("bottom"), -F.col("ref_e")).alias("to_height")
    )
    cells = odd.select("*", F.explode(F.expr("sequence(0, to_height - 1)")).alias("row")).select("*", F.explode(F.expr("sequence(0, to_width - 1)")).alias("col"))
    source = lambda k, have, want: F.least(F.floor((F.col(k) + 0.5) * F.col(have) / F.col(want)).cast("int"), F.col(have) - 1)
    at = cells.select("tile_id", "row", "col", source("row", "from_height", "to_height").alias("srow"), source("col", "from_width", "to_width").alias("scol"))
    src = pixels.select(F.col("tile_id").alias("of"), F.col("row").alias("r"), F.col("col").alias("c"), "value")
    resampled = at.join(src, (F.col("tile_id") == F.col("of")) & (F.col("srow") == F.col("r")) & (F.col("scol") == F.col("c"))).select("tile_id", "row", "col", "value")
    ids = odd.select("tile_id")
    grids = both.withColumns({"a": F.when(F.col("needs_resample"), F.col("ref_a")).otherwise(F.col("a")), "e": F.when(F.col("needs_resample"), F.col("ref_e")).otherwise(F.col("e"))})
    return pixels.join(ids, "tile_id", "left_anti").select("tile_id", "row", "col", "value").unionByName(resampled), grids.select(*meta.columns)


def placed(meta: DataFrame, mosaic: DataFrame | None = None) -> DataFrame:
    """tile_id, path, and where the tile's corner lies in the mosaic: row0, col0, rows, cols."""
    box = (extent(meta) if mosaic is None else mosaic).select(F.col("left").alias("m_left"), F.col("top").alias("m_top"), "ref_a", "ref_e")
    b = meta.crossJoin(F.broadcast(box))
    size = lambda d, r: F.bround(d / r, 0).cast("int")
    return b.select(
        "tile_id",
        "path",
        grid.offset(F.col("m_top") - F.col("top"), -F.col("ref_e")).alias("row0"),
        grid.offset(F.col("left") - F.col("m_left"), F.col("ref_a")).alias("col0"),
        size(F.col("top") - F.col("bottom"), -F.col("ref_e")).alias("rows"),
        size(F.col("right") - F.col("left"), F.col("ref_a")).alias("cols"),
    )


def global_pixels(pixels: DataFrame, places: DataFrame) -> DataFrame:
    """path, grow, gcol, value of all tiles' pixels. The places are hashed: pixels that an explode makes are estimated
    as small as what they are made from, and would be broadcast."""
    p = places.select(F.col("tile_id").alias("of"), "path", "row0", "col0").hint("shuffle_hash")
    return pixels.join(p, F.col("tile_id") == F.col("of")).select("path", (F.col("row") + F.col("row0")).alias("grow"), (F.col("col") + F.col("col0")).alias("gcol"), "value")


def clip(value: Column, clip_range: tuple[int, int] | None) -> Column:
    """Values within the range; only where both ends are given."""
    return value if clip_range is None or None in clip_range else grid.clipped(value, *clip_range).cast("smallint")


def detected(pixels: DataFrame, nodata: int | None = None) -> DataFrame:
    """The classes that occur, in order, but for nodata; values as they come, before clipping."""
    out = pixels.select("value").distinct()
    return (out if nodata is None else out.where(F.col("value") != nodata)).orderBy("value")


def merged(pixels: DataFrame, strategy: str = "mode", nodata: int | None = None, clip_range: tuple[int, int] | None = None) -> DataFrame:
    """One value for each global pixel that some tile covers.

    mode: the most frequent class, the least of equals. Votes are the clipped values, but only for classes that occur
    unclipped, and nodata (after clipping) has none; a pixel without votes gets nodata, or the least class.
    last: the tile that comes last by path, nodata and all.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    if strategy == "last":
        return pixels.groupBy("grow", "gcol").agg(F.max_by(clip(F.col("value"), clip_range), "path").alias("value"))
    v = clip(F.col("value"), clip_range)
    if nodata is not None:
        v = F.when(v != nodata, v)
    if clip_range is None or None in clip_range:
        vote = pixels.withColumn("vote", v)
    else:  # a clipped value counts only if it occurs by itself somewhere
        seen = detected(pixels, nodata).select(F.col("value").alias("seen"))
        vote = pixels.withColumn("v", v).join(F.broadcast(seen), F.col("v") == F.col("seen"), "left").withColumn("vote", F.col("seen"))
    won = vote.groupBy("grow", "gcol").agg(F.mode("vote", True).alias("value"))
    if nodata is not None:
        return won.withColumn("value", F.coalesce("value", F.lit(nodata)).cast("smallint"))
    least = pixels.agg(F.min("value").alias("least"))
    return won.crossJoin(F.broadcast(least)).select("grow", "gcol", F.coalesce("value", "least").cast("smallint").alias("value"))


def filled(mosaic: DataFrame, height: int, width: int, fill: int) -> DataFrame:
    """All pixels of the mosaic; those that no tile covers get the fill."""
    cells = mosaic.sparkSession.range(height).select(F.col("id").cast("int").alias("grow")).select("grow", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("gcol"))
    return cells.join(mosaic, ["grow", "gcol"], "left").withColumn("value", F.coalesce("value", F.lit(fill)).cast("smallint"))


def tile_blocks(places: DataFrame, block: int = 2048) -> DataFrame:
    """Each tile with every block of the mosaic that it meets, and the rectangle they share.

    A tile lists its blocks by arithmetic, so the range join becomes an explode.
    """
    r1, c1 = F.col("row0") + F.col("rows"), F.col("col0") + F.col("cols")
    span = lambda low, high: F.sequence(F.floor(low / block), F.floor((high - 1) / block))
    each = places.select("*", F.explode(span(F.col("row0"), r1)).alias("block_row")).select("*", F.explode(span(F.col("col0"), c1)).alias("block_col"))
    edge = lambda k: F.col(k) * block
    return each.select(
        "tile_id",
        F.col("block_row").cast("int").alias("block_row"),
        F.col("block_col").cast("int").alias("block_col"),
        F.greatest("row0", edge("block_row")).cast("int").alias("r0"),
        F.least(r1, edge("block_row") + block).cast("int").alias("r1"),
        F.greatest("col0", edge("block_col")).cast("int").alias("c0"),
        F.least(c1, edge("block_col") + block).cast("int").alias("c1"),
    )


def blocks(mosaic: DataFrame, extent_row, name: str, block: int, fill: int) -> tuple[DataFrame, DataFrame]:
    """The mosaic cut into rasters of at most block x block pixels: pixels (tile_id, row, col, value) and the grid of
    each (tile_id, x0, y1, a, e, width, height, crs). extent_row: what `extent` gives. Blocks without a pixel are there."""
    e = extent_row
    spark = mosaic.sparkSession
    edge = lambda n, k: F.least(F.lit(n) - F.col(k) * block, F.lit(block)).cast("int")
    grid_ = spark.range(-(-e.height // block)).select(F.col("id").alias("br")).crossJoin(spark.range(-(-e.width // block)).select(F.col("id").alias("bc")))
    label = F.concat_ws("_", F.lit(name), F.col("br").cast("string"), F.col("bc").cast("string"))
    grids = grid_.select(label.alias("tile_id"), (F.lit(e.left) + F.col("bc") * block * F.lit(e.ref_a)).alias("x0"), (F.lit(e.top) + F.col("br") * block * F.lit(e.ref_e)).alias("y1"), F.lit(e.ref_a).alias("a"), F.lit(e.ref_e).alias("e"), edge(e.width, "bc").alias("width"), edge(e.height, "br").alias("height"), F.lit(e.ref_crs).alias("crs"))
    own = mosaic.withColumns({"br": F.floor(F.col("grow") / block), "bc": F.floor(F.col("gcol") / block)})
    inner = own.select(label.alias("tile_id"), (F.col("grow") - F.col("br") * block).cast("int").alias("row"), (F.col("gcol") - F.col("bc") * block).cast("int").alias("col"), "value")
    corners = grids.select("tile_id", F.lit(0).alias("row"), F.lit(0).alias("col"))  # so that empty blocks are written, too
    taken = inner.where("row = 0 AND col = 0").select("tile_id").hint("shuffle_hash")
    missing = corners.join(taken, "tile_id", "left_anti").withColumn("value", F.lit(fill).cast(mosaic.schema["value"].dataType))
    return inner.unionByName(missing), grids


def write(mosaic: DataFrame, path: str, block: int = 512, mode: str = "errorifexists") -> None:
    """The mosaic as Parquet, laid out by blocks; an existing output is an error unless mode says otherwise."""
    keyed = mosaic.withColumn("block_row", F.floor(F.col("grow") / block).cast("int")).withColumn("block_col", F.floor(F.col("gcol") / block).cast("int"))
    keyed.repartitionByRange("block_row", "block_col").sortWithinPartitions("block_row", "block_col", "grow", "gcol").write.mode(mode).parquet(path)

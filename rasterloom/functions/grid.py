"""Grid geometry as expressions: cells, dimensions, offsets, windows and blend weights."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a row that are filled at once.
SEGMENT = 4096


def truncated(x: Column) -> Column:
    """Towards zero, as an int."""
    return F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("int")


def clipped(x: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.least(F.greatest(x, low), high)


def cells_across(low: Column, high: Column, cell: float) -> Column:
    return F.ceil((high - low) / F.lit(float(cell))).cast("int")


def cell_of(distance: Column, cell: float, count: Column) -> Column:
    """The cell at a distance from the grid's edge, kept inside the grid."""
    return clipped(truncated(distance / F.lit(float(cell))), F.lit(0), count - 1)


def resized_across(low: Column, high: Column, resolution: float) -> Column:
    """Pixels of an extent at a resolution, truncated."""
    return truncated((high - low) / F.lit(float(resolution)))


def offset(delta: Column, resolution: Column | float) -> Column:
    """Pixels that a tile's edge lies from the mosaic's, rounded half to even."""
    r = resolution if isinstance(resolution, Column) else F.lit(float(resolution))
    return F.bround(delta / r, 0).cast("int")


def pixel_size(low: Column, high: Column, n: Column) -> Column:
    """A transform's pixel size from bounds and count."""
    return (high - low) / n


def differs(a: Column, b: Column, tolerance: float = 1e-3) -> Column:
    """Whether two resolutions differ by more than the tolerance."""
    return F.abs(a - b) > F.lit(tolerance)


def window_starts(length: Column, tile: int, overlap: int) -> Column:
    """Starts of the windows along an axis, as an array; those at the end snap inwards and may repeat."""
    stride = tile - overlap
    if stride == 0:
        raise ValueError("tile and overlap are equal: the stride is 0")
    if stride < 0:
        return F.expr("CAST(array() AS ARRAY<INT>)")
    at = F.sequence(F.lit(0), F.greatest(length - 1, F.lit(0)), F.lit(stride))
    starts = F.transform(at, lambda y: F.greatest(F.lit(0), F.least(y + tile, length) - tile).cast("int"))
    return F.when(length > 0, starts).otherwise(F.expr("CAST(array() AS ARRAY<INT>)"))


def windows(images: DataFrame, height: str, width: str, tile: int, overlap: int) -> DataFrame:
    """A row for each window of each image: y, x, h, w and its number; repeats are kept."""
    rows = images.select("*", F.posexplode(window_starts(F.col(height), tile, overlap)).alias("wy", "y"))
    both = rows.select("*", F.posexplode(window_starts(F.col(width), tile, overlap)).alias("wx", "x"))
    return both.withColumn("h", F.least(F.lit(tile), F.col(height))).withColumn("w", F.least(F.lit(tile), F.col(width)))


def filled(runs: DataFrame, dims: DataFrame, fill: int = 0) -> DataFrame:
    """All cells (tile_id, row, col, value) of each tile's grid, where runs have none the fill.

    runs: tile_id, row, c0, c1 (after the last), value; what lies outside the grid is left out. dims: tile_id, rows,
    cols, a row a tile. Only runs and a start for each SEGMENT cells of a row are shuffled and sorted; each makes its
    own cells and the gap up to the next, so cells are neither shuffled nor joined, and a task holds at most SEGMENT.
    """
    kind = runs.schema["value"].dataType
    rows = dims.select("tile_id", "cols", F.explode(F.expr("CASE WHEN rows > 0 THEN sequence(0, rows - 1) END")).alias("row")).select("tile_id", "row", "cols", F.explode(F.expr(f"CASE WHEN cols > 0 THEN sequence(0, CAST(floor((cols - 1) / {SEGMENT}) AS INT)) END")).alias("part"))
    low = F.col("part") * SEGMENT
    starts = rows.select("tile_id", "row", "part", low.alias("c0"), low.alias("c1"), F.lit(None).cast(kind).alias("value"), F.least(low + SEGMENT, "cols").alias("stop"))
    inside = runs.where("tile_id IS NOT NULL AND row >= 0 AND c0 < c1 AND c1 > 0").withColumn("c0", F.greatest("c0", F.lit(0)))
    cut = inside.withColumn("part", F.explode(F.expr(f"sequence(CAST(floor(c0 / {SEGMENT}) AS INT), CAST(floor((c1 - 1) / {SEGMENT}) AS INT))")))
    own = cut.select("tile_id", "row", "part", F.greatest("c0", low).alias("c0"), F.least("c1", low + SEGMENT).alias("c1"), "value", F.lit(None).cast("int").alias("stop"))
    # a number of partitions, as their bytes do not tell how many cells they make
    dealt = starts.unionByName(own).repartition(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "tile_id", "row", "part")
    w = Window.partitionBy("tile_id", "row", "part").orderBy("c0", F.col("stop").asc_nulls_last())
    spans = dealt.withColumns({"upto": F.first("stop").over(w.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("c0").over(w)}).where("c0 < upto")
    end = F.least("upto", F.greatest("c1", F.coalesce("next", "upto")))
    cells = spans.withColumn("end", end).where("c0 < end").select("tile_id", "row", "c1", "value", F.explode(F.expr("sequence(c0, end - 1)")).alias("col"))
    return cells.select("tile_id", "row", "col", F.when(F.col("col") < F.col("c1"), F.coalesce("value", F.lit(fill))).otherwise(F.lit(fill)).cast("smallint").alias("value"))


def first_at(f: Callable[[Column], Column], value: Column, low: Column, stop: Column, near: Column) -> Column:
    """The first whole k from low on with f(k) >= value, stop if none is below it; f never falls. near: a guess, looked at
    with its neighbours; where none is right, k is found by halving."""
    guess = clipped(F.coalesce(near, low), low, stop).cast("int")
    right = lambda k: ((k <= low) | (f(k - 1) < value)) & ((k >= stop) | (f(k) >= value))

    def halved(s: Column, _: Column) -> Column:
        k = s["a"] + F.floor((s["b"] - s["a"]) / 2).cast("int")
        later = f(k) < value
        return F.when(s["a"] >= s["b"], s).when(later, F.struct((k + 1).alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), k.alias("b")))

    searched = F.aggregate(F.sequence(F.lit(1), F.lit(32)), F.struct(low.cast("int").alias("a"), stop.cast("int").alias("b")), halved)["a"]
    return F.when(right(guess), guess).when(right(guess + 1), guess + 1).when(right(guess - 1), guess - 1).otherwise(searched)


def _ramp(i: Column, overlap: int) -> Column:
    if overlap == 1:
        return F.lit(0.0)
    return F.lit(0.5) - F.lit(0.5) * F.cos(F.lit(math.pi) * i / F.lit(float(overlap - 1)))


def blend_weight(y: Column, x: Column, h: Column, w: Column, overlap: int) -> Column:
    """The cosine ramp's weight of a window pixel: by rows the later ramp wins, by columns both multiply."""
    if overlap <= 0:
        return F.lit(1.0)
    rows = F.when(h <= overlap, 1.0).when(y >= h - overlap, _ramp(h - 1 - y, overlap)).when(y < overlap, _ramp(y, overlap)).otherwise(1.0)
    left = F.when(x < overlap, _ramp(x, overlap)).otherwise(1.0)
    right = F.when(x >= w - overlap, _ramp(w - 1 - x, overlap)).otherwise(1.0)
    return rows * F.when(w <= overlap, 1.0).otherwise(left * right)

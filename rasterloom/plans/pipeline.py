"""The five stages from points and images to polygons, as one lazy chain of DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators import blend, fuse, mosaic, points, tiles, vector


def prepared(cloud: DataFrame, resolution: float = 0.8, extended: bool = True) -> tuple[DataFrame, DataFrame]:
    """Stage 2: class rasters of all tiles and their grids."""
    return points.rasterized(cloud, resolution, extended), points.extents(cloud, resolution)


def predicted(centres: DataFrame, pixels: DataFrame, size: int, bands: list[str], model: Callable[[DataFrame], DataFrame], classes: int, tile: int = 384, overlap: int = 192, step: int = 5, modes=blend.DEFAULT_MODES, simplify: bool = True, bias=None, margin: float = 3.0) -> DataFrame:
    """Stage 3: class maps of tiles (tx, ty, tile_id) by a model that sees each tile's 3 x 3 context.

    All tiles go through together: windows, blending and augmentation are keyed by tile. Windows that do not meet the
    centre are never cut, and of the neighbours only what such windows reach takes part; blending is by pixel, so the
    centre's scores are the same. `context.predicted` does the same for image files, a task a tile.
    """
    around = tiles.neighbours(centres, step)
    context = tiles.context_mosaic(around, pixels, size, bands, dense=True, reach=tile - 1).withColumnsRenamed({"mrow": "row", "mcol": "col"})
    side = 3 * size
    passes = []
    for mode in ("original", *(modes or ())):
        r, c, _, _ = blend.augmented(mode, F.col("row"), F.col("col"), F.lit(side), F.lit(side))
        turned = context.select("tile_id", r.alias("row"), c.alias("col"), *bands)
        # the centre is the centre in every mode
        scores = model(blend.windowed(turned, side, side, tile, overlap, (size, 2 * size)))
        inside = F.col("row").between(size, 2 * size - 1) & F.col("col").between(size, 2 * size - 1)
        out = blend.blended(scores.where(inside), classes, overlap, ("tile_id", "row", "col"))
        r, c = blend.deaugmented(mode, F.col("row"), F.col("col"), F.lit(side), F.lit(side))
        passes.append(out.select("tile_id", (r - size).alias("row"), (c - size).alias("col"), "logits"))
    mean = passes[0] if len(passes) == 1 else blend.averaged(passes, classes, ("tile_id", "row", "col"))
    return blend.class_map(mean, bias, margin, simplify)


def land_cover(cloud_raster: DataFrame, model_raster: DataFrame, meta: DataFrame, strategy: str = "mode", clip_range: tuple[int, int] | None = (0, 3), nodata: int | None = None) -> DataFrame:
    """Stages 4 and 5: fused tiles as one mosaic (grow, gcol, value)."""
    merged = fuse.fused(cloud_raster, model_raster).select("tile_id", "row", "col", "value")
    return mosaic.merged(mosaic.global_pixels(merged, mosaic.placed(meta)), strategy, nodata, clip_range)


def vectorized(raster: DataFrame, eight: bool = False, nodata: int | None = None) -> DataFrame:
    return vector.polygons(vector.components(raster, eight, nodata))

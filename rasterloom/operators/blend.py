"""Windowed model inference with weighted blending and test-time augmentation.

Scores are arrays of one value per class; pixels are rows. Each augmentation mode is a change of coordinates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import grid, pixels

MODES = ("original", "hflip", "vflip", "hvflip", "rot90", "rot180", "rot270")
DEFAULT_MODES = ("hflip", "vflip", "hvflip")


def augmented(mode: str, row: Column, col: Column, height: Column, width: Column) -> tuple[Column, Column, Column, Column]:
    """Where a pixel goes in a mode, and the augmented image's height and width."""
    if mode == "original":
        return row, col, height, width
    if mode == "hflip":
        return row, width - 1 - col, height, width
    if mode == "vflip":
        return height - 1 - row, col, height, width
    if mode in ("hvflip", "rot180"):
        return height - 1 - row, width - 1 - col, height, width
    if mode == "rot90":
        return width - 1 - col, row, width, height
    if mode == "rot270":
        return col, height - 1 - row, width, height
    raise ValueError(f"unknown augmentation {mode}")


def deaugmented(mode: str, row: Column, col: Column, height: Column, width: Column) -> tuple[Column, Column]:
    """Back from the augmented image's place; height and width of the image as it was."""
    if mode in ("original", "hflip", "vflip", "hvflip", "rot180"):
        return augmented(mode, row, col, height, width)[:2]
    if mode == "rot90":
        return col, width - 1 - row
    if mode == "rot270":
        return height - 1 - col, row
    raise ValueError(f"unknown augmentation {mode}")


def windowed(image: DataFrame, height: int, width: int, tile: int, overlap: int, box: tuple[int, int] | None = None) -> DataFrame:
    """Each pixel once for each window that covers it: y, x, h, w and the place inside, wr and wc. Repeated windows repeat.

    A pixel's windows follow from its place, so no join is needed. box: only windows that meet these rows and columns.
    """
    ys = grid.window_starts(F.lit(height), tile, overlap)
    xs = grid.window_starts(F.lit(width), tile, overlap)
    h, w = min(tile, height), min(tile, width)
    if box is not None:
        ys, xs = F.filter(ys, lambda y: (y < box[1]) & (y + h > box[0])), F.filter(xs, lambda x: (x < box[1]) & (x + w > box[0]))
    rows = image.select("*", F.explode(F.filter(ys, lambda y: (F.col("row") >= y) & (F.col("row") < y + h))).alias("y"))
    both = rows.select("*", F.explode(F.filter(xs, lambda x: (F.col("col") >= x) & (F.col("col") < x + w))).alias("x"))
    return both.select("*", F.lit(h).alias("h"), F.lit(w).alias("w"), (F.col("row") - F.col("y")).alias("wr"), (F.col("col") - F.col("x")).alias("wc"))


def blended(windows: DataFrame, classes: int, overlap: int, keys: tuple[str, ...] = ("row", "col"), scores: str = "logits") -> DataFrame:
    """Weighted mean of the window scores of each pixel; where all weights are 0, the scores are 0.

    A running sum for each class keeps the aggregation map-side and in one shuffle.
    """
    wt = grid.blend_weight(F.col("wr"), F.col("wc"), F.col("h"), F.col("w"), overlap)
    weighed = windows.withColumn("_w", wt)
    sums = weighed.groupBy(*keys).agg(F.sum("_w").alias("_w"), *[F.sum(F.col(scores)[k] * F.col("_w")).alias(f"_s{k}") for k in range(classes)])
    return sums.select(*keys, F.array(*[F.when(F.col("_w") > 0, F.col(f"_s{k}") / F.col("_w")).otherwise(0.0) for k in range(classes)]).alias(scores))


def averaged(passes: list[DataFrame], classes: int, keys: tuple[str, ...] = ("row", "col"), scores: str = "logits") -> DataFrame:
    """The mean over the passes, each brought back to the image's own places."""
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    return every.groupBy(*keys).agg(F.array(*[F.sum(F.col(scores)[k]) / F.lit(float(len(passes))) for k in range(classes)]).alias(scores))


def segmented(image: DataFrame, height: int, width: int, model: Callable[[DataFrame], DataFrame], classes: int, tile: int = 512, overlap: int = 256, modes: tuple[str, ...] | None = DEFAULT_MODES) -> DataFrame:
    """Blended scores of an image (row, col and bands): original and modes, averaged.

    model: from windowed pixels (with y, x, h, w, wr, wc) to the same rows with `logits`.
    """
    passes = []
    for mode in ("original", *(modes or ())):
        r, c, h, w = augmented(mode, F.col("row"), F.col("col"), F.lit(height), F.lit(width))
        rest = [x for x in image.columns if x not in ("row", "col")]
        turned = image.select(r.alias("row"), c.alias("col"), *rest)
        size = (width, height) if mode in ("rot90", "rot270") else (height, width)
        out = blended(model(windowed(turned, *size, tile, overlap)), classes, overlap)
        r, c = deaugmented(mode, F.col("row"), F.col("col"), F.lit(height), F.lit(width))
        passes.append(out.select(r.alias("row"), c.alias("col"), "logits"))
    return passes[0] if len(passes) == 1 else averaged(passes, classes)


def lit_windows(windows: DataFrame, bands: list[str], least: int = 10, keys: tuple[str, ...] = ("y", "x")) -> DataFrame:
    """Windows whose brightest value reaches the least; the dark ones never reach the model."""
    top = windows.groupBy(*keys).agg(F.max(F.greatest(*bands) if len(bands) > 1 else F.col(bands[0])).alias("_top")).where(F.col("_top") >= least)
    return windows.join(top.select(*[F.col(k).alias(f"_{k}") for k in keys]), [F.col(k) == F.col(f"_{k}") for k in keys], "left_semi")


_models: dict = {}


def loaded(key: str, load: Callable[[], Callable]) -> Callable:
    """A model held once in each Python worker."""
    if key not in _models:
        _models[key] = load()
    return _models[key]


def infer(windows: DataFrame, keys: list[str], bands: list[str], key: str, load: Callable[[], Callable], classes: int) -> DataFrame:
    """A pluggable model on whole windows: it maps an (h, w, bands) array to (h, w, classes); each window is one group.

    keys name the window and must hold y, x, h and w; rows need wr and wc.
    """
    import numpy as np
    import pandas as pd

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in windows.schema.fields if f.name not in bands) + ", logits array<double>"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = loaded(key, load)
        h, w = int(pdf["h"].iloc[0]), int(pdf["w"].iloc[0])
        cube = np.zeros((h, w, len(bands)), np.float64)
        r, c = pdf["wr"].to_numpy(), pdf["wc"].to_numpy()
        cube[r, c] = pdf[bands].to_numpy()
        scores = np.asarray(model(cube), np.float64)
        if scores.shape[:2] != (h, w):  # the model's own resolution
            scores = _bilinear(scores, h, w)
        out = pdf.drop(columns=bands)
        out["logits"] = list(scores[r, c, :classes])
        return out

    return windows.groupBy(*keys).applyInPandas(run, schema)


def _bilinear(a, h: int, w: int):
    """Resized with corners not aligned."""
    import numpy as np

    def axis(n: int, m: int):
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), at - low

    r0, r1, fr = axis(a.shape[0], h)
    c0, c1, fc = axis(a.shape[1], w)
    top = a[r0][:, c0] * (1 - fc)[None, :, None] + a[r0][:, c1] * fc[None, :, None]
    low = a[r1][:, c0] * (1 - fc)[None, :, None] + a[r1][:, c1] * fc[None, :, None]
    return top * (1 - fr)[:, None, None] + low * fr[:, None, None]


def class_map(scores: DataFrame, bias: dict[int, float] | None = None, margin: float = 0.0, simplify: bool = False) -> DataFrame:
    return scores.withColumn("value", pixels.decided(F.col("logits"), bias, margin, simplify)).drop("logits")


def binary_map(scores: DataFrame, class_id: int, threshold: float = 0.5) -> DataFrame:
    return scores.withColumn("value", pixels.thresholded(pixels.softmax(F.col("logits"))[class_id], threshold)).drop("logits")


def positives(mask: DataFrame) -> DataFrame:
    """Count and percent of set pixels."""
    return mask.agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("n"), (100.0 * F.coalesce(F.sum("value"), F.lit(0)) / F.count("*")).alias("percent"))



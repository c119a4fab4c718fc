"""Class maps of tiles by a model that sees each tile's 3 x 3 context, a task a tile.

Tiles travel as their files' bytes: a centre meets at most nine of them in one group, so a task's memory is bounded by
the tile size, whatever the number of tiles. Windows that do not meet the centre are never cut, and only the centre's
part of a window's scores is kept. `plans.pipeline.predicted` gives the same with a row a pixel.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import pixels
from rasterloom.functions.classes import MODEL_TO_SIMPLIFIED
from rasterloom.operators import blend, tiles
from rasterloom.sources import tiff

#: A window whose brightest value is below this never reaches the model.
DARK = 10


def coerced(bands: np.ndarray) -> np.ndarray:
    """Band values as 0..255, as `pixels.eight_bit` gives them."""
    if bands.dtype == np.uint16:
        return (bands // 257).astype(np.uint8)
    if bands.dtype.kind == "f":
        return np.clip(bands * 255.0, 0, 255).astype(np.uint8)
    return bands.astype(np.uint8)


def turned(image: np.ndarray, mode: str, back: bool = False) -> np.ndarray:
    """An (h, w, ...) array in an augmentation mode, or back from it."""
    if mode in ("hvflip", "rot180"):
        return image[::-1, ::-1]
    if mode in ("rot90", "rot270"):
        return np.rot90(image, 1 if (mode == "rot90") != back else 3)
    return {"original": image, "hflip": image[:, ::-1], "vflip": image[::-1]}[mode]


def starts(length: int, tile: int, overlap: int) -> list[int]:
    """Starts of the windows along an axis, as `grid.window_starts` gives them."""
    if tile == overlap:
        raise ValueError("tile and overlap are equal: the stride is 0")
    return [max(0, min(y + tile, length) - tile) for y in range(0, length, tile - overlap)] if tile > overlap else []


def weights(h: int, w: int, overlap: int) -> np.ndarray:
    """The weight of each pixel of a window, as `grid.blend_weight` gives it."""
    if overlap <= 0:
        return np.ones((h, w))
    ramp = np.zeros(1) if overlap == 1 else 0.5 - 0.5 * np.cos(np.pi * np.arange(overlap) / (overlap - 1))
    rows, cols = np.ones(h), np.ones(w)
    if h > overlap:
        rows[:overlap] = ramp
        rows[h - overlap :] = ramp[::-1]
    if w > overlap:
        cols[:overlap] *= ramp
        cols[w - overlap :] *= ramp[::-1]
    return rows[:, None] * cols[None, :]


def centre_scores(image: np.ndarray, size: int, model: Callable, classes: int, tile: int, overlap: int) -> np.ndarray:
    """The blended scores of the middle size x size pixels of an image of three times that."""
    side = image.shape[0]
    total, weight = np.zeros((size, size, classes)), np.zeros((size, size))
    for y in starts(side, tile, overlap):
        for x in starts(side, tile, overlap):
            h, w = min(tile, side), min(tile, side)
            r0, r1, c0, c1 = max(y, size), min(y + h, 2 * size), max(x, size), min(x + w, 2 * size)
            if r0 >= r1 or c0 >= c1:
                continue
            cut = image[y : y + h, x : x + w]
            if cut.max() < DARK:
                continue
            normal = (cut.astype(np.float64) - np.array(pixels.MEANS)) / np.array(pixels.DEVIATIONS)
            got = np.asarray(model(normal), np.float64)[..., :classes]
            if got.shape[:2] != (h, w):  # the model's own resolution
                got = blend._bilinear(got, h, w)
            part = (slice(r0 - y, r1 - y), slice(c0 - x, c1 - x))
            here = (slice(r0 - size, r1 - size), slice(c0 - size, c1 - size))
            k = weights(h, w, overlap)[part]
            total[here] += got[part] * k[..., None]
            weight[here] += k
    return np.divide(total, weight[..., None], out=np.zeros_like(total), where=weight[..., None] > 0)


def decided(scores: np.ndarray, bias: dict[int, float] | None, margin: float, simplify: bool) -> np.ndarray:
    """Bias, argmax, recovery, then the nineteen classes to four; as `pixels.decided` does."""
    for k, b in (bias or {}).items():
        scores[..., k] += b
    out = scores.argmax(axis=-1)
    if margin > 0:
        out[(out == 0) & (scores[..., 0] - scores[..., 1] < margin)] = 1
    if simplify:
        table = np.zeros(256, np.uint8)
        for target, codes in MODEL_TO_SIMPLIFIED.items():
            table[list(codes)] = target
        out = table[out]
    return out.astype(np.uint8)


def predicted(images: DataFrame, key: str, load: Callable[[], Callable], classes: int, tile: int = 384, overlap: int = 192, step: int = 5, modes=blend.DEFAULT_MODES, simplify: bool = True, bias: dict[int, float] | None = None, margin: float = 3.0) -> DataFrame:
    """images: tx, ty, tile_id and content (a GeoTIFF of three bands or more, all of one size). Returns tile_id, the
    place (x0, y1, a, e, crs), height, width and values, the class map's bytes by row."""
    around = tiles.neighbours(images.select("tx", "ty", "tile_id"), step).where("neighbour IS NOT NULL").select("tile_id", "ri", "ci", "neighbour")
    parts = around.join(images.select(F.col("tile_id").alias("neighbour"), "content"), "neighbour")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = blend.loaded(key, load)
        middle = pdf[(pdf["ri"] == 1) & (pdf["ci"] == 1)].iloc[0]
        about = tiff.info(middle["content"])
        size, image = about["height"], None
        for part in pdf.itertuples():
            bands = tiff.decode(part.content)
            if len(bands) < 3:
                raise ValueError(f"{part.neighbour}: {len(bands)} bands, three are needed")
            if bands.shape[1:] != (size, size):
                raise ValueError(f"{part.neighbour}: {bands.shape[1:]} pixels, not {size} x {size}")
            if image is None:
                image = np.zeros((3 * size, 3 * size, 3), np.uint8)
            image[part.ri * size : (part.ri + 1) * size, part.ci * size : (part.ci + 1) * size] = coerced(bands[:3]).transpose(1, 2, 0)
        every = ("original", *(modes or ()))
        scores = sum(turned(centre_scores(turned(image, m), size, model, classes, tile, overlap), m, back=True) for m in every) / len(every)
        values = decided(scores, bias, margin, simplify)
        return pd.DataFrame([{"tile_id": middle["tile_id"], **{c: about[c] for c in ("x0", "y1", "a", "e", "crs")}, "height": size, "width": size, "values": values.tobytes()}])

    return parts.groupBy("tile_id").applyInPandas(run, "tile_id string, x0 double, y1 double, a double, e double, crs string, height int, width int, values binary")

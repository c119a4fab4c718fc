"""Aerial images brought to a pixel size: bicubic, as 8-bit GeoTIFF bands."""

from __future__ import annotations

import os
import urllib.parse
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from rasterloom.operators import process
from rasterloom.sources import fetch, tiff


def axis(n: int, m: int) -> np.ndarray:
    """The weights (m x n) of n pixels in m, as `resample.bicubic_axis` gives them."""
    scale, wide = n / m, max(n / m, 1.0)
    out = np.zeros((m, n))
    for k in range(m):
        centre = (k + 0.5) * scale
        src = np.arange(max(0, int(np.floor(centre - 2 * wide + 0.5))), min(n, int(np.floor(centre + 2 * wide + 0.5))))
        x = np.abs((src + 0.5 - centre) / wide)
        w = np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((x - 5) * x + 8) * x * -0.5 + 2, 0.0))
        out[k, src] = w / w.sum()
    return out


def _byte(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(x + 0.5), 0, 255).astype(np.uint8)


def resized(bands: np.ndarray, height: int, width: int) -> np.ndarray:
    """(bands, h, w) of bytes at another size: across first, rounded, then down."""
    across = _byte(np.asarray(bands, np.float64) @ axis(bands.shape[2], width).T)
    return _byte(np.einsum("ij,bjk->bik", axis(bands.shape[1], height), across.astype(np.float64)))


def at_resolution(data: bytes, resolution: float) -> bytes:
    """A GeoTIFF's image at another pixel size, on its own bounds; sizes are cut to whole pixels."""
    about, bands = tiff.info(data), tiff.decode(data)
    right, bottom = about["x0"] + about["a"] * about["width"], about["y1"] + about["e"] * about["height"]
    width, height = int((right - about["x0"]) / resolution), int((about["y1"] - bottom) / resolution)
    if min(width, height) < 1:
        raise ValueError(f"the image is smaller than a pixel of {resolution}")
    return tiff.encode(resized(bands, height, width), about["x0"], about["y1"], (right - about["x0"]) / width, (bottom - about["y1"]) / height, about["crs"])


def map_url(base: str, layer: str, about: dict, resolution: float, image_format: str = "image/tiff") -> str:
    """The WMS 1.3.0 request for a raster's bounds, as `names.map_request` builds it."""
    right, bottom = about["x0"] + about["a"] * about["width"], about["y1"] + about["e"] * about["height"]
    size = int((right - about["x0"]) / resolution), int((about["y1"] - bottom) / resolution)
    box = ",".join(str(x) for x in (about["x0"], bottom, right, about["y1"]))
    pairs = {"SERVICE": "WMS", "VERSION": "1.3.0", "REQUEST": "GetMap", "LAYERS": layer, "CRS": about["crs"], "BBOX": box, "WIDTH": size[0], "HEIGHT": size[1], "FORMAT": image_format, "STYLES": ""}
    return base + "?" + urllib.parse.urlencode(pairs)


def prepared(tiles: DataFrame, folder: str, resolution: float, get: Callable[[str, str], str | None] = fetch.download, suffix: str = ".tif") -> DataFrame:
    """tiles: tile_id, url. Each image is fetched and saved as orthophoto_{tile_id} in the folder; those there already
    stay. Returns tile_id, status, error."""

    def work(row: dict) -> None:
        path = os.path.join(folder, f"orthophoto_{row['tile_id']}{suffix}")
        if os.path.exists(path):
            return
        os.makedirs(folder, exist_ok=True)
        raw = path + ".part"
        try:
            if get(row["url"], raw) is None:
                raise ValueError("the answer is no image")
            with open(raw, "rb") as f:
                data = at_resolution(f.read(), resolution)
            with open(path, "wb") as f:
                f.write(data)
        finally:
            if os.path.exists(raw):
                os.remove(raw)

    return process.processed(tiles, work)


def from_map_service(rasters: DataFrame, folder: str, base: str, layer: str, resolution: float = 0.8, image_format: str = "image/tiff", get: Callable[[str, str], str | None] = fetch.fetch_image) -> DataFrame:
    """rasters: tile_id, x0, y1, a, e, width, height, crs. The map service's image of each raster's bounds, saved on its
    grid at the resolution; tile_id, status, error."""

    def work(row: dict) -> None:
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f"orthophoto_{row['tile_id']}.tif")
        raw = path + ".part"
        try:
            if get(map_url(base, layer, row, resolution, image_format), raw) is None:
                raise ValueError("the answer is no image")
            with open(raw, "rb") as f:
                bands = tiff.decode(f.read())
        finally:
            if os.path.exists(raw):
                os.remove(raw)
        right, bottom = row["x0"] + row["a"] * row["width"], row["y1"] + row["e"] * row["height"]
        width, height = int((right - row["x0"]) / resolution), int((row["y1"] - bottom) / resolution)
        with open(path, "wb") as f:
            f.write(tiff.encode(resized(bands, height, width), row["x0"], row["y1"], (right - row["x0"]) / width, (bottom - row["y1"]) / height, row["crs"]))

    return process.processed(rasters, work)

"""Uncompressed LAS point files as a table of points, and a small writer for tests and exports."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Place of the class code in each point record format.
_CODE_AT = {0: 15, 1: 15, 2: 15, 3: 15, 4: 15, 5: 15, 6: 16, 7: 16, 8: 16, 9: 16, 10: 16}


def parse(data: bytes) -> pd.DataFrame:
    """x, y, z and classification of one file."""
    if data[:4] != b"LASF":
        raise ValueError("not a LAS file")
    start, = struct.unpack_from("<L", data, 96)
    kind, size = struct.unpack_from("<BH", data, 104)
    if kind & 0x80:
        raise ValueError("compressed points (LAZ) are not supported")
    n, = struct.unpack_from("<L", data, 107)
    if data[25] >= 4 and n == 0:
        n, = struct.unpack_from("<Q", data, 247)
    sx, sy, sz, ox, oy, oz = struct.unpack_from("<6d", data, 131)
    raw = np.frombuffer(data, np.uint8, n * size, start).reshape(n, size)
    xyz = np.ascontiguousarray(raw[:, :12]).view("<i4")
    code = raw[:, _CODE_AT[kind]].astype(np.int16)
    if kind < 6:
        code = code & 0x1F
    return pd.DataFrame({"x": xyz[:, 0] * sx + ox, "y": xyz[:, 1] * sy + oy, "z": xyz[:, 2] * sz + oz, "classification": code})


def encode(points: pd.DataFrame, scale: float = 0.01) -> bytes:
    """LAS 1.2, format 0, of columns x, y, classification."""
    x, y = points["x"].to_numpy(float), points["y"].to_numpy(float)
    ox, oy = (np.floor(x.min()), np.floor(y.min())) if len(x) else (0.0, 0.0)
    raw = np.zeros((len(x), 20), np.uint8)
    raw[:, 0:4] = np.rint((x - ox) / scale).astype("<i4").view(np.uint8).reshape(-1, 4)
    raw[:, 4:8] = np.rint((y - oy) / scale).astype("<i4").view(np.uint8).reshape(-1, 4)
    raw[:, 15] = points["classification"].to_numpy()
    head = bytearray(227)
    head[:4] = b"LASF"
    head[24], head[25] = 1, 2
    struct.pack_into("<HL", head, 94, 227, 227)
    struct.pack_into("<BH", head, 104, 0, 20)
    struct.pack_into("<L", head, 107, len(x))
    struct.pack_into("<6d", head, 131, scale, scale, scale, ox, oy, 0.0)
    return bytes(head) + raw.tobytes()


def read(spark: SparkSession, path: str, pattern: str = "*.las") -> DataFrame:
    """tile_id (the file's name up to its first dot), x, y, classification of all files."""
    files_ = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    named = files_.select(F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1).alias("tile_id"), "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for tile, data in zip(frame["tile_id"], frame["content"]):
                points = parse(bytes(data))
                for k in range(0, len(points), 1_000_000):
                    part = points.iloc[k : k + 1_000_000]
                    yield pd.DataFrame({"tile_id": tile, "x": part["x"], "y": part["y"], "classification": part["classification"]})

    return named.mapInPandas(run, "tile_id string, x double, y double, classification smallint")

"""A small GeoTIFF codec and its table forms: class rasters, band rasters and tile metadata.

Reads strips and tiles, uncompressed, LZW or Deflate, with horizontal differencing; writes Deflate strips with
transform, EPSG code and nodata.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from contextlib import nullcontext

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.sources import files

# TIFF field types, tags and sample formats.
_TYPES = {1: "B", 2: "c", 3: "H", 4: "L", 5: "LL", 6: "b", 8: "h", 9: "l", 11: "f", 12: "d", 16: "Q", 17: "q"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, LENGTHS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_W, TILE_H, TILES, TILE_LENGTHS, FORMAT = 284, 317, 322, 323, 324, 325, 339
SCALE, TIEPOINT, GEOKEYS, NODATA = 33550, 33922, 34735, 42113
_KINDS = {(8, 1): "u1", (16, 1): "u2", (32, 1): "u4", (8, 2): "i1", (16, 2): "i2", (32, 2): "i4", (32, 3): "f4", (64, 3): "f8"}


def _lzw(data: bytes) -> bytes:
    out, table, width, bits, held = bytearray(), [], 9, 0, 0
    first = [bytes([k]) for k in range(256)] + [b"", b""]
    table, last = list(first), b""
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        while bits >= width:
            code = (held >> (bits - width)) & ((1 << width) - 1)
            bits -= width
            held &= (1 << bits) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                table, width, last = list(first), 9, b""
                continue
            entry = table[code] if code < len(table) else last + last[:1]
            out += entry
            if last:
                table.append(last + entry[:1])
            last = entry
            width = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9
    return bytes(out)


def _tags(read: Callable[[int, int], bytes], skip: tuple[int, ...] = ()) -> tuple[str, dict]:
    """Byte order and tags of a TIFF or BigTIFF file, by range reads: read(at, n). skip: tags that aren't read."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack_from(order + "H", head, 2)[0] if order and len(head) >= 8 else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    word, entry, inline = ("Q", 20, 8) if big else ("L", 12, 4)
    at, = struct.unpack_from(order + word, head, 8 if big else 4)
    counted = 8 if big else 2
    n, = struct.unpack(order + ("Q" if big else "H"), read(at, counted))
    table = read(at + counted, entry * n)
    tags = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HH" + word, table, entry * k)
        code = _TYPES.get(kind)
        if code is None or tag in skip:
            continue
        size = struct.calcsize("=" + code) * count
        body = table[entry * (k + 1) - inline : entry * (k + 1)]
        if size > inline:
            body = read(struct.unpack(order + word, body)[0], size)
        tags[tag] = body[:size] if kind == 2 else struct.unpack(order + code * count, body[:size])
    return order, tags


def _within(data: bytes) -> Callable[[int, int], bytes]:
    return lambda at, n: data[at : at + n]


def info(data: bytes | Callable[[int, int], bytes]) -> dict:
    """The metadata of a file: x0, y1, a, e, width, height, crs, dtype, band_count, nodata. data: the file's bytes, or
    a function that reads a range of them."""
    order, t = _tags(data if callable(data) else _within(data), skip=(STRIPS, LENGTHS, TILES, TILE_LENGTHS))
    sx, sy = t.get(SCALE, (1.0, 1.0, 0.0))[:2]
    tie = t.get(TIEPOINT, (0.0,) * 6)
    keys = t.get(GEOKEYS, ())
    epsg = next((keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k] in (3072, 2048) and keys[k + 1] == 0), None)
    nodata = t.get(NODATA)
    kind = _KINDS[(t[BITS][0], t.get(FORMAT, (1,))[0])]
    return {
        "x0": float(tie[3] - tie[0] * sx), "y1": float(tie[4] + tie[1] * sy), "a": float(sx), "e": float(-sy), "width": int(t[WIDTH][0]), "height": int(t[HEIGHT][0]),
        "crs": f"EPSG:{epsg}" if epsg else None, "dtype": np.dtype(kind).name, "band_count": int(t.get(SAMPLES, (1,))[0]), "nodata": float(nodata.rstrip(b"\0").strip()) if nodata else None,
    }


def decode(data: bytes | Callable[[int, int], bytes], window: tuple[int, int, int, int] | None = None) -> np.ndarray:
    """All bands, (bands, height, width). data: the file's bytes, or a function that reads a range of them. window: rows
    from, to and columns from, to; only strips and tiles that meet it are read and decoded."""
    read = data if callable(data) else _within(data)
    order, t = _tags(read)
    h, w, bands = t[HEIGHT][0], t[WIDTH][0], t.get(SAMPLES, (1,))[0]
    top, bottom, left, right = window or (0, h, 0, w)
    if not (0 <= top <= bottom <= h and 0 <= left <= right <= w):
        raise ValueError(f"the window {window} is not within {h} x {w}")
    kind = np.dtype(order + _KINDS[(t[BITS][0], t.get(FORMAT, (1,))[0])])
    tiled = TILES in t
    bh, bw = (t[TILE_H][0], t[TILE_W][0]) if tiled else (min(t.get(ROWS, (h,))[0], h), w)
    places, sizes = (t[TILES], t[TILE_LENGTHS]) if tiled else (t[STRIPS], t[LENGTHS])
    planar = t.get(PLANAR, (1,))[0] == 2 and bands > 1
    per = 1 if planar else bands
    across, down = -(-w // bw), -(-h // bh)
    how = t.get(COMPRESSION, (1,))[0]
    out = np.zeros((bands, bottom - top, right - left), kind.newbyteorder("="))
    for k, (at, size) in enumerate(zip(places, sizes)):
        plane, cell = divmod(k, across * down) if planar else (0, k)
        r0, c0 = (cell // across) * bh, (cell % across) * bw
        rows = bh if tiled else min(bh, h - r0)
        low_r, high_r, low_c, high_c = max(r0, top), min(r0 + rows, bottom), max(c0, left), min(c0 + bw, right)
        if low_r >= high_r or low_c >= high_c:
            continue
        raw = read(at, size)
        if how == 5:
            raw = _lzw(raw)
        elif how in (8, 32946):
            raw = zlib.decompress(raw)
        elif how != 1:
            raise ValueError(f"compression {how} is not supported")
        block = np.frombuffer(raw, kind, rows * bw * per).reshape(rows, bw, per).astype(kind.newbyteorder("="))
        if t.get(PREDICTOR, (1,))[0] == 2:
            block = np.cumsum(block, axis=1, dtype=block.dtype)
        part = block[low_r - r0 : high_r - r0, low_c - c0 : high_c - c0].transpose(2, 0, 1)
        out[plane : plane + per, low_r - top : high_r - top, low_c - left : high_c - left] = part
    return out


def encode(bands: np.ndarray, x0: float, y1: float, a: float, e: float, crs: str | None = "EPSG:2154", nodata: float | None = None) -> bytes:
    """A Deflate GeoTIFF of (bands, height, width)."""
    n, h, w = bands.shape
    raw = np.ascontiguousarray(bands.transpose(1, 2, 0))
    kind = raw.dtype
    fmt = {"u": 1, "i": 2, "f": 3}[kind.kind]
    strip = max(1, (1 << 18) // max(1, w * n * kind.itemsize))
    strips = [zlib.compress(raw[k : k + strip].astype(kind.newbyteorder("<")).tobytes(), 6) for k in range(0, h, strip)]
    fields: list[tuple[int, str, tuple]] = [
        (WIDTH, "L", (w,)), (HEIGHT, "L", (h,)), (BITS, "H", (kind.itemsize * 8,) * n), (COMPRESSION, "H", (8,)), (PHOTOMETRIC, "H", (2 if n == 3 else 1,)),
        (STRIPS, "L", (0,) * len(strips)), (SAMPLES, "H", (n,)), (ROWS, "L", (strip,)), (LENGTHS, "L", tuple(map(len, strips))), (PLANAR, "H", (1,)), (FORMAT, "H", (fmt,) * n),
        (SCALE, "d", (a, -e, 0.0)), (TIEPOINT, "d", (0.0, 0.0, 0.0, x0, y1, 0.0)),
    ]
    if crs and crs.startswith("EPSG:"):
        fields.append((GEOKEYS, "H", (1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, int(crs[5:]))))
    if nodata is not None:
        fields.append((NODATA, "c", tuple(f"{nodata:g}\0".encode())))
    fields.sort()
    code = {v: k for k, v in _TYPES.items()}
    extra_at = 8 + 2 + 12 * len(fields) + 4
    sizes = [struct.calcsize("=" + f) * len(v) for _, f, v in fields]
    extra = sum(s for s in sizes if s > 4)
    data_at = extra_at + extra
    starts = tuple(int(x) for x in data_at + np.cumsum([0, *map(len, strips)])[:-1])
    head, tail, at = struct.pack("<2sHLH", b"II", 42, 8, len(fields)), b"", extra_at
    for (tag, f, v), size in zip(fields, sizes):
        v = starts if tag == STRIPS else v
        body = bytes(v) if f == "c" else struct.pack("<" + f * len(v), *v)
        if size > 4:
            head += struct.pack("<HHLL", tag, code[f], len(v), at)
            tail, at = tail + body, at + size
        else:
            head += struct.pack("<HHL", tag, code[f], len(v)) + body.ljust(4, b"\0")
    return head + struct.pack("<L", 0) + tail + b"".join(strips)


META = "tile_id string, path string, x0 double, y1 double, a double, e double, width int, height int, crs string, dtype string, band_count int, nodata double"


def _binary(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.tif$", "").alias("tile_id"), "content")


def contents(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """path, tile_id and content of all files."""
    return _binary(spark, path, pattern)


def metadata(spark: SparkSession, path: str, pattern: str = "*.tif") -> DataFrame:
    """The metadata of all files; only their headers are read where they lie, if tasks can reach them."""
    near = files.ranged(path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples():
                with files.opened(r.path) if near else nullcontext(bytes(r.content)) as data:
                    rows.append({"tile_id": r.tile_id, "path": r.path, **info(data)})
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in META.split(", ")])

    found = _binary(spark, path, pattern)
    return (found.drop("content") if near else found).mapInPandas(run, META)


def read(spark: SparkSession, path: str, bands: tuple[int, ...] = (1,), names: tuple[str, ...] = ("value",), pattern: str = "*.tif") -> DataFrame:
    """tile_id, row, col and the bands as doubles; a file with fewer bands is an error."""
    schema = "tile_id string, row int, col int, " + ", ".join(f"{n} double" for n in names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for tile, d in zip(f["tile_id"], f["content"]):
                cube = decode(bytes(d))
                if len(cube) < max(bands):
                    raise ValueError(f"{tile}: {len(cube)} bands, band {max(bands)} is asked for")
                _, h, w = cube.shape
                step = max(1, 1_000_000 // max(1, w))
                for r in range(0, h, step):
                    part = cube[:, r : r + step]
                    rows, cols = np.indices(part.shape[1:])
                    yield pd.DataFrame({"tile_id": tile, "row": (rows + r).ravel().astype(np.int32), "col": cols.ravel().astype(np.int32), **{n: part[b - 1].ravel().astype(float) for b, n in zip(bands, names)}})

    return _binary(spark, path, pattern).mapInPandas(run, schema)


def _saved(folder: str, name: str, data: bytes) -> str:
    """Writes a file in the folder; its path."""
    import pyarrow.fs as pafs

    fs, base = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
    fs.create_dir(base, recursive=True)
    path = f"{base}/{name}"
    with fs.open_output_stream(path) as out:
        out.write(data)
    return path


def write_vrt(parts: list, extent, path: str, nodata: float | None = None) -> str:
    """A virtual raster over the blocks of a mosaic. parts: rows of path, x0, y1, width, height; extent: of the whole."""
    from xml.sax.saxutils import escape

    missing = "" if nodata is None else f"<NoDataValue>{nodata:g}</NoDataValue>"
    lines = [f'<VRTDataset rasterXSize="{extent.width}" rasterYSize="{extent.height}">', f"<SRS>{escape(extent.ref_crs or '')}</SRS>", f"<GeoTransform>{extent.left}, {extent.ref_a}, 0, {extent.top}, 0, {extent.ref_e}</GeoTransform>", f'<VRTRasterBand dataType="Byte" band="1">{missing}']
    for p in parts:
        col, row = round((p.x0 - extent.left) / extent.ref_a), round((p.y1 - extent.top) / extent.ref_e)
        size = f'xSize="{p.width}" ySize="{p.height}"'
        lines.append(f'<SimpleSource><SourceFilename relativeToVRT="1">{escape(p.path.rsplit("/", 1)[-1])}</SourceFilename><SourceBand>1</SourceBand><SrcRect xOff="0" yOff="0" {size}/><DstRect xOff="{col}" yOff="{row}" {size}/></SimpleSource>')
    folder, _, name = path.rpartition("/")
    return _saved(folder or ".", name, "\n".join([*lines, "</VRTRasterBand>", "</VRTDataset>"]).encode())


def write_rasters(rasters: DataFrame, folder: str, prefix: str = "", nodata: float | None = None) -> DataFrame:
    """A GeoTIFF for each row (tile_id, x0, y1, a, e, crs, height, width, values: bytes by row); tile_id and path."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples():
                cube = np.frombuffer(r.values, np.uint8).reshape(1, r.height, r.width)
                rows.append((r.tile_id, _saved(folder, f"{prefix}{r.tile_id}.tif", encode(cube, r.x0, r.y1, r.a, r.e, r.crs, nodata))))
            yield pd.DataFrame(rows, columns=["tile_id", "path"])

    return rasters.mapInPandas(run, "tile_id string, path string")


def write(raster: DataFrame, meta: DataFrame, folder: str, bands: tuple[str, ...] = ("value",), dtype: str = "uint8", prefix: str = "", nodata: float | None = None, fill: int = 0) -> DataFrame:
    """A GeoTIFF for each tile, named prefix + tile_id; returns tile_id and path. A tile's raster is one group, as its file is one file."""
    m = meta.select(F.col("tile_id").alias("of"), "x0", "y1", "a", "e", "width", "height", "crs").hint("shuffle_hash")  # never the pixels
    joined = raster.select("tile_id", "row", "col", *bands).join(m, F.col("tile_id") == F.col("of")).drop("of")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        f = pdf.iloc[0]
        cube = np.full((len(bands), int(f["height"]), int(f["width"])), fill, dtype)
        for k, b in enumerate(bands):
            cube[k, pdf["row"].to_numpy(), pdf["col"].to_numpy()] = pdf[b].to_numpy()
        path = _saved(folder, f"{prefix}{f['tile_id']}.tif", encode(cube, f["x0"], f["y1"], f["a"], f["e"], f["crs"], nodata))
        return pd.DataFrame({"tile_id": [f["tile_id"]], "path": [path]})

    return joined.groupBy("tile_id").applyInPandas(run, "tile_id string, path string")

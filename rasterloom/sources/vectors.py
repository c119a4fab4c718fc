"""Polygon files: GeoPackage, Shapefile and GeoJSON lines, each made in memory from rows of class and rings.

A file is one task's work, as it is one document; of many polygons, `write` makes a file for each partition.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import scratch
from rasterloom.sources.tiff import _saved

Ring = list[tuple[float, float]]

# Marks of the GeoPackage format, and its tables.
_APPLICATION, _VERSION = 0x47504B47, 10300
_TABLES = """
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ', 'now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
INSERT INTO gpkg_spatial_ref_sys VALUES ('Undefined cartesian SRS', -1, 'NONE', -1, 'undefined', NULL), ('Undefined geographic SRS', 0, 'NONE', 0, 'undefined', NULL);
"""


def _box(rings: list[Ring]) -> tuple[float, float, float, float]:
    x, y = zip(*(p for ring in rings for p in ring))
    return min(x), min(y), max(x), max(y)


def _turn(ring: Ring) -> float:
    """Twice the signed area: above 0 where the ring turns left."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))


def wkb(rings: list[Ring]) -> bytes:
    out = struct.pack("<BLL", 1, 3, len(rings))
    return out + b"".join(struct.pack("<L", len(r)) + b"".join(struct.pack("<2d", *p) for p in r) for r in rings)


def geopackage(rows: list[tuple[int, list[Ring]]], field: str = "class", srs: int = 2154, layer: str = "vegetation") -> bytes:
    """A GeoPackage of one layer of polygons with an integer field."""
    db = sqlite3.connect(":memory:")
    db.executescript(f"PRAGMA application_id = {_APPLICATION}; PRAGMA user_version = {_VERSION};" + _TABLES)
    name = lambda x: '"' + x.replace('"', '""') + '"'
    db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srs}", srs, srs))
    db.execute(f"CREATE TABLE {name(layer)} (fid INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB, {name(field)} INTEGER)")
    boxes = [_box(rings) for _, rings in rows]
    whole = (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)) if boxes else (None,) * 4
    db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, min_x, min_y, max_x, max_y, srs_id) VALUES (?, 'features', ?, ?, ?, ?, ?, ?)", (layer, layer, *whole, srs))
    db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POLYGON', ?, 0, 0)", (layer, srs))
    # header: version 0, little-endian with an envelope of x and y
    blobs = ((struct.pack("<2sBBl4d", b"GP", 0, 3, srs, b[0], b[2], b[1], b[3]) + wkb(rings), cls) for (cls, rings), b in zip(rows, boxes))
    db.executemany(f"INSERT INTO {name(layer)} (geom, {name(field)}) VALUES (?, ?)", blobs)
    db.commit()
    return db.serialize()


def shapefile(rows: list[tuple[int, list[Ring]]], field: str = "class") -> dict[str, bytes]:
    """The files of a Shapefile by extension: shp, shx and dbf. Outer rings turn right, holes left."""
    shapes, index, at = [], [], 50
    for k, (_, rings) in enumerate(rows):
        turned = [r if (_turn(r) < 0) == (i == 0) else r[::-1] for i, r in enumerate(rings)]
        starts = [0]
        for r in turned:
            starts.append(starts[-1] + len(r))
        body = struct.pack("<L4d2L", 5, *_box(turned), len(turned), starts[-1]) + struct.pack(f"<{len(turned)}L", *starts[:-1]) + b"".join(struct.pack("<2d", *p) for r in turned for p in r)
        shapes.append(struct.pack(">2L", k + 1, len(body) // 2) + body)
        index.append(struct.pack(">2L", at, len(body) // 2))
        at += len(shapes[-1]) // 2
    boxes = [_box(rings) for _, rings in rows] or [(0.0, 0.0, 0.0, 0.0)]
    whole = (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes))
    head = lambda n: struct.pack(">7L", 9994, 0, 0, 0, 0, 0, n) + struct.pack("<2L8d", 1000, 5, *whole, 0, 0, 0, 0)
    dbf = struct.pack("<4BLHH20x", 3, 100, 1, 1, len(rows), 65, 11) + struct.pack("<11sc4xBB14x", field.encode()[:10], b"N", 10, 0) + b"\r" + b"".join(b" " + f"{cls:>10d}".encode() for cls, _ in rows) + b"\x1a"
    return {"shp": head(at) + b"".join(shapes), "shx": head(50 + 4 * len(rows)) + b"".join(index), "dbf": dbf}


def write(polys: DataFrame, path: str, form: str, field: str = "class", srs: int = 2154, single: bool = True) -> DataFrame:
    """polys (class, rings of x and y) as files `path` (its extension the format's): one file, or with `single` off one
    for each partition, numbered. form: GPKG or ESRI Shapefile. Returns the paths."""
    if form not in ("GPKG", "ESRI Shapefile"):
        raise ValueError(f"unknown format {form}")
    folder, _, name = path.rpartition("/")
    stem = name.rpartition(".")[0] or name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [(r["class"], [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]]) for b in batches for r in b.to_pylist()]
        yield pa.RecordBatch.from_pydict({"path": save(rows, stem if single else f"{stem}-{TaskContext.get().partitionId():05d}")})

    def save(rows: list, base: str) -> list[str]:
        made = {"gpkg": geopackage(rows, field, srs)} if form == "GPKG" else shapefile(rows, field)
        return [_saved(folder or ".", f"{base}.{ext}", data) for ext, data in made.items()]

    chosen = polys.select(F.col("class").cast("int").alias("class"), "rings")
    paths, _ = scratch.written((chosen.repartition(1) if single else chosen).mapInArrow(run, "path string"), "paths")
    if single and not paths.count():  # no polygon, no task: the file is there all the same
        paths = polys.sparkSession.createDataFrame([(p,) for p in save([], stem)], "path string")
    return paths

"""Files written and read back."""

import json
import struct

import numpy as np
import pandas as pd
import pytest

from rasterloom.operators import mosaic
from rasterloom.plans import pipeline
from rasterloom.sources import checkpoint, fetch, las, manifest, tiff
from rasterloom.streaming import incremental


def test_manifest_round_trip(spark, tmp_path):
    rows = [("test", "1_2", "test/o.tif", "test/c.tif", "http://x/1", 0), ("train", "3_4", "train/o.tif", "train/c.tif", "http://x/2", 0), ("test", "0_1", "a", "b", "c", 1)]
    cat = spark.createDataFrame(rows, "split string, tile_id string, orthophoto string, classification_map string, url string, position int")
    manifest.write_manifest(cat, str(tmp_path / "m"), "position")
    back = manifest.read_manifest(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_text_lists(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("﻿nom;url\na b; http://x/1 \n".encode())
    assert [tuple(r) for r in manifest.read_tile_csv(spark, str(tmp_path / "t.csv")).collect()] == [("a b", "http://x/1")]
    (tmp_path / "u.txt").write_text("# no\n\n  http://x/1  \nhttp://x/2\n")
    assert [r.url for r in manifest.read_url_list(spark, str(tmp_path / "u.txt")).collect()] == ["http://x/1", "http://x/2"]


def test_las(spark, tmp_path):
    p = pd.DataFrame({"x": [10.25, 11.5, 10.0], "y": [5.0, 6.75, 5.5], "classification": [2, 5, 6]})
    (tmp_path / "a.las").write_bytes(las.encode(p))
    got = las.read(spark, str(tmp_path)).orderBy("classification").collect()
    assert [(r.tile_id, round(r.x, 2), round(r.y, 2), r.classification) for r in got] == [("a", 10.25, 5.0, 2), ("a", 11.5, 6.75, 5), ("a", 10.0, 5.5, 6)]
    with pytest.raises(ValueError):
        las.parse(b"nope" * 100)


@pytest.mark.parametrize("kind, n", [("uint8", 1), ("uint8", 3), ("uint16", 1), ("float32", 2)])
def test_tiff_round_trip(kind, n):
    cube = (np.arange(n * 7 * 5).reshape(n, 7, 5) * 3 % 200).astype(kind)
    data = tiff.encode(cube, 100.0, 200.0, 0.8, -0.8, "EPSG:2154", 255)
    assert (tiff.decode(data) == cube).all()
    i = tiff.info(data)
    assert (i["x0"], i["y1"], i["a"], i["e"], i["width"], i["height"], i["crs"], i["dtype"], i["band_count"], i["nodata"]) == (100.0, 200.0, 0.8, -0.8, 5, 7, "EPSG:2154", kind, n, 255.0)


def test_lzw():
    # clear, 1, 1, 258 (= 1 1), end; nine bits each
    bits = "".join(f"{c:09b}" for c in (256, 1, 1, 258, 257)).ljust(48, "0")
    assert tiff._lzw(int(bits, 2).to_bytes(6, "big")) == bytes([1, 1, 1, 1])


def test_tiff_tables(spark, tmp_path):
    px = spark.createDataFrame([("t", r, c, r * 3 + c) for r in range(2) for c in range(3)], "tile_id string, row int, col int, value int")
    meta = spark.createDataFrame([("t", 0.0, 2.0, 1.0, -1.0, 3, 2, "EPSG:2154")], "tile_id string, x0 double, y1 double, a double, e double, width int, height int, crs string")
    assert tiff.write(px, meta, str(tmp_path / "o")).count() == 1
    back = tiff.read(spark, str(tmp_path / "o"))
    assert sorted((r.row, r.col, int(r.value)) for r in back.collect()) == sorted((r.row, r.col, r.value) for r in px.collect())
    assert tiff.metadata(spark, str(tmp_path / "o")).first().crs == "EPSG:2154"
    with pytest.raises(Exception, match="bands"):
        tiff.read(spark, str(tmp_path / "o"), (1, 2, 3), ("r", "g", "b")).collect()


def test_checkpoint(spark, tmp_path):
    head = json.dumps({"__metadata__": {}, "model.a": {"dtype": "F32", "shape": [2, 3]}, "criterion.w": {"dtype": "F32", "shape": [4]}}).encode()
    (tmp_path / "m.safetensors").write_bytes(struct.pack("<Q", len(head)) + head)
    assert [(r.name, r.size) for r in checkpoint.read(spark, str(tmp_path / "m.safetensors")).collect()] == [("a", 6)]


def test_failed_download_is_a_row(spark, tmp_path):
    urls = spark.createDataFrame([("t", "file:///nowhere/at/all.laz")], "tile_id string, url string")
    assert fetch.downloaded(urls, str(tmp_path)).first().status == "failed"


def test_incremental_mosaic(spark, tmp_path):
    rows = [[(0, 0, 1), (0, 1, 2)], [(0, 0, 3), (0, 1, 2)], [(0, 0, 3)]]
    schema = "grow int, gcol int, value int"
    for k, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = incremental.start(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "cp"))
        q.awaitTermination(120)
    got = {(r.grow, r.gcol): r.value for r in incremental.mosaic(incremental.read_state(spark, str(tmp_path / "state"))).collect()}
    every = spark.createDataFrame([("a", *r) for p in rows for r in p], "path string, " + schema)
    assert got == {(r.grow, r.gcol): r.value for r in mosaic.merged(every).collect()} == {(0, 0): 3, (0, 1): 2}


def test_written_mosaic(spark, tmp_path):
    m = spark.createDataFrame([(r, c, r % 2) for r in range(4) for c in range(4)], "grow int, gcol int, value int")
    mosaic.write(m, str(tmp_path / "m"), 2)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 16
    with pytest.raises(Exception, match="already exists"):
        mosaic.write(m, str(tmp_path / "m"), 2)


def test_context_inference(spark):
    from pyspark.sql import functions as F

    size = 4
    centres = spark.createDataFrame([(0, 0, "0_0"), (1, 0, "1_0")], "tx int, ty int, tile_id string")
    px = spark.createDataFrame([(t, r, c, float((r * 5 + c * 3 + k) % 7)) for k, t in enumerate(("0_0", "1_0")) for r in range(size) for c in range(size)], "tile_id string, row int, col int, v double")
    model = lambda w: w.withColumn("logits", F.array(F.lit(3.0), F.col("v")))
    out = pipeline.predicted(centres, px, size, ["v"], model, 2, tile=6, overlap=2, step=1, simplify=False, margin=0.0)
    assert out.count() == 2 * size * size
    assert {(r.tile_id, r.row, r.col): r.value for r in out.collect()} == {(r.tile_id, r.row, r.col): int(r.v > 3) for r in px.collect()}


def test_polygon_files(spark, tmp_path):
    """Shapefile and GeoPackage of polygons with and without holes, and of none."""
    import sqlite3
    import struct

    from pyspark.sql import functions as F

    from rasterloom.operators import vector
    from rasterloom.sources import vectors

    px = spark.createDataFrame([(r, c, 2 if (r, c) == (1, 1) else 1) for r in range(3) for c in range(3)], "grow int, gcol int, value int")
    polys = vector.polygons(vector.components(px)).withColumn("rings", vector.to_map(F.col("rings"), 10.0, 20.0, 2.0, -2.0))
    for k, rows in enumerate((polys, polys.where("false"))):
        made = [r.path for r in vectors.write(rows, f"{tmp_path}/v{k}.shp", "ESRI Shapefile").collect()]
        assert [m.rsplit(".", 1)[1] for m in made] == ["shp", "shx", "dbf"]
        shp, shx, dbf = (open(m, "rb").read() for m in made)
        n = 2 if k == 0 else 0
        assert struct.unpack_from(">L", shp, 24)[0] * 2 == len(shp) and struct.unpack_from(">L", shx, 24)[0] * 2 == len(shx) == 100 + 8 * n
        assert struct.unpack_from("<L", dbf, 4)[0] == n and len(dbf) == 65 + 11 * n + 1
        shapes = []
        for i in range(n):
            at = struct.unpack_from(">L", shx, 100 + 8 * i)[0] * 2 + 8
            kind, *box = struct.unpack_from("<L4d", shp, at)
            shapes.append((kind, box, *struct.unpack_from("<2L", shp, at + 36)))
        assert sorted(shapes) == ([(5, [10.0, 14.0, 16.0, 20.0], 2, 10), (5, [12.0, 16.0, 14.0, 18.0], 1, 5)] if n else [])
        path, = [r.path for r in vectors.write(rows, f"{tmp_path}/v{k}.gpkg", "GPKG", "kind").collect()]
        with sqlite3.connect(path) as db:
            assert db.execute("SELECT kind FROM vegetation ORDER BY kind").fetchall() == ([(1,), (2,)] if n else [])
            assert db.execute("PRAGMA application_id").fetchone()[0] == 0x47504B47 and db.execute("SELECT srs_id FROM gpkg_contents").fetchone()[0] == 2154


def test_big_tiff_headers():
    """The same fields as 64-bit entries; only the header's ranges are read."""
    import struct

    import numpy as np

    small = tiff.encode(np.arange(12, dtype=np.uint8).reshape(1, 3, 4), 5.0, 9.0, 0.5, -0.5, nodata=255)
    _, tags = tiff._tags(tiff._within(small))
    kinds = {tiff.SCALE: ("d", 12), tiff.TIEPOINT: ("d", 12), tiff.GEOKEYS: ("H", 3), tiff.NODATA: ("c", 2)}
    strip = small[tags[tiff.STRIPS][0] : tags[tiff.STRIPS][0] + tags[tiff.LENGTHS][0]]
    fields, at = [], 16 + 8 + 20 * len(tags) + 8
    extra = b""
    for tag in sorted(tags):
        code, kind = kinds.get(tag, ("Q", 16))
        body = tags[tag] if code == "c" else struct.pack("<" + code * len(tags[tag]), *tags[tag])
        n = len(tags[tag])
        if tag == tiff.STRIPS:
            body = b"STRIPAT!"
        if len(body) > 8:
            fields.append(struct.pack("<HHQQ", tag, kind, n, at + len(extra)))
            extra += body
        else:
            fields.append(struct.pack("<HHQ", tag, kind, n) + body.ljust(8, b"\0"))
    big = struct.pack("<2sHHHQQ", b"II", 43, 8, 0, 16, len(fields)) + b"".join(fields) + struct.pack("<Q", 0) + extra
    big = big.replace(b"STRIPAT!", struct.pack("<Q", len(big))) + strip
    assert tiff.info(big) == tiff.info(small) and (tiff.decode(big) == tiff.decode(small)).all()
    seen = []

    def read(at, n):
        seen.append(at + n)
        return big[at : at + n]

    assert tiff.info(read) == tiff.info(small) and max(seen) <= len(big) - len(strip)


@pytest.mark.parametrize("form", ["uint8", "uint16", "float32"])
def test_context_by_tile(spark, form):
    """A task a tile gives what rows of pixels give: windows, weights, modes, decisions; dark windows are left out."""
    import numpy as np
    from pyspark.sql import functions as F

    from rasterloom.functions import pixels
    from rasterloom.operators import blend, context
    from rasterloom.plans import pipeline

    size, rng = 8, np.random.default_rng(4)
    tiles = {(x, y): rng.integers(10, 250, (3, size, size)) for x, y in ((0, 0), (1, 0), (0, 1), (5, 5))}
    files, rows = [], []
    for (x, y), cube in tiles.items():
        raw = {"uint8": cube.astype(np.uint8), "uint16": (cube * 257).astype(np.uint16), "float32": ((cube + 0.5) / 255).astype(np.float32)}[form]
        files.append((x, y, f"{x}_{y}", tiff.encode(raw, x * 8.0, y * 8.0 + 8, 1.0, -1.0)))
        rows += [(f"{x}_{y}", r, c, *[float(v) for v in cube[:, r, c]]) for r in range(size) for c in range(size)]

    def model(cut):
        s = cut.sum(axis=2)
        rows_, cols_ = np.indices(s.shape)  # depends on the place in the window, too
        return np.stack([s, np.roll(s, 1, 0) + 0.1, s[::-1] * 0.9 + 0.01 * rows_, s * 0 + 0.02 * cols_], axis=2)

    images = spark.createDataFrame(files, "tx int, ty int, tile_id string, content binary")
    modes = ("hflip", "vflip", "hvflip", "rot90", "rot180", "rot270")
    got = {r.tile_id: np.frombuffer(r.values, np.uint8).reshape(size, size) for r in context.predicted(images, form, lambda: model, 4, 6, 3, 1, modes, False, {2: 0.5}, 0.4).select("tile_id", F.col("values").alias("values")).collect()}
    px = spark.createDataFrame(rows, "tile_id string, row int, col int, r double, g double, b double")

    def run(w):  # missing pixels are 0 before bands are normalized
        bands = pixels.normalized([F.col(b) for b in "rgb"])
        return blend.infer(w.withColumns(dict(zip("rgb", bands))), ["tile_id", "y", "x"], ["r", "g", "b"], "m" + form, lambda: model, 4)

    out = pipeline.predicted(images.select("tx", "ty", "tile_id"), px, size, ["r", "g", "b"], run, 4, 6, 3, 1, modes, False, {2: 0.5}, 0.4)
    # a window of missing tiles alone is dark to the one and not to the other: tiles with all neighbours nearby agree
    want = {}
    for r in out.collect():
        want.setdefault(r.tile_id, np.zeros((size, size), np.uint8))[r.row, r.col] = r.value
    assert set(got) == set(want) == {f"{x}_{y}" for x, y in tiles}
    for k in got:
        assert (got[k] == want[k]).all(), k
    dark = spark.createDataFrame([(0, 0, "0_0", tiff.encode(np.full((3, size, size), 9, np.uint8), 0.0, 8.0, 1.0, -1.0))], images.schema)
    r, = context.predicted(dark, "dark", lambda: model, 4, 6, 3, 1, None, False, None, 0.0).collect()
    assert set(np.frombuffer(r["values"], np.uint8)) == {0} and (r.x0, r.y1, r.crs) == (0.0, 8.0, "EPSG:2154")
    with pytest.raises(Exception, match="bands"):
        context.predicted(dark.withColumn("content", F.lit(tiff.encode(np.zeros((1, 8, 8), np.uint8), 0, 8, 1, -1))), "x", lambda: model, 4).collect()


def test_orthophotos(spark, tmp_path):
    """Images brought to a pixel size, as the row form does it; from a map service; what isn't an image is a failed row."""
    import numpy as np

    from rasterloom.operators import resample
    from rasterloom.sources import ortho

    rng = np.random.default_rng(1)
    cube = rng.integers(0, 256, (3, 12, 10)).astype(np.uint8)
    (tmp_path / "a.tif").write_bytes(tiff.encode(cube, 0.0, 6.0, 0.5, -0.5))
    (tmp_path / "b.tif").write_bytes(b"no image")
    tiles = spark.createDataFrame([("1_1", f"file://{tmp_path}/a.tif"), ("2_2", f"file://{tmp_path}/b.tif")], "tile_id string, url string")
    done = {r.tile_id: r.status for r in ortho.prepared(tiles, f"{tmp_path}/out", 1.0).collect()}
    assert done == {"1_1": "success", "2_2": "failed"}
    data = (tmp_path / "out" / "orthophoto_1_1.tif").read_bytes()
    got = tiff.decode(data)
    assert got.shape == (3, 6, 5) and tiff.info(data)["a"] == 1.0
    px = spark.createDataFrame([(r, c, float(cube[0, r, c])) for r in range(12) for c in range(10)], "row int, col int, value double")
    want = {(r.row, r.col): r.value for r in resample.resized(px, (12, 10), (6, 5)).collect()}
    assert all(abs(int(got[0, r, c]) - v) <= 1 for (r, c), v in want.items()) and len(want) == 30  # one rounding more
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["orthophoto_1_1.tif"]

    def answer(url, path):
        if "2_2" in url:
            return None
        with open(path, "wb") as f:
            f.write(tiff.encode(cube, 0.0, 6.0, 0.5, -0.5))
        return path

    rasters = spark.createDataFrame([("1_1", 0.0, 6.0, 1.0, -1.0, 5, 6, "EPSG:2154"), ("3_3", 0.0, 6.0, 1.0, -1.0, 5, 6, "2_2")], "tile_id string, x0 double, y1 double, a double, e double, width int, height int, crs string")
    done = {r.tile_id: r.status for r in ortho.from_map_service(rasters, f"{tmp_path}/map", "http://wms", "ortho", 1.0, get=answer).collect()}
    assert done == {"1_1": "success", "3_3": "failed"} and tiff.decode((tmp_path / "map" / "orthophoto_1_1.tif").read_bytes()).shape == (3, 6, 5)


def test_compacted_state_goes_on(spark, tmp_path):
    """A stream started on a compacted state adds to it."""
    schema = "grow int, gcol int, value int"
    spark.createDataFrame([(0, 0, 1)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    start = lambda state, cp: incremental.start(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / state), str(tmp_path / cp)).awaitTermination(120)
    start("state", "cp")
    incremental.compact(spark, str(tmp_path / "state"), str(tmp_path / "more"))
    spark.createDataFrame([(0, 1, 2)], schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in"))
    start("more", "cp2")
    assert {(r.grow, r.gcol): r.value for r in incremental.mosaic(incremental.read_state(spark, str(tmp_path / "more"))).collect()} == {(0, 0): 1, (0, 1): 2}


def test_pickled_checkpoint(spark, tmp_path):
    """A zipped checkpoint's index, without the library that wrote it; names that would do harm stay inert."""
    import collections
    import os
    import pickle
    import sys
    import types
    import zipfile

    torch, utils = types.ModuleType("torch"), types.ModuleType("torch._utils")

    def rebuild(*args):
        return args

    rebuild.__module__, rebuild.__qualname__, rebuild.__name__ = "torch._utils", "_rebuild_tensor_v2", "_rebuild_tensor_v2"
    utils._rebuild_tensor_v2 = rebuild
    kinds = {}
    for name in ("FloatStorage", "HalfStorage"):
        kinds[name] = type(name, (), {"__module__": "torch"})
        setattr(torch, name, kinds[name])

    class Stored:
        def __init__(self, kind, shape):
            self.kind, self.shape = kind, shape

    class Storage:
        def __init__(self, kind):
            self.kind = kind

    class Harm:
        def __reduce__(self):
            return os.system, (f"touch {tmp_path}/harm",)

    class Pickler(pickle.Pickler):
        def persistent_id(self, x):
            return ("storage", kinds[x.kind], "0", "cpu", 1) if isinstance(x, Storage) else None

        def reducer_override(self, x):
            if isinstance(x, Stored):
                return rebuild, (Storage(x.kind), 0, x.shape, (1,), False, collections.OrderedDict())
            return NotImplemented

    state = collections.OrderedDict([("model.a.weight", Stored("FloatStorage", (3, 4))), ("model.b", Stored("HalfStorage", ())), ("criterion.w", Stored("FloatStorage", (2,)))])
    sys.modules["torch"], sys.modules["torch._utils"] = torch, utils
    try:
        raw = __import__("io").BytesIO()
        Pickler(raw, protocol=2).dump({"state_dict": state, "epoch": 3, "extra": Harm()})
    finally:
        del sys.modules["torch"], sys.modules["torch._utils"]
    with zipfile.ZipFile(tmp_path / "m.pth", "w") as z:
        z.writestr("archive/data.pkl", raw.getvalue())
        z.writestr("archive/data/0", b"\0" * 100)
    got = {r.name: (r.dtype, list(r.shape), r.size) for r in checkpoint.read(spark, str(tmp_path / "m.pth")).collect()}
    assert got == {"a.weight": ("F32", [3, 4], 12), "b": ("F16", [], 1)} and not (tmp_path / "harm").exists()


def test_windowed_read():
    """Only the strips that meet a window are read."""
    import numpy as np

    cube = np.random.default_rng(2).integers(0, 256, (2, 700, 600)).astype(np.uint8)
    data = tiff.encode(cube, 0.0, 700.0, 1.0, -1.0)
    seen = []

    def read(at, n):
        seen.append(n)
        return data[at : at + n]

    for window in ((0, 700, 0, 600), (0, 1, 0, 1), (300, 420, 77, 78), (699, 700, 0, 600), (5, 5, 2, 2)):
        r0, r1, c0, c1 = window
        assert (tiff.decode(data, window) == cube[:, r0:r1, c0:c1]).all()
    tiff.decode(read, (300, 301, 0, 600))
    assert sum(seen) < len(data) / 2
    with pytest.raises(ValueError):
        tiff.decode(data, (0, 701, 0, 1))

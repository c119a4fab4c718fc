"""Small cases with answers worked out by hand."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import classes, grid, names, pixels
from rasterloom.operators import blend, fuse, metrics, mosaic, patches, points, process, resample, tiles, vector


def cloud(spark, rows):
    return spark.createDataFrame([("t", float(x), float(y), c) for x, y, c in rows], "tile_id string, x double, y double, classification int")


def value(df, col="value"):
    return [r[col] for r in df.collect()]


@pytest.mark.parametrize("codes, extended, expected", [([3, 5], False, 1), ([2, 2, 5], False, 0), ([8], True, 3)])
def test_majority(spark, codes, extended, expected):
    corners = [(0, 0, 6), (1, 1, 6)]
    out = points.rasterized(cloud(spark, [(0.5, 0.5, c) for c in codes] + corners), 1.0, extended)
    assert value(out) == [expected]


def test_empty_and_building_cells(spark):
    c = cloud(spark, [(0, 0, 3), (4, 2, 6), (0.5, 1.9, 8)])
    assert [(r.cols, r.rows) for r in points.extents(c, 1.0).collect()] == [(4, 2)]
    sparse = points.rasterized(c, 1.0)
    dense = points.densified(sparse, points.extents(c, 1.0).select("tile_id", "rows", "cols"))
    assert dense.count() == 8 and sorted(value(dense)) == [0] * 7 + [1]
    assert value(sparse) == [1]  # code 8 only counts in the extended filter


def test_boundary_points_stay_inside(spark):
    out = points.rasterized(cloud(spark, [(0, 0, 5), (2, 2, 6), (2, 0, 4)]), 1.0).collect()
    assert {(r.row, r.col): r.value for r in out} == {(1, 0): 3, (1, 1): 2}


FUSION = {(1, 0): 0, (1, 1): 1, (1, 2): 2, (2, 1): 1, (3, 1): 1, (0, 3): 3, (2, 3): 2, (3, 2): 3, (0, 255): 0, (255, 2): 255}


def test_fusion_truth_table(spark):
    every = list(itertools.product([0, 1, 2, 3, 255], repeat=2))
    df = spark.createDataFrame(every, "p int, m int").withColumn("v", fuse.rule(F.col("p"), F.col("m")))
    got = {(r.p, r.m): r.v for r in df.collect()}
    for k, v in FUSION.items():
        assert got[k] == v
    for (p, m), v in got.items():  # the steps one after another
        out = p
        if m == 1:
            out = 1
        elif p in (0, 1) and m in (2, 3):
            out = m
        elif p == 1:
            out = 0
        assert v == out


@pytest.mark.parametrize("n, tile, overlap, expected", [(1000, 512, 256, [0, 256, 488, 488]), (300, 384, 192, [0, 0]), (1875, 384, 192, [0, 192, 384, 576, 768, 960, 1152, 1344, 1491, 1491])])
def test_window_starts(spark, n, tile, overlap, expected):
    assert spark.range(1).select(grid.window_starts(F.lit(n), tile, overlap).alias("s")).first().s == expected


def test_window_stride_must_be_positive(spark):
    with pytest.raises(ValueError):
        grid.window_starts(F.lit(5), 4, 4)
    assert spark.range(1).select(grid.window_starts(F.lit(5), 4, 6).alias("s")).first().s == []


def weights(spark, h, w, o):
    px = spark.range(h).select(F.col("id").cast("int").alias("y")).crossJoin(spark.range(w).select(F.col("id").cast("int").alias("x")))
    out = np.zeros((h, w))
    for r in px.select("y", "x", grid.blend_weight(F.col("y"), F.col("x"), F.lit(h), F.lit(w), o).alias("v")).collect():
        out[r.y, r.x] = r.v
    return out


def test_blend_weights(spark):
    one = weights(spark, 8, 8, 1)
    assert (one[0] == 0).all() and (one[:, -1] == 0).all() and (one[1:-1, 1:-1] == 1).all()
    assert (weights(spark, 4, 4, 0) == 1).all() and (weights(spark, 4, 6, 4)[:, 3] == weights(spark, 4, 6, 4)[0, 3]).all()
    w = weights(spark, 10, 12, 4)
    ramp = [0.5 - 0.5 * math.cos(math.pi * i / 3) for i in range(4)]
    assert np.allclose(w[:4, 5], ramp) and np.allclose(w[5, :4], ramp) and w.min() >= 0 and w.max() <= 1


@pytest.mark.parametrize("mode", blend.MODES)
def test_augmentation_round_trip(spark, mode):
    px = spark.range(6).select((F.col("id") / 3).cast("int").alias("row"), (F.col("id") % 3).cast("int").alias("col"))
    r, c, h, w = blend.augmented(mode, F.col("row"), F.col("col"), F.lit(2), F.lit(3))
    turned = px.select(F.col("row").alias("r0"), F.col("col").alias("c0"), r.alias("row"), c.alias("col"), h.alias("h"), w.alias("w"))
    r, c = blend.deaugmented(mode, F.col("row"), F.col("col"), F.lit(2), F.lit(3))
    for x in turned.select("*", r.alias("r1"), c.alias("c1")).collect():
        assert (x.r0, x.c0) == (x.r1, x.c1) and 0 <= x.row < x.h and 0 <= x.col < x.w
    image = np.arange(6).reshape(2, 3)
    by_numpy = {"original": image, "hflip": image[:, ::-1], "vflip": image[::-1], "hvflip": image[::-1, ::-1], "rot90": np.rot90(image), "rot180": np.rot90(image, 2), "rot270": np.rot90(image, 3)}[mode]
    for x in turned.collect():
        assert by_numpy[x.row, x.col] == image[x.r0, x.c0]


def test_unknown_mode():
    with pytest.raises(ValueError):
        blend.augmented("diagonal", None, None, None, None)


def one(spark, scores):
    return spark.createDataFrame([(scores,)], "l array<double>")


def test_decisions(spark):
    first = lambda s, f: one(spark, s).select(f(F.col("l")).alias("v")).first().v
    assert first([2.0, 2.0, 1.0, 0.0], pixels.argmax) == 0
    assert first([5.0, 3.0, 0.0, 0.0], lambda c: pixels.recovered(c, 3)) == 1
    assert first([5.0, 3.0, 0.0, 0.0], lambda c: pixels.recovered(c, 2)) == 0
    assert first([1.0, 0.5, 0.0, 0.0], lambda c: pixels.decided(c, {2: 5.0})) == 2
    assert abs(sum(first([1.0, 0.5, 3.0, 0.0], pixels.softmax)) - 1) < 1e-12
    with pytest.raises(ValueError):
        pixels.postprocessed(F.col("l"), "binary")
    with pytest.raises(ValueError):
        pixels.postprocessed(F.col("l"), "other")


def test_remaps(spark):
    df = spark.createDataFrame([(k,) for k in (8, 11, 14, 15, 16, 18, 99)], "k int")
    assert value(df.select(classes.simplify_model(F.col("k")).alias("value"))) == [1, 0, 2, 0, 3, 0, 0]
    df = spark.createDataFrame([(k,) for k in (0, 63, 127, 191, 255, 5)], "k int")
    assert value(df.select(classes.simplify_scaled(F.col("k")).alias("value"))) == [0, 1, 2, 3, 0, 0]
    assert value(classes.training_classes(spark), "name") == ["herbaceous", "hedge", "trees"]
    assert classes.head_names(4)[0] == "else" and classes.head_names(19)[18] == "class_18"


def overlap(spark, rows):
    return spark.createDataFrame(rows, "path string, grow int, gcol int, value int")


def test_mosaic_ties_gaps_and_clip(spark):
    two = overlap(spark, [("a", 0, 0, 3), ("b", 0, 0, 1)])
    assert value(mosaic.merged(two)) == [1] and value(mosaic.merged(two, "last")) == [1]
    assert value(mosaic.merged(overlap(spark, [("a", 0, 0, 1), ("b", 0, 0, 3)]), "last")) == [3]
    gap = mosaic.merged(overlap(spark, [("a", 0, 0, 255)]), nodata=255)
    assert value(gap) == [255]
    # 255 clips to 3, which occurs nowhere: no vote, so the least class
    some = overlap(spark, [("a", 0, 0, 255), ("a", 0, 1, 0), ("a", 0, 2, 2)])
    got = {r.gcol: r.value for r in mosaic.merged(some, clip_range=(0, 3)).collect()}
    assert got == {0: 0, 1: 0, 2: 2}
    with pytest.raises(ValueError):
        mosaic.merged(two, "first")
    dense = mosaic.filled(mosaic.merged(two), 1, 2, 9)
    assert sorted(value(dense)) == [1, 9]


def meta(spark, **change):
    base = {"tile_id": "x", "path": "a", "left": 0.0, "bottom": 0.0, "right": 4.0, "top": 4.0, "a": 1.0, "e": -1.0, "width": 4, "height": 4, "crs": "EPSG:2154", "dtype": "uint8", "band_count": 1}
    return spark.createDataFrame(pd.DataFrame([base, base | {"path": "b", "tile_id": "y"} | change]))


def test_mosaic_checks(spark):
    assert [r.needs_resample for r in mosaic.checked(meta(spark, a=1.0005)).orderBy("path").collect()] == [False, False]
    assert [r.needs_resample for r in mosaic.checked(meta(spark, a=1.5), resample=True).orderBy("path").collect()] == [False, True]
    for change in ({"crs": "EPSG:4326"}, {"band_count": 3}, {"a": 1.5}):
        with pytest.raises(Exception, match="another"):
            mosaic.checked(meta(spark, **change)).collect()
    assert spark.range(1).select(grid.offset(F.lit(2.5), 1.0).alias("v")).first().v == 2


def test_names(spark):
    ids = ["0848_6520", "orthophoto_18430_51735.tif", "a_1", "1_2_3"]
    df = spark.createDataFrame([(i,) for i in ids], "i string").select(names.tile_key(F.col("i")).alias("k"))
    assert [r.k and tuple(r.k) for r in df.collect()] == [(848, 6520), (18430, 51735), None, None]
    url = spark.createDataFrame([("http://x/y/LHD_FXX_0848_6520_PTS.copc.laz",)], "u string")
    row = url.select(names.block_id(F.col("u")).alias("a"), names.block_parts(F.col("u")).alias("b"), names.tile_name(F.col("u")).alias("c"), names.basename(F.col("u")).alias("d")).first()
    assert tuple(row) == ("0848_6520", "0848_6520", "LHD_FXX_0848_6520_PTS", "LHD_FXX_0848_6520_PTS.copc.laz")
    with pytest.raises(Exception, match="no tile id"):
        spark.createDataFrame([("http://x/none.laz",)], "u string").select(names.block_id(F.col("u"))).collect()
    assert names.parsed_bias(["1:2.0", "3:-1"]) == {1: 2.0, 3: -1.0} and names.parsed_bias(None) is None


def test_neighbours_of_the_small_catalogue(spark):
    # 844..848 by 6520..6523 without (848, 6522) and (848, 6523), one more tile apart
    keys = [(x, y) for x in range(844, 849) for y in range(6520, 6524) if (x, y) not in ((848, 6522), (848, 6523))]
    t = spark.createDataFrame([(x, y, f"{x}_{y}") for x, y in [*keys, (900, 6000)]], "tx int, ty int, tile_id string")
    n = tiles.neighbours(t, 1).groupBy("tile_id").agg(F.count("neighbour").alias("n")).groupBy("n").count()
    assert {r.n: r["count"] for r in n.collect()} == {1: 1, 4: 4, 5: 1, 6: 7, 7: 1, 8: 1, 9: 4}


def test_metrics_of_absent_classes(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1)], "pred int, target int")
    got = {r["class"]: r for r in metrics.rates(metrics.confusion(pairs)).collect()}
    assert (got[3].precision, got[3].recall, got[3].f1, got[3].iou) == (0, 0, 0, 0)
    assert abs(got[0].precision - 0.5) < 1e-6 and abs(got[0].recall - 1) < 1e-6
    rows = spark.createDataFrame([([5.0, -60.0, -90.0, -90.0], 0)], "logits array<double>, target int")
    assert metrics.dice_loss(rows).first().dice < 1e-3  # classes that never occur score 1


def test_process_results(spark):
    r = spark.createDataFrame([("a", "success", None), ("b", "failed", "x"), ("c", "other", None)], "tile_id string, status string, error string")
    s = process.summary(r, 4.0).first()
    assert (s.n_success, s.n_failed, s.n_total, s.mean_time) == (1, 1, 2, 2.0)


def test_checkerboard(spark):
    board = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (1, 0, 2), (1, 1, 1)], "grow int, gcol int, value int")
    assert vector.regions(vector.components(board)).count() == 4
    assert vector.regions(vector.components(board, eight=True)).count() == 2


def test_polygon_with_a_hole(spark):
    ring = spark.createDataFrame([(r, c, 0 if (r, c) == (1, 1) else 1) for r in range(3) for c in range(3)], "grow int, gcol int, value int")
    polys = {r["class"]: r.rings for r in vector.polygons(vector.components(ring, block=2)).collect()}
    assert len(polys[1]) == 2 and len(polys[0]) == 1 and len(polys[0][0]) == 5
    text = vector.geojson(vector.polygons(vector.components(ring)).withColumn("rings", vector.to_map(F.col("rings"), 0.0, 3.0, 1.0, -1.0))).collect()
    assert all('"Polygon"' in r.value for r in text)


def traced(cells):
    """Rings of one component by walking its sides; cells: a set of (row, col)."""
    sides = {}
    for r, c in cells:
        for dr, dc, a, b, x, y in ((-1, 0, 0, 0, 0, 1), (0, 1, 0, 1, 1, 1), (1, 0, 1, 1, 1, 0), (0, -1, 1, 0, 0, 0)):
            if (r + dr, c + dc) not in cells:
                sides.setdefault((r + a, c + b), []).append((r + x, c + y))
    found = []
    while sides:
        at = start = min(sides)
        way, ring = None, []
        while True:
            options = sides[at]
            to = options[0] if len(options) == 1 or way is None else (at[0] + way[1], at[1] - way[0])
            options.remove(to)
            if not options:
                del sides[at]
            step = (to[0] - at[0], to[1] - at[1])
            if step != way:
                ring.append(at)
            at, way = to, step
            if at == start:
                break
        found.append(tuple([*ring, start]))
    return sorted(found)


@pytest.mark.parametrize("block,eight", [(3, False), (256, False), (4, True)])
def test_rings_by_block(spark, monkeypatch, block, eight):
    """Chains of small blocks, over several levels, against rings walked at once; with gaps in the raster."""
    import numpy as np

    monkeypatch.setattr(vector, "LARGER", 2)
    rng = np.random.default_rng(block)
    rows = [(int(r) + 5, int(c) + 2, int(v)) for (r, c), v in np.ndenumerate(rng.choice([1, 1, 1, 2, 3], (17, 23))) if v != 3]
    rows += [(40, 40, 1)]
    own = vector.components(spark.createDataFrame(rows, "grow int, gcol int, value int"), eight, block=block)
    cells = {}
    for r in own.collect():
        cells.setdefault(r.component_id, set()).add((r.grow, r.gcol))
    got = {r.component_id: [tuple((int(p.r), int(p.c)) for p in ring) for ring in r.rings] for r in vector.polygons(own, block).collect()}
    assert got == {k: traced(v) for k, v in cells.items()}
    for k, polygon in got.items():
        assert polygon[0][0] == min(p for ring in polygon for p in ring)


@pytest.mark.parametrize("together", [0, 1000])
def test_labels(spark, together):
    """A hub, a chain, a ring, a link to itself and repeated links, in one task and by contraction."""
    from rasterloom.operators import graph

    links = [(1000, k) for k in range(1001, 1100)] + [(k, k + 3) for k in range(10, 60, 3)] + [(201, 200), (200, 202), (202, 201)] * 2 + [(7, 7)]
    got = {r.node: r.label for r in graph.labels(spark.createDataFrame(links, "a long, b long"), together=together).collect()}
    assert got == {**{k: 1000 for k in range(1000, 1100)}, **{k: 10 for k in range(10, 62, 3)}, 200: 200, 201: 200, 202: 200}
    assert graph.labels(spark.createDataFrame([], "a long, b long"), together=together).count() == 0


def test_joins_with_hubs(spark, monkeypatch):
    from pyspark.sql import functions as F

    from rasterloom.operators import graph

    monkeypatch.setattr(graph, "HUB_ROWS", 3)
    big = spark.createDataFrame([(1, k) for k in range(9)] + [(2, 20), (3, 30), (None, 40)], "k long, v long")
    small = spark.createDataFrame([(1, "a", 9), (2, "b", 1)], "of long, w string, n long")
    for how, rest in (("inner", []), ("left", [(30, None), (40, None)])):
        for out in (graph.joined(big, "k", small, "of", "n", 12, how), graph.met(big, "k", small, "of", how)):
            assert sorted((r.v, r.w) for r in out.select("v", F.col("w")).collect()) == [*[(k, "a") for k in range(9)], (20, "b"), *rest]


def test_components_of_a_long_line(spark):
    line = spark.createDataFrame([(0, c, 1) for c in range(200)], "grow int, gcol int, value int")
    assert vector.regions(vector.components(line, block=4)).collect()[0].n_pixels == 200


@pytest.mark.parametrize("how", ["nearest", "bilinear", "bicubic"])
def test_resizing_a_constant(spark, how):
    px = spark.createDataFrame([(r, c, 7.0) for r in range(6) for c in range(5)], "row int, col int, value double")
    for to in ((3, 2), (9, 11)):
        out = resample.resized(px, (6, 5), to, how)
        assert out.count() == to[0] * to[1] and set(value(out)) == {7}


def test_gaussian_keeps_the_mean(spark):
    px = spark.createDataFrame([(r, c, float(r * 4 + c)) for r in range(5) for c in range(4)], "row int, col int, value double")
    out = resample.gaussian(px, 5, 4, 1.0)
    assert abs(sum(value(out)) - sum(range(20))) < 1e-9 and resample.gaussian(px, 5, 4, None) is px


def test_patches(spark):
    t = spark.createDataFrame([("a", 20, 30), ("b", 8, 30)], "tile_id string, height int, width int")
    p = patches.sampled(t, 8, 50)
    assert p.count() == 50 and p.where("y NOT BETWEEN 0 AND 11 OR x NOT BETWEEN 0 AND 21").count() == 0
    assert p.exceptAll(patches.sampled(t, 8, 50)).count() == 0
    assert [r.tile_id for r in patches.too_small(t, 8).collect()] == ["b"]
    img = spark.createDataFrame([("a", 0, 0, 1)], "tile_id string, row int, col int, value int")
    with pytest.raises(Exception, match="differ in shape"):
        patches.paired(img.drop("value"), img.withColumn("col", F.col("col") + 1)).collect()


def test_model_interface(spark):
    px = spark.createDataFrame([(r, c, float(r + c)) for r in range(4) for c in range(4)], "row int, col int, v double")
    cut = blend.windowed(px, 4, 4, 4, 0)
    out = blend.infer(cut, ["y", "x"], ["v"], "half", lambda: (lambda cube: np.repeat(cube[::2, ::2], 2, axis=2)), 2)
    assert out.count() == 16 and all(len(r.logits) == 2 for r in out.collect())
    assert blend.segmented(px.withColumn("logits", F.array("v")), 4, 4, lambda w: w, 1, 4, 0, modes=("rot90", "rot270")).count() == 16


def test_mosaics_do_not_broadcast_pixels(spark, small):
    """Exploded pixels are estimated as small as the table they are made from."""
    from rasterloom.plans import adapters as A
    from rasterloom.sources import tiff

    meta = A.tile_meta(spark, small)
    merged = mosaic.merged(mosaic.global_pixels(A.tile_pixels(spark, small), mosaic.placed(meta)))
    inner, grids = mosaic.blocks(merged, mosaic.extent(meta).first(), "m", 16, 0)
    plan = tiff.write(inner, grids, "/tmp/never")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan


def test_blocks_without_their_corner(spark):
    """A block whose corner has a pixel gets no second one; one without gets the fill there."""
    row = spark.createDataFrame([(0.0, 4.0, 1.0, -1.0, "EPSG:2154", 4, 4)], "left double, top double, ref_a double, ref_e double, ref_crs string, width int, height int").first()
    px = spark.createDataFrame([(0, 0, 3), (1, 3, 2)], "grow int, gcol int, value smallint")
    inner, _ = mosaic.blocks(px, row, "m", 2, 7)
    assert sorted(tuple(r) for r in inner.collect()) == [("m_0_0", 0, 0, 3), ("m_0_1", 0, 0, 7), ("m_0_1", 1, 1, 2), ("m_1_0", 0, 0, 7), ("m_1_1", 0, 0, 7)]


def test_filled_by_segment(spark, monkeypatch):
    """Gaps, ends, runs over several segments and what lies outside, against cells one by one; no join of cells."""
    monkeypatch.setattr(grid, "SEGMENT", 4)
    dims = {"a": (3, 11), "b": (1, 4), "c": (2, 1)}
    runs = [("a", 0, 0, 1, 5), ("a", 0, 3, 9, 6), ("a", 1, 10, 14, 7), ("a", 2, -2, 2, 8), ("a", 3, 0, 3, 9), ("a", -1, 0, 3, 9), ("b", 0, 4, 6, 9), ("c", 1, 0, 1, 4), ("d", 0, 0, 1, 9), (None, 0, 0, 1, 9)]
    want = {(t, r, c): 2 for t, (h, w) in dims.items() for r in range(h) for c in range(w)}
    for t, r, c0, c1, v in runs:
        want.update({(t, r, c): v for c in range(c0, c1) if (t, r, c) in want})
    out = grid.filled(spark.createDataFrame(runs, "tile_id string, row int, c0 int, c1 int, value smallint"), spark.createDataFrame([(t, *s) for t, s in dims.items()], "tile_id string, rows int, cols int"), 2)
    assert sorted(tuple(r) for r in out.collect()) == sorted((*k, v) for k, v in want.items())
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("a, e", [(0.5, -0.5), (3.0, -2.0), (0.7, -1.3), (-0.5, 0.5)])
def test_nearest_cell_by_cell(spark, a, e):
    """Finer, coarser, odd and turned grids that begin elsewhere; cells are not joined."""
    values = {(r, c): 1 + (3 * r + c) % 4 for r in range(4) for c in range(6) if (r + c) % 3}
    h, w, x0, y1 = 9, 14, 0.9, 21.3
    want = {(r, c): values.get((math.floor((y1 + (r + 0.5) * e - 20.0) / -1.0), math.floor((x0 + (c + 0.5) * a - 0.0) / 1.0)), 0) for r in range(h) for c in range(w)}
    meta = "tile_id string, x0 double, y1 double, a double, e double, width int, height int"
    source = spark.createDataFrame([("t", r, c, v) for (r, c), v in values.items()], "tile_id string, row int, col int, value smallint")
    out = fuse.resampled_to(source, spark.createDataFrame([("t", 0.0, 20.0, 1.0, -1.0, 6, 4)], meta), spark.createDataFrame([("t", x0, y1, a, e, w, h)], meta))
    assert {(r.row, r.col): r.value for r in out.collect()} == want
    assert out.count() == h * w
    assert "scol" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_densify_joins_no_cells(spark):
    raster = spark.createDataFrame([("a", 1, 2, 3), ("b", 0, 9, 1)], "tile_id string, row int, col int, value smallint")
    out = points.densified(raster, spark.createDataFrame([("a", 2, 3), ("b", 1, 1)], "tile_id string, rows int, cols int"), 7)
    assert sorted(tuple(r) for r in out.collect()) == [("a", 0, 0, 7), ("a", 0, 1, 7), ("a", 0, 2, 7), ("a", 1, 0, 7), ("a", 1, 1, 7), ("a", 1, 2, 3), ("b", 0, 0, 7)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_first_at_whatever_the_guess(spark):
    """Right, off by one, far off and no guess, against a search one by one."""
    rows = [(v, low, low + n, near) for v in range(-1, 9) for low in (0, 3) for n in (0, 1, 7) for near in (None, -900, 0, 2, 5, 9, 900)]
    of = lambda k: k * k // 5
    df = spark.createDataFrame(rows, "v int, low int, stop int, near int")
    out = df.withColumn("k", grid.first_at(lambda k: F.floor(k * k / 5), F.col("v"), F.col("low"), F.col("stop"), F.col("near")))
    assert all(r.k == next((k for k in range(r.low, r.stop) if of(k) >= r.v), r.stop) for r in out.collect())


@pytest.mark.parametrize("a", [0.3, 7.0, -0.3, -7.0])
def test_nearest_by_part(spark, monkeypatch, a):
    """Columns over several parts, outside the source on both sides, a null value; pixels are shuffled once, not joined."""
    monkeypatch.setattr(fuse, "PART", 4)
    values = {("t", r, c): 1 + (r + c) % 3 for r in range(2) for c in range(40) if (r * c) % 5 != 1} | {("t", 0, 7): None}
    x0, w = (-3.0, 160) if a == 0.3 else (47.0, 170) if a == -0.3 else (-10.0, 9) if a > 0 else (50.0, 9)
    want = {(r, c): values.get(("t", r, math.floor(x0 + (c + 0.5) * a)), 0) or 0 for r in range(2) for c in range(w)}
    meta = "tile_id string, x0 double, y1 double, a double, e double, width int, height int"
    source = spark.createDataFrame([(*k, v) for k, v in values.items()], "tile_id string, row int, col int, value smallint").repartition(3)
    out = fuse.resampled_to(source, spark.createDataFrame([("t", 0.0, 0.0, 1.0, -1.0, 40, 2)], meta), spark.createDataFrame([("t", x0, 0.0, a, -1.0, w, 2), ("u", 0.0, 0.0, a, -1.0, w, 2)], meta))
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(want) and {(r, c): v for _, r, c, v in got} == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1  # of the metas


def test_nearest_comes_by_part(spark, monkeypatch):
    """Each task's cells come part by part, so that the same columns follow one another and take few bytes in a file."""
    monkeypatch.setattr(fuse, "PART", 4)
    meta = "tile_id string, x0 double, y1 double, a double, e double, width int, height int"
    source = spark.createDataFrame([("t", 1, 5, 2)], "tile_id string, row int, col int, value smallint")
    out = fuse.resampled_to(source, spark.createDataFrame([("t", 0.0, 0.0, 1.0, -1.0, 32, 9)], meta), spark.createDataFrame([("t", 0.0, 0.0, 0.5, -0.5, 64, 18)], meta))
    for cols in out.select(F.spark_partition_id().alias("p"), "col").groupBy("p").agg(F.collect_list("col").alias("cols")).collect():
        parts = [c // 8 for c in cols.cols]
        assert parts == sorted(parts)

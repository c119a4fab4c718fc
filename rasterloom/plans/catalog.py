"""The registered queries of the engine, each with its SQL oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import classes, grid, names, pixels, scratch
from rasterloom.operators import blend, fuse, metrics, mosaic, patches, points, process, resample, tiles, vector
from rasterloom.plans import adapters as A
from rasterloom.sources import manifest

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}

ARGMAX = "list_position({0}, list_max({0})) - 1"


def query(sql: str | None = None):
    """Registers the function under its name, with its oracle."""

    def put(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return put


def _all() -> None:
    """Has the queries over files registered, too."""
    from rasterloom.plans import filed  # noqa: F401


def queries() -> dict[str, Callable]:
    _all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_SQL)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


# points


@query(f"WITH {A.RASTERIZED} SELECT tile_id, row, col, value FROM ras")
def rasterize_majority(spark, d):
    return points.rasterized(A.cloud(spark, d), A.CELL, extended=True)


@query(f"WITH {A.CLOUD} SELECT CAST(classification AS SMALLINT) AS classification, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent, CASE classification {' '.join(f'WHEN {k} THEN {chr(39)}{v}{chr(39)}' for k, v in classes.POINT_CODES.items())} ELSE 'Unknown' END AS description FROM pts GROUP BY classification")
def class_histogram(spark, d):
    return _rounded(points.histogram(A.cloud(spark, d)), "percent")


@query(f"WITH {A.CLOUD} SELECT tile_id, x, y, CAST(classification AS SMALLINT) AS classification FROM pts WHERE classification BETWEEN 2 AND 5 OR classification = 8")
def point_filter_veg(spark, d):
    return points.filtered(A.cloud(spark, d), extended=True)


@query(f"WITH {A.CLOUD} SELECT tile_id, x, y, CAST(classification AS SMALLINT) AS classification FROM pts WHERE classification BETWEEN 2 AND 5")
def point_filter_basic(spark, d):
    return points.filtered(A.cloud(spark, d))


@query(f"WITH {A.CLOUD}, {A.BOX} SELECT tile_id, xmin, xmax, ymin, ymax, cols, rows, round((xmax - xmin) / cols, 9) AS pixel_x, round((ymax - ymin) / rows, 9) AS pixel_y FROM box")
def grid_extent(spark, d):
    return _rounded(points.extents(A.cloud(spark, d), A.CELL), "pixel_x", "pixel_y", digits=9)


@query(f"WITH {A.RASTERIZED} SELECT b.tile_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, CAST(coalesce(value, 0) AS SMALLINT) AS value FROM (SELECT tile_id, cols, unnest(generate_series(0, rows - 1)) AS r, cols - 1 AS last FROM box) b, LATERAL (SELECT unnest(generate_series(0, last)) AS c) LEFT JOIN ras ON ras.tile_id = b.tile_id AND ras.row = r AND ras.col = c")
def raster_densify(spark, d):
    cloud = A.cloud(spark, d)
    return points.densified(points.rasterized(cloud, A.CELL, True), points.extents(cloud, A.CELL).select("tile_id", "rows", "cols"))


# fusion

_RULE = "CASE WHEN m = 1 THEN 1 WHEN p IN (0, 1) AND m IN (2, 3) THEN m WHEN p = 1 THEN 0 ELSE p END"
_FUSED = f"{A.RASTERIZED}, {A.MODEL}, fus AS (SELECT tile_id, row, col, p, m, {_RULE} AS value FROM (SELECT ras.tile_id, ras.row, ras.col, ras.value AS p, mdl.value AS m FROM ras JOIN mdl USING (tile_id, row, col)))"


def _fused(spark, d):
    ras = points.rasterized(A.cloud(spark, d), A.CELL, True)
    return fuse.fused(ras, A.model_map(ras))


@query(f"WITH {_FUSED} SELECT tile_id, row, col, CAST(p AS SMALLINT) AS p, CAST(m AS SMALLINT) AS m, CAST(value AS SMALLINT) AS value FROM fus")
def fuse_rule(spark, d):
    return _fused(spark, d)


@query(f"WITH {_FUSED}, n AS (SELECT value, count(*) AS n FROM fus GROUP BY value) SELECT CAST(k AS INTEGER) AS value, coalesce(n, 0) AS n, round(100.0 * coalesce(n, 0) / (SELECT count(*) FROM fus), 6) AS percent FROM range(4) t(k) LEFT JOIN n ON n.value = k")
def fuse_distribution(spark, d):
    return _rounded(fuse.distribution(_fused(spark, d)), "percent")


@query(f"WITH {_FUSED} SELECT count(*) FILTER (m = 1) AS n_herbaceous, count(*) FILTER (p IN (0, 1) AND m IN (2, 3)) AS n_filled, count(*) FILTER (p = 1 AND m NOT IN (1, 2, 3)) AS n_dropped, count(*) FILTER (NOT (m = 1 OR (p IN (0, 1) AND m IN (2, 3)) OR p = 1)) AS n_points FROM fus")
def fuse_counters(spark, d):
    return fuse.counters(_fused(spark, d))


def _paths(spark, d):
    c = A.table(spark, d, "customer").select(F.concat(F.lit("las/classification_map_"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 4, "0"), F.lit("_"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lit(".tif")).alias("path")).distinct()
    o = A.table(spark, d, "orders").select(F.concat(F.lit("out/prediction_"), F.col("o_custkey") % 1000, F.lit("_"), F.col("o_orderkey") % 50, F.lit(".tif")).alias("path")).distinct()
    return c, o


_PATHS = "c AS (SELECT DISTINCT lpad(CAST(c_custkey % 1000 AS VARCHAR), 4, '0') || '_' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS id, c_custkey % 1000 AS x, c_nationkey AS y FROM customer), o AS (SELECT DISTINCT o_custkey % 1000 AS x, o_orderkey % 50 AS y FROM orders)"


@query(f"WITH {_PATHS} SELECT id, 'las/classification_map_' || id || '.tif' AS points_path, 'out/prediction_' || x || '_' || y || '.tif' AS model_path FROM c JOIN o USING (x, y)")
def tile_match_join(spark, d):
    return fuse.matched(*_paths(spark, d))


@query(f"WITH {_PATHS} SELECT 'las/classification_map_' || id || '.tif' AS path FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.x = c.x AND o.y = c.y)")
def tile_match_skipped(spark, d):
    return fuse.skipped(*_paths(spark, d))


@query(f"WITH {_PATHS} SELECT id, 'las/classification_map_' || id || '.tif' AS points_path, 'out/prediction_' || x || '_' || y || '.tif' AS model_path FROM c JOIN o USING (x, y) WHERE id = x || '_' || y")
def tile_match_strict(spark, d):
    return fuse.matched(*_paths(spark, d), strict_name=True)


@query(f"WITH {A.RASTERIZED}, t AS (SELECT tile_id, unnest(generate_series(0, 2 * rows)) AS r, 2 * cols AS last FROM box), g AS (SELECT tile_id, r, unnest(generate_series(0, last)) AS c FROM t) SELECT g.tile_id, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, CAST(coalesce(value, 0) AS SMALLINT) AS value FROM g LEFT JOIN ras ON ras.tile_id = g.tile_id AND ras.row = CAST(floor((r + 0.5) * 0.5) AS INTEGER) AND ras.col = CAST(floor((c + 0.5) * 0.5) AS INTEGER)")
def nearest_resample(spark, d):
    cloud = A.cloud(spark, d)
    box, _ = scratch.written(points.extents(cloud, A.CELL), "extents")
    meta = lambda a, k, more: box.select("tile_id", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y1"), F.lit(a).alias("a"), F.lit(-a).alias("e"), (F.col("cols") * k + more).alias("width"), (F.col("rows") * k + more).alias("height"))
    return fuse.resampled_to(points.rasterized(cloud, A.CELL, True, box), meta(1.0, 1, 0), meta(0.5, 2, 1))


# mosaics


@query(f"WITH {A.META} SELECT min(lft) AS left, min(btm) AS bottom, max(rgt) AS right, max(top) AS top, 1.0::DOUBLE AS ref_a, -1.0::DOUBLE AS ref_e, 'EPSG:2154' AS ref_crs, 'uint8' AS ref_dtype, 1 AS ref_band_count, CAST(max(rgt) - min(lft) AS INTEGER) AS width, CAST(max(top) - min(btm) AS INTEGER) AS height FROM meta")
def mosaic_extent(spark, d):
    return mosaic.extent(A.tile_meta(spark, d))


@query(f"WITH {A.META} SELECT tile_id, path, CAST(1000 - top AS INTEGER) AS row0, CAST(lft AS INTEGER) AS col0, 8 AS rows, 8 AS cols FROM meta")
def mosaic_placement(spark, d):
    return mosaic.placed(A.tile_meta(spark, d))


@query(f"WITH {A.META} SELECT tile_id, k % 3 = 1 AS needs_resample, k % 4 = 2 AS dtype_differs FROM meta")
def mosaic_checks(spark, d):
    k = F.col("tile_id").cast("int")
    m = A.tile_meta(spark, d).withColumn("a", F.when(k % 3 == 1, 1.01).otherwise(1.0)).withColumn("dtype", F.when(k % 4 == 2, "uint16").otherwise("uint8"))
    return mosaic.checked(m, resample=True).select("tile_id", "needs_resample", "dtype_differs")


def _pixels(spark, d):
    return mosaic.global_pixels(A.tile_pixels(spark, d), mosaic.placed(A.tile_meta(spark, d)))


_MODE = "SELECT grow, gcol, CAST({empty} AS SMALLINT) AS value FROM (SELECT DISTINCT grow, gcol FROM px) LEFT JOIN (SELECT grow, gcol, vote, row_number() OVER (PARTITION BY grow, gcol ORDER BY count(*) DESC, vote) AS k FROM ({votes}) WHERE vote IS NOT NULL GROUP BY grow, gcol, vote) w USING (grow, gcol) WHERE k = 1 OR k IS NULL"


@query(f"WITH {A.META}, {A.PIXELS} " + _MODE.format(empty="coalesce(vote, (SELECT min(value) FROM px))", votes="SELECT grow, gcol, value AS vote FROM px"))
def mosaic_mode(spark, d):
    return mosaic.merged(_pixels(spark, d))


@query(f"WITH {A.META}, {A.PIXELS} " + _MODE.format(empty="coalesce(vote, 3)", votes="SELECT grow, gcol, CASE WHEN least(greatest(value, 1), 3) <> 3 AND least(greatest(value, 1), 3) IN (SELECT value FROM px WHERE value <> 3) THEN least(greatest(value, 1), 3) END AS vote FROM px"))
def mosaic_mode_clipped(spark, d):
    return mosaic.merged(_pixels(spark, d), nodata=3, clip_range=(1, 3))


@query(f"WITH {A.META}, {A.PIXELS} " + _MODE.format(empty="vote", votes="SELECT grow, gcol, value AS vote FROM px"))
def incremental_mosaic(spark, d):
    from rasterloom.functions import scratch
    from rasterloom.streaming import incremental

    _, arrived = scratch.written(_pixels(spark, d).select("grow", "gcol", "value"), "arrived")
    stream = spark.readStream.schema("grow int, gcol int, value smallint").option("maxFilesPerTrigger", 2).parquet(arrived)
    incremental.start(stream, f"{arrived}-state", f"{arrived}-offsets").awaitTermination()
    return incremental.mosaic(incremental.read_state(spark, f"{arrived}-state"))


@query(f"WITH {A.META}, {A.PIXELS} SELECT grow, gcol, CAST(arg_max(value, path) AS SMALLINT) AS value FROM px GROUP BY grow, gcol")
def mosaic_last(spark, d):
    return mosaic.merged(_pixels(spark, d), "last")


@query(f"WITH {A.META}, {A.PIXELS} SELECT DISTINCT CAST(value AS SMALLINT) AS value FROM px WHERE value <> 255")
def mosaic_classes(spark, d):
    return mosaic.detected(_pixels(spark, d), nodata=255)


@query(f"WITH {A.META}, {A.PIXELS}, m AS (SELECT grow, gcol, arg_max(value, path) AS v FROM px GROUP BY grow, gcol), e AS (SELECT CAST(max(top) - min(btm) AS INTEGER) AS h, CAST(max(rgt) AS INTEGER) AS w FROM meta), g AS (SELECT unnest(generate_series(0, h - 1)) AS r, w FROM e), c AS (SELECT r, unnest(generate_series(0, w - 1)) AS c FROM g) SELECT CAST(r AS INTEGER) AS grow, CAST(c AS INTEGER) AS gcol, CAST(coalesce(v, 255) AS SMALLINT) AS value FROM c LEFT JOIN m ON m.grow = r AND m.gcol = c")
def mosaic_filled(spark, d):
    e = mosaic.extent(A.tile_meta(spark, d)).first()
    return mosaic.filled(mosaic.merged(_pixels(spark, d), "last"), e.height, e.width, 255)


@query(f"WITH {A.META}, p AS (SELECT tile_id, CAST(1000 - top AS INTEGER) AS r, CAST(lft AS INTEGER) AS c FROM meta), b AS (SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y FROM range(200) s(x), range(10) t(y)) SELECT tile_id, x AS block_row, y AS block_col, greatest(r, 16 * x) AS r0, least(r + 8, 16 * x + 16) AS r1, greatest(c, 16 * y) AS c0, least(c + 8, 16 * y + 16) AS c1 FROM p JOIN b ON r < 16 * x + 16 AND r + 8 > 16 * x AND c < 16 * y + 16 AND c + 8 > 16 * y")
def mosaic_blocks(spark, d):
    return mosaic.tile_blocks(mosaic.placed(A.tile_meta(spark, d)), 16)


# windows and blending


def _starts(length: str, t: int, o: int) -> str:
    return f"SELECT least(s + {t}, {length}) - {t} AS v, s FROM (SELECT unnest(generate_series(0, {length} - 1, {t - o})) AS s)"


@query("WITH i AS (SELECT n_nationkey, 100 + 37 * n_nationkey AS hh, 90 + 11 * n_nationkey AS ww FROM nation), a AS (SELECT *, unnest(generate_series(0, hh - 1, 40)) AS s FROM i), b AS (SELECT *, unnest(generate_series(0, ww - 1, 40)) AS u FROM a) SELECT n_nationkey, CAST(s // 40 AS INTEGER) AS wy, CAST(u // 40 AS INTEGER) AS wx, CAST(greatest(0, least(s + 64, hh) - 64) AS INTEGER) AS y, CAST(greatest(0, least(u + 64, ww) - 64) AS INTEGER) AS x, 64 AS h, 64 AS w FROM b")
def window_grid(spark, d):
    n = A.table(spark, d, "nation").select("n_nationkey", (100 + 37 * F.col("n_nationkey")).cast("int").alias("height"), (90 + 11 * F.col("n_nationkey")).cast("int").alias("width"))
    return grid.windows(n, "height", "width", 64, 24).drop("height", "width")


def _weight_sql(y: str, x: str, h: str, w: str, o: int) -> str:
    ramp = lambda i: "0.0" if o == 1 else f"(0.5 - 0.5 * cos(pi() * ({i}) / {o - 1}.0))"
    rows = f"CASE WHEN {h} <= {o} THEN 1.0 WHEN {y} >= {h} - {o} THEN {ramp(f'{h} - 1 - {y}')} WHEN {y} < {o} THEN {ramp(y)} ELSE 1.0 END"
    cols = f"CASE WHEN {w} <= {o} THEN 1.0 ELSE (CASE WHEN {x} < {o} THEN {ramp(x)} ELSE 1.0 END) * (CASE WHEN {x} >= {w} - {o} THEN {ramp(f'{w} - 1 - {x}')} ELSE 1.0 END) END"
    return f"({rows}) * ({cols})"


@query(f"WITH n AS (SELECT n_nationkey AS k, 3 + n_nationkey AS h, 2 + 2 * n_nationkey AS w FROM nation), a AS (SELECT *, unnest(generate_series(0, h - 1)) AS y FROM n), b AS (SELECT *, unnest(generate_series(0, w - 1)) AS x FROM a) SELECT k, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, round({_weight_sql('y', 'x', 'h', 'w', 5)}, 6) + 0.0 AS weight FROM b")
def blend_weight(spark, d):
    n = A.table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (3 + F.col("n_nationkey")).alias("h"), (2 + 2 * F.col("n_nationkey")).alias("w"))
    px = n.select("*", F.explode(F.expr("sequence(0, h - 1)")).alias("y")).select("*", F.explode(F.expr("sequence(0, w - 1)")).alias("x"))
    return _rounded(px.select("k", "y", "x", grid.blend_weight(F.col("y"), F.col("x"), F.col("h"), F.col("w"), 5).alias("weight")), "weight")


def _toy(windows: DataFrame) -> DataFrame:
    """A model whose scores depend on the place in the window."""
    return windows.withColumn("logits", F.transform("logits", lambda v, k: v * (1 + 0.01 * F.col("wr") + 0.02 * F.col("wc")) + 0.1 * k))


def _pass_sql(mode: str, tag: str) -> str:
    """One pass over the score image: windows of 16 with overlap 8 in the mode's frame, blended and brought back."""
    turn = {"original": ("row", "col", "h", "w"), "hflip": ("row", "w - 1 - col", "h", "w"), "vflip": ("h - 1 - row", "col", "h", "w"), "hvflip": ("h - 1 - row", "w - 1 - col", "h", "w"), "rot90": ("w - 1 - col", "row", "w", "h")}[mode]
    back = {"original": ("row", "col"), "hflip": ("row", "w - 1 - col"), "vflip": ("h - 1 - row", "col"), "hvflip": ("h - 1 - row", "w - 1 - col"), "rot90": ("col", "w - 1 - row")}[mode]
    weight = _weight_sql("(row - y)", "(col - x)", "least(16, hh)", "least(16, ww)", 8)
    sums = ", ".join(f"sum((l[{k + 1}] * (1 + 0.01 * (row - y) + 0.02 * (col - x)) + 0.1 * {k}) * wt) AS s{k}" for k in range(4))
    return f"""t_{tag} AS (SELECT {turn[0]} AS row, {turn[1]} AS col, {turn[2]} AS hh, {turn[3]} AS ww, h, w, l FROM img, dims),
y_{tag} AS (SELECT *, greatest(0, least(s + 16, hh) - 16) AS y FROM (SELECT *, unnest(generate_series(0, hh - 1, 8)) AS s FROM t_{tag})),
x_{tag} AS (SELECT *, greatest(0, least(s2 + 16, ww) - 16) AS x FROM (SELECT *, unnest(generate_series(0, ww - 1, 8)) AS s2 FROM y_{tag} WHERE row >= y AND row < y + least(16, hh))),
w_{tag} AS (SELECT *, {weight} AS wt FROM x_{tag} WHERE col >= x AND col < x + least(16, ww)),
p_{tag} AS (SELECT {back[0]} AS row, {back[1]} AS col, [CASE WHEN wt > 0 THEN s0 / wt ELSE 0 END, CASE WHEN wt > 0 THEN s1 / wt ELSE 0 END, CASE WHEN wt > 0 THEN s2 / wt ELSE 0 END, CASE WHEN wt > 0 THEN s3 / wt ELSE 0 END] AS l FROM (SELECT row, col, h, w, sum(wt) AS wt, {sums} FROM w_{tag} GROUP BY row, col, h, w))"""


_DIMS = f"{A.scores_sql()}, dims AS (SELECT CAST(max(row) + 1 AS INTEGER) AS h, {A.SIDE} AS w FROM img)"
_FLAT = ", ".join(f"round(l[{k + 1}], 6) + 0.0 AS l{k}" for k in range(4))


def _flat(df: DataFrame) -> DataFrame:
    return df.select("row", "col", *[(F.round(F.col("logits")[k], 6) + 0.0).alias(f"l{k}") for k in range(4)])


@query(f"WITH {_DIMS}, {_pass_sql('original', 'o')} SELECT CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, {_FLAT} FROM p_o")
def blend_logits(spark, d):
    img = A.scores(spark, d).select("row", "col", "logits")
    return _flat(blend.segmented(img, A.height(spark, d), A.SIDE, _toy, 4, 16, 8, modes=None))


_TTA = ("original", "hflip", "vflip", "hvflip", "rot90")


@query("WITH " + _DIMS + ", " + ", ".join(_pass_sql(m, m[:3] + str(k)) for k, m in enumerate(_TTA)) + ", u AS (" + " UNION ALL ".join(f"SELECT * FROM p_{m[:3]}{k}" for k, m in enumerate(_TTA)) + ") SELECT CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, " + ", ".join(f"round(sum(l[{k + 1}]) / {len(_TTA)}, 6) + 0.0 AS l{k}" for k in range(4)) + " FROM u GROUP BY row, col")
def tta_mean(spark, d):
    img = A.scores(spark, d).select("row", "col", "logits")
    return _flat(blend.segmented(img, A.height(spark, d), A.SIDE, _toy, 4, 16, 8, modes=_TTA[1:]))


@query(f"WITH {_DIMS}, b AS (SELECT row // 5 AS y, col // 5 AS x, max(trunc(abs(l[1]) * 60)) AS top FROM img GROUP BY ALL) SELECT CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col FROM img JOIN b ON b.y = row // 5 AND b.x = col // 5 WHERE top >= 14")
def dark_tile_skip(spark, d):
    px = A.scores(spark, d).select("row", "col", F.floor(F.col("row") / 5).alias("y"), F.floor(F.col("col") / 5).alias("x"), F.floor(F.abs(F.col("logits")[0]) * 60).cast("int").alias("v"))
    return blend.lit_windows(px, ["v"], 14).select("row", "col")


def _linear():
    import numpy as np

    return lambda cube: np.concatenate([cube * (k + 1) - k * 0.05 for k in range(4)], axis=2)


@query(f"WITH {_DIMS} SELECT CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, " + ", ".join(f"round(l[1] * {k + 1} - {k} * 0.05, 6) + 0.0 AS l{k}" for k in range(4)) + " FROM img")
def model_inference_stub(spark, d):
    px = A.scores(spark, d).select("row", "col", F.col("logits")[0].alias("v"))
    cut = blend.windowed(px, A.height(spark, d), A.SIDE, 5, 0)
    return _flat(blend.infer(cut, ["y", "x"], ["v"], "linear", _linear, 4).dropDuplicates(["row", "col"]))


# decisions on scores


@query(f"WITH {A.scores_sql(19)} SELECT row, col, CAST({ARGMAX.format('l')} AS INTEGER) AS k FROM img")
def argmax(spark, d):
    return A.scores(spark, d, 19).select("row", "col", pixels.argmax(F.col("logits")).alias("k"))


@query(f"WITH {A.scores_sql()}, e AS (SELECT row, col, list_transform(l, lambda v: exp(v - list_max(l))) AS e FROM img) SELECT row, col, " + ", ".join(f"round(e[{k + 1}] / list_sum(e), 6) AS l{k}" for k in range(4)) + " FROM e")
def softmax(spark, d):
    return _flat(A.scores(spark, d).select("row", "col", pixels.softmax(F.col("logits")).alias("logits")))


@query(f"WITH {A.scores_sql()}, e AS (SELECT row, col, list_transform(l, lambda v: exp(v - list_max(l))) AS e FROM img) SELECT row, col, CAST(e[2] / list_sum(e) >= 0.26 AS SMALLINT) AS value FROM e")
def threshold_mask(spark, d):
    return blend.binary_map(A.scores(spark, d).select("row", "col", "logits"), 1, 0.26)


@query(f"WITH {A.scores_sql()}, e AS (SELECT list_transform(l, lambda v: exp(v - list_max(l))) AS e FROM img), m AS (SELECT CAST(e[2] / list_sum(e) >= 0.26 AS INTEGER) AS value FROM e) SELECT CAST(sum(value) AS BIGINT) AS n, round(100.0 * sum(value) / count(*), 6) AS percent FROM m")
def positive_pixels(spark, d):
    return _rounded(blend.positives(threshold_mask(spark, d)), "percent")


@query(f"WITH {A.scores_sql()}, b AS (SELECT row, col, [l[1], l[2] + 0.1, l[3], l[4] - 0.2] AS l FROM img) SELECT row, col, CAST({ARGMAX.format('l')} AS SMALLINT) AS value FROM b")
def bias_argmax(spark, d):
    return blend.class_map(A.scores(spark, d).select("row", "col", "logits"), {1: 0.1, 3: -0.2})


@query(f"WITH {A.scores_sql()}, b AS (SELECT row, col, l, {ARGMAX.format('l')} AS k FROM img) SELECT row, col, CAST(CASE WHEN k = 0 AND l[1] - l[2] < 0.15 THEN 1 ELSE k END AS SMALLINT) AS value FROM b")
def herb_recovery(spark, d):
    return blend.class_map(A.scores(spark, d).select("row", "col", "logits"), margin=0.15)


_TO_4 = "CASE WHEN {0} IN (8, 9, 10) THEN 1 WHEN {0} = 14 THEN 2 WHEN {0} IN (12, 13, 16, 17) THEN 3 ELSE 0 END"


@query(f"WITH {A.scores_sql(19)}, b AS (SELECT row, col, {ARGMAX.format('l')} AS k FROM img) SELECT row, col, CAST({_TO_4.format('k')} AS SMALLINT) AS value FROM b")
def remap_19_4(spark, d):
    return blend.class_map(A.scores(spark, d, 19).select("row", "col", "logits"), simplify=True)


@query("SELECT l_orderkey, l_linenumber, CAST(CASE l_partkey % 256 WHEN 63 THEN 1 WHEN 127 THEN 2 WHEN 191 THEN 3 ELSE 0 END AS SMALLINT) AS value FROM lineitem")
def scaled_remap(spark, d):
    return A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", classes.simplify_scaled(F.col("l_partkey") % 256).alias("value"))


@query(f"WITH {A.scores_sql(19)}, b AS (SELECT row, col, CAST({ARGMAX.format('l')} AS INTEGER) AS k FROM img) SELECT row, col, k, CASE k {' '.join(f'WHEN {k} THEN {chr(39)}{v}{chr(39)}' for k, v in classes.MODEL_CLASSES.items())} ELSE 'unknown' END AS class_name FROM b")
def class_names(spark, d):
    return classes.named(argmax(spark, d), "k", classes.MODEL_CLASSES)


@query(f"WITH {A.scores_sql()} SELECT row, col, " + ", ".join(f"CAST(target = {k} AS INTEGER) AS h{k}" for k in range(4)) + " FROM img")
def one_hot(spark, d):
    h = A.scores(spark, d).select("row", "col", pixels.one_hot(F.col("target"), 4).alias("h"))
    return h.select("row", "col", *[F.col("h")[k].alias(f"h{k}") for k in range(4)])


@query("SELECT l_orderkey, l_linenumber, round((l_partkey % 256 - 106.59) / 39.78, 6) AS r, round((l_suppkey % 256 - 105.66) / 52.23, 6) AS g, round((l_quantity - 111.35) / 45.62, 6) AS b FROM lineitem")
def normalize_rgb(spark, d):
    r, g, b = pixels.normalized([F.col("l_partkey") % 256, F.col("l_suppkey") % 256, F.col("l_quantity")])
    return _rounded(A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", r.alias("r"), g.alias("g"), b.alias("b")), "r", "g", "b")


@query("SELECT l_orderkey, l_linenumber, CAST(floor((l_partkey * 31 % 65536) / 257.0) AS SMALLINT) AS u16, CAST(floor((l_partkey * 31 % 65536) / 256.0) AS SMALLINT) AS u16_training, CAST(floor(least(greatest(l_discount * 12 * 255.0, 0), 255)) AS SMALLINT) AS f32, CAST(l_linenumber AS SMALLINT) AS u8 FROM lineitem")
def dtype_coerce(spark, d):
    v = F.col("l_partkey") * 31 % 65536
    return A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", pixels.eight_bit(v, "uint16").alias("u16"), pixels.eight_bit(v, "uint16", True).alias("u16_training"), pixels.eight_bit(F.col("l_discount") * 12, "float32").alias("f32"), pixels.eight_bit(F.col("l_linenumber"), "uint8").alias("u8"))


# catalogues


@query(f"WITH {A.CATALOGUE} SELECT split, tile_id, split || '/orthophoto_' || tile_id || '.tif' AS orthophoto, split || '/classification_map_' || tile_id || '.tif' AS classification_map, url, CAST(row_number() OVER (PARTITION BY split ORDER BY position) - 1 AS INTEGER) AS position FROM cat")
def manifest_parse(spark, d):
    return manifest.parsed(manifest.manifest_text(A.catalogue(spark, d), "position"))


_BLOCK = "lpad(CAST(c_custkey AS VARCHAR), 12, '0') || '_' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0')"


@query(
    f"""SELECT 'test' AS split, regexp_extract(u, 'LHD_FXX_(\\d+)_(\\d+)_', 1) || '_' || regexp_extract(u, 'LHD_FXX_(\\d+)_(\\d+)_', 2) AS tile_id,
       'test/orthophoto_' || {_BLOCK} || '.tif' AS orthophoto, 'test/classification_map_' || {_BLOCK} || '.tif' AS classification_map, u AS url
FROM (SELECT *, 'http://x.example.com/LHD_FXX_' || {_BLOCK} || '_PTS.laz' AS u FROM customer)"""
)
def manifest_entries(spark, d):
    c = A.table(spark, d, "customer")
    url = F.concat(F.lit("http://x.example.com/LHD_FXX_"), F.lpad(F.col("c_custkey").cast("string"), 12, "0"), F.lit("_"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lit("_PTS.laz"))
    return tiles.entries(c.select(url.alias("url")), "test")


@query(f"WITH {A.CATALOGUE} SELECT split, tile_id, 'data/' || split AS folder FROM cat WHERE split = 'train'")
def tile_list(spark, d):
    return tiles.tile_list(A.catalogue(spark, d), ["train", "absent"], "data").select("split", "tile_id", "folder")


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, split_part(regexp_extract(url, '([^/]*)$', 1), '.', 1) AS name, CASE WHEN regexp_matches(regexp_extract(url, '([^/]*)$', 1), '\\d') THEN 'd' ELSE 'n' END AS kind FROM pages")
def url_basename(spark, d):
    base = names.basename(F.col("url"))
    return A.table(spark, d, "pages").select("page_id", base.alias("base"), names.tile_name(F.col("url")).alias("name"), F.when(base.rlike(r"\d"), "d").otherwise("n").alias("kind"))


@query("WITH c AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '_' || c_nationkey WHEN 1 THEN 'orthophoto_' || c_custkey || '_' || c_nationkey || '.tif' WHEN 2 THEN 'a_' || c_custkey WHEN 3 THEN c_custkey || '_1_2' ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer) SELECT c_custkey, id, CASE WHEN c_custkey % 5 < 2 THEN CAST(c_custkey AS INTEGER) END AS tx, CASE WHEN c_custkey % 5 < 2 THEN c_nationkey END AS ty FROM c JOIN customer USING (c_custkey)")
def tile_id_parse(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    made = F.when(k % 5 == 0, F.concat(F.lpad(k.cast("string"), 6, "0"), F.lit("_"), n)).when(k % 5 == 1, F.concat(F.lit("orthophoto_"), k, F.lit("_"), n, F.lit(".tif"))).when(k % 5 == 2, F.concat(F.lit("a_"), k)).when(k % 5 == 3, F.concat(k, F.lit("_1_2"))).otherwise(k.cast("string"))
    c = A.table(spark, d, "customer").select("c_custkey", made.alias("id"))
    return c.withColumn("p", names.tile_key(F.col("id"))).select("c_custkey", "id", "p.tx", "p.ty")


@query("SELECT s_suppkey, 'http://wms.example.com?SERVICE=WMS&VERSION=1.3.0&REQUEST=GetMap&LAYERS=ortho&CRS=EPSG%3A2154&BBOX=' || s_suppkey || '%2C1%2C' || (s_suppkey + 5) || '%2C6&WIDTH=6&HEIGHT=6&FORMAT=image%2Fjpeg&STYLES=' AS request, CAST(trunc((s_suppkey * CAST(0.7 AS DOUBLE) + 5.0) / CAST(0.8 AS DOUBLE)) AS INTEGER) AS across FROM supplier")
def map_requests(spark, d):
    k = F.col("s_suppkey")
    size = grid.resized_across(F.lit(0.0), F.lit(5.0), 0.8)
    return A.table(spark, d, "supplier").select("s_suppkey", names.map_request("http://wms.example.com", "ortho", F.lit("EPSG:2154"), k, F.lit(1), k + 5, F.lit(6), size, size).alias("request"), grid.resized_across(F.lit(0.0), k * 0.7 + 5.0, 0.8).alias("across"))


@query("SELECT o_orderkey, CASE WHEN n > 1073741824 THEN printf('%.2f GB', n / 1073741824.0) WHEN n > 1048576 THEN printf('%.2f MB', n / 1048576.0) ELSE printf('%.2f KB', n / 1024.0) END AS size, CASE o_orderkey % 4 WHEN 0 THEN 'ESRI Shapefile' WHEN 1 THEN 'GeoJSON' ELSE 'GPKG' END AS format, (o_orderkey % 7) / 2.0 AS bias FROM (SELECT *, o_orderkey * o_orderkey * 64 AS n FROM orders)")
def output_names(spark, d):
    k = F.col("o_orderkey")
    path = F.concat(F.lit("out/a.b"), F.when(k % 4 == 0, ".SHP").when(k % 4 == 1, ".geojson").when(k % 4 == 2, ".gpkg").otherwise(".xyz"))
    bias = names.class_bias(F.concat(F.lit("1:2.0,3:"), (k % 7) / 2.0))
    return A.table(spark, d, "orders").select("o_orderkey", names.file_size((k * k * 64).cast("double")).alias("size"), names.vector_format(path).alias("format"), F.element_at(bias, 3).alias("bias"))


_LAST = f"{A.CATALOGUE}, t AS (SELECT tx, ty, arg_max(tile_id, position) AS tile_id, arg_max(url, position) AS url FROM cat GROUP BY tx, ty)"


def _tiles(spark, d):
    return tiles.tile_map(A.catalogue(spark, d), "position")


@query(f"WITH {_LAST} SELECT CAST(tx AS INTEGER) AS tx, ty, tile_id, url FROM t")
def tile_map_last_wins(spark, d):
    return _tiles(spark, d).select("tx", "ty", "tile_id", "url")


@query(f"WITH {A.CATALOGUE}, f AS (SELECT *, split || '/orthophoto_' || tile_id || '.tif' AS o FROM cat), t AS (SELECT tx, ty, arg_max(url, position) AS url FROM f WHERE o IN (SELECT o FROM f WHERE position % 3 = 0) GROUP BY tx, ty) SELECT CAST(tx AS INTEGER) AS tx, ty, url FROM t")
def tile_map_existing(spark, d):
    c = A.catalogue(spark, d)
    return tiles.tile_map(c, "position", c.where("position % 3 = 0").select(F.col("orthophoto").alias("path"))).select("tx", "ty", "url")


@query(f"WITH {_LAST} SELECT count(*) AS n_tiles, CAST(min(tx) AS INTEGER) AS min_x, CAST(max(tx) AS INTEGER) AS max_x, min(ty) AS min_y, max(ty) AS max_y FROM t")
def tile_key_range(spark, d):
    return tiles.key_range(_tiles(spark, d))


_NEAR = f"{_LAST}, o AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{n}{chr(39)}, {r}, {c}, {dx}, {dy})' for n, r, c, dx, dy in tiles.PLACES)}) v(place, ri, ci, dx, dy)), nb AS (SELECT t.tx, t.ty, t.tile_id, place, ri, ci, u.tile_id AS neighbour FROM t CROSS JOIN o LEFT JOIN t u ON u.tx = t.tx + dx AND u.ty = t.ty + dy)"


@query(f"WITH {_NEAR} SELECT CAST(tx AS INTEGER) AS tx, ty, tile_id, place, ri, ci, neighbour FROM nb")
def tile_neighbours(spark, d):
    return tiles.neighbours(_tiles(spark, d), 1)


def _tile_bands(spark, d):
    cells = _tiles(spark, d).select("tile_id", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("row")).select("tile_id", "row", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("col"))
    return cells.withColumn("v", (F.substring("tile_id", 1, 4).cast("int") * 10 + F.substring("tile_id", 6, 4).cast("int") + F.col("row") * 2 + F.col("col")).cast("int"))


# each neighbour gives its own cells of the mosaic
_MOSAIC = f"""{_NEAR}, mos AS (
  SELECT tile_id, ri * 2 + r AS mr, ci * 2 + c AS mc, CASE WHEN neighbour IS NULL THEN 0 ELSE CAST(substr(neighbour, 1, 4) AS INTEGER) * 10 + CAST(substr(neighbour, 6, 4) AS INTEGER) + r * 2 + c END AS v
  FROM nb, (VALUES (0), (1)) a(r), (VALUES (0), (1)) b(c))"""


@query(f"WITH {_MOSAIC} SELECT tile_id, CAST(mr AS INTEGER) AS mrow, CAST(mc AS INTEGER) AS mcol, CAST(v AS INTEGER) AS v FROM mos")
def context_mosaic(spark, d):
    return tiles.context_mosaic(tiles.neighbours(_tiles(spark, d), 1), _tile_bands(spark, d), 2, ["v"], dense=True)


@query(f"WITH {_MOSAIC} SELECT tile_id, CAST(mr - 2 AS INTEGER) AS mrow, CAST(mc - 2 AS INTEGER) AS mcol, CAST(v AS INTEGER) AS v FROM mos WHERE mr BETWEEN 2 AND 3 AND mc BETWEEN 2 AND 3")
def centre_crop(spark, d):
    return tiles.centre(context_mosaic(spark, d), 2)


@query(f"WITH {A.CATALOGUE} SELECT split, count(*) AS n FROM cat WHERE position % 2 = 0 GROUP BY split")
def predictions_by_split(spark, d):
    path = F.concat(F.lit("out/"), "split", F.when(F.col("position") % 2 == 0, F.lit("/prediction_")).otherwise(F.lit("/other_")), "tile_id", F.lit(".tif"))
    return tiles.predictions_by_split(A.catalogue(spark, d).select(path.alias("path")))


# results


@query("SELECT count(*) FILTER (event_type NOT IN ('error', 'view')) AS n_success, count(*) FILTER (event_type = 'error') AS n_failed, count(*) FILTER (event_type <> 'view') AS n_total, 60.0 / count(*) FILTER (event_type <> 'view') AS mean_time FROM events")
def process_summary(spark, d):
    return process.summary(A.results(spark, d), 60.0)


@query("SELECT 'e' || event_id AS tile_id, CASE WHEN event_id % 2 = 0 THEN 'code ' || user_id ELSE 'Unknown' END AS error FROM events WHERE event_type = 'error'")
def failed_tiles(spark, d):
    return process.failed_lines(process.appended(process.successes(A.results(spark, d)), process.failures(A.results(spark, d))))


def _work(row: dict) -> None:
    if row["k"] % 7 == 3:
        raise ValueError(f"tile {row['k']}")


@query("SELECT CAST(c_custkey AS VARCHAR) AS tile_id, CASE WHEN c_custkey % 7 = 3 THEN 'failed' ELSE 'success' END AS status, CASE WHEN c_custkey % 7 = 3 THEN 'ValueError: tile ' || c_custkey END AS error FROM customer")
def tile_processing(spark, d):
    c = A.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("tile_id"), F.col("c_custkey").alias("k"))
    return process.processed(c, _work)


# metrics

_PRED = f"{A.scores_sql()}, b AS (SELECT row AS batch, target, l, {ARGMAX.format('l')} AS pred FROM img)"
_RATES = "tp / (tp + fp + 1e-7) AS p, tp / (tp + fn + 1e-7) AS r, tp / (tp + fp + fn + 1e-7) AS iou"


def _counts_sql(by: str = "") -> str:
    key = by + ", " if by else ""
    return f"c AS (SELECT {key}k, count(*) FILTER (pred = k AND target = k) AS tp, count(*) FILTER (pred = k AND target <> k) AS fp, count(*) FILTER (pred <> k AND target = k) AS fn FROM b, range(4) t(k) GROUP BY {key}k), x AS (SELECT *, {_RATES} FROM c)"


@query(f"WITH {_PRED}, {_counts_sql()} SELECT CAST(k AS INTEGER) AS class, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r + 1e-7), 6) AS f1, round(iou, 6) AS iou FROM x")
def confusion_metrics(spark, d):
    return _rounded(metrics.rates(metrics.confusion(A.batches(spark, d))), "precision", "recall", "f1", "iou")


@query(f"WITH {_PRED}, {_counts_sql('batch')} SELECT CAST(k AS INTEGER) AS class, round(avg(iou), 6) AS iou, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(2 * p * r / (p + r + 1e-7)), 6) AS f1 FROM x GROUP BY k")
def epoch_metrics(spark, d):
    return _rounded(metrics.epoch(A.batches(spark, d), "batch"), "precision", "recall", "f1", "iou")


def _daily(spark, d):
    return A.table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("loss"))


_DAILY = "e AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS loss FROM events GROUP BY 1)"


@query(f"WITH {_DAILY} SELECT CAST(day AS VARCHAR) AS day, round(loss, 6) AS loss, round(avg(loss) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING), 6) AS running FROM e")
def running_loss(spark, d):
    return _rounded(metrics.running_loss(_daily(spark, d), "day").withColumn("day", F.col("day").cast("string")), "loss", "running")


@query(f"WITH {_DAILY} SELECT round(avg(loss), 6) AS mean_loss FROM e")
def mean_loss(spark, d):
    return _rounded(metrics.mean_loss(_daily(spark, d)), "mean_loss")


_LOSS = f"{A.scores_sql()}, s AS (SELECT target, list_transform(l, lambda v: exp(v - list_max(l))) AS e, list_max(l) + ln(list_sum(list_transform(l, lambda v: exp(v - list_max(l))))) - l[target + 1] AS ce FROM img), f AS (SELECT avg(0.25 * pow(1 - exp(-ce), 2) * ce) AS focal FROM s), q AS (SELECT k, (2 * sum(CASE WHEN target = k THEN e[k + 1] / list_sum(e) ELSE 0 END) + 1e-5) / (sum(e[k + 1] / list_sum(e) + CAST(target = k AS INTEGER)) + 1e-5) AS s FROM s, range(4) t(k) GROUP BY k), dc AS (SELECT 1 - avg(s) AS dice FROM q)"


@query(f"WITH {_LOSS} SELECT round(focal, 6) AS focal FROM f")
def focal_loss(spark, d):
    return _rounded(metrics.focal_loss(A.scores(spark, d)), "focal")


@query(f"WITH {_LOSS} SELECT round(dice, 6) AS dice FROM dc")
def dice_loss(spark, d):
    return _rounded(metrics.dice_loss(A.scores(spark, d)), "dice")


@query(f"WITH {_LOSS} SELECT round(focal, 6) AS focal, round(dice, 6) AS dice, round(0.5 * focal + 0.5 * dice, 6) AS loss FROM f, dc")
def combined_loss(spark, d):
    return _rounded(metrics.combined_loss(A.scores(spark, d)), "focal", "dice", "loss")


# vectors


def _classes(spark, d):
    return A.scores(spark, d).select(F.col("row").alias("grow"), F.col("col").alias("gcol"), F.col("target").alias("value"))


def _components_sql(eight: bool) -> str:
    near = "abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1" if eight else "abs(a.row - b.row) + abs(a.col - b.col) <= 1"
    return f"RECURSIVE {A.scores_sql()}, p AS MATERIALIZED (SELECT row, col, target AS v, CAST(row AS BIGINT) * 4294967296 + col AS id FROM img), e AS MATERIALIZED (SELECT a.id AS x, b.id AS y FROM p a JOIN p b ON a.v = b.v AND {near}), r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x), comp AS (SELECT x AS id, min(y) AS component_id FROM r GROUP BY x), cp AS (SELECT row, col, v, component_id FROM p JOIN comp USING (id))"


@query(f"WITH {_components_sql(False)} SELECT row AS grow, col AS gcol, CAST(v AS INTEGER) AS value, component_id FROM cp")
def components_4(spark, d):
    return vector.components(_classes(spark, d), block=8)


@query(f"WITH {_components_sql(True)} SELECT row AS grow, col AS gcol, CAST(v AS INTEGER) AS value, component_id FROM cp")
def components_8(spark, d):
    return vector.components(_classes(spark, d), eight=True, block=8)


@query(f"WITH {_components_sql(False)} SELECT component_id, CAST(min(v) AS INTEGER) AS class, count(*) AS n_pixels, min(row) AS row0, max(row) + 1 AS row1, min(col) AS col0, max(col) + 1 AS col1 FROM cp WHERE v <> 0 GROUP BY component_id")
def regions(spark, d):
    return vector.regions(vector.components(_classes(spark, d), nodata=0, block=8))


@query(f"WITH {_components_sql(False)} SELECT component_id, CAST(min(v) AS INTEGER) AS class, CAST(count(*) AS DOUBLE) AS area FROM cp GROUP BY component_id")
def polygon_areas(spark, d):
    polys = vector.polygons(vector.components(_classes(spark, d), block=8)).withColumn("rings", vector.to_map(F.col("rings"), 0.0, 0.0, 1.0, -1.0))
    # the outer ring and the holes turn opposite ways
    return polys.select("component_id", "class", F.abs(F.aggregate(F.transform("rings", vector.area), F.lit(0.0), lambda a, x: a + x)).alias("area"))


# corners of regions by the 2 x 2 windows around them: one or three pixels turn once, two diagonal ones twice
_QUADS = """q AS (SELECT component_id, row + a AS wr, col + b AS wc, count(*) AS n, sum(CASE WHEN a = b THEN 1 ELSE 0 END) AS s FROM cp, (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b) GROUP BY ALL),
k AS (SELECT component_id, count(*) FILTER (n = 1) AS q1, count(*) FILTER (n = 3) AS q3, count(*) FILTER (n = 2 AND s IN (0, 2)) AS qd FROM q GROUP BY component_id),
sums AS (SELECT component_id, min(v) AS class, count(*) AS area FROM cp GROUP BY component_id)"""


@query(f"WITH {_components_sql(False)}, {_QUADS} SELECT CAST(class AS INTEGER) AS vegetation_class, CAST(2 - (q1 - q3 + 2 * qd) // 4 AS INTEGER) AS n_rings, CAST(q1 + q3 + 2 * qd + 2 - (q1 - q3 + 2 * qd) // 4 AS INTEGER) AS n_points, CAST(area AS DOUBLE) AS area FROM sums JOIN k USING (component_id)")
def polygon_geojson(spark, d):
    """Features are written as text and parsed again."""
    polys = vector.polygons(vector.components(_classes(spark, d), block=8), block=8).withColumn("rings", vector.to_map(F.col("rings"), 0.0, 0.0, 0.8, -0.8))
    features = vector.geojson(polys, field="vegetation_class")
    f = features.select(F.from_json("value", "type STRING, properties STRUCT<vegetation_class: INT>, geometry STRUCT<type: STRING, coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>").alias("f")).select("f.*").where("type = 'Feature' AND geometry.type = 'Polygon'")
    rings = F.transform(F.col("geometry.coordinates"), lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    areas = F.aggregate(F.transform(rings, vector.area), F.lit(0.0), lambda a, x: a + x)
    points = F.aggregate(F.col("geometry.coordinates"), F.lit(0), lambda a, ring: a + F.size(ring))
    return f.select("properties.vegetation_class", F.size("geometry.coordinates").alias("n_rings"), points.alias("n_points"), F.round(F.abs(areas) / 0.64, 6).alias("area"))


def _square(spark, d):
    k = F.col("s_suppkey").cast("double")
    corner = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    s = A.table(spark, d, "supplier")
    return s.select("s_suppkey", F.array(corner("s_suppkey", "0"), corner("s_suppkey + 8", "0"), corner("s_suppkey + 8", "4"), corner("s_suppkey", "4"), corner("s_suppkey", "0")).alias("ring")).withColumn("k", k)


@query("WITH s AS (SELECT s_suppkey, CAST(s_suppkey AS DOUBLE) AS k FROM supplier), c AS (SELECT s_suppkey, unnest([0, 1, 2, 3]) AS i, k FROM s), p AS (SELECT s_suppkey, i, k + [0, 8, 8, 0, 0][i + 1] AS x0, [0, 0, 4, 4, 0][i + 1] AS y0, k + [0, 8, 8, 0, 0][i + 2] AS x1, [0, 0, 4, 4, 0][i + 2] AS y1 FROM c), q AS (SELECT s_suppkey, 2 * i AS n, 0.75 * x0 + 0.25 * x1 AS x, 0.75 * y0 + 0.25 * y1 AS y FROM p UNION ALL SELECT s_suppkey, 2 * i + 1, 0.25 * x0 + 0.75 * x1, 0.25 * y0 + 0.75 * y1 FROM p) SELECT s_suppkey, CAST(n AS INTEGER) AS n, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM q UNION ALL SELECT s_suppkey, 8, round(x, 6) + 0.0, round(y, 6) + 0.0 FROM q WHERE n = 0")
def chaikin(spark, d):
    out = _square(spark, d).select("s_suppkey", F.posexplode(vector.chaikin(F.col("ring"), 1)).alias("n", "p"))
    return _rounded(out.select("s_suppkey", "n", "p.x", "p.y"), "x", "y")


@query("SELECT s_suppkey, 32.0 AS area, CAST(s_suppkey + 4 AS DOUBLE) AS middle FROM supplier")
def smoothed_area(spark, d):
    out = vector.smoothed(_square(spark, d).select("s_suppkey", "ring"))
    top = F.array_max(F.transform("ring", lambda p: p["x"]))
    low = F.array_min(F.transform("ring", lambda p: p["x"]))
    return _rounded(out.select("s_suppkey", vector.area(F.col("ring")).alias("area"), ((top + low) / 2).alias("middle")), "area", "middle")


# resampling

_GRAY = f"{A.scores_sql()}, g AS (SELECT row, col, floor((l[1] + 0.5) * 200) AS v FROM img), dims AS (SELECT CAST(max(row) + 1 AS INTEGER) AS h, {A.SIDE} AS w FROM g)"


def _gray(spark, d):
    return A.scores(spark, d).select("row", "col", F.floor((F.col("logits")[0] + 0.5) * 200).cast("double").alias("value"))


def _axis_sql(name: str, n: str, m: str, kind: str) -> str:
    if kind == "bilinear":
        pos = f"greatest(0.0, least((d + 0.5) * ({n} / CAST({m} AS DOUBLE)) - 0.5, {n} - 1.0))"
        rows = f"(SELECT d, {pos} AS pos, {n} AS nn FROM dims, range(1000) t(d) WHERE d < {m})"
        return f"{name} AS (SELECT d, CAST(floor(pos) AS INTEGER) AS s, 1 - (pos - floor(pos)) AS k FROM {rows} UNION ALL SELECT d, least(CAST(floor(pos) AS INTEGER) + 1, nn - 1), pos - floor(pos) FROM {rows})"
    if kind == "gaussian":
        return f"{name} AS (SELECT d, CASE WHEN i < nn THEN i ELSE 2 * nn - 1 - i END AS s, k FROM (SELECT d, {n} AS nn, ((d + o) % (2 * {n}) + 2 * {n}) % (2 * {n}) AS i, exp(-0.5 * pow(o / 1.5, 2)) / (SELECT sum(exp(-0.5 * pow(q / 1.5, 2))) FROM range(-6, 7) z(q)) AS k FROM dims, range(1000) t(d), range(-6, 7) u(o) WHERE d < {n}))"
    x = "abs((s + 0.5 - centre) / wide)"
    cubic = f"CASE WHEN {x} < 1 THEN (1.5 * {x} - 2.5) * {x} * {x} + 1 WHEN {x} < 2 THEN ((({x} - 5) * {x} + 8) * {x} - 4) * -0.5 ELSE 0 END"
    return f"{name} AS (SELECT d, s, c / sum(c) OVER (PARTITION BY d) AS k FROM (SELECT d, s, {cubic} AS c FROM (SELECT d, (d + 0.5) * ({n} / CAST({m} AS DOUBLE)) AS centre, greatest({n} / CAST({m} AS DOUBLE), 1.0) AS wide, {n} AS n FROM dims, range(1000) t(d) WHERE d < {m}), range(1000) v(s) WHERE s >= greatest(floor(centre - 2 * wide + 0.5), 0) AND s < least(floor(centre + 2 * wide + 0.5), n)))"


def _apply_sql(kind: str, m_rows: str, m_cols: str) -> str:
    return f"WITH {_GRAY}, {_axis_sql('ar', 'h', m_rows, kind)}, {_axis_sql('ac', 'w', m_cols, kind)} SELECT CAST(ar.d AS INTEGER) AS row, CAST(ac.d AS INTEGER) AS col, round(sum(v * ar.k * ac.k), 5) + 0.0 AS value FROM g JOIN ar ON ar.s = g.row JOIN ac ON ac.s = g.col GROUP BY ar.d, ac.d"


@query(_apply_sql("bilinear", "30", "40"))
def bilinear(spark, d):
    return _rounded(resample.resized(_gray(spark, d), (A.height(spark, d), A.SIDE), (30, 40), "bilinear", eight_bit=False), "value", digits=5)


@query(_apply_sql("bicubic", "9", "40"))
def bicubic(spark, d):
    return _rounded(resample.resized(_gray(spark, d), (A.height(spark, d), A.SIDE), (9, 40), "bicubic", eight_bit=False), "value", digits=5)


@query(_apply_sql("gaussian", "h", "w"))
def gaussian(spark, d):
    return _rounded(resample.gaussian(_gray(spark, d), A.height(spark, d), A.SIDE, 1.5), "value", digits=5)


# training data


def _sizes(spark, d):
    return A.table(spark, d, "nation").select(F.col("n_name").alias("tile_id"), (F.col("n_nationkey") * 40).alias("height"), F.lit(700).alias("width"))


_DRAW = "CAST('0x' || substr(md5(tile_id || '#' || n || '#0#' || {0}), 1, 8) AS BIGINT) / 4294967296.0"


@query(f"""WITH e AS (SELECT n_name AS tile_id, n_nationkey * 40 AS height, 700 AS width, unnest(generate_series(1, 20)) AS n FROM nation WHERE n_nationkey * 40 > 512)
SELECT tile_id || '#' || n AS patch_id, tile_id, CAST(floor({_DRAW.format(1)} * (height - 512)) AS INTEGER) AS y, CAST(floor({_DRAW.format(2)} * (width - 512)) AS INTEGER) AS x FROM e""")
def patch_sample(spark, d):
    return patches.sampled(_sizes(spark, d), 512, 20).select("patch_id", "tile_id", "y", "x")


@query("SELECT n_name AS tile_id, n_nationkey * 40 AS height, 700 AS width FROM nation WHERE n_nationkey * 40 <= 512")
def patches_too_small(spark, d):
    return patches.too_small(_sizes(spark, d))


_BANDS = ", ".join(f"round((l[{k + 1}] * 100 - {m}) / {s}, 6) AS {b}" for k, (b, m, s) in enumerate(zip("rgb", pixels.MEANS, pixels.DEVIATIONS)))


@query(
    f"""WITH {_DIMS}, e AS (SELECT 't' AS tile_id, h, w, unnest(generate_series(1, 50)) AS n FROM dims WHERE h > 8 AND w > 8),
p AS (SELECT tile_id || '#' || n AS patch_id, floor({_DRAW.format(1)} * (h - 8)) AS py, floor({_DRAW.format(2)} * (w - 8)) AS px FROM e),
f AS (SELECT *, CAST('0x' || substr(md5(patch_id || '#0#7'), 1, 1) AS INTEGER) AS bits FROM p),
c AS (SELECT patch_id, l, target, bits // 4 AS turns, CASE WHEN bits // 2 % 2 = 1 THEN 7 - (row - py) ELSE row - py END AS r, CASE WHEN bits % 2 = 1 THEN 7 - (col - px) ELSE col - px END AS c FROM img JOIN f ON row BETWEEN py AND py + 7 AND col BETWEEN px AND px + 7)
SELECT patch_id, CAST(CASE turns WHEN 0 THEN r WHEN 1 THEN 7 - c WHEN 2 THEN 7 - r ELSE c END AS INTEGER) AS pr, CAST(CASE turns WHEN 0 THEN c WHEN 1 THEN r WHEN 2 THEN 7 - c ELSE 7 - r END AS INTEGER) AS pc,
       {_BANDS}, CAST(target AS SMALLINT) AS mask, list_transform(range(4), lambda k: CAST(k = target AS INTEGER)) AS class_mask FROM c"""
)
def patch_augment(spark, d):
    img = A.scores(spark, d).select(F.lit("t").alias("tile_id"), "row", "col", (F.col("logits")[0] * 100).alias("r"), (F.col("logits")[1] * 100).alias("g"), (F.col("logits")[2] * 100).alias("b"), F.element_at(F.array(*[F.lit(v) for v in (0, 63, 127, 191)]), F.col("target") + 1).alias("value"))
    size = spark.createDataFrame([("t", A.height(spark, d), A.SIDE)], "tile_id string, height int, width int")
    p = patches.draws(patches.sampled(size, 8, 50))
    return _rounded(patches.samples(patches.augmented(patches.pixels_of(p, img, 8), 8)), "r", "g", "b")


@query(f"WITH {_DIMS} SELECT count(*) AS n FROM img")
def paired_pixels(spark, d):
    img = A.scores(spark, d).select(F.lit("t").alias("tile_id"), "row", "col", F.col("logits")[0].alias("r"), F.col("target").alias("value"))
    return patches.paired(img.drop("value"), img.drop("r")).agg(F.count("*").alias("n"))


def _parameters(spark, d):
    p = A.table(spark, d, "part")
    part = F.when(F.col("p_partkey") % 10 == 0, "head").when(F.col("p_partkey") % 3 == 0, "decoder").otherwise("encoder")
    return p.select(part.alias("part"), F.col("p_partkey").alias("position"), F.concat(F.when(F.col("p_partkey") % 4 == 0, "criterion.").otherwise("model."), F.col("p_name")).alias("name"), F.col("p_size").cast("long").alias("size"))


@query("WITH p AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'head' WHEN p_partkey % 3 = 0 THEN 'decoder' ELSE 'encoder' END AS part, p_partkey, CAST(p_size AS BIGINT) AS size FROM part), r AS (SELECT *, NOT (part = 'encoder' OR (part = 'decoder' AND row_number() OVER (PARTITION BY part ORDER BY p_partkey) <= 20)) AS t FROM p) SELECT CAST(sum(size) AS BIGINT) AS total, CAST(sum(CASE WHEN NOT t THEN size ELSE 0 END) AS BIGINT) AS frozen, CAST(sum(CASE WHEN t THEN size ELSE 0 END) AS BIGINT) AS trainable FROM r")
def parameter_totals(spark, d):
    return patches.parameter_totals(patches.frozen(_parameters(spark, d), True, 20))


@query("SELECT p_partkey AS position, p_name AS name FROM part WHERE p_partkey % 4 <> 0")
def checkpoint_keys(spark, d):
    return patches.checkpoint_keys(_parameters(spark, d)).select("position", "name")


@query(f"WITH {A.scores_sql()}, t AS (SELECT * FROM (VALUES (0, 0), (5, 3), (9, 17)) v(py, px)) SELECT 't#' || py || '#' || px AS patch_id, CAST(row - py AS INTEGER) AS pr, CAST(col - px AS INTEGER) AS pc, row, col FROM img JOIN t ON row BETWEEN py AND py + 7 AND col BETWEEN px AND px + 7")
def patch_pixels(spark, d):
    corners = spark.createDataFrame([("t", y, x, f"t#{y}#{x}") for y, x in ((0, 0), (5, 3), (9, 17))], "tile_id string, y int, x int, patch_id string")
    img = A.scores(spark, d).select(F.lit("t").alias("tile_id"), "row", "col")
    return patches.pixels_of(corners, img, 8).select("patch_id", "pr", "pc", "row", "col")


@query("SELECT * FROM (VALUES (1, 'herbaceous'), (2, 'hedge'), (3, 'trees')) v(code, name)")
def training_class_list(spark, d):
    return classes.training_classes(spark)


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 19 ELSE 4 END AS outputs FROM part")
def checkpoint_outputs(spark, d):
    path = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, F.lit(".safetensors")).otherwise(F.lit(".pth")))
    return A.table(spark, d, "part").select("p_partkey", classes.outputs_of_checkpoint(path).alias("outputs"))


@query("SELECT doc_id, substr(text, 1, 500) AS preview FROM documents")
def error_preview(spark, d):
    return A.table(spark, d, "documents").select("doc_id", names.preview(F.col("text")).alias("preview"))


@query("SELECT o_orderkey, CASE WHEN s < 1 THEN 'a moment' WHEN s < 60 THEN CASE WHEN s // 1 = 1 THEN 'a second' ELSE s // 1 || ' seconds' END WHEN s < 3600 THEN CASE WHEN s // 60 = 1 THEN 'a minute' ELSE s // 60 || ' minutes' END WHEN s < 86400 THEN CASE WHEN s // 3600 = 1 THEN 'an hour' ELSE s // 3600 || ' hours' END ELSE CASE WHEN s // 86400 = 1 THEN 'a day' ELSE s // 86400 || ' days' END END AS took FROM (SELECT o_orderkey, o_orderkey * 13 AS s FROM orders)")
def humanized_time(spark, d):
    return A.table(spark, d, "orders").select("o_orderkey", names.humanized(F.col("o_orderkey") * 13).alias("took"))


@query(f"WITH {A.scores_sql()}, dims AS (SELECT CAST(max(row) + 1 AS INTEGER) AS h, {A.SIDE} AS w FROM img), e AS (SELECT row, col, list_transform(l, lambda v: exp(v - list_max(l))) AS e FROM img), g AS (SELECT row, col, e[3] / list_sum(e) AS v FROM e), " + "{axes} SELECT CAST(ar.d AS INTEGER) AS row, CAST(ac.d AS INTEGER) AS col, CAST(round(sum(v * ar.k * ac.k), 6) >= 0.25 AS SMALLINT) AS value FROM g JOIN ar ON ar.s = g.row JOIN ac ON ac.s = g.col GROUP BY ar.d, ac.d".format(axes=f"{_axis_sql('ar', 'h', 'h', 'gaussian')}, {_axis_sql('ac', 'w', 'w', 'gaussian')}"))
def binary_smoothed(spark, d):
    p = A.scores(spark, d).select("row", "col", pixels.softmax(F.col("logits"))[2].alias("value"))
    smooth = resample.gaussian(p, A.height(spark, d), A.SIDE, 1.5)
    return smooth.withColumn("value", pixels.thresholded(F.round("value", 6), 0.25))


# the stages together

_LAND = f"{_FUSED}, m2 AS (SELECT tile_id, row + (CASE tile_id WHEN 'A' THEN 0 WHEN 'N' THEN 10 ELSE 20 END) AS grow, col + (CASE tile_id WHEN 'A' THEN 0 WHEN 'N' THEN 5 ELSE 10 END) AS gcol, least(greatest(value, 0), 3) AS v FROM fus), w AS (SELECT grow, gcol, v, row_number() OVER (PARTITION BY grow, gcol ORDER BY count(*) DESC, v) AS k FROM m2 GROUP BY grow, gcol, v) SELECT CAST(grow AS INTEGER) AS grow, CAST(gcol AS INTEGER) AS gcol, CAST(v AS SMALLINT) AS value FROM w WHERE k = 1"


@query(f"WITH {_LAND}")
def land_cover(spark, d):
    from rasterloom.plans import pipeline

    cloud = A.cloud(spark, d)
    ras, box = pipeline.prepared(cloud, A.CELL)
    shift = F.when(F.col("tile_id") == "A", 0).when(F.col("tile_id") == "N", 1).otherwise(2)
    meta = box.select("tile_id", F.col("tile_id").alias("path"), (shift * 5.0).alias("left"), (1000 - shift * 10.0 - F.col("rows")).alias("bottom"), (shift * 5.0 + F.col("cols")).alias("right"), (1000 - shift * 10.0).alias("top"), F.lit(1.0).alias("a"), F.lit(-1.0).alias("e"), F.lit("EPSG:2154").alias("crs"), F.lit("uint8").alias("dtype"), F.lit(1).alias("band_count"))
    return pipeline.land_cover(ras, A.model_map(ras), meta)

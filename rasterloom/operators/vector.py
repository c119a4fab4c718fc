"""Regions of equal class as polygons.

Components in two levels: pixels are labelled within blocks by union-find over row runs, then labels that meet across
a seam are linked, and the links' components join them.

Rings are traced block by block as well: within a block the sides of its pixels join into chains, which end at the
block's border; then chains alone meet in blocks of LARGER times the size, and so on until one block holds all. A ring
that closes leaves at once, and a chain is its corners as packed integers, so no task ever holds a region's pixels.
Only a polygon's own rings meet in one row at the end, as the result demands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import scratch
from rasterloom.operators import graph

BLOCK = 256
#: How many blocks of a level lie side by side in one of the next.
LARGER = 8


def _label_block(eight: bool):
    import numpy as np
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["grow", "gcol"], kind="stable").reset_index(drop=True)
        r, c, v = (pdf[k].to_numpy().astype(np.int64) for k in ("grow", "gcol", "value"))
        n = len(r)
        new = np.ones(n, bool)
        new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1) | (v[1:] != v[:-1])
        run_of = np.cumsum(new) - 1
        parent = list(range(int(run_of[-1]) + 1 if n else 0))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        place = (r << 32) + c
        for step in (-1, 0, 1) if eight else (0,):
            below = ((r + 1) << 32) + c + step
            k = np.minimum(np.searchsorted(place, below), n - 1)
            hit = (place[k] == below) & (v[k] == v)
            for a, b in np.unique(np.stack([run_of[hit], run_of[k[hit]]]), axis=1).T:
                x, y = find(int(a)), find(int(b))
                if x != y:
                    parent[max(x, y)] = min(x, y)
        first = place[np.flatnonzero(new)]
        pdf["label"] = np.array([first[find(x)] for x in range(len(parent))], np.int64)[run_of]
        return pdf[["grow", "gcol", "value", "label"]]

    return run


def components(raster: DataFrame, eight: bool = False, nodata: int | None = None, block: int = BLOCK) -> DataFrame:
    """grow, gcol, value and component_id (the number of its first pixel) of all pixels but nodata."""
    px = raster.select("grow", "gcol", "value")
    if nodata is not None:
        px = px.where(F.col("value") != nodata)
    keyed = px.withColumn("br", F.floor(F.col("grow") / block)).withColumn("bc", F.floor(F.col("gcol") / block))
    kinds = {f.name: f.dataType.simpleString() for f in px.schema.fields}
    local = keyed.groupBy("br", "bc").applyInPandas(_label_block(eight), f"grow {kinds['grow']}, gcol {kinds['gcol']}, value {kinds['value']}, label long")
    local, _ = scratch.written(local, "labels")
    edge = local.where((F.col("grow") % block).isin(0, block - 1) | (F.col("gcol") % block).isin(0, block - 1))
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if eight else [])
    around = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in steps])
    here = edge.select(F.col("value").alias("v"), F.col("label").alias("a"), "grow", "gcol", F.explode(around).alias("s")).select("v", "a", (F.col("grow") + F.col("s.dr")).alias("r"), (F.col("gcol") + F.col("s.dc")).alias("c"))
    links = here.join(edge.select(F.col("grow").alias("r"), F.col("gcol").alias("c"), F.col("value").alias("v"), F.col("label").alias("b")), ["r", "c", "v"]).where("a <> b").select("a", "b").distinct()
    joined = graph.labels(links).select("node", F.col("label").alias("least"))
    return local.join(joined, F.col("label") == F.col("node"), "left").select("grow", "gcol", "value", F.coalesce("least", "label").alias("component_id"))


def regions(pixels: DataFrame) -> DataFrame:
    """component_id, class, n_pixels and bounds (in pixels, ends exclusive) of each component."""
    return pixels.groupBy("component_id").agg(
        F.min("value").alias("class"), F.count("*").alias("n_pixels"), F.min("grow").alias("row0"), (F.max("grow") + 1).alias("row1"), F.min("gcol").alias("col0"), (F.max("gcol") + 1).alias("col1")
    )


# sides of a pixel: the neighbour's place, and the side's ends, from first to second with the inside to the right
_SIDES = ((-1, 0, 0, 0, 0, 1), (0, 1, 0, 1, 1, 1), (1, 0, 1, 1, 1, 0), (0, -1, 1, 0, 0, 0))
_CHAIN = "component_id long, class int, points binary, closed boolean"


def _seams(pixels: DataFrame, block: int) -> DataFrame:
    """Sides between blocks that border on another component: component_id, class, grow, gcol and k, the side's number."""
    edge = pixels.where((F.col("grow") % block).isin(0, block - 1) | (F.col("gcol") % block).isin(0, block - 1))
    sides = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s[0]).alias("dr"), F.lit(s[1]).alias("dc")) for k, s in enumerate(_SIDES)])
    each = edge.select("component_id", "value", "grow", "gcol", F.explode(sides).alias("s")).select("component_id", "value", "grow", "gcol", "s.k", (F.col("grow") + F.col("s.dr")).alias("nr"), (F.col("gcol") + F.col("s.dc")).alias("nc"))
    out = (F.floor(F.col("nr") / block) != F.floor(F.col("grow") / block)) | (F.floor(F.col("nc") / block) != F.floor(F.col("gcol") / block))
    other = edge.select(F.col("grow").alias("nr"), F.col("gcol").alias("nc"), F.col("component_id").alias("n_id"))
    return each.where(out).join(other, ["nr", "nc"], "left").where(~F.col("component_id").eqNullSafe(F.col("n_id"))).select("component_id", F.col("value").cast("int").alias("class"), "grow", "gcol", "k")


def _block_sides(px, seams):
    """component, class and ends (rows of r0, c0, r1, c1) of a block's sides. Sides to other blocks come from seams."""
    import numpy as np

    r, c, v, own = (px[k].to_numpy().astype(np.int64) for k in ("grow", "gcol", "value", "component_id"))
    parts = [(seams["component_id"].to_numpy(np.int64), seams["class"].to_numpy(np.int64), seams["grow"].to_numpy(np.int64), seams["gcol"].to_numpy(np.int64), seams["k"].to_numpy(np.int64))]
    if len(r):
        low_r, low_c = r.min(), c.min()
        # one place around, so that each neighbour is in the array; no component is -1
        of = np.full((int(r.max() - low_r) + 3, int(c.max() - low_c) + 3), -1, np.int64)
        of[r - low_r + 1, c - low_c + 1] = own
        br, bc, size = px["br"].iloc[0], px["bc"].iloc[0], int(px["size"].iloc[0])
        for k, (dr, dc, *_) in enumerate(_SIDES):
            inside = ((r + dr) // size == br) & ((c + dc) // size == bc)
            differs = inside & (of[r - low_r + 1 + dr, c - low_c + 1 + dc] != own)
            parts.append((own[differs], v[differs], r[differs], c[differs], np.full(int(differs.sum()), k)))
    own, v, r, c, k = (np.concatenate(x) for x in zip(*parts))
    ends = np.array([s[2:] for s in _SIDES])[k] + np.stack([r, c, r, c], axis=1) if len(k) else np.zeros((0, 4), np.int64)
    return own, v, ends


def _straight(points):
    """The points of a chain without those between two equal directions; its ends stay."""
    import numpy as np

    if len(points) < 3:
        return points
    step = np.sign(np.diff(points, axis=0))
    return points[np.concatenate([[True], (step[1:] != step[:-1]).any(axis=1), [True]])]


def _linked(own, cls, chains, inside):
    """Chains (arrays of points) of components, joined where the point between is inside(r, c): rows of component,
    class, points, closed. Where two cells of a component meet at a corner only, a chain turns right, so rings do not
    cross."""
    import numpy as np

    begins: dict = {}
    for i, p in enumerate(chains):
        begins.setdefault((int(own[i]), int(p[0][0]), int(p[0][1])), []).append(i)
    heading = [(int(np.sign(p[1][0] - p[0][0])), int(np.sign(p[1][1] - p[0][1]))) for p in chains]
    coming = [(int(np.sign(p[-1][0] - p[-2][0])), int(np.sign(p[-1][1] - p[-2][1]))) for p in chains]

    def following(i: int) -> int:
        r, c = int(chains[i][-1][0]), int(chains[i][-1][1])
        if not inside(r, c):
            return -1
        options = begins[int(own[i]), r, c]
        if len(options) == 1:
            return options[0]
        right = (coming[i][1], -coming[i][0])
        return next(j for j in options if heading[j] == right)

    after = [following(i) for i in range(len(chains))]
    before = set(after)
    done = [False] * len(chains)
    rows = []

    def walk(first: int, closed: bool) -> None:
        parts, i = [], first
        while i >= 0 and not done[i]:
            done[i] = True
            parts.append(chains[i] if not parts else chains[i][1:])
            i = after[i]
        rows.append((int(own[first]), int(cls[first]), _straight(np.concatenate(parts)).astype("<i8").tobytes(), closed))

    for i in range(len(chains)):
        if i not in before:
            walk(i, False)
    for i in range(len(chains)):
        if not done[i]:
            walk(i, True)
    return rows


def _interior(br: int, bc: int, size: int):
    """Whether a corner lies within a block, so that all four pixels around it are the block's."""
    return lambda r, c: br * size < r < (br + 1) * size and bc * size < c < (bc + 1) * size


def _first_chains(key, px, seams):
    import pandas as pd

    own, cls, ends = _block_sides(px, seams)
    rows = _linked(own, cls, ends.reshape(-1, 2, 2), _interior(int(key[0]), int(key[1]), int(key[2])))
    return pd.DataFrame(rows, columns=["component_id", "class", "points", "closed"])


def _more_chains(last: bool):
    import numpy as np
    import pandas as pd

    def run(key, pdf):
        chains = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in pdf["points"]]
        inside = (lambda r, c: True) if last else _interior(int(key[0]), int(key[1]), int(key[2]))
        return pd.DataFrame(_linked(pdf["component_id"].to_numpy(), pdf["class"].to_numpy(), chains, inside), columns=["component_id", "class", "points", "closed"])

    return run


def rings(pixels: DataFrame, block: int = BLOCK, larger: int | None = None) -> DataFrame:
    """component_id, class and points (packed rows and columns, the first repeated at the end) of each closed ring."""
    px, _ = scratch.written(pixels.select("component_id", "value", "grow", "gcol"), "pixels")  # read four times
    at = lambda c, size: F.floor(F.col(c) / size).cast("long")
    keyed = px.withColumns({"br": at("grow", block), "bc": at("gcol", block), "size": F.lit(block)})
    seams, _ = scratch.written(_seams(px, block).withColumns({"br": at("grow", block), "bc": at("gcol", block), "size": F.lit(block)}), "seams")
    chains = keyed.groupBy("br", "bc", "size").cogroup(seams.groupBy("br", "bc", "size")).applyInPandas(_first_chains, _CHAIN)
    chains, _ = scratch.written(chains, "chains")
    box = px.agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("grow", "gcol")]).first()
    closed = chains.where("closed")
    open_, size = chains.where("NOT closed"), block
    while box.min_grow is not None:
        size *= larger or LARGER
        last = box.min_grow // size == box.max_grow // size and box.min_gcol // size == box.max_gcol // size
        # a chain lies in one block of the level before, and its first side tells which
        placed = open_.mapInPandas(_placed(size), "br long, bc long, size long, " + _CHAIN)
        joined = placed.groupBy("br", "bc", "size").applyInPandas(_more_chains(last), _CHAIN)
        joined, _ = scratch.written(joined, "chains")
        closed, open_ = closed.unionByName(joined.where("closed")), joined.where("NOT closed")
        if last:
            break
    return closed.drop("closed")


def _placed(size: int):
    """Chains with the block of the level that holds them: that of the pixel to the right of the first side."""
    import numpy as np

    def run(frames):
        for f in frames:
            heads = np.array([np.frombuffer(x, "<i8", 4) for x in f["points"]]).reshape(-1, 4)
            step = np.sign(heads[:, 2:] - heads[:, :2])
            # of a side from a to b with the inside to the right, the inside's pixel begins at a but for those that go left or up
            r = heads[:, 0] - (step[:, 1] < 0) - (step[:, 0] < 0)
            c = heads[:, 1] - (step[:, 0] > 0) - (step[:, 1] < 0)
            yield f.assign(br=r // size, bc=c // size, size=size)[["br", "bc", "size", "component_id", "class", "points", "closed"]]

    return run


def _unpacked(frames):
    import numpy as np
    import pandas as pd

    for f in frames:
        rows = []
        for own, cls, data in zip(f["component_id"], f["class"], f["points"]):
            p = np.frombuffer(data, "<i8").reshape(-1, 2)[:-1]
            k = int(np.lexsort((p[:, 1], p[:, 0]))[0])  # the first corner is always a turn
            p = _straight(np.concatenate([p[k:], p[: k + 1]]))
            rows.append((own, cls, [{"r": float(r), "c": float(c)} for r, c in p]))
        yield pd.DataFrame(rows, columns=["component_id", "class", "ring"])


def polygons(pixels: DataFrame, block: int = BLOCK) -> DataFrame:
    """component_id, class and rings (closed arrays of corners; the outer one holds the first corner) of each component."""
    each = rings(pixels, block).mapInPandas(_unpacked, "component_id long, class int, ring array<struct<r: double, c: double>>")
    return each.groupBy("component_id").agg(F.min("class").alias("class"), F.array_sort(F.collect_list("ring")).alias("rings"))


def to_map(rings: Column, x0: float, y1: float, a: float, e: float) -> Column:
    """Rings of corners as rings of map coordinates."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct((F.lit(x0) + p["c"] * F.lit(a)).alias("x"), (F.lit(y1) + p["r"] * F.lit(e)).alias("y"))))


def area(ring: Column) -> Column:
    """The signed area of a closed ring of (x, y)."""
    n = F.size(ring)
    return F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), lambda s, i: s + ring[i]["x"] * ring[i + 1]["y"] - ring[i + 1]["x"] * ring[i]["y"]) / 2


def chaikin(ring: Column, iterations: int = 3) -> Column:
    """Corner cutting of a closed ring: each side gives its points at a quarter and three quarters."""
    point = lambda p, q, t: F.struct((p["x"] * (1 - t) + q["x"] * t).alias("x"), (p["y"] * (1 - t) + q["y"] * t).alias("y"))


    def once(r: Column) -> Column:
        cut = F.flatten(F.transform(F.sequence(F.lit(0), F.size(r) - 2), lambda i: F.array(point(r[i], r[i + 1], 0.25), point(r[i], r[i + 1], 0.75))))
        return F.concat(cut, F.slice(cut, 1, 1))

    for _ in range(iterations):
        ring = once(ring)
    return ring


def smoothed(df: DataFrame, ring: str = "ring", iterations: int = 3, preserve_area: bool = True) -> DataFrame:
    """The rings smoothed by corner cutting; preserve_area: scaled about the mean of their points to the area they had."""
    out = df.withColumn("_was", area(F.col(ring)))
    for _ in range(iterations):
        out = out.withColumn(ring, chaikin(F.col(ring), 1))
    if not preserve_area:
        return out.drop("_was")
    n = (F.size(ring) - 1).cast("double")
    mean = lambda k: F.aggregate(F.slice(F.col(ring), 1, F.size(ring) - 1), F.lit(0.0), lambda s, p: s + p[k]) / n
    out = out.withColumn("_x", mean("x")).withColumn("_y", mean("y")).withColumn("_now", area(F.col(ring)))
    scale = F.when(F.col("_now") != 0, F.sqrt(F.abs(F.col("_was") / F.col("_now")))).otherwise(1.0)
    out = out.withColumn("_s", scale)
    moved = F.transform(ring, lambda p: F.struct((F.col("_x") + (p["x"] - F.col("_x")) * F.col("_s")).alias("x"), (F.col("_y") + (p["y"] - F.col("_y")) * F.col("_s")).alias("y")))
    return out.withColumn(ring, moved).drop("_was", "_x", "_y", "_now", "_s")


def wkt(rings: Column) -> Column:
    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, lambda ring: F.concat(F.lit("("), F.array_join(F.transform(ring, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))), ", "), F.lit(")"))), ", "), F.lit(")"))


def geojson(polys: DataFrame, rings: str = "rings", field: str = "class") -> DataFrame:
    """A GeoJSON feature a row, in column value."""
    coordinates = F.transform(F.col(rings), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    return polys.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("class").alias(field)).alias("properties"), F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"))).alias("value"))

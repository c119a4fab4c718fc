"""Connected components of a link table by alternating star contractions, and a join in which one key may hold a large
share of the rows; no group of unbounded size is ever gathered in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import scratch

#: Links, about 1 MB, that one task labels faster than many steps over the cluster.
TOGETHER = 50_000
#: A key with more rows than this, and more than one in HUBS of all rows, is a hub; so there are fewer than HUBS hubs.
HUB_ROWS, HUBS = 1000, 50_000


def joined(big: DataFrame, key: str, small: DataFrame, name: str, times: str, total: int, how: str = "inner", limit: int | None = None) -> DataFrame:
    """big with the columns of small where big's key equals small's name.

    small has one row a key, with the number of big's rows of that key in `times`; total: at least the rows of big. The
    rows of hubs stay where they are and meet a broadcast of fewer than HUBS rows; the others are shuffled by key. how:
    inner or left (rows with a null key stay where they are, too). limit: rows from which on a key is a hub, where
    small's rows are wide.
    """
    limit = limit or max(HUB_ROWS, total // HUBS)
    hubs = small.where(F.col(times) > limit)
    at_hubs = big.join(F.broadcast(hubs), F.col(key) == F.col(name))
    elsewhere = big.join(F.broadcast(hubs.select(F.col(name).alias("hub"))), F.col(key) == F.col("hub"), "left_anti")
    met = elsewhere.where(F.col(key).isNotNull()).join(small.where(F.col(times) <= limit), F.col(key) == F.col(name), how)
    out = at_hubs.unionByName(met)
    if how == "left":
        out = out.unionByName(big.where(F.col(key).isNull()), allowMissingColumns=True)
    return out


def met(big: DataFrame, key: str, small: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """big with the columns of small (a row a key, of narrow rows) where big's key equals small's name.

    small is written first, so that both sides of the join come straight from their shuffles: adaptive execution then
    splits a partition with a key that many rows of big share, or broadcasts small where it turns out to be small.
    """
    written, _ = scratch.written(small, "met")
    return big.join(written, F.col(key) == F.col(name), how)


def _contract_up(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hub = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("of"), F.least("a", "least").alias("least"))
    return met(both.where("b > a"), "a", hub, "of").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _contract_down(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of these; in links a > b."""
    hub, _ = scratch.written(links.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "of"), "least")
    moved = links.join(hub, F.col("a") == F.col("of")).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(hub.select(F.col("of").alias("a"), F.col("least").alias("b"))).distinct()


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and label of a few links, by union-find."""
    parent: dict[int, int] = {}

    def least(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = least(a), least(b)
            parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([least(x) for x in nodes], pa.int64())], ["node", "label"])


def labels(links: DataFrame, rounds: int = 60, together: int = TOGETHER) -> DataFrame:
    """node and label (the least node reached) of all nodes in links (a, b); nodes without links are absent. Up to
    `together` links are worked out in one task; the result is the same."""
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, path = scratch.written(now, "links")
    last = None
    for _ in range(rounds):
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if last is None and state[0] <= together:
            return now.coalesce(1).mapInArrow(_joined_up, "node long, label long")
        if state == last or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        last, old = state, path
        with scratch.swept(links.sparkSession) as keep:
            up, _ = scratch.written(_contract_up(now), "up")
            now, path = scratch.written(_contract_down(up), "links")
            keep(path)
        scratch.delete(links.sparkSession, old)
    raise RuntimeError("the components did not settle")

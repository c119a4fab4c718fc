"""Benchmark decontamination with suffix arrays of the training shards.

A shard is a block of documents. Its words become numbers of the benchmark's vocabulary (0: not in it). Only
suffixes that begin with as many vocabulary words as the shortest window needs can hold a match, so the shard's
suffix array is built over those alone, by prefix doubling. Every benchmark suffix is searched in it word by word,
all of them at once: each step narrows its range of the suffix array by binary search. The last depth with a
range that isn't empty is the longest verbatim match, and the range holds its locations. For contamination the search
ends at the longest window, as every occurrence of a window begins at a suffix; `longest_matches` goes on to the end.

The scan is map-only. What each task and the driver get of the benchmark is bounded: beyond BENCHMARK_BYTES it is taken
in groups of items, one after the other, whose hit words are merged by document (`clean` drops rows scan by scan).

Defined results: a null or empty text has no words and no hits; items without words are ignored; several items with one
item_id count as one; repeated document rows give a row each (where the benchmark needs several groups, rows that
repeat both doc_id and text are merged and given back as often as they came); a null item_id is named `null`; texts
are searched whole, however long; other columns of the inputs are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import scratch
from rasterloom.llm import textblocks as tb
from rasterloom.operators.graph import joined

WINDOW = 10
#: Text of the benchmark that one task may hold.
BENCHMARK_BYTES = 8 << 20


class Suffixes:
    """The benchmark's words as numbers, and its distinct windows."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int = WINDOW):
        per_item = tb.words_of(texts, tb.PUNCTUATION)
        keep = [i for i, w in enumerate(per_item) if len(w)]
        self.ids = [ids[i] for i in keep]
        per_item = [per_item[i] for i in keep]
        flat = np.concatenate([np.zeros(0, np.uint64), *per_item])
        self.vocabulary, numbers = np.unique(flat, return_inverse=True)
        lengths = np.array([len(w) for w in per_item], np.int64)
        ends = np.cumsum(lengths)
        self.item = np.repeat(np.arange(len(per_item)), lengths)  # of each suffix
        self.start = np.arange(len(flat))
        self.offset = self.start - np.repeat(ends - lengths, lengths)
        self.left = np.repeat(ends, lengths) - self.start  # words from here to the item's end
        self.stream = np.append(numbers + 1, 0).astype(np.int64)
        need = np.minimum(window, lengths)[self.item] if len(flat) else self.left
        whole = self.left >= need
        #: Words of the window that begins at a suffix; 0 if none does.
        self.window = np.where(whole, need, 0)
        self.shortest = int(need.min()) if len(flat) else 0
        self.widest = int(need.max()) if len(flat) else 0
        self.longest = int(lengths.max()) if len(flat) else 0
        classes: dict[bytes, int] = {}
        self.of_class: list[list[int]] = []
        self.window_class = np.full(len(flat), -1)
        for j in np.flatnonzero(whole):
            key = self.stream[j : j + need[j]].tobytes()
            c = classes.setdefault(key, len(classes))
            if c == len(self.of_class):
                self.of_class.append([])
            if not self.of_class[c] or self.of_class[c][-1] != self.item[j]:
                self.of_class[c].append(int(self.item[j]))
            self.window_class[j] = c


class Shard:
    """The suffix array of a block of documents over the places where a benchmark suffix can match."""

    def __init__(self, block: tb.Block, test: Suffixes, depth: int):
        """depth: words by which the suffixes are told apart, the longest match that is searched."""
        _, _, hashes, self.at = tb.words(block, tb.PUNCTUATION)
        n = len(hashes)
        v = test.vocabulary
        k = np.minimum(np.searchsorted(v, hashes), max(0, len(v) - 1))
        number = np.where(v[k] == hashes, k + 1, 0) if len(v) and n else np.zeros(n, np.int64)
        # runs of vocabulary words within a document
        known = number > 0
        head = np.zeros(n + 1, bool)
        head[self.at] = True
        previous = np.append(False, known[:-1]) if n else known
        starts = np.flatnonzero(known & (~previous | head[:n]))
        following = np.append(known[1:], False) if n else known
        ends = np.flatnonzero(known & (~following | head[1:])) + 1
        long = ends - starts >= max(1, test.shortest)
        starts, ends = starts[long], ends[long]
        size = ends - starts + 1  # with a 0 after each run
        base = np.cumsum(size) - size
        total = int(size.sum())
        inner = np.arange(total) - np.repeat(base, size)
        self.place = np.repeat(starts, size) + inner  # word of the block
        self.stream = np.zeros(total + 1, np.int64)
        body = inner < np.repeat(ends - starts, size)
        self.stream[:total][body] = number[self.place[body]]
        self.array = self._sorted(depth)
        self.depth = depth

    def _sorted(self, depth: int) -> np.ndarray:
        s = self.stream
        if len(s) <= 1:
            return np.zeros(0, np.int64)
        rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
        k = 1
        while k < depth:
            shifted = np.zeros_like(rank)
            shifted[:-k or None] = rank[k:] if k < len(rank) else 0
            found, rank = np.unique(rank * (int(rank.max()) + 1) + shifted, return_inverse=True)
            if len(found) == len(rank):
                break
            k *= 2
        order = np.argsort(rank, kind="stable")
        return order[s[order] > 0]

    def search(self, test: Suffixes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth: the benchmark suffixes that still match, and their ranges of the suffix array."""
        array, stream = self.array, self.stream
        active = test.start
        low = np.zeros(len(active), np.int64)
        high = np.full(len(active), len(array))
        depth = 0
        while len(active) and depth < self.depth:
            on = test.left[active] > depth
            active, low, high = active[on], low[on], high[on]
            want = test.stream[active + depth]
            ends = []
            for strict in (False, True):  # first place with a word not below it, and with a word above it
                lo, hi = low.copy(), high.copy()
                while (lo < hi).any():
                    mid = (lo + hi) >> 1
                    inside = lo < hi
                    got = stream[np.minimum(array[np.minimum(mid, len(array) - 1)] + depth, len(stream) - 1)]
                    below = inside & ((got <= want) if strict else (got < want))
                    lo = np.where(below, mid + 1, lo)
                    hi = np.where(inside & ~below, mid, hi)
                ends.append(lo)
            low, high = ends
            on = low < high
            active, low, high = active[on], low[on], high[on]
            depth += 1
            if len(active):
                yield depth, active, low, high


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    n = high - low
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n), of


def _hits(block: tb.Block, test: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[set[int]]]:
    """Of each document: words, hit words; for each word if it is hit; items found."""
    shard = Shard(block, test, test.widest)
    n = int(shard.at[-1])
    change = np.zeros(n + 1, np.int64)
    found: list[set[int]] = [set() for _ in range(len(block))]
    seen: set[int] = set()
    for depth, active, low, high in shard.search(test):
        done = test.window[active] == depth
        fresh = [k for k in np.flatnonzero(done) if (c := int(test.window_class[active[k]])) not in seen and not seen.add(c)]
        if not fresh:
            continue
        places, of = _expand(low[fresh], high[fresh])
        where = shard.place[shard.array[places]]
        np.add.at(change, where, 1)
        np.add.at(change, where + depth, -1)
        docs = np.searchsorted(shard.at, where, "right") - 1
        classes = test.window_class[active[fresh]][of]
        for d, c in np.unique(np.stack([docs, classes]), axis=1).T:
            found[d].update(test.of_class[c])
    hit = np.cumsum(change[:n]) > 0
    counts = np.concatenate([[0], np.cumsum(hit)])
    return np.diff(shard.at), counts[shard.at[1:]] - counts[shard.at[:-1]], hit, found


def _groups(benchmark: DataFrame, most: int) -> tuple[int, Iterator[Suffixes]]:
    """The benchmark in groups of at most about `most` bytes: their number, and each when it is asked for."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), F.coalesce("text", F.lit("")).alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-size // most))

    def each() -> Iterator[Suffixes]:
        for k in range(n):
            part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
            got = part.collect()
            yield Suffixes([r.i for r in got], [r.t.encode() for r in got])

    return n, each()


SCHEMA = "doc_id {kind}, n_words long, n_hit long, item_ids array<string>"


def contamination(docs: DataFrame, benchmark: DataFrame, most: int = BENCHMARK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any occurrence of a window), item_ids (sorted)."""
    scratch.bounded(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    sc = docs.sparkSession.sparkContext
    n, groups = _groups(benchmark, most)
    if n == 1:
        shared = sc.broadcast(next(groups))
        return texts.mapInArrow(lambda batches: _scan(batches, shared.value), SCHEMA.format(kind=kind))
    # several groups: the hit words are merged by document
    keyed = texts.withColumn("k", F.xxhash64("doc_id", "text"))
    parts = None
    for g in groups:
        shared = sc.broadcast(g)
        part, _ = scratch.written(keyed.mapInArrow(lambda batches, s=shared: _scan_bits(batches, s.value), f"doc_id {kind}, k long, n_words long, bits binary, item_ids array<string>"), "hits")
        shared.destroy()
        part = part.dropDuplicates(["doc_id", "k"])  # equal rows have equal hits
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("doc_id", "k").applyInArrow(_merge_bits, f"doc_id {kind}, k long, n_words long, n_hit long, item_ids array<string>")
    counted = keyed.groupBy("doc_id", "k").agg(F.count("*").alias("times")).withColumnsRenamed({"doc_id": "d", "k": "kk"})
    known, _ = scratch.written(merged.withColumnRenamed("doc_id", "id").join(counted, F.col("id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("kk"))).drop("k", "id"), "merged")
    n_rows = known.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    out = joined(keyed.select("doc_id", "k"), "k", known, "kk", "times", n_rows).where(F.col("doc_id").eqNullSafe(F.col("d")))
    return out.select("doc_id", "n_words", "n_hit", "item_ids")


def _scan(batches: Iterator[pa.RecordBatch], test: Suffixes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(iter([batch])):
            n_words, n_hit, _, found = _hits(block, test)
            items = [sorted({test.ids[i] for i in f}) for f in found]
            ids = batch.schema.field("doc_id").type
            yield pa.RecordBatch.from_arrays([pa.array(block.columns["doc_id"], ids), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "n_hit", "item_ids"])


def _scan_bits(batches: Iterator[pa.RecordBatch], test: Suffixes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(iter([batch])):
            n_words, _, hit, found = _hits(block, test)
            at = np.concatenate([[0], np.cumsum(n_words)])
            bits = [np.packbits(hit[at[i] : at[i + 1]]).tobytes() for i in range(len(block))]
            items = [sorted({test.ids[i] for i in f}) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.columns["doc_id"], batch.schema.field("doc_id").type), pa.array(block.columns["k"], pa.int64()), pa.array(n_words, pa.int64()), pa.array(bits, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "k", "n_words", "bits", "item_ids"],
            )


def _merge_bits(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    bits = np.bitwise_or.reduce([np.frombuffer(r["bits"], np.uint8) for r in rows])
    items = sorted({i for r in rows for i in r["item_ids"]})
    return pa.table(
        [pa.array([rows[0]["doc_id"]], table.schema.field("doc_id").type), pa.array([rows[0]["k"]], pa.int64()), pa.array([rows[0]["n_words"]], pa.int64()), pa.array([int(np.unpackbits(bits).sum())], pa.int64()), pa.array([items], pa.list_(pa.string()))],
        ["doc_id", "k", "n_words", "n_hit", "item_ids"],
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = 5, most: int = BENCHMARK_BYTES) -> DataFrame:
    """The longest verbatim match of every benchmark suffix over all shards, from `least` words on.

    Returns item_id, word_offset, length, doc_id, position (of the first such match by doc_id), and n_places (its
    occurrences over all shards that reach that length).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    sc = docs.sparkSession.sparkContext
    parts = None
    for g in _groups(benchmark, most)[1]:
        shared = sc.broadcast(g)
        found = docs.select("doc_id", "text").mapInArrow(lambda batches, s=shared: _longest(batches, s.value, least), f"item_id string, word_offset long, length long, doc_id {kind}, position long, n_places long")
        part, _ = scratch.written(found, "matches")
        shared.destroy()
        parts = part if parts is None else parts.unionByName(part)
    best = parts.groupBy("item_id", "word_offset", "length").agg(F.sum("n_places").alias("n_places"), F.min(F.struct("doc_id", "position")).alias("first"))
    top = best.groupBy("item_id", "word_offset").agg(F.max_by(F.struct("length", "n_places", "first"), "length").alias("m"))
    return top.select("item_id", "word_offset", "m.length", F.col("m.first.doc_id").alias("doc_id"), F.col("m.first.position").alias("position"), "m.n_places")


def _longest(batches: Iterator[pa.RecordBatch], test: Suffixes, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(iter([batch])):
            shard = Shard(block, test, test.longest)
            length = np.zeros(len(test.start), np.int64)
            low, high = length.copy(), length.copy()
            for depth, active, lo, hi in shard.search(test):
                length[active], low[active], high[active] = depth, lo, hi
            js = np.flatnonzero(length >= max(least, test.shortest or 1))
            rows = []
            for j in js:
                where = shard.place[shard.array[low[j] : high[j]]]
                w = int(where.min())
                d = int(np.searchsorted(shard.at, w, "right")) - 1
                rows.append((test.ids[test.item[j]], int(test.offset[j]), int(length[j]), block.columns["doc_id"][d], w - int(shard.at[d]), len(where)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), batch.schema.field("doc_id").type, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["item_id", "word_offset", "length", "doc_id", "position", "n_places"])


def sha256_of(items) -> F.Column:
    """Lowercase hex of the sorted item ids, comma-joined."""
    return F.sha2(F.concat_ws(",", items).cast("binary"), 256)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def op2_suffix_decontam(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of `contamination` over the whole documents and benchmark tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), sha256_of(F.col("item_ids")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def clean(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without any benchmark window, with all their columns; map-only, and each row is
    judged by its own text. A further group of the benchmark scans what the one before kept, from a table, so that a
    task holds one group."""
    scratch.bounded(docs.sparkSession)
    path = None
    for k, group in enumerate(_groups(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), BENCHMARK_BYTES)[1]):
        if k:
            before = path
            docs, path = scratch.written(docs, "clean")
            if before:
                scratch.delete(spark, before)
        shared = spark.sparkContext.broadcast(group)
        docs = docs.mapInArrow(lambda batches, s=shared: _kept(batches, s.value), docs.schema)
    return docs


def _kept(batches: Iterator[pa.RecordBatch], test: Suffixes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flags = [_hits(block, test)[1] == 0 for block in tb.blocks(iter([batch.select(["text"])]))]
        if flags:
            yield batch.filter(pa.array(np.concatenate(flags)))


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.s, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h USING (r) LEFT JOIN items t USING (r)
"""

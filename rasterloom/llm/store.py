"""A content-addressed store of token ids.

Each document's ids (with the end id) are cut into chunks where a rolling hash of the last WINDOW ids has its low
bits clear, so equal passages give equal chunks wherever they stand. A chunk's address is the SHA-256 of its bytes.
The store has four Parquet tables:

* `objects/kind=chunk`: every distinct chunk once: digest, width (bytes an id), n, data, the key of the first document
  that has it (its owner) and how many have it;
* `recipes`: for each document its digests in order, key (a hash of doc_id and root), doc_id, n_tokens, start, and the
  Merkle root of its digests;
* `segments`: for each range of documents in doc_id order: first and last id, tokens, Merkle root of its documents;
* `manifest`: the Merkle root over the segments, with counts and parameters.

Writing: one pass encodes and cuts; what it makes is shuffled once, by digest, and each chunk written once. Document
order and `start` come from a range partitioning of the recipes by doc_id, segments of about SEGMENT_DOCS documents,
and one small sum for each.

Reading counts each segment again from the recipes (documents, tokens, first and last id, order, starts, Merkle
root) and compares it with `segments`, and these with `manifest`; then it brings each document's recipe and chunks
together, and checks every chunk's SHA-256 and each recipe's root. A chunk goes straight to its owner; the few chunks
that very many documents share are broadcast to the others, the rest is joined.
A document without ids but the end id has one chunk. Chunks hold LEAST to MOST ids (the last may be shorter).

Encoding: words between ASCII spaces never share a token, so a block's distinct words are encoded once by the
tokenizers library and looked up by a hash; their bytes are compared, too, and where two words have one hash the
block's texts are encoded whole. Tests hold this against encoding whole texts.

Defined results: a null text counts as empty; a null doc_id comes before all others; rows that repeat a doc_id
follow one another, ordered by their ids; texts are whole, a block holds one at least; an empty table gives an empty
store; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm import scratch
from rasterloom.llm import textblocks as tb
from rasterloom.operators.graph import joined

END_ID = 2
WINDOW = 8
#: A cut falls on one id in 2 ** BITS on average.
BITS = 8
LEAST, MOST = 32, 2048
#: Distinct words whose ids a worker keeps.
KEPT_WORDS = 1_000_000
#: Words encoded as one text, texts encoded at once, and the character between words.
TOGETHER, TEXTS, _BETWEEN = 500, 32, "\x01"
BLOCK = 2 << 20
#: A document of at most this many ids is one chunk.
WHOLE = 64
SEGMENT_DOCS = 20_000
#: A chunk that more than one in SHARERS of all uses fall on, and this many, is broadcast; there are fewer than SHARERS.
SHARERS, SHARED_BY = 1000, 1000

_MULTIPLIERS = tb.mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)
_workers: dict = {}


class Encoder:
    """The ids of all words of a block, by the tokenizers library, with a bounded memory of words seen.

    Words are encoded many at a time, with a control character of its own id between them; where the ids do not show
    as many of these as expected, each word is encoded alone. A tokenizer that lower-cases may be given words whose
    A-Z are folded, except in a block that could hold the text of a special token.
    """

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        with open(path) as f:
            self.lowers = '"Lowercase"' in json.dumps(json.load(f).get("normalizer"))
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.count, self.spelt, self.size, self.blocks = (np.zeros(0, np.int32) for _ in range(5))
        self.flat = np.zeros(0, np.uint32)
        self.letters = np.zeros(0, np.uint8)

    def _tidied(self) -> None:
        """Keeps the words that several blocks had, at most half of what may be kept."""
        often = np.flatnonzero(self.blocks > 1)
        if len(often) > KEPT_WORDS // 2:
            often = np.sort(often[np.argsort(-self.blocks[often], kind="stable")[: KEPT_WORDS // 2]])
        n, size = self.count[often], self.size[often]
        flat = self.flat[np.repeat(self.begin[often], n) + _inner(n)]
        letters = self.letters[np.repeat(self.spelt[often], size) + _inner(size)]
        self.keys, self.blocks, self.count, self.size, self.flat, self.letters = self.keys[often], np.ones(len(often), np.int32), n, size, flat, letters
        self.begin, self.spelt = ((np.cumsum(x) - x).astype(np.int32) for x in (n, size))

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has. The library's own results are large, so a part is encoded at once."""
        flat, count = [], []
        for k in range(0, len(words), TOGETHER * TEXTS):
            some = words[k : k + TOGETHER * TEXTS]
            texts = [f" {_BETWEEN} ".join(some[j : j + TOGETHER]) for j in range(0, len(some), TOGETHER)]
            for j, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                part = some[j * TOGETHER : (j + 1) * TOGETHER]
                ids = np.array(e.ids, np.uint32)
                marks = np.flatnonzero(ids == self.between) if self.between is not None else []
                if len(marks) == len(part) - 1:
                    n = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
                    ids = np.delete(ids, marks)
                else:
                    alone = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                    n = np.array([len(x) for x in alone], np.int64)
                    ids = np.array([i for x in alone for i in x], np.uint32)
                flat.append(ids)
                count.append(n)
        return np.concatenate(flat), np.concatenate(count).astype(np.int64)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """keys: sorted, none of them known."""
        ids, n = self._ids([w.decode() for w in words])
        size = np.array([len(w) for w in words], np.int64)
        new = {"begin": len(self.flat) + np.cumsum(n) - n, "count": n, "spelt": len(self.letters) + np.cumsum(size) - size, "size": size, "blocks": np.zeros(len(n))}
        self.flat = np.concatenate([self.flat, ids])
        self.letters = np.concatenate([self.letters, np.frombuffer(b"".join(words), np.uint8)])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        for name, values in new.items():
            setattr(self, name, np.insert(getattr(self, name), at, values.astype(np.int32)))

    def encode(self, block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block's documents, an end id after each, and where each document begins (n + 1)."""
        return self._by_words(block) or self._by_texts(block)

    def _by_texts(self, block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
        """Each text as a whole: for blocks in which two words have the same hash."""
        each = [np.array([*self.tokenizer.encode(block.bytes_of(i).decode(), add_special_tokens=False).ids, END_ID], np.uint32) for i in range(len(block))]
        return np.concatenate(each), np.cumsum([0, *map(len, each)])

    def _by_words(self, block: tb.Block) -> tuple[np.ndarray, np.ndarray] | None:
        """By the memory of words; a word is known by its hash and its bytes. None where two words have one hash."""
        raw = block.buffer.tobytes()
        fold = self.lowers and b"<" not in raw
        starts, ends, hashes, at = tb.words(block, tb.SPACE, fold=fold)
        if not fold:
            hashes = ~hashes  # kept apart from folded words
        keys, first, inverse = _distinct(hashes)
        letters, size = tb.FOLD[block.buffer] if fold else block.buffer, ends - starts
        if not _same_bytes(letters, starts, size, letters, starts[first][inverse], size[first][inverse]):
            return None
        if len(self.keys) > KEPT_WORDS:
            self._tidied()
        place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)
        old, w = place[known], first[known]
        if not _same_bytes(letters, starts[w], size[w], self.letters, self.spelt[old], self.size[old]):
            return None
        new = np.flatnonzero(~known)
        if len(new):
            w, spelt = first[new], letters.tobytes()
            self._learn(keys[new], [spelt[a:b] for a, b in zip(starts[w].tolist(), ends[w].tolist())])
            place = np.searchsorted(self.keys, keys)
        self.blocks[place] += 1
        begin, count = self.begin[place][inverse], self.count[place][inverse]
        # the words' ids follow one another, with an end id after each document
        total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        offsets = total[at] + np.arange(len(block) + 1)
        out = np.empty(int(offsets[-1]), np.uint32)
        body = np.ones(len(out), bool)
        body[offsets[1:] - 1] = False
        out[body] = self.flat[np.repeat(begin - total[:-1], count) + np.arange(int(total[-1]))]
        out[offsets[1:] - 1] = END_ID
        return out, offsets


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct values, the place where each is first, and the number of each value among them; as
    np.unique gives, but sorting distinct values only."""
    codes, found = pd.factorize(values)
    first = np.empty(len(found), np.int64)
    first[codes[::-1]] = np.arange(len(values) - 1, -1, -1)
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    return found[order], first[order], rank[codes]


#: By how many bytes of a group of eight count: the mask of them.
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _groups(data: np.ndarray) -> np.ndarray:
    """At each place, the eight bytes from there on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _same_bytes(x: np.ndarray, x_at: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_at: np.ndarray, y_size: np.ndarray) -> bool:
    """Whether each span of x equals its span of y; eight bytes of all are compared at once, then the next of longer ones."""
    if not np.array_equal(x_size, y_size):
        return False
    apart = np.flatnonzero(x_at != y_at) if x is y else np.arange(len(x_at))
    a, b, left = x_at[apart], y_at[apart], x_size[apart]
    p = _groups(x)
    q = p if x is y else _groups(y)
    while len(a):
        if ((p[a] ^ q[b]) & _MASKS[np.minimum(left, 8)]).any():
            return False
        more = left > 8
        a, b, left = a[more] + 8, b[more] + 8, left[more] - 8
    return True


def _inner(count: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def encoder(path: str) -> Encoder:
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def marks(ids: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places after which a chunk may end: where the rolling hash of the last WINDOW ids has its low bits clear."""
    n = len(ids)
    rolled = np.zeros(n, np.uint64)
    wide = ids.astype(np.uint64) + np.uint64(1)
    for k in range(min(WINDOW, n)):
        rolled[k:] += wide[: n - k] * _MULTIPLIERS[k]
    return np.flatnonzero((tb.mix(rolled) & np.uint64((1 << bits) - 1)) == 0) + 1


def cuts(ids: np.ndarray, offsets: np.ndarray, least: int = LEAST, most: int = MOST) -> list[list[int]]:
    """Ends of the chunks of each document, counted from its begin; offsets: where documents begin in ids (n + 1).

    As no chunk ends before `least` ids, which is more than WINDOW, marks that look back into the document before
    are never used.
    """
    every = marks(ids)
    first = np.searchsorted(every, offsets, "right")
    out = []
    for i in range(len(offsets) - 1):
        begin = int(offsets[i])
        n = int(offsets[i + 1]) - begin
        if n <= WHOLE:
            out.append([n])
            continue
        ends, last = [], 0
        for m in (*(every[first[i] : first[i + 1]] - begin).tolist(), n):
            if m > n or m == last:
                continue
            while m - last > most:
                last += most
                ends.append(last)
            if m - last >= least or m == n and m > last:
                ends.append(m)
                last = m
        out.append(ends)
    return out


def merkle(digests: list[bytes]) -> bytes:
    """The root of a Merkle tree over digests; an odd one goes up alone."""
    level = digests or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _key(doc_id, root: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(root + repr(doc_id).encode(), digest_size=8).digest(), "little", signed=True)


_CUT = "spread long, key long, doc_id {kind}, n_tokens long, digests array<binary>, root binary, digest binary, n_docs long, data binary"


def _cut(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows of both kinds: a recipe for each document, and each distinct chunk of the block with its first document."""
    e = encoder(path)
    for batch in batches:
        for block in tb.blocks(iter([batch]), most=BLOCK):
            ids, at = e.encode(block)
            packed = ids.astype("<u2" if e.width == 2 else "<u4")
            lists, roots, keys = [], [], []
            had: dict[bytes, list] = {}  # data, key of the first document, documents
            for i, ends in enumerate(cuts(ids, at)):
                low, here, last = int(at[i]), [], 0
                parts = {}
                for c in ends:
                    data = packed[low + last : low + c].tobytes()
                    d = hashlib.sha256(data).digest()
                    parts[d] = data
                    here.append(d)
                    last = c
                lists.append(here)
                roots.append(merkle(here))
                keys.append(_key(block.columns["doc_id"][i], roots[-1]))
                for d, data in parts.items():
                    had.setdefault(d, [data, keys[-1], 0])[2] += 1
            kind = batch.schema.field("doc_id").type
            n, m = len(block), len(had)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys + [int.from_bytes(d[:8], "little", signed=True) for d in had], pa.int64()),
                    pa.array(keys + [v[1] for v in had.values()], pa.int64()),
                    pa.array(block.columns["doc_id"] + [None] * m, kind),
                    pa.array(np.diff(at).tolist() + [None] * m, pa.int64()),
                    pa.array(lists + [None] * m, pa.list_(pa.binary())),
                    pa.array(roots + [None] * m, pa.binary()),
                    pa.array([None] * n + list(had), pa.binary()),
                    pa.array([None] * n + [v[2] for v in had.values()], pa.int64()),
                    pa.array([None] * n + [v[0] for v in had.values()], pa.binary()),
                ],
                ["spread", "key", "doc_id", "n_tokens", "digests", "root", "digest", "n_docs", "data"],
            )


def _width(spark, tokenizer: str) -> int:
    """Bytes of an id in chunks; asked of a task, so that the driver need not load the tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"width": pa.array([encoder(tokenizer).width], pa.int32())})

    return spark.range(1, numPartitions=1).mapInArrow(run, "width int").first()[0]


def _objects(spark, folder: str, kind: str, schema) -> DataFrame:
    """The objects of a kind: chunk or list (recipes that aren't in order yet)."""
    return spark.read.schema(schema).parquet(f"{folder}/objects").where(F.col("kind") == kind).drop("kind")


def write_store(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Writes the store's four tables below the folder."""
    spark = docs.sparkSession
    scratch.bounded(spark)
    width = _width(spark, tokenizer)
    cut = docs.select("doc_id", "text").mapInArrow(lambda batches: _cut(batches, tokenizer), _CUT.format(kind=docs.schema["doc_id"].dataType.simpleString()))
    # one row of each chunk stays, that of the least key, with the documents of all blocks
    same = Window.partitionBy("spread", "digest").orderBy("key")
    counted = cut.withColumns({"turn": F.row_number().over(same), "n_docs": F.sum("n_docs").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    once = counted.where("digest IS NULL OR turn = 1").drop("spread", "turn")
    objects = once.withColumns({"width": F.lit(width), "n": (F.octet_length("data") / width).cast("long"), "kind": F.when(F.col("digest").isNull(), "list").otherwise("chunk")})
    concurrent = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(concurrent)
    try:
        spark.conf.set(concurrent, 2)  # both kinds are written side by side, not sorted first
        objects.write.partitionBy("kind").option("compression", "zstd").parquet(f"{folder}/objects")
    finally:
        spark.conf.set(concurrent, before)
    # ascending doc_id: ranges, with the tokens before each range from one small sum
    with scratch.swept(spark):
        recipes = _objects(spark, folder, "list", objects.schema).select("key", "doc_id", "n_tokens", "digests", "root")
        n = max(1, -(-recipes.count() // SEGMENT_DOCS))
        ranged = recipes.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.col("root")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "root")
        ordered, _ = scratch.written(ranged.withColumn("segment", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "ordered")
        scratch.delete(spark, f"{folder}/objects/kind=list")
        sums = ordered.groupBy("segment").agg(F.sum("n_tokens").alias("tokens"))
        earlier = sums.withColumn("before", F.coalesce(F.sum("tokens").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        inside = F.sum("n_tokens").over(Window.partitionBy("segment").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
        placed = ordered.withColumn("inside", F.coalesce(inside, F.lit(0))).join(earlier.select(F.col("segment").alias("s"), "before"), F.col("segment") == F.col("s"))
        placed.select("key", "doc_id", "n_tokens", (F.col("before") + F.col("inside")).alias("start"), "digests", "root", "segment", "place").write.parquet(f"{folder}/recipes")
    recipes = spark.read.parquet(f"{folder}/recipes")
    tree = recipes.select("segment", "place", "root").repartition("segment").sortWithinPartitions("segment", "place").mapInArrow(_segment_roots, "segment int, root binary")
    stats = recipes.groupBy("segment").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"), F.min("start").alias("before"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    stats.join(tree, "segment").select("segment", "n_docs", "tokens", "before", "first_id", "last_id", "root").write.parquet(f"{folder}/segments")
    tops = spark.read.parquet(f"{folder}/segments").orderBy("segment").select("root", "n_docs", "tokens").collect()
    spark.createDataFrame(
        [(merkle([bytes(r.root) for r in tops]), sum(r.n_docs for r in tops), sum(r.tokens for r in tops), len(tops), width, END_ID, BITS)],
        "root binary, n_docs long, n_tokens long, n_segments long, width int, end_id int, bits int",
    ).coalesce(1).write.parquet(f"{folder}/manifest")


def _segment_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merkle roots of the segments; a partition holds whole segments, in order."""
    found: dict[int, list[bytes]] = {}
    for b in batches:
        for s, r in zip(b.column("segment").to_pylist(), b.column("root").to_pylist()):
            found.setdefault(s, []).append(r)
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([merkle(v) for v in found.values()], pa.binary())], ["segment", "root"])


def _recounted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What `segments` should hold, and the faults within each segment; a partition holds whole segments, in order."""
    found: list[dict] = []
    roots: list[bytes] = []
    kind = pa.null()
    for b in batches:
        kind = b.schema.field("doc_id").type
        for segment, doc_id, n_tokens, start, root in zip(*[b.column(c).to_pylist() for c in ("segment", "doc_id", "n_tokens", "start", "root")]):
            if not found or found[-1]["segment"] != segment:
                if found:
                    found[-1]["root"] = merkle(roots)
                found.append({"segment": segment, "n_docs": 0, "tokens": 0, "before": start, "first_id": None, "last_id": None, "nulls": 0, "fault": None})
                roots = []
            one = found[-1]
            if start != one["before"] + one["tokens"]:
                one["fault"] = one["fault"] or f"document {doc_id} starts at {start}, not {one['before'] + one['tokens']}"
            if one["last_id"] is not None and (doc_id is None or doc_id < one["last_id"]):
                one["fault"] = one["fault"] or f"document {doc_id} is out of order"
            if doc_id is None:
                one["nulls"] += 1
            else:
                one["first_id"] = doc_id if one["first_id"] is None else one["first_id"]
                one["last_id"] = doc_id
            one["n_docs"] += 1
            one["tokens"] += n_tokens
            roots.append(root)
    if found:
        found[-1]["root"] = merkle(roots)
        kinds = {"segment": pa.int32(), "n_docs": pa.int64(), "tokens": pa.int64(), "before": pa.int64(), "first_id": kind, "last_id": kind, "nulls": pa.int64(), "fault": pa.string(), "root": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], k) for c, k in kinds.items()], list(kinds))


def _compare(recipes: DataFrame, segments: DataFrame, manifest: DataFrame) -> None:
    """Raises an error where recipes, segments and manifest do not agree. A row a segment comes to the driver."""
    kind = recipes.schema["doc_id"].dataType.simpleString()
    inside = recipes.select("segment", "place", "doc_id", "n_tokens", "start", "root").repartition("segment").sortWithinPartitions("segment", "place")
    again = inside.mapInArrow(_recounted, f"segment int, n_docs long, tokens long, before long, first_id {kind}, last_id {kind}, nulls long, fault string, root binary").collect()
    counted = {r.segment: r for r in again}
    rows = segments.collect()
    listed = {r.segment: r for r in rows}
    if sorted(counted) != sorted(r.segment for r in rows):
        raise ValueError(f"the recipes have {len(counted)} segments, the store lists {len(rows)}, or others")
    at, last, ids = 0, None, False
    for k in sorted(counted):
        one = counted[k]
        if one.fault:
            raise ValueError(f"segment {k}: {one.fault}")
        for c in ("n_docs", "tokens", "before", "first_id", "last_id", "root"):
            if one[c] != listed[k][c] and not (one[c] != one[c] and listed[k][c] != listed[k][c]):
                raise ValueError(f"segment {k}: the recipes do not match its {c}")
        if one.before != at:
            raise ValueError(f"segment {k} begins at {one.before}, not {at}")
        if ids and (one.nulls or one.first_id < last):
            raise ValueError(f"segment {k} is out of order")
        at += one.tokens
        if one.last_id is not None:
            last, ids = one.last_id, True
    tops = manifest.select("root", "n_docs", "n_tokens", "n_segments").collect()
    want = (merkle([bytes(counted[k].root) for k in sorted(counted)]), sum(r.n_docs for r in again), at, len(again))
    if [(bytes(r.root), r.n_docs, r.n_tokens, r.n_segments) for r in tops] != [want]:
        raise ValueError("the segments do not match the manifest")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of documents: of each key the recipes, then their chunks, come one after another."""
    key = None
    held: list[tuple] = []  # doc_id, start, n_tokens, root, digests
    had: dict[bytes, bytes] = {}
    out, size = [], 0
    kind, wide = None, 4

    def ids_of(doc_id, n_tokens: int, root: bytes, digests: list[bytes]) -> bytes:
        if merkle(digests) != root:
            raise ValueError(f"document {doc_id}: the recipe does not match its root")
        lost = [d for d in digests if d not in had]
        if lost:
            raise ValueError(f"document {doc_id}: the chunk with the address {lost[0].hex()} is missing")
        data = had[digests[0]] if len(digests) == 1 else b"".join([had[d] for d in digests])
        if len(data) != n_tokens * wide:
            raise ValueError(f"document {doc_id}: {len(data) // wide} ids, the recipe has {n_tokens}")
        return data if wide == 4 else np.frombuffer(data, f"<u{wide}").astype("<u4").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["doc_id", "start", "ids"])

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal out, size
        for doc_id, start, *recipe in held:
            out.append((doc_id, start, ids_of(doc_id, *recipe)))
            size += len(out[-1][2])
            if size > BLOCK:
                yield batch_of(out)
                out, size = [], 0

    for b in batches:
        kind = b.schema.field("doc_id").type
        keys = b.column("key").to_pylist()
        heads = np.asarray(b.column("digests").is_valid())
        recipes, chunks = b.filter(pa.array(heads)), b.filter(pa.array(~heads))
        recipe = zip(*[recipes.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens", "root", "digests")])
        chunk = zip(*[chunks.column(c).to_pylist() for c in ("digest", "width", "data")])
        for k, head in zip(keys, heads.tolist()):
            if k != key:
                yield from close()
                key, held, had = k, [], {}
            if head:
                held.append(next(recipe))
                continue
            digest, wide, data = next(chunk)
            if digest not in had:
                if hashlib.sha256(data).digest() != digest:
                    raise ValueError("a chunk does not match its address")
                had[digest] = data
    yield from close()
    if out:
        yield batch_of(out)


def read_store(spark, folder: str) -> DataFrame:
    """doc_id, start and ids (little-endian unsigned 32-bit integers) of each document, checked against the hashes.

    The recipes are checked against segments and manifest at once, the rest as rows are read.
    """
    recipes = spark.read.parquet(f"{folder}/recipes")
    chunks = _objects(spark, folder, "chunk", "key long, digest binary, n_docs long, width int, data binary, kind string")
    kind = recipes.schema["doc_id"].dataType.simpleString()
    own = ["doc_id", "start", "n_tokens", "root", "digests"]
    heads = recipes.select("key", *own, F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("binary").alias("data"))

    def part(rows: DataFrame) -> DataFrame:
        return rows.select("key", *[F.lit(None).cast(recipes.schema[c].dataType).alias(c) for c in own], "digest", "width", "data")

    uses = chunks.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    many = max(SHARED_BY, uses // SHARERS)
    shared = chunks.where("n_docs > 1").select("digest", "width", "data", F.col("key").alias("owner"), "n_docs")
    wanted = recipes.select("key", F.explode(F.array_distinct("digests")).alias("d"))
    others = joined(wanted, "d", shared, "digest", "n_docs", uses, limit=many).where("key <> owner")
    together = heads.unionByName(part(chunks)).unionByName(part(others))
    spread = together.repartition("key").sortWithinPartitions("key", F.col("digests").isNull())
    out = spread.mapInArrow(_joined, f"doc_id {kind}, start long, ids binary")
    try:
        segments, manifest = (spark.read.parquet(f"{folder}/{t}") for t in ("segments", "manifest"))
    except AnalysisException as missing:
        out.write.format("noop").mode("overwrite").save()  # a damaged document is named first
        raise ValueError(f"the store in {folder} lacks segments or manifest") from missing
    _compare(recipes, segments, manifest)
    return out


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Writes the documents' store and returns what is read back: doc_id, start, n_tokens, ids_crc32."""
    write_store(docs, folder, tokenizer)
    back = read_store(docs.sparkSession, folder)
    return back.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_content_store(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch.folder(spark, "store"), tokenizer_path())


def stored(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the documents' store is written and read back; its digest by document."""
    return digests(docs, scratch.folder(spark, "store"), tokenizer_path())

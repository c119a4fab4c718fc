"""Language-model scoring by deleted interpolation.

Maximum-likelihood estimates of orders ORDER to 1 and an even distribution are mixed; the weights depend on the
longest context that was seen and on how often (buckets by powers of two), and are learned by expectation-maximisation
on counts of a part of the training texts that the estimates leave out (the deleted part). In a bucket the orders whose
context was not seen have no weight, so each context's probabilities sum to 1. The final estimates use the whole
training part.

Counts go through the cluster in blocks, not word by word:

1. Texts are cut into blocks of words, kept as numbers of a block vocabulary of 64-bit word hashes; the deleted part
   has blocks of its own. The table is written, so the later steps need no text.
2. Each block sends the distinct n-grams of every order with its own counts, sorted and sliced by key range, to the
   range's task, which adds them up and answers every block with the totals in the order asked. A frequent n-gram
   is one entry a block. The number of ranges follows the number of tokens, so a task's share is bounded. Blocks and
   ranges both follow the tokens, so slices get shorter; a slice holds at least one n-gram, so there are at most as
   many rows as distinct n-grams of blocks. Words are known by 64 bits, longer n-grams by log2(tokens) + KEY_BITS: at
   any size one meets another by chance with probability 2 ** -KEY_BITS, and the sorted keys' differences stay short.
3. Blocks meet their answers. Those of the deleted part give the events for expectation-maximisation, summed by
   bucket in Spark, an aggregate an iteration; then all blocks are scored.

Tokens: words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, then one end. Unknown words share the even part,
1 / (V + 1).

Defined results: a null or empty text is the end alone; a null doc_id is neither trained on nor held out; repeated
rows give a row each and train as often as they come; with no training text every estimate but the even one is 0
(base: counts of 0); very long texts are whole, a block holds one at least; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import scratch
from rasterloom.llm import textblocks as tb

ORDER = 3
#: Buckets of each order above 1; bucket 0 is that of order 1 alone.
BUCKETS = 26
ITERATIONS = 15
BLOCK = 8 << 20
#: Keys of all orders that one range's task is meant to hold.
RANGE_KEYS = 3_000_000
#: Bits of a key beyond those that number the tokens.
KEY_BITS = 24
HELD, DELETED, RETAINED, UNUSED = 0, 1, 2, 3

_BEGIN, _END = np.uint64(0x51ED270B5F2D6A17), np.uint64(0xA24BAED4963EE407)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId(), [0]
    waiting: list[pa.RecordBatch] = []
    size = 0

    def rows(parts: list[pa.RecordBatch], deleted: bool) -> Iterator[pa.RecordBatch]:
        for block in tb.blocks(iter(parts), most=BLOCK):
            _, _, h, at = tb.words(block, tb.SPACE)
            vocabulary, numbers, n = np.unique(h, return_inverse=True, return_counts=True)
            frequent = np.argsort(-n, kind="stable")  # small numbers for frequent words: the high bytes are mostly 0
            rank = np.empty(len(n), np.uint32)
            rank[frequent] = np.arange(len(n), dtype=np.uint32)
            name = (task << 24) + made[0]
            made[0] += 1
            kind = parts[0].schema.field("doc_id").type
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.int64()),
                    pa.array([deleted]),
                    pa.array([block.columns["doc_id"]], pa.list_(kind)),
                    pa.array([block.columns["fold"]], pa.list_(pa.int32())),
                    pa.array([np.diff(at).tolist()], pa.list_(pa.int64())),
                    pa.array([vocabulary[frequent].tobytes()], pa.binary()),
                    pa.array([planes(rank[numbers])], pa.binary()),
                ],
                ["block", "deleted", "doc_ids", "folds", "n_words", "vocabulary", "words"],
            )

    for batch in batches:
        part = np.asarray(batch.column("fold")) == DELETED
        rest = batch.filter(pa.array(~part))
        if rest.num_rows:
            yield from rows([rest], False)
        if part.any():
            waiting.append(batch.filter(pa.array(part)))
            size += waiting[-1].nbytes
            if size > BLOCK:
                yield from rows(waiting, True)
                waiting, size = [], 0
    if waiting:
        yield from rows(waiting, True)


def planes(numbers: np.ndarray) -> bytes:
    """The numbers' bytes, all first bytes before all second ones and so on, which compresses well."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def packed_counts(n: np.ndarray) -> bytes:
    """Counts in planes, with no more bytes for each than the largest needs; their number comes first."""
    most = int(n.max()) if len(n) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return bytes([width]) + planes(n.astype(f"<u{width}"))


def unpacked_counts(data: bytes) -> np.ndarray:
    view = memoryview(data)
    return from_planes(view[1:], f"<u{view[0]}")


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, in planes."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    return planes(steps)


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


class Grams:
    """The n-grams of a block: for each order a key for every place. A begin stands before and an end after a text.

    bits: of a key of the orders above 1; words keep all 64.
    """

    def __init__(self, row: dict, order: int, bits: int = 64):
        n = np.array(row["n_words"], np.int64)
        self.docs = len(n)
        self.begin = np.cumsum(n + 2) - (n + 2)
        total = int((n + 2).sum())
        self.keys = [np.empty(total, np.uint64)]
        words = np.frombuffer(row["vocabulary"], np.uint64)[from_planes(row["words"], np.uint32)]
        body = np.ones(total, bool)
        body[self.begin] = False
        self.predicted = np.flatnonzero(body)
        self.n_tokens = n + 1
        body[self.begin + n + 1] = False
        first = self.keys[0]
        first[self.begin], first[self.begin + n + 1], first[body] = _BEGIN, _END, words
        for k in range(1, order):
            longer = np.empty(total, np.uint64)
            longer[1:] = tb.combine(self.keys[-1][:-1], first[1:])
            longer[self.begin] = _BEGIN + np.uint64(k)
            self.keys.append(longer)
        if bits < 64:
            self.keys[1:] = [k >> np.uint64(64 - bits) for k in self.keys[1:]]
        fold = np.array(row["folds"], np.int64)
        self.training = np.repeat((fold == DELETED) | (fold == RETAINED), n + 2)
        self.order = order

    def distinct(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct keys of an order (from 1), and the number of each place's key."""
        return np.unique(self.keys[k - 1], return_inverse=True)


def _asked(batches: Iterator[pa.RecordBatch], order: int, bits: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """A row for each block, order and key range that has keys."""
    for batch in batches:
        for row in batch.to_pylist():
            g = Grams(row, order, bits)
            for k in range(1, order + 1):
                keys, of = g.distinct(k)
                n = np.bincount(of[g.training], minlength=len(keys))
                at = np.concatenate([[0], np.searchsorted(keys, _edges(ranges, 64 if k == 1 else bits)), [len(keys)]])
                used = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int64()),
                        pa.array([row["block"]] * len(used), pa.int64()),
                        pa.array([row["deleted"]] * len(used), pa.bool_()),
                        pa.array([k] * len(used), pa.int32()),
                        pa.array([packed_keys(keys[at[r] : at[r + 1]]) for r in used], pa.binary()),
                        pa.array([packed_counts(n[at[r] : at[r + 1]]) for r in used], pa.binary()),
                    ],
                    ["range", "block", "deleted", "order", "keys", "counts"],
                )
                g.keys[k - 1] = None  # a longer order needs it no more


def _edges(ranges: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // ranges for i in range(1, ranges)], np.uint64)


def _answered(table: pa.Table) -> pa.Table:
    """The totals of one key range, for each block that asked; and a row of sums (block -1)."""
    out = {n: [] for n in ("block", "order", "range", "total", "retained", "tokens", "types", "tokens_kept", "types_kept")}
    name = table.column("range")[0].as_py()
    order_of = np.asarray(table.column("order"))
    for k in np.unique(order_of):
        part = table.filter(pa.array(order_of == k))
        arrays = [unpacked_keys(x.as_buffer()) for x in part.column("keys")]
        lengths = np.array([len(a) for a in arrays])
        keys, of = np.unique(np.concatenate(arrays), return_inverse=True)
        del arrays
        n = np.concatenate([unpacked_counts(x.as_buffer()) for x in part.column("counts")]).astype(np.float64)
        deleted = np.asarray(part.column("deleted"))
        left_out = np.repeat(deleted, lengths)
        total = np.bincount(of, weights=n, minlength=len(keys))
        kept = total - np.bincount(of[left_out], weights=n[left_out], minlength=len(keys))
        ends = np.cumsum(lengths)
        for i, block in enumerate(part.column("block").to_pylist()):
            mine = of[ends[i] - lengths[i] : ends[i]]
            out["block"].append(block)
            out["total"].append(packed_counts(total[mine]))
            out["retained"].append(packed_counts(kept[mine]) if deleted[i] else None)
            for c in ("tokens", "types", "tokens_kept", "types_kept"):
                out[c].append(0)
        if k == 1:
            real = keys != _BEGIN
            out["block"].append(-1)
            out["total"].append(b"")
            out["retained"].append(None)
            out["tokens"].append(int(total[real].sum()))
            out["types"].append(int((total[real] > 0).sum()))
            out["tokens_kept"].append(int(kept[real].sum()))
            out["types_kept"].append(int((kept[real] > 0).sum()))
        rows = len(out["block"]) - len(out["order"])
        out["order"] += [int(k)] * rows
        out["range"] += [name] * rows
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))


_ANSWER = "block long, order int, range long, total binary, retained binary, tokens long, types long, tokens_kept long, types_kept long"


def _counts(right: pa.Table, k: int, column: str) -> np.ndarray:
    """A block's counts of one order, in the order of its keys."""
    part = right.filter(pa.array(np.asarray(right.column("order")) == k)).sort_by("range")
    return np.concatenate([unpacked_counts(x.as_buffer()) for x in part.column(column)]).astype(np.float64)


def bucket_of(context: np.ndarray, order: int) -> np.ndarray:
    """The bucket of a context of this order's estimate (above 1) that was seen so often."""
    return 1 + (order - 2) * BUCKETS + np.minimum(np.floor(np.log2(np.maximum(context, 1))), BUCKETS - 1).astype(np.int64)


def order_of(bucket: int) -> int:
    """The highest order that has a weight in a bucket."""
    return 1 if bucket == 0 else 2 + (bucket - 1) // BUCKETS


def estimates(g: Grams, counts: list[np.ndarray], tokens: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each predicted place: its bucket, the estimates of orders 1 to n (rows), and the word's count."""
    place = g.predicted
    at = [c[g.distinct(k + 1)[1]] for k, c in enumerate(counts)]
    p = np.zeros((g.order, len(place)))
    p[0] = at[0][place] / max(tokens, 1.0)
    bucket = np.zeros(len(place), np.int64)
    for k in range(1, g.order):
        context = at[k - 1][place - 1]
        seen = context > 0
        p[k] = np.divide(at[k][place], context, out=np.zeros(len(place)), where=seen)
        bucket[seen] = bucket_of(context[seen], k + 1)
    return bucket, p, at[0][place]


def _events(left: pa.Table, right: pa.Table, order: int, bits: int, tokens: float) -> pa.Table:
    row = left.to_pylist()[0]
    g = Grams(row, order, bits)
    bucket, p, _ = estimates(g, [_counts(right, k + 1, "retained") for k in range(order)], tokens)
    sort = np.lexsort([*p, bucket])
    s = np.vstack([bucket[sort], p[:, sort]])
    new = np.concatenate([[True], (s[:, 1:] != s[:, :-1]).any(axis=0)]) if s.shape[1] else np.zeros(0, bool)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, s.shape[1]))
    return pa.table([pa.array(s[0, first].astype(np.int32)), *[pa.array(s[k + 1, first]) for k in range(order)], pa.array(n, pa.int64())], ["bucket", *[f"p{k + 1}" for k in range(order)], "n"])


def weights_learned(events: DataFrame, order: int, even: float, iterations: int = ITERATIONS) -> np.ndarray:
    """Mixture weights by bucket (rows): of the even distribution and orders 1 to n. Each iteration is one aggregate."""
    n = 1 + (order - 1) * BUCKETS
    may = np.array([[k <= order_of(b) for k in range(order + 1)] for b in range(n)])
    lam = may / may.sum(axis=1, keepdims=True)
    smoothed = lambda share, b: (share + 0.1) * may[b] / ((share + 0.1) * may[b]).sum()
    last = None
    for _ in range(iterations):
        parts = []
        for k in range(order + 1):
            w = F.array(*[F.lit(float(x)) for x in lam[:, k]])[F.col("bucket")]
            parts.append(w * (F.lit(even) if k == 0 else F.col(f"p{k}")))
        mix = parts[0]
        for x in parts[1:]:
            mix = mix + x
        priced = events.select("bucket", "n", mix.alias("mix"), *[x.alias(f"x{k}") for k, x in enumerate(parts)])
        rows = priced.groupBy("bucket").agg(F.sum(F.col("n") * F.log("mix")).alias("ll"), *[F.sum(F.col("n") * F.col(f"x{k}") / F.col("mix")).alias(f"r{k}") for k in range(order + 1)]).collect()
        whole = np.zeros(order + 1)
        for r in rows:
            share = np.array([r[f"r{k}"] for k in range(order + 1)])
            whole += share
            lam[r.bucket] = smoothed(share, r.bucket)
        seen = {r.bucket for r in rows}
        if seen:
            for b in set(range(n)) - seen:  # no event: the nearest bucket below of that order that has some, else all events
                below = [s for s in seen if s < b and order_of(s) == order_of(b)]
                lam[b] = lam[max(below)] if below else smoothed(whole, b)
        ll = sum(r.ll for r in rows)
        if last is not None and abs(ll - last) <= 1e-5 * abs(last):
            break
        last = ll
    return lam


def _scored(left: pa.Table, right: pa.Table, order: int, bits: int, tokens: int, types: int, lam: np.ndarray) -> pa.Table:
    row = left.to_pylist()[0]
    g = Grams(row, order, bits)
    bucket, p, count = estimates(g, [_counts(right, k + 1, "total") for k in range(order)], float(tokens))
    mix = lam[bucket, 0] / (types + 1)
    for k in range(order):
        mix += lam[bucket, k + 1] * p[k]
    begin = np.cumsum(g.n_tokens) - g.n_tokens
    score = np.add.reduceat(np.log10(mix), begin)
    base = np.add.reduceat(np.log10((count + 0.1) / (tokens + 0.1 * (types + 1))), begin)
    known = np.add.reduceat((count > 0).astype(np.int64), begin)
    kind = left.schema.field("doc_ids").type.value_type
    fold = np.array(row["folds"])
    return pa.table(
        [pa.array(row["doc_ids"], kind), pa.array(fold == HELD), pa.array(g.n_tokens), pa.array(known), pa.array([tokens] * g.docs, pa.int64()), pa.array(base), pa.array(score)],
        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def scored(docs: DataFrame, fold, order: int = ORDER) -> DataFrame:
    """Scores of all texts by a model of those whose fold is DELETED or RETAINED. fold: an int column; UNUSED texts are
    neither trained on nor held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    scratch.bounded(spark)
    rows = docs.select("doc_id", fold.cast("int").alias("fold"), "text")
    blocks, _ = scratch.written(rows.mapInArrow(_blocked, f"block long, deleted boolean, doc_ids array<{kind}>, folds array<int>, n_words array<long>, vocabulary binary, words binary"), "blocks", compression="zstd")
    size = blocks.select(F.aggregate("n_words", F.lit(0).cast("long"), lambda a, x: a + x + 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = max(8, -(-int(size) * order // RANGE_KEYS))
    bits = min(64, max(1, int(size)).bit_length() + KEY_BITS)
    asked = blocks.mapInArrow(lambda b: _asked(b, order, bits, ranges), "range long, block long, deleted boolean, order int, keys binary, counts binary")
    answers, _ = scratch.written(asked.groupBy("range").applyInArrow(_answered, _ANSWER), "answers", compression="zstd")
    sums = answers.where("block = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("tokens", "types", "tokens_kept", "types_kept")]).first()
    replies = answers.where("block >= 0").select("block", "order", "range", "total", "retained")
    schema = ", ".join(["bucket int", *[f"p{k + 1} double" for k in range(order)], "n long"])
    kept = float(sums.tokens_kept)
    events = blocks.where("deleted").groupBy("block").cogroup(replies.where("retained IS NOT NULL").drop("total").groupBy("block")).applyInArrow(lambda a, b: _events(a, b, order, bits, kept), schema)
    events, events_path = scratch.written(events, "events")
    lam = weights_learned(events, order, 1.0 / (sums.types_kept + 1))
    scratch.delete(spark, events_path)
    tokens, types = int(sums.tokens), int(sums.types)
    return blocks.groupBy("block").cogroup(replies.drop("retained").groupBy("block")).applyInArrow(
        lambda a, b: _scored(a, b, order, bits, tokens, types, lam),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def fold_of(doc_id) -> F.Column:
    """By the remainder of the id's checksum: 0 held out, 1 deleted, else retained; a null id is not used."""
    r = F.crc32(doc_id.cast("string").cast("binary")) % 10
    return F.when(r.isNull(), UNUSED).when(r == 0, HELD).when(r == 1, DELETED).otherwise(RETAINED)


def op1_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, fold_of(F.col("doc_id")))

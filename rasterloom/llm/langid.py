"""Language identification by prediction by partial matching.

Each language has a byte context tree of order ORDER: how often each byte followed each context of up to ORDER
bytes. A byte that a context has seen n times among T with D distinct successors costs -log2(n / (T + D)); else the
escape costs -log2(D / (T + D)) and the next shorter context decides, down to an even choice of 256. Contexts never
seen pass on free of cost; there is no exclusion. Statistics are frozen, so the cost of a byte after its context is
a constant: a table over (context, byte) filled on demand turns a text's code length into one gather and one sum.

The trees are learned from a bounded sample: about DOCS_PER_LANGUAGE whole texts per language, chosen by hash, and
at most about DOCS of all languages; so what is broadcast is bounded too. Texts of at most TEXT_BYTES come first; a
language with too few of them takes up to LONG_TEXTS longer ones. Everything else covers all rows.

Defined results: a null, empty or letterless text is `und` with score 0, as is any text if no language was learned;
ties go to the first language by name; a null doc_id never trains; repeated rows give a row each; other columns
are not read. A-Z count as a-z. score: the posterior of the predicted language among the learned, with code lengths
scaled to a text of at most SCORE_BYTES bytes.
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
DOCS_PER_LANGUAGE, DOCS = 600, 60_000
TEXT_BYTES, LONG_TEXTS = 100_000, 20
SCORE_BYTES = 64
BLOCK = 2 << 20
#: Byte pairs that the table of costs covers at most, and its bytes; costs of others are worked out for each block.
PAIRS, TABLE_BYTES = 1023, 16 << 20

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


def grams(block: tb.Block) -> np.ndarray:
    """For each byte, itself and the three before it as one number; a newline stands before each text."""
    b = tb.FOLD[block.buffer].astype(np.uint32)
    out = b.copy()
    place = np.arange(len(b)) - np.repeat(block.offsets[:-1], np.diff(block.offsets))
    for k in range(1, ORDER + 1):
        before = np.full(len(b), 10, np.uint32)
        before[k:] = b[:-k] if len(b) > k else before[k:]
        before[place < k] = 10
        out |= before << np.uint32(8 * k)
    return out


class Trees:
    """Frozen context trees of some languages; cost() gives bits for (context, byte) numbers."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        self.tables = []
        for name in self.languages:
            key, n = counts[name]
            orders = []
            for k in range(ORDER, -1, -1):
                mask = np.uint32(0xFFFFFFFF >> (8 * (ORDER - k)))
                keys, inverse = np.unique(key & mask, return_inverse=True)
                seen = np.bincount(inverse, weights=n)
                contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
                total = np.bincount(of, weights=seen)
                distinct = np.bincount(of)
                hit = -np.log2(seen / (total[of] + distinct[of]))
                escape = -np.log2(distinct / (total + distinct))
                orders.append((mask, keys, hit, contexts, escape))
            self.tables.append(orders)
        every = np.concatenate([np.zeros(0, np.uint32), *(c[0] for c in counts.values())])
        weight = np.concatenate([np.zeros(0), *(c[1] for c in counts.values())])
        pairs = min(PAIRS, int((TABLE_BYTES / 8 / max(1, len(self.languages))) ** 0.5) - 1)
        self.high = self._dense(every >> np.uint32(16), weight, pairs)
        self.low = self._dense(every & np.uint32(0xFFFF), weight, pairs)
        self.n_low = int(self.low.max()) + 1
        self.memo: np.ndarray | None = None

    @staticmethod
    def _dense(values: np.ndarray, weight: np.ndarray, pairs: int) -> np.ndarray:
        """Small numbers for the most frequent byte pairs; 0 for the others."""
        out = np.zeros(65536, np.int32)
        total = np.bincount(values, weights=weight, minlength=65536)
        v = np.argsort(-total, kind="stable")[:pairs]
        v = v[total[v] > 0]
        out[v] = np.arange(1, len(v) + 1)
        return out

    def cost(self, gram: np.ndarray) -> np.ndarray:
        """Bits for each number, a row for each language."""
        out = np.zeros((len(self.languages), len(gram)))
        for row, orders in zip(out, self.tables):
            open_ = np.ones(len(gram), bool)
            for mask, keys, hit, contexts, escape in orders:
                at = np.flatnonzero(open_)
                if not len(at):
                    break
                g = gram[at] & mask
                k = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
                found = keys[k] == g
                row[at[found]] += hit[k[found]]
                open_[at[found]] = False
                rest, c = at[~found], g[~found] >> np.uint32(8)
                k = np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
                known = contexts[k] == c
                row[rest[known]] += escape[k[known]]
            row[open_] += 8.0
        return out

    def lengths(self, block: tb.Block) -> np.ndarray:
        """The code length in bits of each text (columns) by each language (rows)."""
        out = np.zeros((len(self.languages), len(block)))
        if not len(block.buffer):
            return out
        g = grams(block)
        if self.memo is None:
            self.memo = np.full((len(self.languages), (int(self.high.max()) + 1) * self.n_low), np.nan)
        high, low = self.high[g >> np.uint32(16)], self.low[g & np.uint32(0xFFFF)]
        slot = high * self.n_low + low
        slot[(high == 0) | (low == 0)] = 0
        missing = np.isnan(self.memo[0][slot])
        missing[slot == 0] = False
        if missing.any():
            slots, first = np.unique(slot[missing], return_index=True)
            self.memo[:, slots] = self.cost(g[missing][first])
        strange = np.flatnonzero(slot == 0)
        if len(strange):
            values, inverse = np.unique(g[strange], return_inverse=True)
            odd = self.cost(values)
        full = np.flatnonzero(np.diff(block.offsets))
        for k in range(len(self.languages)):
            bits = self.memo[k][slot]
            if len(strange):
                bits[strange] = odd[k][inverse]
            out[k, full] = np.add.reduceat(bits, block.offsets[:-1][full])
        return out


def learned(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Trees:
    """Trees from a hash sample of the rows given: those with lang, text and doc_id."""
    rows = docs.select("doc_id", "text", "lang").where("doc_id IS NOT NULL AND text <> '' AND lang IS NOT NULL").withColumn("long", F.octet_length("text") > TEXT_BYTES)
    counts = {(r.lang, r.long): r.n for r in rows.groupBy("lang", "long").agg(F.count("*").alias("n")).collect()}
    per_language = min(per_language, DOCS / max(1, len({name for name, _ in counts})))
    rates = [(name, long, min(LONG_TEXTS, max(0.0, per_language - counts.get((name, False), 0))) / n if long else per_language / n) for (name, long), n in counts.items()]
    share = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    table = docs.sparkSession.createDataFrame(rates, "of string, size boolean, rate double")  # two rows a language
    sample = rows.join(F.broadcast(table), (F.col("lang") == F.col("of")) & (F.col("long") == F.col("size"))).where(share < F.col("rate")).select("lang", "text")
    found = sample.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    out = {}
    for name, part in found.groupby("lang"):
        out[str(name)] = (part["gram"].to_numpy().astype(np.uint32), part["n"].to_numpy().astype(np.float64))
    return Trees(out)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in tb.blocks(batches, most=BLOCK):
        g = grams(block)
        of = np.array(block.columns["lang"], object)
        each = np.repeat(np.arange(len(block)), np.diff(block.offsets))
        for name in np.unique(of):
            keys, n = np.unique(g[(of == name)[each]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def _letters(block: tb.Block) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[block.buffer])])
    has = sums[block.offsets[1:]] > sums[block.offsets[:-1]]
    for i in np.flatnonzero(~has & (np.diff(block.offsets) > 0)):
        has[i] = any(c.isalpha() for c in block.bytes_of(i).decode("utf-8", "ignore"))
    return has


def _predicted(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(iter([batch]), most=BLOCK):
            has = _letters(block) & ~block.null & bool(trees.languages)
            names = np.full(len(block), "und", object)
            score = np.zeros(len(block))
            if trees.languages:
                bits = trees.lengths(block)
                best = bits.argmin(axis=0)
                scale = np.minimum(1.0, SCORE_BYTES / np.maximum(1, np.diff(block.offsets)))
                apart = np.minimum((bits - bits.min(axis=0)) * scale, 1000.0)
                score = np.where(has, 1.0 / np.exp2(-apart).sum(axis=0), 0.0)
                names[has] = np.array(trees.languages, object)[best[has]]
            yield pa.RecordBatch.from_arrays([pa.array(block.columns["doc_id"], batch.schema.field("doc_id").type), pa.array(names.tolist(), pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])


def predicted(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, lang_pred, score of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _predicted(batches, shared.value), f"doc_id {kind}, lang_pred string, score double")


def _remainder(most: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % most


def op7_ppm_langid(spark, sf_dir: str) -> DataFrame:
    scratch.bounded(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = learned(docs.where(_remainder(4) != 2))
    return predicted(docs, trees).select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


#: Documents whose score is lower are rejected by the pipeline's stage.
LEAST_SCORE = 0.5


def identified(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that have a language, with all their columns as they came."""
    scratch.bounded(spark)
    trees = learned(docs.where(_remainder(4) != 2))
    shared = spark.sparkContext.broadcast(trees)
    return docs.mapInArrow(lambda batches: _kept(batches, shared.value), docs.schema)


def _kept(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flags = [
            np.array([p != "und" and s >= LEAST_SCORE for p, s in zip(got.column("lang_pred").to_pylist(), got.column("score").to_pylist())], bool)
            for got in _predicted(iter([batch.select(["doc_id", "text"])]), trees)
        ]
        if flags:
            yield batch.filter(pa.array(np.concatenate(flags)))

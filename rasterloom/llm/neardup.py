"""Near-duplicate documents by b-bit MinHash.

1. Each text's distinct five-word shingles are hashed; K minima are taken. The first of them, in BANDS groups of ROWS,
   give band keys; of each minimum the low B bits are kept, packed into WORDS longs. Texts with equal sets are one class from
   here on, so exact copies cost nothing further.
2. Candidates: classes that share a band key. First each class meets only the pivot of each of its bands: the class
   that meets most others over all bands, which among edited copies is the one nearest to their source. The bit counts of the packed signatures give a similarity, corrected for chance collisions of B bits; a
   pair goes on if that is within MARGIN of the threshold and its sizes allow the threshold.
3. Links are confirmed on the full shingle sets, read from the texts of the classes concerned.
4. Components of the confirmed links. Then, in each band key that still holds several components, every class
   outside the pivot's component meets every class of another component, with the size and bit-count tests inside
   the join, and a bound: shingles that no other of these classes has cannot be shared, so the rest of a class's
   shingles limits its similarity with any other. So no pair of different components that shares a band key goes
   untested, while groups that the pivots have already joined make no pairs, and copies edited well beyond the
   threshold make few. A pair with several keys in common is made at the first of them.
5. Components of all links; the least doc_id of a component names it.

At similarity 0.75 a pair misses all bands with probability (1 - 0.75 ** ROWS) ** BANDS, 2.5e-7, and the margin is
five standard deviations of the estimate; a link is lost only by these.

Defined results: a null or empty text, or one without words, has n_shingles 0 and is linked with nothing; a text of
fewer than five words has its whole sequence as one shingle; a null doc_id is linked with nothing and kept; rows
that repeat a doc_id give a row each, judged by its own text; other columns are not read. Very long texts are whole:
a block holds one at least. `deduplicated` keeps one row of each component also where several rows carry its doc_id.

Keys that many rows share (band keys of a large group of copies, large components, classes of many equal texts) are
joined so that adaptive execution can split them, see `graph.met`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import scratch
from rasterloom.llm import textblocks as tb
from rasterloom.operators.graph import labels, met

SHINGLE = 5
ROWS, BANDS, B = 4, 40, 2
K = 480
WORDS = K * B // 64
PERCENT = 75
MARGIN = 0.12
BLOCK = 4 << 20
#: Texts or shingle sets that go to Python at once.
WIDE = 1000

_M = tb.mix(np.arange(11, 11 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
_A = (tb.mix(np.arange(101, 101 + K, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_X = (tb.mix(np.arange(1001, 1001 + K, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all documents, one after another, and where each begins (n + 1)."""
    _, _, h, at = tb.words(block, tb.SPACE)
    count = np.diff(at)
    rolled = np.zeros(len(h), np.uint64)
    n = len(h)
    for k in range(min(SHINGLE, n)):
        rolled[: n - k] += h[k:] * _M[k]
    rolled = tb.mix(rolled)
    sets = []
    for i in range(len(block)):
        a, c = int(at[i]), int(count[i])
        if c >= SHINGLE:
            sets.append(np.unique(rolled[a : a + c - SHINGLE + 1]))
        elif c:
            short = np.array([c], np.uint64)
            for k in range(a, a + c):
                short = tb.combine(short, h[k : k + 1])
            sets.append(short)
        else:
            sets.append(np.zeros(0, np.uint64))
    ends = np.cumsum([0, *map(len, sets)])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), ends


def minima(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """K minima (columns) of each non-empty set (rows)."""
    full = np.flatnonzero(np.diff(ends))
    out = np.empty((len(full), K), np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    y = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    for k in range(K if len(full) else 0):
        v = (x ^ _X[k]) * _A[k]
        v ^= v >> np.uint32(15)
        v += y * _A[K - 1 - k]
        out[:, k] = np.minimum.reduceat(v, ends[:-1][full])
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """The low B bits of the minima, as WORDS signed 64-bit integers a row."""
    low = (least & np.uint32((1 << B) - 1)).astype(np.uint64).reshape(len(least), WORDS, 64 // B)
    shifts = np.arange(64 // B, dtype=np.uint64) * np.uint64(B)
    return np.bitwise_or.reduce(low << shifts, axis=2).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    g = least[:, : BANDS * ROWS].astype(np.uint64).reshape(len(least), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(least), BANDS))
    for r in range(ROWS):
        h = tb.combine(h, g[:, :, r])
    return h.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(iter([batch]), most=BLOCK):
            sets, ends = shingle_sets(block)
            least = minima(sets, ends)
            size = np.diff(ends)
            full = np.flatnonzero(size)
            names = [hashlib.blake2b(sets[ends[i] : ends[i + 1]].tobytes(), digest_size=16).digest() if size[i] else None for i in range(len(block))]
            bands, sig = band_keys(least), packed(least)
            row = np.full(len(block), -1)
            row[full] = np.arange(len(full))
            pick = lambda m: pa.array([m[r].tolist() if r >= 0 else None for r in row], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.columns["doc_id"], batch.schema.field("doc_id").type), pa.array(block.columns["mark"], pa.int64()), pa.array(size, pa.int64()), pa.array(names, pa.binary()), pick(bands), pick(sig)],
                ["doc_id", "mark", "n_shingles", "name", "bands", "sig"],
            )


def differing() -> Column:
    """How many of the K low-bit groups of the signatures s0.. and t0.. differ."""
    ones = sum(1 << k for k in range(0, 64, B))
    total = None
    for k in range(WORDS):
        x = F.col(f"s{k}").bitwiseXOR(F.col(f"t{k}"))
        y = x
        for s in range(1, B):
            y = y.bitwiseOR(F.shiftrightunsigned(x, s))
        n = F.bit_count(y.bitwiseAND(F.lit(ones).cast("long")))
        total = n if total is None else total + n
    return total


def estimated(differ: Column) -> Column:
    """The similarity that a number of differing groups speaks for: equal low bits also come by chance."""
    chance = 2.0**-B
    return ((1 - differ / F.lit(float(K))) - F.lit(chance)) / F.lit(1 - chance)


#: Most differing groups of a pair that goes on.
MOST_DIFFERING = int((1 - (2.0**-B + (1 - 2.0**-B) * (PERCENT / 100 - MARGIN))) * K)


def _sizes_allow(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The classes of a block and their shingle sets, from texts."""
    for batch in batches:
        for block in tb.blocks(iter([batch]), most=BLOCK):
            sets, ends = shingle_sets(block)
            parts = [sets[ends[i] : ends[i + 1]] for i in range(len(block))]
            # a doc_id may stand for several texts
            own = [i for i, name in enumerate(block.columns["name"]) if hashlib.blake2b(parts[i].tobytes(), digest_size=16).digest() == name]
            yield [block.columns["cid"][i] for i in own], [parts[i] for i in own]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid and shingles, packed."""
    for cids, sets in _class_sets(batches):
        yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["cid", "shingles"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid and shingles, as arrays."""
    for cids, sets in _class_sets(batches):
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["cid", "shingles"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        x, y = batch.column("x"), batch.column("y")
        keep = []
        for i in range(batch.num_rows):
            p, q = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
            both = len(p) + len(q) - len(np.union1d(p, q))
            if 100 * both >= PERCENT * (len(p) + len(q) - both):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])


def _texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame, packed_sets: bool = True) -> DataFrame:
    """cid and shingles (packed, or as arrays) of the classes in the column c of distinct wanted, from their texts."""
    who = classes.select("cid", "rep", "name").join(wanted, F.col("cid") == F.col("c"), "left_semi")
    texts = docs.select("doc_id", "text").join(who, F.col("doc_id") == F.col("rep")).select("cid", "name", "text")
    sets = texts.mapInArrow(_sets, "cid long, shingles binary") if packed_sets else texts.mapInArrow(_lists, "cid long, shingles array<long>")
    return sets.dropDuplicates(["cid"]) if _repeats(classes) else sets


def _shareable(cids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of classes: `of` and `most`, how many of its shingles another of them has too; without those too few for a link."""
    lists = _texts(cids.withColumnRenamed("cid", "c"), classes, docs, packed_sets=False)
    single = lists.select("cid", F.explode("shingles").alias("h")).groupBy("h").agg(F.count("*").alias("n"), F.min("cid").alias("cid")).where("n = 1")
    alone = single.groupBy("cid").agg(F.count("*").alias("alone")).withColumnRenamed("cid", "c")
    sizes = classes.select("cid", "n").join(cids.withColumnRenamed("cid", "d"), F.col("cid") == F.col("d"), "left_semi")
    most = F.col("n") - F.coalesce("alone", F.lit(0))
    return sizes.join(alone, F.col("cid") == F.col("c"), "left").select(F.col("cid").alias("of"), most.alias("most"), "n").where(100 * F.col("most") >= PERCENT * F.col("n")).select("of", "most")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs (a, b) of classes, written down: those whose full sets reach the threshold."""
    needed = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    sets, path = scratch.written(_texts(needed, classes, docs), "sets", batch=WIDE)
    one = pairs.join(sets.select(F.col("cid").alias("c1"), F.col("shingles").alias("x")), F.col("a") == F.col("c1")).select("a", "b", "x")
    two = one.join(sets.select(F.col("cid").alias("c2"), F.col("shingles").alias("y")), F.col("b") == F.col("c2")).select("a", "b", "x", "y")
    links, _ = scratch.written(two.mapInArrow(_confirmed, "a long, b long"), "confirmed", batch=WIDE)
    scratch.delete(pairs.sparkSession, path)
    return links


def _open(rows: DataFrame, links: DataFrame) -> tuple[DataFrame, str]:
    """Of rows (key, cid, pivot): those of band keys that hold several components, as key, cid, comp and main (the
    pivot's component), written down."""
    label = labels(links)
    own, path = scratch.written(rows.join(label, F.col("cid") == F.col("node"), "left").select("key", "cid", "pivot", F.coalesce("label", "cid").alias("comp")), "own")
    mixed = own.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min(F.when(F.col("cid") == F.col("pivot"), F.col("comp"))).alias("main")).where("low <> high").select(F.col("key").alias("k"), "main")
    still, still_path = scratch.written(met(own, "key", mixed, "k").select("key", "cid", "comp", "main"), "still")
    scratch.delete(rows.sparkSession, path)
    return still, still_path


def _repeats(classes: DataFrame) -> bool:
    """Whether a doc_id stands for several rows, so that a class may find its text twice."""
    return bool(classes.agg(F.max("repeated")).first()[0])


def _named(docs: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """The signed rows; class_name, component and class_size of each class."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed, signed_path = scratch.written(docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(_signed, f"doc_id {kind}, mark long, n_shingles long, name binary, bands array<long>, sig array<long>"), "signed", batch=WIDE)
    repeated = signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    known = signed.where("name IS NOT NULL AND doc_id IS NOT NULL")
    firsts = known.groupBy("name").agg(F.min("doc_id").alias("rep"), F.count("*").alias("class_size"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes, _ = scratch.written(firsts.withColumn("cid", F.monotonically_increasing_id()).withColumn("repeated", F.lit(repeated)), "classes")
    bands = classes.select("cid", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select(F.col("key").alias("k"), "m")
    rows, first_path = scratch.written(met(bands, "key", shared, "k").select("key", "cid", "m"), "bands")
    others = rows.groupBy("cid").agg(F.sum("m").alias("met")).withColumnRenamed("cid", "c")
    weighed = rows.join(others, F.col("cid") == F.col("c")).select("key", "cid", "met")
    pivots = weighed.groupBy("key").agg(F.max(F.struct("met", "cid"))["cid"].alias("pivot")).withColumnRenamed("key", "k")
    rows, _ = scratch.written(met(rows, "key", pivots, "k").select("key", "cid", "pivot"), "pivots")
    scratch.delete(docs.sparkSession, first_path)
    signature = [F.col("sig")[k] for k in range(WORDS)]
    left = classes.select(F.col("cid").alias("c1"), F.col("n").alias("n1"), F.col("bands").alias("bands1"), *[x.alias(f"s{k}") for k, x in enumerate(signature)])
    right = classes.select(F.col("cid").alias("c2"), F.col("n").alias("n2"), F.col("bands").alias("bands2"), *[x.alias(f"t{k}") for k, x in enumerate(signature)])
    close = _sizes_allow("n1", "n2") & (differing() <= MOST_DIFFERING)
    stars = rows.where("cid <> pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
    near = stars.join(left, F.col("a") == F.col("c1")).join(right, (F.col("b") == F.col("c2")) & close).select("a", "b")
    near, _ = scratch.written(near, "pairs")
    links = confirmed(near, classes, docs)
    still, _ = _open(rows, links)
    bound, _ = scratch.written(_shareable(still.select("cid").distinct(), classes, docs), "bounds", batch=WIDE)
    possible = still.join(bound, F.col("cid") == F.col("of")).select("key", "cid", "comp", "main", "most")
    outside = possible.where("comp <> main").join(left, F.col("cid") == F.col("c1")).select("key", F.col("comp").alias("comp1"), F.col("most").alias("most1"), "c1", "n1", "bands1", *[f"s{k}" for k in range(WORDS)])
    every = possible.join(right, F.col("cid") == F.col("c2")).select(F.col("key").alias("k"), F.col("comp").alias("comp2"), F.col("most").alias("most2"), "main", "c2", "n2", "bands2", *[f"t{k}" for k in range(WORDS)])
    once = (F.col("comp2") == F.col("main")) | (F.col("c1") < F.col("c2"))
    common = F.least("most1", "most2")
    allowed = 100 * common >= PERCENT * (F.col("n1") + F.col("n2") - common)
    # a pair is made in the first band that both have in common
    here = F.array_position(F.zip_with("bands1", "bands2", lambda x, y: x == y), True) == F.array_position("bands1", F.col("key"))
    rest = outside.join(every, (F.col("key") == F.col("k")) & (F.col("comp1") != F.col("comp2")) & once & allowed & close & here).select(F.col("c1").alias("a"), F.col("c2").alias("b")).distinct()
    rest, _ = scratch.written(rest, "rest")
    more = confirmed(rest, classes, docs)
    all_labels = labels(links.unionByName(more))
    each = classes.select("cid", "rep", "name", "class_size").join(all_labels, F.col("cid") == F.col("node"), "left").select("cid", "rep", "name", "class_size", F.coalesce("label", "cid").alias("comp"))
    least = each.groupBy("comp").agg(F.min("rep").alias("component")).withColumnRenamed("comp", "c")
    named, named_path = scratch.written(met(each, "comp", least, "c").select(F.col("name").alias("class_name"), "component", "class_size"), "named")
    keep(signed_path, named_path)
    return signed, named


def clustered(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, mark (a hash of its text), n_shingles, component_id, kept, class_size (rows with an equal set)."""
    scratch.bounded(docs.sparkSession)
    with scratch.swept(docs.sparkSession) as keep:
        signed, named = _named(docs, keep)
    slim = signed.select("doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("name")).alias("name"))
    out = slim.join(named, F.col("name") == F.col("class_name"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "mark", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), F.coalesce("class_size", F.lit(1)).alias("class_size"))


def op4_bbit_minhash(spark, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("class_size", "mark")


def deduplicated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each component, with all columns; each row is judged by its own text.

    Where several rows carry the doc_id that names their component, the one with the least hash of its text stays, and
    one of those with that text. Rows with a null doc_id stay.
    """
    found, _ = scratch.written(clustered(docs).where("doc_id IS NOT NULL").select("doc_id", "mark", "component_id", "kept"), "clusters")
    gone = found.where("NOT kept").select("doc_id", "mark")
    again = found.where("kept").groupBy("doc_id").agg(F.min("mark").alias("stays"), F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("named"), "stays")
    again, _ = scratch.written(again, "again")
    repeated = again.limit(1).count() > 0
    if repeated:
        gone = gone.unionByName(found.where("kept").join(again, F.col("doc_id") == F.col("named")).where("mark <> stays").select("doc_id", "mark"))
    gone_id, gone_mark = (scratch.fresh(docs, c) for c in ("gone_id", "gone_mark"))
    gone = gone.distinct().toDF(gone_id, gone_mark)
    out = docs.join(gone, (docs["doc_id"] == gone[gone_id]) & (F.xxhash64(docs["text"]) == gone[gone_mark]), "left_anti")
    if not repeated:
        return out
    # what is left of the repeated doc_ids has one text each
    ids = again.select(F.col("named").alias(gone_id))
    several = out.join(ids, F.col("doc_id") == F.col(gone_id), "left_semi").dropDuplicates(["doc_id"])
    return out.join(ids, F.col("doc_id") == F.col(gone_id), "left_anti").unionByName(several)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON m.x = d.doc_id
"""

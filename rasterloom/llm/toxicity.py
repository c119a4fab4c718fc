"""Toxicity by weak supervision.

Voters look at a text: lexicon families fire when a word of theirs occurs (words that mean something else in another
language are a family of their own), one voter when any of the others does, and pattern voters on shouting,
exclamation runs, and insults beside second-person words. Where a training text has a label,
that label is one more voter. A generative label model with a hidden class estimates from the joint votes how
reliable each voter is and how voters depend on each other: a tree of the strongest dependencies given the class
(conditional mutual information) links them, and expectation-maximisation alternates posteriors, tables and tree.
Votes are summed by pattern in Spark first; there are at most 3 * 2 ** len(VOTERS) patterns.

Besides the lexicon that is given, one is mined: words and word beginnings that go with label 1 much more often than
with label 0, counted over all labelled training rows. It gives voters of its own. Every key that passes the tests is
kept, whatever the input's size. Up to MOST_KEYS of them go to the tasks with the code; more are written as files, which
a task reads one after another for each block of texts: slower, with the same votes and features.

A logistic classifier over counts and ratios is then fitted to the posterior labels of a bounded sample of at most
about SAMPLE training rows, chosen by hash. Votes and features cover all rows and whole texts.

Defined results: a null or empty text has no votes and all features 0; rows with null doc_id are scored but never
trained on; several labels of one doc_id count as their largest; null labels count as absent; with no training row
the classifier is the prior of 0.1; repeated rows give a row each; texts are whole, a block holds one at least; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import scratch
from rasterloom.llm import textblocks as tb

SAMPLE = 20_000
#: Labels that may be broadcast, about 20 MB; more of them are joined by a shuffle.
MARK_ROWS = 500_000
#: Keys of a mined lexicon that a task holds at once, 16 bytes each.
MOST_KEYS = 8_000_000
#: What a mined word or beginning needs: texts with label 1, times the rate of label 0, standard errors above it.
LEAST_TEXTS, LEAST_RATIO, LEAST_ERRORS = 4, 5.0, 4.0
#: Bytes of word beginnings.
BEGINNINGS = (4, 5, 6, 7)
BLOCK = 4 << 20

# Lexicon families.
LEXICON = {
    "stupidity": "idiot idiots moron morons stupid dumb fool imbecile idiotic stupidity idiota imbécil estúpido imbécile stupide crétin dumm blöd trottel",
    "worth": "worthless useless loser losers pathetic inutile inútil wertlos versager",
    "dirt": "trash scum garbage filth filthy vermin ordure basura abschaum dreck",
    "disgust": "disgusting repulsive dégoûtant asqueroso ekelhaft widerlich",
    "mockery": "clown clowns buffoon ridiculous bouffon payaso ridículo lächerlich",
    "profanity": "damn shit fuck fucking bastard bitch merde connard salaud mierda cabrón scheiße arschloch",
    "hatred": "hate despise loathe hateful haine odio hass",
    "violence": "kill murder strangle tuer matar umbringen",
    "ambiguous": "vile gross nul crap stab joke",
}
YOU = "you your yours youre u tu vous votre ton du dich dein ihr usted tú"

FAMILIES = list(LEXICON)
VOTERS = [*FAMILIES, "any_family", "beside_you", "shouting", "bangs", "mined", "mined_twice", "mined_evidence"]
FEATURES = [*FAMILIES, "total", "density", "families", "beside_you", "shouting", "bangs", "mined", "evidence", "evidence_density"]


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, of = [], []
    for k, words in enumerate(LEXICON.values()):
        for w in words.split():
            keys.append(tb.hash_word(w.encode()))
            of.append(k)
    keys = np.array(keys, np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array(of)[order], np.unique(np.array([tb.hash_word(w.encode()) for w in YOU.split()], np.uint64))


def _parts(block: tb.Block) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Word hashes, where each text's words begin, and for words and each length of beginnings: places among the words
    and hashes."""
    starts, ends, h, at = tb.words(block, tb.PUNCTUATION)
    out = [(np.arange(len(h)), h)]
    for n in BEGINNINGS:
        long = np.flatnonzero(ends - starts > n)
        out.append((long, tb.combine(tb.hash_spans(block.buffer, starts[long], starts[long] + n), np.uint64(n))))
    return h, at, out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(iter([batch]), most=BLOCK):
            _, at, parts = _parts(block)
            toxic = np.array(block.columns["label"]) == 1
            of = np.repeat(np.arange(len(block)), np.diff(at))
            doc = np.concatenate([of[w] for w, _ in parts])
            key = np.concatenate([k for _, k in parts])
            order = np.lexsort((doc, key))
            doc, key = doc[order], key[order]
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            keys, inverse = np.unique(key[first], return_inverse=True)
            ones = np.bincount(inverse, weights=toxic[doc[first]], minlength=len(keys)).astype(np.int64)
            every = np.bincount(inverse, minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ones), pa.array(every - ones)], ["key", "n1", "n0"])


def _lookup(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their weights."""
    keys = np.asarray(table.column("key")).astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.minimum(np.asarray(table.column("w")).astype(np.float64), 5.0)[order]


def _slices(lexicon: tuple[np.ndarray, np.ndarray] | list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The lexicon's keys and weights, file by file where it is in files."""
    if isinstance(lexicon, tuple):
        yield lexicon
        return
    for uri in lexicon:
        fs, path = pafs.FileSystem.from_uri(uri)
        with fs.open_input_file(path) as f:
            yield _lookup(pq.read_table(f))


def mined(docs: DataFrame, marks: DataFrame) -> tuple[np.ndarray, np.ndarray] | list[str]:
    """Sorted hashes of mined words and beginnings, and their weights (log odds, at most 5); more than MOST_KEYS of them
    as Parquet files in the shared folder. marks: labelled, label."""
    sizes = {r.label: r.n for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return np.zeros(0, np.uint64), np.zeros(0)
    few = sum(sizes.values()) <= MARK_ROWS  # counted
    rows = docs.select("doc_id", "text").join(F.broadcast(marks) if few else marks, F.col("doc_id") == F.col("labelled")).select("label", "text")
    odds = F.log((F.col("n1") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("n0") + 0.5) / (sizes[0] + 1.0))
    errors = odds / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    with scratch.swept(docs.sparkSession) as keep:
        summed, _ = scratch.written(rows.mapInArrow(_counted, "key long, n1 long, n0 long").groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where("n1 > 0"), "words")
        good = summed.where(F.col("n1") >= LEAST_TEXTS).select("key", odds.alias("w"), errors.alias("z")).where((F.col("w") >= np.log(LEAST_RATIO)) & (F.col("z") >= LEAST_ERRORS)).select("key", "w")
        n = good.count()
        if n <= MOST_KEYS:
            return _lookup(good.toArrow())
        sliced, path = scratch.written(good.repartitionByRange(-(-2 * n // MOST_KEYS), "key"), "lexicon")  # files of about half of what a task holds
        keep(path)
        return sorted(sliced.inputFiles())


def _looked_at(batches: Iterator[pa.RecordBatch], lexicon: tuple[np.ndarray, np.ndarray] | list[str]) -> Iterator[pa.RecordBatch]:
    keys, family, you = _tables()
    upper = np.zeros(256, bool)
    upper[0x41:0x5B] = True
    letter = upper.copy()
    letter[0x61:0x7B] = True
    for batch in batches:
        for block in tb.blocks(iter([batch]), most=BLOCK):
            h, at, parts = _parts(block)
            docs = len(block)
            of = np.repeat(np.arange(docs), np.diff(at))
            k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[k] == h)
            counts = np.zeros((docs, len(FAMILIES)))
            np.add.at(counts, (of[hit], family[k[hit]]), 1)
            ys = np.flatnonzero(np.isin(h, you))
            near = np.zeros(len(hit), bool)
            if len(ys) and len(hit):
                # the first such word of the same text from three places before on
                y = ys[np.minimum(np.searchsorted(ys, np.maximum(hit - 3, at[of[hit]])), len(ys) - 1)]
                near = (np.abs(y - hit) <= 3) & (of[y] == of[hit])
            beside = np.bincount(of[hit[near]], minlength=docs)
            # each distinct word counts once, by the best of what is mined of it
            weight = np.zeros(len(h))
            for held, weights in _slices(lexicon):
                if not len(held):
                    continue
                for place, key in parts:
                    j = np.minimum(np.searchsorted(held, key), len(held) - 1)
                    found = held[j] == key
                    np.maximum.at(weight, place[found], weights[j[found]])
            some = np.flatnonzero(weight)
            order = some[np.lexsort((h[some], of[some]))]
            new = np.ones(len(order), bool)
            new[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
            once = order[new]
            n_mined = np.bincount(of[once], minlength=docs)
            evidence = np.bincount(of[once], weights=weight[once], minlength=docs)
            n_words = np.diff(at)
            buf, o = block.buffer, block.offsets
            per = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[o])
            caps, letters = per(upper[buf]), per(letter[buf])
            bang = buf == 0x21
            pairs = np.zeros(len(buf), bool)
            pairs[1:] = bang[1:] & bang[:-1]
            bangs = per(pairs)
            total = counts.sum(axis=1)
            words = np.maximum(n_words, 1)
            shout = caps / np.maximum(letters, 1)
            votes = np.column_stack(
                [counts > 0, counts[:, :-1].any(axis=1), beside > 0, (shout > 0.5) & (letters >= 20), bangs >= np.maximum(3, n_words / 20), n_mined >= 1, n_mined >= 2, evidence >= np.maximum(8.0, 0.05 * n_words)]
            )
            mask = (votes * (1 << np.arange(len(VOTERS)))).sum(axis=1)
            x = np.column_stack([np.log1p(counts), np.log1p(total), np.log1p(100 * total / words), (counts > 0).sum(axis=1), np.log1p(beside), shout, np.log1p(bangs), np.log1p(n_mined), np.log1p(evidence), np.log1p(100 * evidence / words)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.columns["doc_id"], batch.schema.field("doc_id").type), pa.array(mask, pa.int64()), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "votes", "x"]
            )


def looked_at(docs: DataFrame, lexicon: tuple[np.ndarray, np.ndarray] | list[str]) -> DataFrame:
    """doc_id, votes (a bit for each voter) and features x of every text. lexicon: what `mined` gave."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _looked_at(batches, lexicon), f"doc_id {kind}, votes long, x array<double>")


class LabelModel:
    """A hidden class, voters with class-dependent tables, and a dependency tree among them.

    Patterns: votes (n x J of 0/1), labels (-1 none, 0, 1) and weights. The label depends on the class alone.
    """

    def __init__(self, votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, iterations: int = 40):
        self.votes, self.labels, self.weights = votes, labels, weights
        fired = (votes[:, len(FAMILIES)] == 1) | (votes[:, -2] == 1)
        q = np.where(fired, 0.9, 0.05)
        q = np.where(labels == 1, np.maximum(q, 0.3), q)
        self.parents = np.full(votes.shape[1], -1)
        self.log_likelihood = -np.inf
        for k in range(iterations):
            if k % 10 == 0:
                self.parents = self._tree(q)
            self._fit(q)
            q, value = self._posterior()
            if k > 15 and abs(value - self.log_likelihood) < 1e-7 * abs(value):
                break
            self.log_likelihood = value
        self.posterior = q

    def _fit(self, q: np.ndarray) -> None:
        w1, w0 = self.weights * q, self.weights * (1 - q)
        self.prior = (w1.sum() + 1) / (self.weights.sum() + 10)
        J = self.votes.shape[1]
        #: P(vote of j is 1 | class, vote of j's parent)
        self.table = np.zeros((J, 2, 2))
        for j in range(J):
            parent = self.votes[:, self.parents[j]] if self.parents[j] >= 0 else np.zeros(len(q), int)
            for c, w in ((0, w0), (1, w1)):
                rate = (w @ self.votes[:, j] + 0.5) / (w.sum() + 5.0)  # few cases lean on the rate of the class
                for v in (0, 1):
                    at = parent == v
                    self.table[j, c, v] = (w[at] @ self.votes[at, j] + 4 * rate) / (w[at].sum() + 4)
        has = self.labels >= 0
        #: P(label is 1 | class); labels are taken to be better than chance
        self.label_rate = np.array([min(0.4, (w0[has] @ self.labels[has] + 1) / (w0[has].sum() + 10)), max(0.6, (w1[has] @ self.labels[has] + 9) / (w1[has].sum() + 10))])

    def _posterior(self) -> tuple[np.ndarray, float]:
        log = np.zeros((len(self.weights), 2))
        log[:, 0], log[:, 1] = np.log(1 - self.prior), np.log(self.prior)
        for j in range(self.votes.shape[1]):
            parent = self.votes[:, self.parents[j]] if self.parents[j] >= 0 else np.zeros(len(log), int)
            for c in (0, 1):
                p = self.table[j, c][parent]
                log[:, c] += np.log(np.where(self.votes[:, j] == 1, p, 1 - p))
        for c in (0, 1):
            r = self.label_rate[c]
            log[:, c] += np.where(self.labels < 0, 0.0, np.log(np.where(self.labels == 1, r, 1 - r)))
        top = log.max(axis=1)
        total = top + np.log(np.exp(log - top[:, None]).sum(axis=1))
        return np.exp(log[:, 1] - total), float(self.weights @ total)

    def dependence(self, q: np.ndarray) -> np.ndarray:
        """Conditional mutual information of each two voters, given the class."""
        J = self.votes.shape[1]
        out = np.zeros((J, J))
        for w in (self.weights * q, self.weights * (1 - q)):
            share = w.sum() / self.weights.sum()
            w = w / max(w.sum(), 1e-12)
            for a in range(J):
                for b in range(a):
                    for va in (0, 1):
                        for vb in (0, 1):
                            p = w[(self.votes[:, a] == va) & (self.votes[:, b] == vb)].sum()
                            pa_, pb = w[self.votes[:, a] == va].sum(), w[self.votes[:, b] == vb].sum()
                            if p > 0:
                                out[a, b] += share * p * np.log(p / (pa_ * pb))
                    out[b, a] = out[a, b]
        return out

    def _tree(self, q: np.ndarray) -> np.ndarray:
        """Each voter's parent in the tree of greatest total dependence; -1 for the root. Rounded, so that the order of
        sums decides no tie."""
        d = np.round(self.dependence(q), 9)
        J = len(d)
        parents, inside = np.full(J, -1), [0]
        while len(inside) < J:
            outside = [j for j in range(J) if j not in inside]
            best = max(((d[i, j], -i, -j) for i in inside for j in outside))
            parents[-best[2]] = -best[1]
            inside.append(-best[2])
        return parents


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (the constant last) of a logistic regression on soft targets, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def marked(labels: DataFrame) -> DataFrame:
    """labelled and label of each doc_id that has one."""
    return labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(F.max(F.col("toxic").cast("int")).alias("label"))


def fitted(seen: DataFrame, marks: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, LabelModel | None]:
    """The classifier's weights and the label model, from rows (doc_id, votes, x) to train on."""
    joined = seen.where("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("labelled"), "left").select("doc_id", "votes", "x", F.coalesce("label", F.lit(-1)).alias("label"))
    joined, path = scratch.written(joined, "marked")
    patterns = joined.groupBy("votes", "label").agg(F.count("*").alias("n")).orderBy("votes", "label").collect()
    if not patterns:
        return np.append(np.zeros(len(FEATURES)), np.log(0.1 / 0.9)), None
    masks = np.array([r.votes for r in patterns])
    votes = (masks[:, None] >> np.arange(len(VOTERS))) & 1
    model = LabelModel(votes, np.array([r.label for r in patterns]), np.array([float(r.n) for r in patterns]))
    known = {(r.votes, r.label): q for r, q in zip(patterns, model.posterior)}
    total = sum(r.n for r in patterns)
    share = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = joined.where(share < min(1.0, most / total)).orderBy("doc_id", "votes").select("votes", "label", "x").collect()
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    y = np.array([known[(r.votes, r.label)] for r in rows])
    scratch.delete(seen.sparkSession, path)
    return logistic(x, y), model


def scored(seen: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score, predicted by the linear classifier, in Spark."""
    z = F.lit(float(weights[-1]))
    for k in range(len(FEATURES)):
        z = z + F.col("x")[k] * F.lit(float(weights[k]))
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return seen.select("doc_id", score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted"))


def op8_weak_toxicity(spark, sf_dir: str) -> DataFrame:
    scratch.bounded(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rest = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 5
    marks, _ = scratch.written(marked(spark.read.parquet(f"{sf_dir}/labels.parquet")).where(rest("labelled") != 0), "marks")
    seen, _ = scratch.written(looked_at(docs, mined(docs, marks)), "seen")
    weights, _ = fitted(seen.where(rest("doc_id") != 0), marks)
    return scored(seen, weights).select("doc_id", F.coalesce(rest("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")

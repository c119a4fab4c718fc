"""Mixing sources to target weights by iterative proportional fitting.

Documents are first summed into cells of (source, language, topic); all fitting happens on cells. A marginal's target
tokens are its share of the token budget, at most what it has; what that leaves over goes to the other values of the
dimension in proportion. Each step rakes the cells' weights to one dimension's targets by a factor for each of its
values. A cell's expected tokens are its weight, but never more than it has: the factor is worked out for the cells
below that bound while those at it count with all they have, so the bound takes part in the fit. The expected tokens of a cell
against its tokens are the inclusion probability of its documents, and a hash of seed and doc_id decides. Rounds end
when all marginals hold within TOLERANCE; `residuals` reports what could not be met. DataFrame functions only.

Targets can be given as a table (dimension, value, share); shares are scaled to 1 in each dimension, and a value that
is not listed gets none. Else a value's share is that of its tokens to a power.

Up to CELLS_TOGETHER cells are fitted in one task, by window sums without any shuffle; more of them by grouped sums
joined back, in which a value with many cells is spread over tasks. Both give the same sums.

Defined results: null source or language counts as the value `(none)`; a null or empty text has no tokens and gets its
cell's probability (0 for a cell without tokens); rows that repeat a doc_id share their fate; a null doc_id is drawn as
`null`; an empty table gives an empty result; texts are whole, however long; other columns are not read (`mixed` keeps
them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import scratch
from rasterloom.operators.graph import joined

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 60
#: Rounds between two looks at the residuals.
LOOK = 10
TOLERANCE = 1e-9
SCALINGS = 8
#: Without a table of targets, a value's share is that of its tokens to this power: 1 leaves the mix, 0 makes it even.
POWER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
FRACTION = 0.6
SEED = 17
CELLS_TOGETHER = 100_000
#: Rates that may be broadcast; about 20 MB.
RATE_ROWS = 200_000
#: A weight beyond its cell's tokens grows no further than this many times them.
_HIGHEST = 1e9

# Topic rules, the first that matches names the topic; else prose.
TOPICS = [
    ("listing", r" \| "),
    ("emphatic", r"!!"),
    ("markup", r"[#*$%&]{3}"),
    ("contact", r"[A-Za-z0-9._]@[A-Za-z0-9]"),
    ("record", r"[0-9]{6}"),
]


def topic_of(text: Column, topics: list[tuple[str, str]] | None = None) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS if topics is None else topics):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def described(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.coalesce(F.col("source"), F.lit("(none)")).alias("source"),
        F.coalesce(F.col("lang"), F.lit("(none)")).alias("lang"),
        (topic_of(text) if topic is None else topic).alias("topic"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
    )


def targets_by_power(cells: DataFrame, power: dict[str, float] | None = None) -> DataFrame:
    """dimension, value, share: of each value, its share of the tokens to the dimension's power."""
    power = POWER if power is None else power
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]) or 1.0
    parts = [cells.groupBy(F.col(d).alias("value")).agg(F.pow(F.sum("tokens").cast("double") / total, F.lit(power[d])).alias("share")).select(F.lit(d).alias("dimension"), "value", "share") for d in DIMENSIONS]
    return reduce(DataFrame.unionByName, parts)


def marginals(cells: DataFrame, targets: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """dimension, value, share, has (its tokens), n_cells and target of every value that the cells or the targets have."""
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    there = reduce(DataFrame.unionByName, [cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").cast("double").alias("has"), F.count("*").alias("n_cells")).select(F.lit(d).alias("dimension"), "value", "has", "n_cells") for d in DIMENSIONS])
    wanted = targets.groupBy("dimension", "value").agg(F.sum("share").cast("double").alias("share"))
    both = there.join(wanted, ["dimension", "value"], "full").na.fill(0.0, ["share", "has"]).na.fill(0, ["n_cells"])
    both, _ = scratch.written(both, "marginals")
    scale = dict.fromkeys(DIMENSIONS, 0.0)
    for r in both.where("has > 0").groupBy("dimension").agg(F.sum("share").alias("s")).collect():
        scale[r.dimension] = fraction * total / r.s if r.s else 0.0

    def at(scale: dict[str, float]) -> Column:
        out = F.lit(0.0)
        for d, x in scale.items():
            out = F.when(F.col("dimension") == d, F.lit(x)).otherwise(out)
        return out * F.col("share")

    for _ in range(SCALINGS):
        full = at(scale) >= F.col("has")
        rows = both.where("has > 0").groupBy("dimension").agg(F.sum(F.when(full, F.col("has")).otherwise(0.0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("share"))).alias("open")).collect()
        scale |= {r.dimension: (fraction * total - r.full) / r.open for r in rows if r.open > 0}
    return both.withColumn("target", F.least(F.col("has"), at(scale)))


#: A cell counts with all it has from this share of its tokens on, so that rounding does not move it to and fro.
_FULL = f"weight >= tokens * {1 - 1e-9!r}"
_BOUND, _FREE = f"sum(CASE WHEN {_FULL} THEN tokens ELSE 0.0D END)", f"sum(CASE WHEN {_FULL} THEN 0.0D ELSE weight END)"


def _factored(d: str) -> str:
    factor = f"CASE WHEN free > 0 AND target_{d} > bound THEN (target_{d} - bound) / free WHEN bound + free > 0 THEN target_{d} / (bound + free) ELSE 0.0D END"
    return f"least(weight * ({factor}), tokens * {_HIGHEST:.0f}D) AS weight"


def _raked_together(cells: DataFrame, rounds: int) -> DataFrame:
    """Some rounds in one task: in a single partition window sums need no shuffle."""
    others = ", ".join(c for c in cells.columns if c != "weight")
    cells = cells.coalesce(1)
    for _ in range(rounds):
        sql = "SELECT * FROM {cells}"
        for d in DIMENSIONS:
            sums = f"SELECT *, {_BOUND} OVER (PARTITION BY {d}) AS bound, {_FREE} OVER (PARTITION BY {d}) AS free FROM ({sql})"
            sql = f"SELECT {others}, {_factored(d)} FROM ({sums})"
        cells = cells.sparkSession.sql(sql, cells=cells)
    return cells


def _raked(cells: DataFrame, d: str, n_cells: int) -> DataFrame:
    """One step of any size: the weights of each value of the dimension times its factor."""
    sums = cells.groupBy(F.col(d).alias("of")).agg(F.expr(_BOUND).alias("bound"), F.expr(_FREE).alias("free"), F.count("*").alias("n"))
    return joined(cells, d, sums, "of", "n", n_cells).select(*[c for c in cells.columns if c != "weight"], F.expr(_factored(d).removesuffix(" AS weight")).alias("weight"))


def _attained(cells: DataFrame) -> DataFrame:
    """dimension, value, target, attained (expected tokens)."""
    parts = [cells.groupBy(F.col(d).alias("value")).agg(F.first(f"target_{d}").alias("target"), F.sum(F.least("weight", "tokens")).alias("attained")).select(F.lit(d).alias("dimension"), "value", "target", "attained") for d in DIMENSIONS]
    return reduce(DataFrame.unionByName, parts)


def fitted(cells: DataFrame, targets: DataFrame, fraction: float = FRACTION, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells (source, lang, topic, tokens) with `weight` and the `probability` of their documents, raked to the targets
    (dimension, value, share)."""
    spark = cells.sparkSession
    n_cells = cells.count()
    goal = marginals(cells, targets, fraction).select("dimension", "value", "target", "n_cells")
    out = cells.withColumn("tokens", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        own = goal.where(F.col("dimension") == d).select(F.col("value").alias("of"), F.col("target").alias(f"target_{d}"), "n_cells")
        out = joined(out, d, own, "of", "n_cells", n_cells).drop("of", "n_cells")
    out, path = scratch.written(out.withColumn("weight", F.col("tokens") * F.lit(fraction)), "ipf")
    for done in range(0, rounds, LOOK):
        now = min(LOOK, rounds - done)
        steps = [lambda x: _raked_together(x, now)] if n_cells <= CELLS_TOGETHER else [lambda x, d=d: _raked(x, d, n_cells) for _ in range(now) for d in DIMENSIONS]
        for step in steps:
            before = path
            out, path = scratch.written(step(out), "ipf")
            scratch.delete(spark, before)
        off = _attained(out).agg(F.max(F.abs(F.col("attained") - F.col("target")) / F.greatest(F.col("target"), F.lit(1e-9)))).first()[0]
        if off is None or off <= tolerance:
            break
    return out.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") / F.col("tokens"))).otherwise(F.lit(0.0)))


def residuals(fit: DataFrame, targets: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Of a fit: dimension, value, wanted (its share of the budget), has (its tokens), target, attained (the expected
    tokens), and feasible (whether what it has allows what is wanted)."""
    cells = fit.select(*DIMENSIONS, "tokens")
    goal = marginals(cells, targets, fraction)
    shares = targets.groupBy("dimension").agg(F.sum("share").alias("shares"))
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0.0))).first()[0])
    got = _attained(fit).drop("target")
    out = goal.join(shares, "dimension").join(got, ["dimension", "value"], "left").na.fill(0.0, ["attained"])
    wanted = F.col("share") / F.col("shares") * F.lit(fraction * total)
    return out.select("dimension", "value", wanted.alias("wanted"), "has", "target", "attained", (wanted <= F.col("has") * (1 + 1e-9)).alias("feasible"))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from a document's id."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def rated(rows: DataFrame, own: dict[str, Column], rates: DataFrame) -> DataFrame:
    """rows with the column `cell_rate` (a fresh name), the probability of their cell. own: each dimension's value of a row."""
    cell = lambda values: F.xxhash64(*values)
    key, rate = scratch.fresh(rows, "cell_key"), scratch.fresh(rows, "cell_rate")
    at = [scratch.fresh(rows, f"cell_{d}") for d in DIMENSIONS]
    small = rates.select(cell([F.col(d) for d in DIMENSIONS]).alias("cell_of"), *[F.col(d).alias(a) for d, a in zip(DIMENSIONS, at)], F.col("probability").alias(rate), "n_docs")
    same = reduce(lambda a, b: a & b, [own[d] == F.col(a) for d, a in zip(DIMENSIONS, at)])
    n = rates.count()
    if n <= RATE_ROWS:  # counted: small enough for every task
        return rows.join(F.broadcast(small), same).drop("cell_of", "n_docs", *at)
    total = rates.agg(F.sum("n_docs")).first()[0]
    return joined(rows.withColumn(key, cell([own[d] for d in DIMENSIONS])), key, small, "cell_of", "n_docs", total).where(same).drop(key, "cell_of", "n_docs", *at)


def rates_of(each: DataFrame, targets: DataFrame | None, power: dict[str, float] | None, fraction: float) -> DataFrame:
    """source, lang, topic, probability and n_docs of each cell of `each` (as `described` gives it)."""
    with scratch.swept(each.sparkSession) as keep:
        cells, _ = scratch.written(each.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")), "cells")
        fit = fitted(cells, targets_by_power(cells, power) if targets is None else targets, fraction)
        known, path = scratch.written(fit.select(*DIMENSIONS, "probability", "n_docs"), "rates")
        keep(path)
    return known


def sampled(docs: DataFrame, topic: Column | None = None, targets: DataFrame | None = None, power: dict[str, float] | None = None, fraction: float = FRACTION, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, source, lang, topic, n_tokens, its cell's probability, and whether it is sampled.

    targets: (dimension, value, share); else shares follow `power`.
    """
    each, _ = scratch.written(described(docs, topic), "described")
    out = rated(each, {d: F.col(d) for d in DIMENSIONS}, rates_of(each, targets, power, fraction))
    return out.select("doc_id", *DIMENSIONS, "n_tokens", F.col("cell_rate").alias("probability"), (draw(F.col("doc_id"), seed) < F.col("cell_rate")).alias("sampled"))


def op3_ipf_mix(spark, sf_dir: str) -> DataFrame:
    out = sampled(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumn("probability", F.round("probability", 6))


def mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the sampled documents with all their columns."""
    own = {"source": F.coalesce(docs["source"], F.lit("(none)")), "lang": F.coalesce(docs["lang"], F.lit("(none)")), "topic": topic_of(F.coalesce(docs["text"], F.lit("")))}
    out = rated(docs, own, rates_of(described(docs), None, None, FRACTION))
    return out.where(draw(F.col("doc_id")) < F.col(scratch.fresh(docs, "cell_rate"))).select(*docs.columns)


def _oracle() -> str:
    topic = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS) + " ELSE 'prose' END"
    steps = "CASE k % 3 WHEN 0 THEN source WHEN 1 THEN lang ELSE topic END"
    parts = [
        "d AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(text, '') AS t FROM documents)",
        rf"e AS MATERIALIZED (SELECT doc_id, source, lang, {topic} AS topic, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM d)",
        "c AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM e GROUP BY ALL)",
        f"tot AS (SELECT sum(tokens) AS total, sum(tokens) * {FRACTION} AS budget FROM c)",
        "m AS MATERIALIZED ("
        + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS value, sum(tokens) AS has, pow(sum(tokens) / max(total), {POWER[d]}) AS share FROM c, tot GROUP BY {d}" for d in DIMENSIONS)
        + ")",
        "z0 AS MATERIALIZED (SELECT dimension, max(budget) / sum(share) AS z FROM m, tot WHERE has > 0 GROUP BY dimension)",
    ]
    for i in range(SCALINGS):
        parts.append(
            f"z{i + 1} AS MATERIALIZED (SELECT dimension, CASE WHEN sum(CASE WHEN z * share >= has THEN 0 ELSE share END) > 0 THEN (max(budget) - sum(CASE WHEN z * share >= has THEN has ELSE 0 END)) / sum(CASE WHEN z * share >= has THEN 0 ELSE share END) ELSE max(z) END AS z FROM m JOIN z{i} USING (dimension), tot WHERE has > 0 GROUP BY dimension)"
        )
    parts.append(f"g AS MATERIALIZED (SELECT dimension, value, least(has, z * share) AS target FROM m JOIN z{SCALINGS} USING (dimension))")
    goals = " ".join(f"JOIN (SELECT value AS {d}, target AS target_{d} FROM g WHERE dimension = '{d}') USING ({d})" for d in DIMENSIONS)
    parts.append(
        f"""r AS (SELECT 0 AS k, c.*, tokens * {FRACTION} AS weight, {", ".join(f"target_{d}" for d in DIMENSIONS)} FROM c {goals}
  UNION ALL
  SELECT k + 1, source, lang, topic, tokens, least(weight * CASE WHEN free > 0 AND target > bound THEN (target - bound) / free WHEN bound + free > 0 THEN target / (bound + free) ELSE 0 END, tokens * {_HIGHEST}) AS weight, target_source, target_lang, target_topic FROM (
    SELECT *, CASE k % 3 WHEN 0 THEN target_source WHEN 1 THEN target_lang ELSE target_topic END AS target,
      sum(CASE WHEN {_FULL} THEN tokens ELSE 0 END) OVER (PARTITION BY {steps}) AS bound, sum(CASE WHEN {_FULL} THEN 0 ELSE weight END) OVER (PARTITION BY {steps}) AS free
    FROM r WHERE k < {3 * ROUNDS}))"""
    )
    parts.append(f"p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(1.0, weight / tokens) ELSE 0.0 END AS p FROM r WHERE k = {3 * ROUNDS})")
    return (
        "WITH RECURSIVE " + ",\n".join(parts) + f"\nSELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability, "
        f"CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) / 4294967296.0 < p AS sampled FROM e JOIN p USING (source, lang, topic)"
    )


ORACLE = _oracle()

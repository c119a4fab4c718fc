"""Quality rules: a threshold table compiled into one Spark projection.

Every rule compares a ratio of two counted measures with a low and a high bound. The measures are built-in
expressions over the words and lines of the whole text; no user function is involved.

Defined results: a null or empty text has no words and fails the base rule; a null doc_id stays null; repeated rows
give a row each; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for was with on as it by be this are from or an at not have "
    "le la les des et en un une du de est dans que qui pour par sur au il pas avec "
    "der die das und den von zu mit sich auf ist im ein eine nicht dem es als bei "
    "el los las del y se con por su lo una al más como"
).split()

#: name, measure, the measure it is divided by, least, most (None: no bound)
THRESHOLDS = [
    ("word_length", "word_chars", "n_words", 2.0, 12.0),
    ("symbol_ratio", "n_symbols", "n_words", None, 0.3),
    ("bang_ratio", "n_bangs", "n_words", None, 0.5),
    ("stop_word_ratio", "n_stop_words", "n_words", 0.01, None),
    ("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    ("line_length", "n_words", "n_lines", 1.5, None),
]


def compiled(thresholds: list[tuple]) -> tuple[Column, Column]:
    """The verdict and the comma-joined names of failed rules, as expressions over the measures."""
    fails = []
    for name, measure, per, low, high in thresholds:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(measure) < F.lit(low) * F.col(per))
        if high is not None:
            bad = bad | (F.col(measure) > F.lit(high) * F.col(per))
        fails.append(F.when(bad, F.lit(name)))
    names = F.concat_ws(",", *fails)
    return names == "", names


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counted measures of each text."""
    stop = [w for s in STOP_WORDS for w in {s, s.capitalize()}]
    words = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select(
        "doc_id",
        F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.translate("t", "!", ""))).cast("long").alias("n_bangs"),
    )
    hashed = words.select(
        "doc_id",
        "n_symbols",
        "n_bangs",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.filter("w", lambda x: x.isin(stop))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("w") >= 3,
            F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))),
        ).alias("h"),
    )
    # the heavy path runs where a window repeats
    repeats = hashed.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    starts = repeats.withColumn(
        "s",
        F.when(
            F.col("s").isNotNull(),
            F.filter("s", lambda x, k: ((k > 0) & (F.get(F.col("s"), k - 1)["h"] == x["h"])) | ((k < F.size("s") - 1) & (F.get(F.col("s"), k + 1)["h"] == x["h"]))),
        ),
    )
    return starts.withColumn(
        "n_repeat_words", F.coalesce(F.size(F.array_distinct(F.flatten(F.transform("s", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))), F.lit(0)).cast("long")
    ).drop("h", "s")


def judged(docs: DataFrame, thresholds: list[tuple] | None = None) -> DataFrame:
    """The measures with base_failed, kept, and failed_rules (names of the table's rules that failed)."""
    passed, names = compiled(THRESHOLDS if thresholds is None else thresholds)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measures(docs).select("*", failed.alias("base_failed"), (~failed & passed).alias("kept"), names.alias("failed_rules"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules"
    )


def _sql_rule(name: str, measure: str, per: str, low: float | None, high: float | None) -> str:
    tests = [f"{measure} < CAST({low} AS DOUBLE) * {per}"] * (low is not None) + [f"{measure} > CAST({high} AS DOUBLE) * {per}"] * (high is not None)
    return f"CASE WHEN {' OR '.join(tests)} THEN '{name}' END"


_STOPS = ", ".join(f"'{w}'" for s in STOP_WORDS for w in sorted({s, s.capitalize()}))
ORACLE = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(regexp_extract_all(t, '!')) AS BIGINT) AS n_bangs,
        CAST(len(list_filter(w, lambda x: x IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN cov USING (r)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        concat_ws(',', {', '.join(_sql_rule(*t) for t in THRESHOLDS)}) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM j
"""

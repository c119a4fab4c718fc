"""Secret scans with multipart credential linking.

One pass over each text finds the base kinds (assign, access, hex) with their places, and the weak parts:
identifiers, opaque strings and endpoints. A text's matches and the gaps between them come from the same pattern,
so running lengths give every place; they run within slices of PIECE matches and then over the slices, so a text's
cost stays about linear in its matches. Texts that hold parts of complementary roles are exploded, and identifiers
meet secrets in an interval join: an equality on text and scope cell, each part standing in the cells of its start
and its stop or in their neighbours, then the distance. Only parts within SCOPE of their complement are reported;
endpoints are reported near a linked pair. Built-in functions only. A cell is SCOPE characters long, so it holds a
bounded number of parts however long the text is.

Defined results: a null or empty text has no findings; a null doc_id stays null; each input row gives a row; texts and
parts may be of any length; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm import scratch

#: Code points between two parts of one credential.
SCOPE = 200
#: Matches whose lengths are summed one by one.
PIECE = 256

# The kinds in their order, with pattern, the group whose length counts, its least length, and the role.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "secret"),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, "identifier"),
    ("hex", r"[0-9a-f]{24,}", 0, 24, "secret"),
    ("identifier", r"""(?i:access_?key_?id|client_?id|user_?name|account_?id|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 1, 3, "identifier"),
    ("opaque", r"[A-Za-z0-9+/]{28,}={0,2}", 0, 28, "secret"),
    ("endpoint", r"""[a-z][a-z0-9+.-]*://[A-Za-z0-9][^\x20\x09-\x0D"'<>]*""", 0, 8, "endpoint"),
]
BASE = ("assign", "access", "hex")


def matches(text: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """The leftmost non-overlapping matches as structs of start, rank, stop (code points), without those too short."""
    whole = f"regexp_extract_all({text}, {_quoted(pattern)}, 0)"
    inner = whole if group == 0 else f"regexp_extract_all({text}, {_quoted(pattern)}, {group})"
    gaps = f"split({text}, {_quoted(pattern)}, -1)"
    span = "STRUCT<start: INT, stop: INT, size: INT>"
    within = f"""aggregate(slice(p, CAST(k * {PIECE} + 1 AS INT), {PIECE}), named_struct('at', 0, 'out', CAST(array() AS ARRAY<{span}>)),
        (s, x) -> named_struct('at', s.at + length(x.g) + length(x.m), 'out',
            concat(s.out, array(named_struct('start', s.at + length(x.g), 'stop', s.at + length(x.g) + length(x.m), 'size', length(x.v))))))"""
    over = f"""aggregate(transform(sequence(0, CAST((size(p) - 1) div {PIECE} AS INT)), k -> {within}), named_struct('at', 0, 'out', CAST(array() AS ARRAY<STRUCT<at: INT, out: ARRAY<{span}>>>)),
        (s, c) -> named_struct('at', s.at + c.at, 'out', concat(s.out, array(named_struct('at', s.at, 'out', c.out)))), s -> s.out)"""
    # the last gap has no match; the array of one binds p
    sql = f"""element_at(transform(array(filter(zip_with(zip_with({whole}, {inner}, (m, v) -> named_struct('m', m, 'v', v)), {gaps}, (x, g) -> named_struct('m', x.m, 'v', x.v, 'g', g)), x -> x.m IS NOT NULL)),
        p -> flatten(transform({over}, c -> transform(filter(c.out, y -> y.size >= {least}), y -> named_struct('start', c.at + y.start, 'rank', {rank}, 'stop', c.at + y.stop))))), 1)"""
    return F.when(F.expr(f"{text} RLIKE {_quoted(pattern)}"), F.expr(sql))


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _names(spans: str) -> Column:
    kinds = "array(" + ", ".join(f"'{k[0]}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat({kinds}[x.rank], ':', x.start, ':', x.stop)), ',')")


_EMPTY = "CAST(array() AS ARRAY<STRUCT<start: INT, rank: INT, stop: INT>>)"


def found(docs: DataFrame) -> DataFrame:
    """doc_id, base (base spans by start and rank) and weak (weak parts), each an array of (start, rank, stop)."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    cols = {name: matches("t", r, pattern, group, least) for r, (name, pattern, group, least, _) in enumerate(KINDS)}
    first = t.select("doc_id", "t", *[F.coalesce(cols[k], F.expr(_EMPTY)).alias(k) for k in BASE], F.coalesce(cols["identifier"], F.expr(_EMPTY)).alias("identifier"))
    # opaque strings and endpoints can only be linked to an identifier
    some = (F.size("access") > 0) | (F.size("identifier") > 0)
    rest = first.select("doc_id", F.array_sort(F.concat(*BASE)).alias("base"), "identifier", *[F.when(some, F.coalesce(cols[k], F.expr(_EMPTY))).otherwise(F.expr(_EMPTY)).alias(k) for k in ("opaque", "endpoint")])
    return rest.select("doc_id", "base", F.concat("identifier", "opaque", "endpoint").alias("weak"))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Of (row, base, weak): row and the weak parts that a complement confirms, as array `more`."""
    roles = "array(" + ", ".join(f"'{k[4]}'" for k in KINDS) + ")"
    one = parts.where("size(weak) > 0").select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*", F.expr(f"{roles}[p.rank]").alias("role"))
    # parts within scope do not overlap, so the end of one and the start of the other stand in the same cell or in neighbours
    cell = lambda c: f"CAST(floor({c} / {scope}) AS BIGINT)"
    around = lambda x: F.explode(F.expr(f"array_distinct(array({cell(x + '.start')} - 1, {cell(x + '.start')}, {cell(x + '.stop')}, {cell(x + '.stop')} + 1))")).alias("cell")
    both = F.explode(F.expr(f"array_distinct(array({cell('start')}, {cell('stop')}))")).alias("cell")
    identifiers = one.where("role = 'identifier'").select("row", F.struct("start", "rank", "stop").alias("i")).select("row", "i", around("i"))
    secrets = one.where("role = 'secret'").select("row", F.struct("start", "rank", "stop").alias("s"), both)
    apart = F.greatest(F.col("i.start"), F.col("s.start")) - F.least(F.col("i.stop"), F.col("s.stop"))
    pairs = identifiers.join(secrets, ["row", "cell"]).where(apart.between(0, scope)).select("row", "i", "s")
    ends = pairs.select("row", F.explode(F.array("i", "s")).alias("x")).distinct()
    near = ends.select("row", "x", around("x"))
    points = one.where("role = 'endpoint'").select("row", F.struct("start", "rank", "stop").alias("e"), both)
    far = F.greatest(F.col("e.start"), F.col("x.start")) - F.least(F.col("e.stop"), F.col("x.stop"))
    reached = points.join(near, ["row", "cell"]).where(far.between(0, scope)).select("row", F.col("e").alias("x"))
    weak = ends.unionByName(reached).distinct().where(F.col("x.rank") >= len(BASE))
    return weak.groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("more"))


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of spans), spans (base and linked, sorted)."""
    parts, _ = scratch.written(found(docs).withColumn("row", F.monotonically_increasing_id()), "secrets")
    more = linked(parts).withColumnRenamed("row", "of")
    return parts.join(more, parts["row"] == more["of"], "left").select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.expr(_EMPTY)))).alias("spans"))


def op10_credential_links(spark, sf_dir: str) -> DataFrame:
    each = findings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda r: F.expr(f"CAST(size(filter(base, x -> x.rank = {r})) AS BIGINT)")
    return each.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_names("base").cast("binary"), 256).alias("base_sha256"), _names("spans").alias("spans"))


def _oracle() -> str:
    parts = ["d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents)"]
    for rank, (name, pattern, group, least, role) in enumerate(KINDS):
        p = pattern.replace("'", "''")
        parts.append(f"""x_{name} AS (
  SELECT r, unnest(generate_series(1, len(m))) AS k, m, v, g FROM (
    SELECT r, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {group}) AS v, string_split_regex(t, '{p}') AS g FROM d WHERE regexp_matches(t, '{p}')))""")
        parts.append(f"""f_{name} AS (
  SELECT r, {rank} AS rank, '{name}' AS kind, '{role}' AS role, sum(length(g[k])) OVER w + sum(length(m[k])) OVER w - length(m[k]) AS a, sum(length(g[k])) OVER w + sum(length(m[k])) OVER w AS b, length(v[k]) AS n, {least} AS least
  FROM x_{name} WINDOW w AS (PARTITION BY r ORDER BY k ROWS UNBOUNDED PRECEDING))""")
    union = " UNION ALL ".join(f"SELECT * FROM f_{k[0]} WHERE n >= least" for k in KINDS)
    parts.append(f"p AS (SELECT r, rank, kind, role, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM ({union}))")
    parts.append(f"pairs AS (SELECT i.r, i.rank AS ir, i.a AS ia, i.b AS ib, s.rank AS sr, s.a AS sa, s.b AS sb FROM p i JOIN p s ON i.r = s.r AND i.role = 'identifier' AND s.role = 'secret' AND greatest(i.a, s.a) - least(i.b, s.b) BETWEEN 0 AND {SCOPE})")
    parts.append("ends AS (SELECT r, ir AS rank, ia AS a, ib AS b FROM pairs UNION SELECT r, sr, sa, sb FROM pairs)")
    parts.append(f"reached AS (SELECT DISTINCT e.r, e.rank, e.a, e.b FROM p e JOIN ends x ON e.r = x.r AND e.role = 'endpoint' AND greatest(e.a, x.a) - least(e.b, x.b) BETWEEN 0 AND {SCOPE})")
    parts.append(f"kinds AS (SELECT unnest({[k[0] for k in KINDS]}) AS kind, unnest(range({len(KINDS)})) AS rank)")
    parts.append(f"every AS (SELECT DISTINCT r, rank, a, b FROM p WHERE rank < {len(BASE)} UNION SELECT * FROM ends WHERE rank >= {len(BASE)} UNION SELECT * FROM reached)")
    parts.append(f"s AS (SELECT r, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans, string_agg(CASE WHEN rank < {len(BASE)} THEN kind || ':' || a || ':' || b END, ',' ORDER BY a, rank) AS base, count(*) FILTER (rank = 0) AS n0, count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2 FROM every JOIN kinds USING (rank) GROUP BY r)")
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access, CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (r)"
    )


ORACLE = _oracle()

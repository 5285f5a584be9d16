"""Secret scans by multipart credential linking, with DataFrame functions only.

Strong findings stand on their own. Weak candidates (user names, unnamed random strings, endpoints)
are reported only where complementary parts of a credential stand in their scope: an identifier
needs a secret, a secret an identifier, an endpoint both, and all parts are disjoint. The scope is a distance in code points, so
the parts are linked by an interval join: positions are cut into cells of the scope's length, and
parts meet over equal cells. Parts of one kind do not overlap, which bounds how many a cell holds.

Texts are scanned once, in one projection; only the lengths of findings and of the gaps between
them are kept, and running sums of those are the positions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.session import through_table

# Kind, pattern, group whose length counts, least length.
BASE = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    # Shorter runs hold no match, and a run is matched from its start: the least length may
    # stand in the pattern.
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# The bounded scheme keeps long unbroken texts linear.
WEAK = (
    (
        "user",
        r"""(?i:user|user_?name|login|account|client_?id|access_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]+""",
        0,
        1,
    ),
    ("random", r"[A-Za-z0-9+/_-]{20,}", 0, 20),
    ("endpoint", r"[A-Za-z][A-Za-z0-9+.-]{0,19}://[A-Za-z0-9._:@-]+", 0, 1),
)
KINDS = BASE + WEAK
# A random string has digits and letters of both cases.
MIXED = (r"[0-9]", r"[a-z]", r"[A-Z]")
SCOPE = 200
PART = {"access": "id", "user": "id", "assign": "key", "hex": "key", "random": "key", "endpoint": "end"}


def _findings(text: Column, number: int) -> Column:
    """Array of (kind, index, gap before, length, counts) for one kind; empty without a match."""
    kind, pattern, group, least = KINDS[number]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)

    def one(pair, index):
        good = F.length(pair["measured"]) >= least
        if kind == "random":
            for mark in MIXED:
                good = good & pair["found"].rlike(mark)
        return F.struct(
            F.lit(number).alias("kind"),
            index.alias("at"),
            F.length(pair["gap"]).alias("gap"),
            F.length(pair["found"]).alias("size"),
            good.alias("good"),
        )

    pairs = F.arrays_zip(
        found.alias("found"), measured.alias("measured"), F.slice(gaps, 1, F.size(found)).alias("gap")
    )
    return F.when(text.rlike(pattern), F.transform(pairs, one))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs`` with the secrets of its whole text.

    Returns ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base`` and ``spans``: arrays of
    ``kind:start:end`` in code points, by start and then kind, of the strong findings and of all.
    A null text counts as empty and has no findings; rows with the same id are scanned each. Other
    columns are not looked at.
    """
    text = text_of(text_col)
    found = [
        F.coalesce(_findings(text, i), F.array().cast(
            "array<struct<kind:int,at:int,gap:int,size:int,good:boolean>>"
        ))
        for i in range(len(KINDS))
    ]
    rows = through_table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.concat(*found).alias("found"),
        ),
        "findings",
    )
    running = Window.partitionBy("row", "kind").orderBy("at")
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (
        rows.select("row", F.inline("found"))
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(running))
        .where("good")
        .select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    )
    spans = through_table(spans, "spans")
    number = {kind: i for i, (kind, *_) in enumerate(KINDS)}
    part = reduce(
        lambda c, k: F.when(F.col("kind") == number[k], F.lit(PART[k])).otherwise(c), PART, F.lit(None)
    )
    parts = spans.withColumn("part", part)
    # A weak candidate looks in all cells that its scope touches, others stand in theirs.
    cells = lambda a, b: F.explode(
        F.sequence(F.floor(a / scope).cast("long"), F.floor(b / scope).cast("long"))
    )
    weak = parts.where(F.col("kind") >= len(BASE)).withColumn(
        "cell", cells(F.col("start") - scope, F.col("end") + scope)
    )
    near = parts.select(
        F.col("row").alias("r"),
        F.col("part").alias("p"),
        F.col("start").alias("s"),
        F.col("end").alias("e"),
        cells(F.col("start"), F.col("end")).alias("c"),
    )
    first = lambda p: F.min(F.when(F.col("p") == p, F.col("e"))).alias(f"{p}_end")
    last = lambda p: F.max(F.when(F.col("p") == p, F.col("s"))).alias(f"{p}_start")
    linked = (
        weak.join(
            near,
            (F.col("row") == F.col("r"))
            & (F.col("cell") == F.col("c"))
            & (F.col("part") != F.col("p"))
            & (F.col("s") <= F.col("end") + scope)
            & (F.col("e") >= F.col("start") - scope)
            # A part does not complete itself.
            & ((F.col("s") >= F.col("end")) | (F.col("e") <= F.col("start"))),
        )
        .groupBy("row", "kind", "start", "end", "part")
        .agg(first("id"), last("id"), first("key"), last("key"))
        .where(
            "(part = 'id' AND key_end IS NOT NULL) OR (part = 'key' AND id_end IS NOT NULL)"
            " OR (part = 'end' AND (id_end <= key_start OR key_end <= id_start))"
        )
        .select("row", "kind", "start", "end")
    )
    names = F.array(*(F.lit(k[0]) for k in KINDS))
    spelled = lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")
    )
    count = lambda k: F.count_if(F.col("kind") == number[k]).alias(f"n_{k}")
    listed = (
        spans.where(F.col("kind") < len(BASE))
        .unionByName(linked)
        .groupBy("row")
        .agg(
            *(count(k[0]) for k in BASE),
            F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("list"),
        )
        .select(
            "row",
            *(f"n_{k[0]}" for k in BASE),
            F.transform(F.filter("list", lambda x: x["kind"] < len(BASE)), spelled).alias("base"),
            F.transform("list", spelled).alias("spans"),
        )
    )
    none = F.array().cast("array<string>")
    return rows.select("row", "doc_id").join(listed, "row", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{k[0]}", F.lit(0)).cast("long").alias(f"n_{k[0]}") for k in BASE),
        F.coalesce("base", none).alias("base"),
        F.coalesce("spans", none).alias("spans"),
    )


# The base findings once more, as plain as they are asked for; the SQL filters by length afterwards.
SQL_BASE = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}


def scan_sql(scope: int = SCOPE) -> str:
    """DuckDB SQL for the digest of :func:`scan` over ``documents``."""
    marks = {"'": "''"}
    quote = lambda p: "'" + "".join(marks.get(c, c) for c in p) + "'"
    selects = []
    for i, (kind, pattern, group, least) in enumerate(KINDS):
        pattern = SQL_BASE.get(kind, pattern)
        good = f"length(m) >= {least}"
        if kind == "random":
            good += "".join(f" AND regexp_matches(f, '{mark}')" for mark in MIXED)
        selects.append(
            f"""SELECT doc_id, {i} AS kind, s + length(g) AS start, s + length(g) + length(f) AS stop FROM (
  SELECT *, coalesce(sum(length(g) + length(f)) OVER (PARTITION BY doc_id ORDER BY num
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM (
    SELECT doc_id, unnest(range(len(fs))) AS num, unnest(fs) AS f, unnest(ms) AS m, unnest(gs[:len(fs)]) AS g FROM (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), {quote(pattern)}) AS fs,
        regexp_extract_all(coalesce(text, ''), {quote(pattern)}, {group}) AS ms,
        string_split_regex(coalesce(text, ''), {quote(pattern)}) AS gs
      FROM documents WHERE regexp_matches(text, {quote(pattern)})))) WHERE {good}"""
        )
    part = " ".join(
        f"WHEN {[k[0] for k in KINDS].index(k)} THEN '{p}'" for k, p in PART.items()
    )
    names = "[" + ", ".join(f"'{k[0]}'" for k in KINDS) + "]"
    base = len(BASE)
    text = f"{names}[kind + 1] || ':' || start || ':' || stop"
    counts = ", ".join(
        f"count(*) FILTER (kind = {i}) AS n_{k[0]}" for i, k in enumerate(BASE)
    )
    union = "\nUNION ALL\n".join(selects)
    return f"""
WITH found AS MATERIALIZED (SELECT doc_id, kind, start::BIGINT AS start, stop::BIGINT AS stop,
  CASE kind {part} END AS part FROM ({union})),
linked AS (
  SELECT w.doc_id, w.kind, w.start, w.stop FROM found w JOIN found n ON w.doc_id = n.doc_id
    AND w.part <> n.part AND n.start <= w.stop + {scope} AND n.stop >= w.start - {scope}
    AND (n.start >= w.stop OR n.stop <= w.start)
  WHERE w.kind >= {base} GROUP BY w.doc_id, w.kind, w.start, w.stop, w.part
  HAVING (w.part = 'id' AND bool_or(n.part = 'key')) OR (w.part = 'key' AND bool_or(n.part = 'id'))
    OR (w.part = 'end' AND (
      min(n.stop) FILTER (n.part = 'id') <= max(n.start) FILTER (n.part = 'key')
      OR min(n.stop) FILTER (n.part = 'key') <= max(n.start) FILTER (n.part = 'id')))
), listed AS (
  SELECT doc_id, {counts},
    string_agg({text}, ',' ORDER BY start, kind) FILTER (kind < {base}) AS base,
    string_agg({text}, ',' ORDER BY start, kind) AS spans
  FROM (SELECT doc_id, kind, start, stop FROM found WHERE kind < {base} UNION ALL FROM linked) GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""

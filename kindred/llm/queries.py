"""The operators as queries over the test tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import (
    align,
    chat,
    decontaminate,
    exact,
    extract,
    jaccard,
    lm,
    mixing,
    quality,
    secrets,
    shards,
    trie,
    urls,
)
from kindred.llm.common import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query(
    "op2_exact_dedup",
    r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY bare) AS group_size,
  row_number() OVER (PARTITION BY bare ORDER BY points DESC, doc_id) = 1 AS kept,
  sha256(bare) AS text_sha256
FROM t
""",
)
def op2(spark, sf):
    return exact.deduplicate(table(spark, sf, "documents"))


@query(
    "op5_source_mixing",
    r"""
WITH t AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('mix:' || doc_id::VARCHAR) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM t GROUP BY source
), w AS (
  SELECT *, sum(source_size) OVER ()
      - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 3 * source_size / weight, source
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
  FROM s
), r AS (
  SELECT min_by(words::DOUBLE / weights::DOUBLE, 3 * source_size / weight) AS rate FROM w
  WHERE 3 * source_size::DOUBLE * weights >= weight * words::DOUBLE
), g AS (
  SELECT source, source_size,
    CASE WHEN 3 * source_size::DOUBLE * weights < weight * words::DOUBLE
      THEN (3 * source_size)::DOUBLE ELSE weight * rate END AS target
  FROM w, r
), p AS (
  SELECT t.doc_id, t.size, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END::BIGINT AS copies,
    (sum(size) OVER (PARTITION BY t.source ORDER BY key, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  copies * size + greatest(0, least(size, round(target)::BIGINT - copies * source_size - start)) AS taken
FROM p
""",
)
def op5(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op7_minimax_sharding")
def op7(spark, sf):
    return shards.shard(table(spark, sf, "documents"))


@query(
    "op10_ngram_jaccard",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3),
      lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w
), n AS MATERIALIZED (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM n a JOIN n b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM s
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, min(reached.other) AS component_id
FROM s JOIN reached USING (doc_id) GROUP BY ALL
""",
)
def op10(spark, sf):
    return jaccard.similarity_classes(table(spark, sf, "documents"))


@query("op3_quality_classifier")
def op3(spark, sf):
    return quality.classify(
        table(spark, sf, "documents"), table(spark, sf, "labels"), remainder("doc_id", 3) == 1
    )


@query("op4_lm_scoring")
def op4(spark, sf):
    return lm.perplexities(table(spark, sf, "documents"), remainder("doc_id", 5) == 1).drop("perplexity")


@query("op1_secret_scan", secrets.scan_sql())
def op1(spark, sf):
    found = secrets.scan(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.concat_ws(",", "base"), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"),
    )


@query("op8_benchmark_decontamination")
def op8(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query(
    "op9_chat_formatting",
    r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### : </turn>') + 1 + length(regexp_replace(role, '[\\#<:]', '..', 'g')) + length(regexp_replace(text, '[\\#<]', '..', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
""",
)
def op9(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.unionByName(hard)))


@query("op6_url_filter")
def op6(spark, sf):
    return urls.judge(table(spark, sf, "pages")).drop("log_odds")


@query(
    "op11_prefix_trie",
    r"""
WITH t AS (
  SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS bytes,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS place
  FROM conversations
), c AS (
  SELECT DISTINCT conv_id, xor(4294967295::BIGINT, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda crc, b: list_reduce(range(8),
      lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, b)),
    4294967295::BIGINT)) % 9 AS h
  FROM conversations
), r AS (
  SELECT c.conv_id, place, mark, bytes FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND place <= h
  UNION ALL
  SELECT c.conv_id, place, mark, bytes FROM c JOIN t ON t.conv_id = c.conv_id AND place > h
), p AS (
  SELECT conv_id, bytes, row_number() OVER w AS depth, string_agg(mark, '') OVER w AS prefix
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), e AS (
  SELECT prefix, string_agg(conv_id, ',' ORDER BY conv_id) AS ends
  FROM (SELECT conv_id, max_by(prefix, depth) AS prefix FROM p GROUP BY conv_id) GROUP BY prefix
), n AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved
  FROM p GROUP BY prefix, depth
), k AS (
  SELECT left(prefix, 32 * (depth - 1)::INT) AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), s AS (
  SELECT left(n.prefix, 32 * up::INT) AS prefix, sum(saved) AS saved,
    count(*) FILTER (k.n_children IS NULL) AS n_leaves
  FROM n LEFT JOIN k USING (prefix), unnest(range(depth + 1)) u(up) GROUP BY ALL
)
SELECT n.conv_id, n.depth::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, s.saved::BIGINT AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM n JOIN s USING (prefix) LEFT JOIN k USING (prefix) LEFT JOIN e USING (prefix)
  LEFT JOIN n m ON m.prefix = left(n.prefix, 32 * (n.depth - 1)::INT) AND m.depth = n.depth - 1
""",
)
def op11(spark, sf):
    return trie.trie(trie.rebuild(trie.sequences(table(spark, sf, "conversations"))))


@query("op12_tokenizer_alignment")
def op12(spark, sf):
    return align.alignment_report(table(spark, sf, "documents"))


@query("op13_html_extraction")
def op13(spark, sf):
    return extract.extract(table(spark, sf, "pages"))


@query("pipeline")
def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)

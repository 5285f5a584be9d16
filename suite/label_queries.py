"""Cluster labels on the documents, with the source as cluster."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import labels
from kindred.operators import vocabulary as voc
from kindred.session import scratch_path, through_table
from kindred.sources import reports
from suite import views
from suite.registry import query
from suite.sql import with_ctes


@query("doc_freq", with_ctes("df", "SELECT token, df FROM df"))
def doc_freq(spark, sf):
    return labels.document_frequency(labels.cluster_token_counts(views.tokens(spark, sf)))


@query("cluster_sizes", "SELECT source AS cluster_id, count(*) AS size FROM documents GROUP BY source")
def cluster_sizes(spark, sf):
    return labels.cluster_sizes(views.tokens(spark, sf))


@query("cluster_doc_freq", with_ctes("ct", "SELECT cluster_id, token, cluster_df FROM ct"))
def cluster_doc_freq(spark, sf):
    return labels.cluster_token_counts(views.tokens(spark, sf))


def _top(spark, sf, by):
    return labels.top_tokens(labels.token_scores(views.tokens(spark, sf)), by).withColumn(
        "score", F.round("score", 6) + F.lit(0.0)
    )


@query(
    "cluster_f1",
    with_ctes(
        "top_f1",
        "SELECT cluster_id, token, round(score, 6) + 0.0 AS score, CAST(rank AS INTEGER) AS rank FROM top_f1",
    ),
)
def cluster_f1(spark, sf):
    return _top(spark, sf, "f1")


@query(
    "cluster_ig",
    with_ctes(
        "top_gain",
        "SELECT cluster_id, token, round(score, 6) + 0.0 AS score, CAST(rank AS INTEGER) AS rank FROM top_gain",
    ),
)
def cluster_ig(spark, sf):
    return _top(spark, sf, "gain")


def _fused(spark, sf):
    scores = through_table(labels.token_scores(views.tokens(spark, sf)), "scores")
    return labels.fused_ranking(scores)


@query(
    "rank_fusion",
    with_ctes("fused", "SELECT cluster_id, word, score, CAST(rank AS INTEGER) AS rank FROM fused"),
)
def rank_fusion(spark, sf):
    return _fused(spark, sf)


@query(
    "candidates",
    with_ctes(
        "fused",
        """SELECT cluster_id, string_agg(word, ',' ORDER BY rank) AS words,
               string_agg(printf('%.3f', score), ',' ORDER BY rank) AS scores
        FROM fused GROUP BY cluster_id""",
    ),
)
def candidates(spark, sf):
    lists = labels.candidate_lists(_fused(spark, sf))
    return lists.select(
        "cluster_id",
        F.array_join("candidates.word", ",").alias("words"),
        F.array_join(
            F.transform("candidates.score", lambda s: F.format_string("%.3f", s)), ","
        ).alias("scores"),
    )


@query(
    "candidate_lines",
    with_ctes(
        "fused",
        """SELECT cluster_id || ' : [' || string_agg('(''' || word || ''', ' || CAST(score AS VARCHAR) || ')',
               ', ' ORDER BY rank) || ']' AS line FROM fused GROUP BY cluster_id""",
    ),
)
def candidate_lines(spark, sf):
    """Written as text and read back."""
    path = scratch_path(spark, "candidates")
    lines = reports.candidate_lines(labels.candidate_lists(_fused(spark, sf)))
    reports.write_lines(lines, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(
    "candidate_file",
    with_ctes(
        "fused",
        """SELECT 0::BIGINT AS place, 'cluster_id : candidate word' AS line
        UNION ALL SELECT row_number() OVER (ORDER BY cluster_id), cluster_id || ' : [' || string_agg('(' || chr(39) || word
            || chr(39) || ', ' || CAST(score AS VARCHAR) || ')', ', ' ORDER BY rank) || ']' FROM fused GROUP BY cluster_id""",
    ),
)
def candidate_file(spark, sf):
    """The written report with its header, read back with the places of its lines."""
    path = scratch_path(spark, "candidate-file")
    reports.write_candidates(labels.candidate_lists(_fused(spark, sf)), path)
    return reports.read_lines(spark, path)


@query(
    "cluster_keywords",
    with_ctes(
        "keywords",
        """SELECT cluster_id, string_agg(word, ',' ORDER BY pos) AS key_word
        FROM keywords GROUP BY cluster_id""",
    ),
)
def cluster_keywords(spark, sf):
    docs = views.tokens(spark, sf)
    return views.keywords_by_source(docs).withColumn("key_word", F.array_join("key_word", ","))


@query(
    "record_keywords",
    with_ctes(
        "keywords tokens",
        """SELECT record_id, t.cluster_id, key_word FROM tokens t JOIN (
            SELECT cluster_id, string_agg(word, ',' ORDER BY pos) AS key_word
            FROM keywords GROUP BY cluster_id) k ON t.cluster_id = k.cluster_id""",
    ),
)
def record_keywords(spark, sf):
    docs = views.tokens(spark, sf)
    records = docs.select("record_id", "cluster_id")
    named = labels.attach_keywords(records, views.keywords_by_source(docs))
    return named.select("record_id", "cluster_id", F.array_join("key_word", ",").alias("key_word"))


def named_clusters(docs):
    """(cluster_id, key_word, key_phrase) of a token table."""
    keywords = through_table(views.keywords_by_source(docs), "keywords")
    report = voc.keyword_report(docs, keywords.select(F.explode("key_word").alias("keyword")))
    return labels.key_phrases(keywords, report)


@query(
    "key_phrases",
    with_ctes(
        "named",
        """SELECT cluster_id, array_to_string(key_word, ',') AS key_word,
               array_to_string(key_phrase, ';') AS key_phrase FROM named""",
    ),
)
def key_phrases(spark, sf):
    return named_clusters(views.tokens(spark, sf)).select(
        "cluster_id",
        F.array_join("key_word", ",").alias("key_word"),
        F.array_join("key_phrase", ";").alias("key_phrase"),
    )


@query(
    "keyword_table",
    with_ctes(
        "named tokens",
        """SELECT record_id, array_to_string(key_word, ',') AS key_word,
               array_to_string(key_phrase, ';') AS key_phrase
        FROM tokens JOIN named USING (cluster_id)""",
    ),
)
def keyword_table(spark, sf):
    docs = views.tokens(spark, sf)
    records = docs.select("record_id", "cluster_id")
    return labels.attach_keywords(records, named_clusters(docs)).select(
        "record_id",
        F.array_join("key_word", ",").alias("key_word"),
        F.array_join("key_phrase", ";").alias("key_phrase"),
    )


@query(
    "cluster_tags",
    with_ctes(
        "messages tokens",
        """SELECT m.record_id, message, cluster_id FROM messages m JOIN tokens t
        ON m.record_id = t.record_id""",
    ),
)
def cluster_tags(spark, sf):
    records = views.records(spark, sf)
    return views.messages(spark, sf).join(
        records.select("record_id", F.col("project").alias("cluster_id")), "record_id"
    )

"""Keywords for clusters. Input: (record_id, cluster_id, tokens)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import through_table

TOP_TOKENS = 10
KEYWORDS = 3
FIRST_POINTS, POINT_STEP = 2.0, 0.1
_LOG_EPSILON = 1e-10


def cluster_token_counts(records: DataFrame) -> DataFrame:
    """(cluster_id, token, cluster_df): records of the cluster with the token.

    Repeats inside a record fall away in the row; counts are partial before the shuffle.
    """
    return (
        records.select("cluster_id", F.explode(F.array_distinct("tokens")).alias("token"))
        .groupBy("cluster_id", "token")
        .agg(F.count(F.lit(1)).alias("cluster_df"))
    )


def document_frequency(cluster_counts: DataFrame) -> DataFrame:
    """(token, df), summed from the per-cluster counts instead of the texts."""
    return cluster_counts.groupBy("token").agg(F.sum("cluster_df").alias("df"))


def cluster_sizes(records: DataFrame) -> DataFrame:
    """(cluster_id, size)."""
    return records.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


def _f1(count: Column, df: Column, size: Column) -> Column:
    precision, recall = count / df, count / size
    return 2 * precision * recall / (precision + recall)


def _gain(count: Column, df: Column, size: Column, total: Column) -> Column:
    """Two terms of an information gain; the second is 0 when it is empty."""
    inside = count / df
    outside_count = total - size - (df - count)
    outside = F.when(
        outside_count != 0, outside_count / F.nullif(total - df, F.lit(0))
    ).otherwise(F.lit(0.0))
    return df / total * inside * F.log(inside + F.lit(_LOG_EPSILON)) + (
        total - df
    ) / total * outside * F.log(outside + F.lit(_LOG_EPSILON))


def token_scores(records: DataFrame) -> DataFrame:
    """(cluster_id, token, f1, gain), both rounded to 12 digits.

    The counts are stored, so the texts are read once, and so are the frequencies, so
    that adaptive execution can split a token that occurs in very many clusters.
    """
    counts = through_table(cluster_token_counts(records), "cluster-tokens")
    frequencies = through_table(document_frequency(counts), "token-frequencies")
    sizes = cluster_sizes(records)
    total = sizes.agg(F.sum("size")).scalar()
    c, d, s = (F.col(x).cast("double") for x in ("cluster_df", "df", "size"))
    return (
        counts.join(frequencies, "token")
        .join(sizes, "cluster_id")
        .select(
            "cluster_id",
            "token",
            F.round(_f1(c, d, s), 12).alias("f1"),
            F.round(_gain(c, d, s, total.cast("double")), 12).alias("gain"),
        )
    )


def top_tokens(scores: DataFrame, by: str, top: int = TOP_TOKENS) -> DataFrame:
    """(cluster_id, token, score, rank) by ``f1`` or ``gain``; ties in order of the token."""
    order = Window.partitionBy("cluster_id").orderBy(F.desc(by), "token")
    return (
        scores.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("cluster_id", "token", F.col(by).alias("score"), "rank")
    )


def fused_ranking(scores: DataFrame) -> DataFrame:
    """(cluster_id, word, score, rank): points of both top-10 lists added up."""
    both = top_tokens(scores, "f1").unionByName(top_tokens(scores, "gain"))
    points = FIRST_POINTS - POINT_STEP * (F.col("rank") - 1)
    fused = both.groupBy("cluster_id", F.col("token").alias("word")).agg(
        F.round(F.sum(points), 3).alias("score")
    )
    order = Window.partitionBy("cluster_id").orderBy(F.desc("score"), "word")
    return fused.withColumn("rank", F.row_number().over(order))


def candidate_lists(fused: DataFrame) -> DataFrame:
    """(cluster_id, candidates): at most 20 (rank, word, score) per cluster, in order."""
    return fused.groupBy("cluster_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "word", "score"))).alias("candidates")
    )


def cluster_keywords(candidates: DataFrame, keywords: int = KEYWORDS) -> DataFrame:
    """(cluster_id, key_word ARRAY): the first candidates that are not numbers."""
    words = F.filter("candidates.word", lambda w: ~w.rlike(r"^\p{Nd}+$"))
    return candidates.select("cluster_id", F.slice(words, 1, keywords).alias("key_word"))


def key_phrases(keywords: DataFrame, report: DataFrame) -> DataFrame:
    """(cluster_id, key_word, key_phrase): phrases of the keywords in keyword order."""
    ranked = keywords.select("cluster_id", F.posexplode("key_word").alias("pos", "keyword"))
    phrases = (
        ranked.join(report.select("keyword", "phrases"), "keyword")
        .groupBy("cluster_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "phrases"))).alias("found"))
        .select("cluster_id", F.flatten("found.phrases").alias("key_phrase"))
    )
    return keywords.join(phrases, "cluster_id", "left").select(
        "cluster_id",
        "key_word",
        F.coalesce("key_phrase", F.array().cast("array<string>")).alias("key_phrase"),
    )


def attach_keywords(records: DataFrame, keywords: DataFrame) -> DataFrame:
    """Every record gets the keywords of its cluster."""
    return records.join(keywords, "cluster_id", "left")

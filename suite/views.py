"""Record tables built from the test tables. ``suite.sql`` defines the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.config import TEXT_FIELDS
from kindred.functions import text as tx
from kindred.functions.scalars import message
from kindred.operators import embedding, labels, vocabulary
from kindred.session import spread, through_table

AS_OF = "2025-06-01 00:00:00"
# Length, first letter, last letter, number of "e": a fixed vector per word.
WORD_SIZE = 4


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def record_id(column: str = "doc_id") -> Column:
    return F.format_string("R%07d", F.col(column))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """The record table: documents with their labels, split into fields.

    The oldest record with the same text is the known duplicate. Copies are counted by a
    digest of the text, so only digests and ids are aggregated.
    """
    documents = spread(table(spark, sf, "documents"), "doc_id").withColumn("digest", F.sha2("text", 256))
    first_copies = (
        documents.groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", record_id("first_doc").alias("first_id"))
    )
    lines = F.split("text", "\n")
    own = record_id()
    return (
        documents.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
        .join(first_copies, "digest", "left")
        .select(
            own.alias("record_id"),
            F.concat_ws("-", "source", "lang").alias("component"),
            F.col("source").alias("project"),
            F.col("lang").alias("product"),
            F.concat(F.lit("m"), (F.col("doc_id") % 17).cast("string")).alias("manager"),
            F.coalesce(F.col("quality").cast("string"), F.lit("none")).alias("severity"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
            .cast("timestamp")
            .alias("submitted_on"),
            F.get(lines, 0).alias("headline"),
            F.get(lines, 1).alias("attribute"),
            F.col("text").alias("description"),
            F.get(lines, 2).alias("symptoms"),
            F.get(lines, 3).alias("conditions"),
            F.get(lines, 4).alias("workarounds"),
            F.get(lines, 5).alias("release_note"),
            F.when(F.col("first_id") < own, F.col("first_id")).alias("duplicate_of"),
            F.concat(F.lit("e"), (F.col("doc_id") % 23).cast("string")).alias("engineer"),
        )
    )


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    """(record_id): the records under review, those labelled toxic."""
    return table(spark, sf, "labels").where("toxic = 1").select(record_id().alias("record_id"))


def new_records(spark: SparkSession, sf: str) -> DataFrame:
    """The items of ``benchmark`` in the shape of records; not part of the corpus."""
    item = F.col("item_id")
    lines = F.split("text", "\n")
    return table(spark, sf, "benchmark").select(
        F.format_string("B%07d", item).alias("record_id"),
        F.lit("new-en").alias("component"),
        F.lit("new").alias("project"),
        F.lit("en").alias("product"),
        F.concat(F.lit("m"), (item % 17).cast("string")).alias("manager"),
        F.lit("none").alias("severity"),
        F.lit("2024-06-01").cast("timestamp").alias("submitted_on"),
        F.get(lines, 0).alias("headline"),
        F.get(lines, 1).alias("attribute"),
        F.col("text").alias("description"),
        *[F.get(lines, i + 2).alias(f) for i, f in enumerate(TEXT_FIELDS[3:])],
        F.lit(None).cast("string").alias("duplicate_of"),
        F.concat(F.lit("e"), (item % 23).cast("string")).alias("engineer"),
    )


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    """(record_id, cluster_id, tokens): clean tokens of each document, source as cluster.

    A stored table, because the queries read it more than once.
    """
    documents = spread(table(spark, sf, "documents"), "doc_id")
    cleaned = documents.select(
        record_id().alias("record_id"),
        F.col("source").alias("cluster_id"),
        tx.clean_tokens(F.col("text")).alias("tokens"),
    )
    return through_table(cleaned, "tokens")


def word_vectors(token_table: DataFrame) -> DataFrame:
    """(word, vector): a fixed vector for every word."""
    words = vocabulary.vocabulary(token_table)
    token = F.col("token")
    parts = [
        F.length(token),
        F.ascii(token),
        F.ascii(F.right(token, F.lit(1))),
        F.length(token) - F.length(F.replace(token, F.lit("e"), F.lit(""))),
    ]
    vectors = words.select(
        token.alias("word"), F.array(*[p.cast("double") for p in parts]).alias("vector")
    )
    return through_table(vectors, "words")


def document_vectors(docs: DataFrame) -> DataFrame:
    """(record_id, cluster_id, vec): mean word vector per document of a token table.

    Clusters have about 20 records, as fitted ones do, and their number grows with the
    documents: a source within 400 ids.
    """
    bucket = F.floor(F.substring("record_id", 2, 20).cast("long") / 400).cast("string")
    docs = docs.withColumn("cluster_id", F.concat_ws("-", "cluster_id", bucket))
    vectors = embedding.embed(
        docs, word_vectors(docs), WORD_SIZE, keys=("record_id", "cluster_id")
    )
    return vectors.withColumnRenamed("vector", "vec")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """(record_id, cluster_id, vec) from the embeddings table, label as cluster."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("record_id"),
        F.col("label").alias("cluster_id"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


def as_queries(corpus: DataFrame) -> DataFrame:
    return corpus.select(
        F.col("record_id").alias("query_id"), "cluster_id", F.col("vec").alias("query_vec")
    )


def keywords_by_source(docs: DataFrame) -> DataFrame:
    """(cluster_id, key_word): keywords of each source."""
    scores = through_table(labels.token_scores(docs), "scores")
    return labels.cluster_keywords(labels.candidate_lists(labels.fused_ranking(scores)))


def keyword_list(docs: DataFrame) -> DataFrame:
    """(keyword): the distinct keywords of all sources, as a stored table."""
    keywords = keywords_by_source(docs).select(F.explode("key_word").alias("keyword"))
    return through_table(keywords.distinct(), "keywords")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).select("record_id", message().alias("message"))

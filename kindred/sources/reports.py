"""Plain-text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ---- Fixed values: first lines of the reports -------------------------------
KEYWORD_HEADER = "keyword,count,related phrase,related keyword,number of related bugs"
CANDIDATE_HEADER = "cluster_id : candidate word"
# -----------------------------------------------------------------------------


def keyword_report_line() -> Column:
    """keyword, count, phrases, words, number of records; lists joined by ``;``."""
    return F.concat_ws(
        ",",
        "keyword",
        F.col("count").cast("string"),
        F.array_join("phrases", ";"),
        F.array_join("words", ";"),
        F.col("n_records").cast("string"),
    )


def keyword_report_lines(report: DataFrame) -> DataFrame:
    return report.select("keyword", keyword_report_line().alias("line"))


def candidate_lines(candidates: DataFrame) -> DataFrame:
    """One line per cluster: ``id : [(word, score), ...]``.

    ``candidates`` holds (cluster_id, candidates ARRAY<STRUCT<rank, word, score>>).
    """
    pairs = F.transform(
        "candidates",
        lambda c: F.concat(
            F.lit("('"), c.word, F.lit("', "), c.score.cast("string"), F.lit(")")
        ),
    )
    return candidates.select(
        "cluster_id",
        F.concat(
            F.col("cluster_id").cast("string"),
            F.lit(" : ["),
            F.array_join(pairs, ", "),
            F.lit("]"),
        ).alias("line"),
    )


def write_lines(lines: DataFrame, path: str, header: str | None = None) -> None:
    """Lines in the order of their partitions; a header is the first line of the first file."""
    lines = lines.select("line")
    if header is not None:
        first = lines.sparkSession.range(0, 1, 1, 1).select(F.lit(header).alias("line"))
        lines = first.unionAll(lines)
    lines.write.text(path)


def write_keyword_report(report: DataFrame, path: str) -> None:
    """The report under its header, most frequent keywords first, then by name."""
    ordered = report.orderBy(F.col("count").desc(), "keyword")
    write_lines(keyword_report_lines(ordered), path, KEYWORD_HEADER)


def write_candidates(candidates: DataFrame, path: str) -> None:
    """One line per cluster under the header, by cluster."""
    write_lines(candidate_lines(candidates.orderBy("cluster_id")), path, CANDIDATE_HEADER)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(place, line): the lines of a report in order; ``place`` counts from 0 without gaps.

    Files are numbered by name, so a prefix sum over one row per file gives each file its first place.
    """
    name = F.col("_metadata.file_name")
    lines = spark.read.option("wholetext", False).text(path).select(
        name.alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )
    within = Window.partitionBy("file", "block").orderBy("row")
    lines = lines.withColumn("at", F.row_number().over(within) - 1)
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return lines.join(starts, ["file", "block"]).select((F.col("start") + F.col("at")).alias("place"), "line")

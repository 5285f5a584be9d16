"""From raw documents to shards of training data.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import decontaminate, jaccard, mixing, quality, shards
from kindred.llm.common import free_name, remainder
from kindred.session import through_table


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Stored documents with a number for each row, so that repeated and null ids stay apart."""
    name = free_name("row", docs.columns)
    return through_table(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects; it learns from the labels that are not held out.

    A null text counts as empty and is judged like any other. Rows are judged one by one: repeated rows
    stay or go alike, null ids have no label. Without documents there are no rows. Columns may have any
    name.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").alias("label"))
    # Labels are joined before anything is measured.
    learnt = docs.select("doc_id", "text").where(remainder("doc_id", 3) != 1).join(known, "doc_id")
    learnt = learnt.select(F.struct("doc_id", "label").alias("of"), "text")
    measured = quality.measure(learnt, "of").select("doc_id.doc_id", "doc_id.label", "stats")
    model = quality.fit(through_table(measured, "stats"))
    # A score needs only the text, so documents are judged where they are read.
    return quality.keep(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked ones: the one with the smallest id, then the first row.

    Rows without an id stand behind all others, so one of them stays where a group has no id at all.
    Rows without words are linked with nothing and stay. Columns may have any name.
    """
    rows, row = _numbered(docs)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(row).alias("row"))
    groups = jaccard.similarity_classes(rows.select(place.alias("place"), "text"), "place")
    its_row = free_name("its_row", rows.columns)
    dropped = through_table(
        groups.where("doc_id.row <> component_id.row").select(F.col("doc_id.row").alias(its_row)),
        "dropped",
    )
    return rows.join(dropped, rows[row] == dropped[its_row], "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item stands; null and blank texts stay.

    Rows are judged one by one, whatever their ids; columns may have any name.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the mix takes them.

    The one document of a source that the budget cuts through stays whole if at least half of it is
    within the budget; documents without words stay away from the mix.
    """
    rows, row = _numbered(docs)
    its_row, copies = (free_name(n, rows.columns) for n in ("its_row", "copies"))
    part = F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)
    # The mix sees no other columns, so that none can clash with its own.
    plain = rows.select("doc_id", "source", "text", F.col(row).alias("_its_row"))
    times = mixing.mix(plain, keep=("_its_row",)).select(
        F.col("_its_row").alias(its_row), F.array_repeat(F.lit(0), (F.col("copies") + part).cast("int")).alias(copies)
    )
    taken = times.where(F.size(copies) > 0).select(its_row, F.explode(copies).alias(copies))
    return rows.join(taken, rows[row] == taken[its_row]).select(*(rows[c] for c in docs.columns))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot; a column that has the name of a result gets ``_`` added.

    A null text has the size of an empty one; equal texts share a shard, repeated rows are kept.
    """
    return shards.shard(docs, keep=tuple(docs.columns))


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Stages 1 and 5 cannot be expressed in SQL. Tests run stages 2 and 3 against brute-force versions,
# stages 1 and 4 against their operators, and hold stage 5 to its rows and loads.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = through_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Exact duplicates by distributed MSD radix partitioning.

Texts are byte strings without blanks. A round splits each group by its next bytes: rows are
grouped by (group, next bytes), the smallest row number of a part names the new group. A part with
one row is done, and so is a part whose bytes have ended, which holds equal texts. The other parts
go on with their remaining bytes. The number of bytes per round grows by a fixed factor, so that the
rounds grow with the logarithm of the longest text; no digest decides anything.

Splitting is a partial aggregation and a join with one row per part, so a group that holds a third
of all rows is neither gathered in a task nor sorted as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import BLANK, rows_of, text_of
from kindred.session import through_table


def radix_groups(rows: DataFrame, first: int = 64, growth: int = 4) -> DataFrame:
    """Groups rows with equal bytes.

    ``rows``: a stored table of ``row`` (unique long), ``head`` (the first ``first`` bytes) and
    ``tail`` (the others). Returns ``row``, ``grp`` (the smallest row of its group) and ``n``.
    """
    done = []
    width = first
    active = rows.select("row", F.lit(0).cast("long").alias("grp"), F.col("head").alias("chunk"))
    rest = None
    while True:
        parts = active.groupBy("grp", "chunk").agg(
            F.min("row").alias("part"), F.count(F.lit(1)).alias("n")
        )
        ended = (F.col("n") == 1) | (F.length("chunk") < width)
        split = active.join(parts, ["grp", "chunk"]).withColumn("ended", ended)
        keep = ["row", F.col("part").alias("grp"), "n", "ended"]
        if rest:
            keep.append(F.when(~F.col("ended"), F.col("rest")).alias("rest"))
        level = through_table(split.select(*keep), "radix")
        done.append(level.where("ended").select("row", "grp", "n"))
        level = level.where("not ended")
        if not rows_of(level):
            return reduce(DataFrame.unionByName, done)
        if not rest:
            level = through_table(
                level.join(rows.select("row", F.col("tail").alias("rest")), "row"), "radix"
            )
            rest = True
        width *= growth
        active = level.select(
            "row",
            "grp",
            F.substring("rest", 1, width).alias("chunk"),
            F.expr(f"substring(rest, {width + 1})").alias("rest"),
        )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: int = 64
) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    Texts are equal when identical after deleting every blank; a null text counts as empty. Of equal
    texts the one with the most code points stays, then the smallest id, a null id last; of rows that
    agree in all of that, one. Returns ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` (of the text without blanks). Other columns of ``docs`` are not looked at; an
    empty table gives an empty result.
    """
    bare = F.regexp_replace(text_of(text_col), BLANK, "").cast("binary")
    rows = through_table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.length(text_of(text_col)).alias("points"),
            bare.alias("bare"),
        ).select(
            "row",
            "doc_id",
            "points",
            F.sha2("bare", 256).alias("text_sha256"),
            F.substring("bare", 1, first).alias("head"),
            F.expr(f"substring(bare, {first + 1})").alias("tail"),
        ),
        "texts",
    )
    info = rows.select("row", "doc_id", "points", "text_sha256")
    grouped = through_table(radix_groups(rows, first).join(info, "row"), "groups")
    best = F.min(
        F.struct(
            (-F.col("points")).alias("less"),
            F.col("doc_id").isNull().alias("no_id"),
            "doc_id",
            "row",
        )
    )
    several = grouped.where("n > 1")
    keepers = several.groupBy("grp").agg(best.alias("best"))
    out = ["doc_id", "keep_id", F.col("n").alias("group_size"), "kept", "text_sha256"]
    return (
        several.join(keepers, "grp")
        .withColumns(
            {"keep_id": F.col("best.doc_id"), "kept": F.col("row") == F.col("best.row")}
        )
        .select(*out)
        .unionByName(
            grouped.where("n = 1")
            .withColumns({"keep_id": F.col("doc_id"), "kept": F.lit(True)})
            .select(*out)
        )
    )

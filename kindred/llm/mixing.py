"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source, documents stand in the order of the key:
the key's first hexadecimal digits cut a source into 4096 ranges of about equal size, whose sums
give each range its offset, and a running sum inside a range does the rest. The order is therefore
a range sort with known bounds, and a source with a third of all rows is spread over its ranges.
A source whose target exceeds its size is taken whole as often as it fits; what is left of the
target is cut off the ordered documents to the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import kept_names, words_in
from kindred.session import through_table

DIGITS = 3  # of the key, 16 ** 3 ranges in a source


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Adds ``target`` to a table of one row per source with ``source`` and ``source_size``.

    Sources in the order of their code points, null last, weigh ``weights`` in turn. Targets share
    the sum of all sizes by weight, none above ``most`` times its source's size; the excess is
    shared again by weight until none is above. Sources that stop are the first ones by
    size / weight, so one pass over the sorted table finds them. The table has one row per source,
    which is why a window over all of it is small.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weighed = sizes.withColumns(
        {
            "weight": F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")),
            "cap": F.col("source_size") * most,
        }
    )
    summed = weighed.withColumns(
        {
            "left_words": F.sum("source_size").over(everything)
            - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "left_weight": F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    above = F.col("cap").cast("double") * F.col("left_weight") < (
        F.col("weight") * F.col("left_words").cast("double")
    )
    share = F.col("left_words") / F.col("left_weight")
    # The first source that does not stop has the share of all that follow.
    rate = F.min_by(
        F.when(~F.col("stops"), share), F.when(~F.col("stops"), F.col("cap") / F.col("weight"))
    ).over(everything)
    return (
        summed.withColumn("stops", above)
        .withColumn("rate", rate)
        .select(
            "source",
            "source_size",
            F.when(F.col("stops"), F.col("cap").cast("double"))
            .otherwise(F.col("weight") * F.col("rate"))
            .alias("target"),
        )
    )


def random_key(column: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("null"))))


MIX = ("doc_id", "source", "size", "source_size", "target", "copies", "part", "taken")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """What the mix takes of every document.

    Returns one row per row of ``docs``: ``doc_id``, ``source``, ``size`` (words), ``source_size``,
    ``target`` (its source's), ``copies`` (whole passes over the source), ``part`` (words of the last
    pass: all, none, or some for the one document at the cut), ``taken`` = copies * size + part, and the
    columns ``keep`` of ``docs`` (with ``_`` added to a name that the result has).
    A null source is a source of its own; null and empty texts have size 0 and give nothing; rows
    with the same id share a key and stand side by side. The result depends on ids, sources and
    sizes alone. Other columns are not looked at.
    """
    rows = through_table(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            words_in(text_col).alias("size"),
            random_key(id_col, seed).alias("key"),
            F.struct(*keep, F.lit(0).alias("_none")).alias("kept"),
        ).withColumn("cell", F.substring("key", 1, DIGITS)),
        "sizes",
    )
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    shares = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    by_cell = Window.partitionBy("source").orderBy("cell")
    earlier = by_cell.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .withColumnRenamed("source", "its_source")
        .join(shares, F.col("its_source").eqNullSafe(F.col("source")))
        .select("its_source", F.col("cell").alias("its_cell"), "offset", "source_size", "target")
    )
    placed = rows.join(
        offsets,
        F.col("source").eqNullSafe(F.col("its_source")) & (F.col("cell") == F.col("its_cell")),
    )
    inside = (
        Window.partitionBy("source", "cell")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    start = F.col("offset") + F.sum("size").over(inside) - F.col("size")
    copies = F.when(
        F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))
    ).otherwise(0)
    left = F.round("target").cast("long") - F.col("copies") * F.col("source_size")
    return (
        placed.withColumn("start", start)
        .withColumn("copies", copies.cast("long"))
        .withColumn("part", F.greatest(F.lit(0), F.least("size", left - F.col("start"))).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))
        .select(*MIX, *(F.col("kept")[c].alias(n) for c, n in zip(keep, kept_names(keep, MIX))))
    )

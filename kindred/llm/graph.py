"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import through_table


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every linked node.

    ``links``: columns ``a`` and ``b``, any order, repeated rows allowed. Alternates two steps until
    nothing changes: every node hands the smallest of its neighbours to its larger neighbours, then
    to its smaller ones. A node with very many links is a partial aggregate and one side of a join,
    never a gathered group.
    """
    edges = through_table(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = through_table(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = through_table(
            small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links"
        )

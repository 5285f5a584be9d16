"""Within-cluster distances, cluster radius and the duplicate decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.vectors import euclidean
from kindred.operators.blocks import BLOCK_ROWS
from kindred.operators.neighbors import nearest_in_group


def member_distances(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """(query_id, related_id, distance) to every other member of the query's cluster.

    ``queries``: (query_id, cluster_id, query_vec); ``corpus``: (record_id, cluster_id, vec).
    The output is the feature: each query lists its whole cluster. Rows stream through
    the join; nothing is collected per cluster.
    """
    return (
        corpus.join(queries, "cluster_id")
        .where(F.col("record_id") != F.col("query_id"))
        .select(
            "query_id",
            F.col("record_id").alias("related_id"),
            F.round(euclidean(F.col("query_vec"), F.col("vec")), 9).alias("distance"),
        )
    )


def centroid_distances(corpus: DataFrame, centroids: DataFrame) -> DataFrame:
    """(record_id, cluster_id, distance) to the centroid of the own cluster."""
    return corpus.join(centroids, "cluster_id").select(
        "record_id",
        "cluster_id",
        euclidean(F.col("vec"), F.col("centroid")).alias("distance"),
    )


def farthest_two(distances: DataFrame) -> DataFrame:
    """(cluster_id, first_id, first_distance, second_distance) from the centroid.

    Enough to know the radius without any one member. Only two rows per cluster and task
    are shuffled.
    """
    order = Window.partitionBy("cluster_id").orderBy(F.desc("distance"), "record_id")
    two = (
        distances.withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= 2)
    )
    return two.groupBy("cluster_id").agg(
        F.max(F.when(F.col("_n") == 1, F.col("record_id"))).alias("first_id"),
        F.max(F.when(F.col("_n") == 1, F.col("distance"))).alias("first_distance"),
        F.max(F.when(F.col("_n") == 2, F.col("distance"))).alias("second_distance"),
    )


def cluster_radius(queries: DataFrame, farthest: DataFrame) -> DataFrame:
    """(query_id, cluster_id, radius): largest centroid distance among the other members.

    Null when the query is the only member.
    """
    return queries.join(farthest, "cluster_id", "left").select(
        "query_id",
        "cluster_id",
        F.when(F.col("first_id") == F.col("query_id"), F.col("second_distance"))
        .otherwise(F.col("first_distance"))
        .alias("radius"),
    )


def nearest_member(
    queries: DataFrame, corpus: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, nearest_id, nearest_distance) within the cluster; lowest id on ties."""
    found = nearest_in_group(queries, corpus, 1, "cluster_id", block_rows=block_rows)
    return found.select(
        "query_id",
        F.col("related_id").alias("nearest_id"),
        F.col("distance").alias("nearest_distance"),
    )


def duplicate_decision(radius: DataFrame, nearest: DataFrame) -> DataFrame:
    """(query_id, duplicate_id, nearest_distance).

    The nearest member is the duplicate when it is strictly nearer than the radius. Null
    means no duplicate; a query alone in its cluster gets distance 0.
    """
    return radius.join(nearest, "query_id", "left").select(
        "query_id",
        F.when(F.col("nearest_distance") < F.round("radius", 9), F.col("nearest_id")).alias(
            "duplicate_id"
        ),
        F.coalesce("nearest_distance", F.lit(0.0)).alias("nearest_distance"),
    )

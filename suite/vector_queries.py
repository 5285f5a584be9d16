"""Distances, neighbours, duplicates and clusters on the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions import vectors as v
from kindred.operators import categories as cat
from kindred.operators import clusters, duplicates, neighbors, scaling
from kindred.operators.silhouette import silhouette
from suite import views
from suite.registry import query
from suite.sql import with_ctes


def r6(column):
    return F.round(column, 6) + F.lit(0.0)


def _with_centroid(spark, sf):
    corpus = views.embeddings(spark, sf)
    return corpus.join(clusters.centroid_table(corpus), "cluster_id")


@query(
    "euclid_pairs",
    with_ctes(
        "emb emb_centroids",
        """SELECT record_id, cluster_id, round(list_distance(vec, centroid), 6) + 0.0 AS distance
        FROM emb JOIN emb_centroids USING (cluster_id)""",
    ),
)
def euclid_pairs(spark, sf):
    """Each vector with the centroid of its label."""
    return _with_centroid(spark, sf).select(
        "record_id", "cluster_id", r6(v.euclidean(F.col("vec"), F.col("centroid"))).alias("distance")
    )


@query(
    "cosine_eps",
    with_ctes(
        "emb emb_centroids",
        """SELECT record_id, cluster_id,
               round(list_inner_product(vec, centroid)
                     / ((sqrt(list_inner_product(vec, vec)) + 1e-10)
                        * (sqrt(list_inner_product(centroid, centroid)) + 1e-10)), 6) + 0.0 AS cosine
        FROM emb JOIN emb_centroids USING (cluster_id)""",
    ),
)
def cosine_eps(spark, sf):
    return _with_centroid(spark, sf).select(
        "record_id", "cluster_id", r6(v.cosine(F.col("vec"), F.col("centroid"))).alias("cosine")
    )


@query(
    "cosine_text",
    with_ctes(
        "records",
        """SELECT a.record_id, a.duplicate_of,
               CASE WHEN a.severity = b.severity THEN 1.0 ELSE 0.0 END::DOUBLE AS severity_cosine,
               CASE WHEN a.project = b.project THEN 1.0 ELSE 0.0 END::DOUBLE AS project_cosine
        FROM records a JOIN records b ON a.duplicate_of = b.record_id""",
    ),
)
def cosine_text(spark, sf):
    """Known duplicates with their first copy: cosine of stored 0/1 vector texts."""
    records = views.records(spark, sf).select("record_id", "duplicate_of", "severity", "project")
    features = ("severity", "project")
    dictionary = cat.category_dictionary(records, features)
    coded = cat.encode(records, dictionary, features).withColumns(
        {f: v.vector_text(F.col(f)) for f in features}
    )
    original = coded.select(
        F.col("record_id").alias("duplicate_of"), *[F.col(f).alias(f"o_{f}") for f in features]
    )
    return coded.join(original, "duplicate_of").select(
        "record_id",
        "duplicate_of",
        *[
            r6(v.cosine_of_text(F.col(f), F.col(f"o_{f}"))).alias(f"{f}_cosine")
            for f in features
        ],
    )


@query(
    "knn_top20",
    with_ctes(
        "emb",
        """SELECT query_id, related_id, rank, round(distance, 6) + 0.0 AS distance FROM (
            SELECT a.record_id AS query_id, b.record_id AS related_id,
                   round(list_distance(a.vec, b.vec), 9) AS distance,
                   row_number() OVER (PARTITION BY a.record_id
                       ORDER BY round(list_distance(a.vec, b.vec), 9), b.record_id) AS rank
            FROM emb a JOIN emb b ON a.record_id <> b.record_id) WHERE rank <= 20""",
    ),
)
def knn_top20(spark, sf):
    """Every vector against the whole table."""
    corpus = views.embeddings(spark, sf)
    cells = neighbors.cell_table(
        corpus, neighbors.mean_cells(corpus, "cluster_id"), "cluster_id"
    )
    queries = views.as_queries(corpus).select("query_id", "query_vec")
    found = neighbors.nearest(queries, corpus, cells, 20)
    return found.select(
        "query_id",
        "related_id",
        F.col("rank").cast("long").alias("rank"),
        r6(F.col("distance")).alias("distance"),
    )


@query(
    "within_cluster_dist",
    with_ctes("members", "SELECT query_id, related_id, round(distance, 6) + 0.0 AS distance FROM members"),
)
def within_cluster_dist(spark, sf):
    """The records under review against all members of their cluster."""
    corpus = views.document_vectors(views.tokens(spark, sf))
    queries = views.as_queries(corpus.join(views.flagged(spark, sf), "record_id", "left_semi"))
    return duplicates.member_distances(queries, corpus).select(
        "query_id", "related_id", r6(F.col("distance")).alias("distance")
    )


def _radius(spark, sf):
    corpus = views.embeddings(spark, sf)
    distances = duplicates.centroid_distances(corpus, clusters.centroid_table(corpus))
    return duplicates.cluster_radius(
        views.as_queries(corpus), duplicates.farthest_two(distances)
    )


@query(
    "cluster_radius",
    with_ctes(
        "emb emb_centroids",
        """SELECT a.record_id AS query_id, a.cluster_id,
               round(max(list_distance(b.vec, centroid)), 6) + 0.0 AS radius
        FROM emb a JOIN emb b ON a.cluster_id = b.cluster_id AND a.record_id <> b.record_id
        JOIN emb_centroids e ON e.cluster_id = a.cluster_id
        GROUP BY a.record_id, a.cluster_id""",
    ),
)
def cluster_radius(spark, sf):
    return _radius(spark, sf).withColumn("radius", r6(F.col("radius")))


@query(
    "nearest_member",
    with_ctes(
        "emb",
        """SELECT query_id, arg_min(related_id, (distance, related_id)) AS nearest_id,
               round(min(distance), 6) + 0.0 AS nearest_distance
        FROM (SELECT a.record_id AS query_id, b.record_id AS related_id,
                     round(list_distance(a.vec, b.vec), 9) AS distance
              FROM emb a JOIN emb b ON a.cluster_id = b.cluster_id AND a.record_id <> b.record_id)
        GROUP BY query_id""",
    ),
)
def nearest_member(spark, sf):
    corpus = views.embeddings(spark, sf)
    return duplicates.nearest_member(views.as_queries(corpus), corpus).withColumn(
        "nearest_distance", r6(F.col("nearest_distance"))
    )


@query(
    "dup_decision",
    with_ctes(
        "emb emb_centroids",
        """SELECT query_id,
               CASE WHEN min(distance) < round(max(far), 9)
                    THEN arg_min(related_id, (distance, related_id)) END AS duplicate_id,
               coalesce(round(min(distance), 6), 0.0) + 0.0 AS nearest_distance
        FROM (SELECT a.record_id AS query_id, b.record_id AS related_id,
                     round(list_distance(a.vec, b.vec), 9) AS distance,
                     list_distance(b.vec, centroid) AS far
              FROM emb a LEFT JOIN (SELECT * FROM emb JOIN emb_centroids USING (cluster_id)) b
                ON a.cluster_id = b.cluster_id AND a.record_id <> b.record_id)
        GROUP BY query_id""",
    ),
)
def dup_decision(spark, sf):
    """For every vector: the probable duplicate in its cluster."""
    corpus = views.embeddings(spark, sf)
    nearest = duplicates.nearest_member(views.as_queries(corpus), corpus)
    return duplicates.duplicate_decision(_radius(spark, sf), nearest).withColumn(
        "nearest_distance", r6(F.col("nearest_distance"))
    )


@query(
    "nearest_centroid",
    with_ctes(
        "emb emb_centroids",
        """SELECT record_id, arg_min(cluster_id, (distance, cluster_id)) AS cluster_id,
               round(min(distance), 6) + 0.0 AS distance
        FROM (SELECT record_id, c.cluster_id, round(list_distance(vec, centroid), 9) AS distance
              FROM emb, emb_centroids c) GROUP BY record_id""",
    ),
)
def nearest_centroid(spark, sf):
    corpus = views.embeddings(spark, sf)
    return clusters.nearest_centroid(corpus, clusters.centroid_table(corpus)).withColumn(
        "distance", r6(F.col("distance"))
    )


@query(
    "centroids",
    with_ctes(
        "emb_dims",
        """SELECT cluster_id, CAST(pos AS INTEGER) AS pos, round(avg(x), 6) + 0.0 AS value
        FROM emb_dims GROUP BY cluster_id, pos""",
    ),
)
def centroids(spark, sf):
    return (
        clusters.centroid_table(views.embeddings(spark, sf))
        .select("cluster_id", F.posexplode("centroid").alias("pos", "value"))
        .withColumn("value", r6(F.col("value")))
    )


@query(
    "k_choice",
    """SELECT count(*) AS n, CAST(least(greatest(floor(count(*) / 20), 2), count(*)) AS INTEGER) AS k
    FROM embeddings""",
)
def k_choice(spark, sf):
    counted = views.embeddings(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("n", clusters.number_of_clusters(F.col("n")).alias("k"))


@query(
    "cluster_count",
    "SELECT count(DISTINCT label) FILTER (label <> -1) AS n_clusters FROM embeddings",
)
def cluster_count(spark, sf):
    return clusters.cluster_count(views.embeddings(spark, sf))


@query(
    "silhouette",
    with_ctes(
        "emb",
        """
        , pairs AS (SELECT a.record_id, a.cluster_id AS own, b.cluster_id AS other,
                           sum(list_distance(a.vec, b.vec)) AS total, count(*) AS n
                    FROM emb a, emb b GROUP BY a.record_id, a.cluster_id, b.cluster_id),
        ab AS (SELECT record_id,
                      max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a,
                      min(CASE WHEN own <> other THEN total / n END) AS b
               FROM pairs GROUP BY record_id)
        SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0.0
                              ELSE (b - a) / greatest(a, b) END), 6) + 0.0 AS silhouette
        FROM ab""",
    ),
)
def silhouette_(spark, sf):
    return silhouette(views.embeddings(spark, sf)).select(
        r6(F.col("silhouette")).alias("silhouette")
    )


@query(
    "calinski_harabasz",
    with_ctes(
        "emb_dims",
        """
        , c AS (SELECT cluster_id, pos, avg(x) AS m, count(*) AS n FROM emb_dims GROUP BY ALL),
        g AS (SELECT pos, avg(x) AS m FROM emb_dims GROUP BY pos),
        between_ AS (SELECT sum(c.n * (c.m - g.m) ** 2) AS s FROM c JOIN g USING (pos)),
        within_ AS (SELECT sum((x - m) ** 2) AS s FROM emb_dims JOIN c USING (cluster_id, pos)),
        n AS (SELECT count(*) AS n, count(DISTINCT label) AS k FROM embeddings)
        SELECT round((between_.s / (k - 1)) / (within_.s / (n - k)), 6) + 0.0 AS calinski_harabasz
        FROM between_, within_, n""",
    ),
)
def calinski_harabasz(spark, sf):
    return clusters.calinski_harabasz(views.embeddings(spark, sf)).select(
        r6(F.col("calinski_harabasz")).alias("calinski_harabasz")
    )


@query(
    "standardize",
    with_ctes(
        "emb_dims",
        """
        , s AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS d FROM emb_dims GROUP BY pos)
        SELECT record_id, CAST(pos AS INTEGER) AS pos,
               round(CASE WHEN d > 0 THEN (x - m) / d ELSE 0.0 END, 6) + 0.0 AS value
        FROM emb_dims JOIN s USING (pos)""",
    ),
)
def standardize(spark, sf):
    corpus = views.embeddings(spark, sf).select("record_id", F.col("vec").alias("features"))
    scaler = scaling.fit_scaler(corpus)
    return (
        scaling.apply_scaler(corpus, scaler)
        .select("record_id", F.posexplode("scaled").alias("pos", "value"))
        .withColumn("value", r6(F.col("value")))
    )


@query(
    "covariance",
    with_ctes(
        "emb_dims",
        """SELECT CAST(a.pos AS INTEGER) AS i, CAST(b.pos AS INTEGER) AS j,
               round(covar_samp(a.x, b.x), 9) + 0.0 AS value
        FROM emb_dims a JOIN emb_dims b USING (record_id) GROUP BY a.pos, b.pos""",
    ),
)
def covariance(spark, sf):
    corpus = views.embeddings(spark, sf).select(F.col("vec").alias("features"))
    return scaling.covariance(corpus).withColumn("value", F.round("value", 9) + F.lit(0.0))

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import clusters, duplicates, neighbors, silhouette


def corpus_frame(spark, vectors, groups):
    rows = [
        (f"r{i:05d}", int(g), [float(x) for x in v])
        for i, (v, g) in enumerate(zip(vectors, groups))
    ]
    return spark.createDataFrame(rows, "record_id STRING, cluster_id INT, vec ARRAY<DOUBLE>")


def as_queries(corpus):
    return corpus.select(
        F.col("record_id").alias("query_id"), "cluster_id", F.col("vec").alias("query_vec")
    )


def brute(vectors, groups, k, same_group):
    ids = [f"r{i:05d}" for i in range(len(vectors))]
    out = {}
    for q in range(len(vectors)):
        dist = np.round(np.sqrt(((vectors - vectors[q]) ** 2).sum(1)), 9)
        others = [
            (dist[j], ids[j])
            for j in range(len(vectors))
            if j != q and (not same_group or groups[j] == groups[q])
        ]
        out[ids[q]] = [i for _, i in sorted(others)[:k]]
    return out


def collected(found):
    rows = found.orderBy("query_id", "rank").collect()
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append(r.related_id)
    return out


def skewed(rng, n=180, copies=70, d=5):
    """Clustered points, a third of them copies of one vector in one hot group."""
    groups = rng.integers(0, 6, n)
    vectors = rng.normal(size=(n, d)) + 8 * rng.normal(size=(6, d))[groups]
    hot = rng.choice(n, copies, replace=False)
    vectors[hot] = vectors[hot[0]]
    groups[hot] = groups[hot[0]]
    return vectors, groups


@pytest.mark.parametrize("block_rows", [7, 8192])
def test_nearest_equals_brute_force(spark, block_rows):
    vectors, groups = skewed(np.random.default_rng(1))
    corpus = corpus_frame(spark, vectors, groups)
    cells = neighbors.cell_table(
        corpus, neighbors.mean_cells(corpus, "cluster_id"), "cluster_id"
    )
    queries = as_queries(corpus).select("query_id", "query_vec")
    found = neighbors.nearest(queries, corpus, cells, 5, block_rows=block_rows)
    assert collected(found) == brute(vectors, groups, 5, same_group=False)


@pytest.mark.parametrize("block_rows", [7, 8192])
def test_nearest_in_group_equals_brute_force(spark, block_rows):
    vectors, groups = skewed(np.random.default_rng(2))
    corpus = corpus_frame(spark, vectors, groups)
    found = neighbors.nearest_in_group(
        as_queries(corpus), corpus, 3, "cluster_id", block_rows=block_rows
    )
    assert collected(found) == brute(vectors, groups, 3, same_group=True)


def test_grid_ties_are_broken_by_id(spark):
    vectors = np.array([[x, y] for x in range(6) for y in range(6)], float)
    groups = np.zeros(36, int)
    corpus = corpus_frame(spark, vectors, groups)
    found = neighbors.nearest_in_group(as_queries(corpus), corpus, 6, "cluster_id", block_rows=5)
    assert collected(found) == brute(vectors, groups, 6, same_group=True)


def test_fewer_records_than_asked_for(spark):
    vectors = np.array([[0.0], [1.0], [5.0]])
    corpus = corpus_frame(spark, vectors, [0, 0, 1])
    cells = neighbors.cell_table(
        corpus, neighbors.mean_cells(corpus, "cluster_id"), "cluster_id"
    )
    queries = as_queries(corpus).select("query_id", "query_vec")
    found = neighbors.nearest(queries, corpus, cells, 20)
    assert collected(found) == brute(vectors, [0, 0, 1], 20, same_group=False)


def test_duplicate_is_strictly_inside_the_radius(spark):
    # Cluster 0: centroid 0; each of two members is 1 from it and 2 from the other.
    # Cluster 1: one member. Cluster 2: two close ones and a far one.
    vectors = np.array([[-1.0], [1.0], [9.0], [20.0], [20.1], [26.0]])
    corpus = corpus_frame(spark, vectors, [0, 0, 1, 2, 2, 2])
    queries = as_queries(corpus)
    distances = duplicates.centroid_distances(corpus, clusters.centroid_table(corpus))
    radius = duplicates.cluster_radius(queries, duplicates.farthest_two(distances))
    nearest = duplicates.nearest_member(queries, corpus)
    got = {
        r.query_id: (r.duplicate_id, round(r.nearest_distance, 6))
        for r in duplicates.duplicate_decision(radius, nearest).collect()
    }
    assert got == {
        "r00000": (None, 2.0),
        "r00001": (None, 2.0),
        "r00002": (None, 0.0),
        "r00003": ("r00004", 0.1),
        "r00004": ("r00003", 0.1),
        "r00005": (None, 5.9),
    }


def test_nearest_distance_equal_to_the_radius_is_no_duplicate(spark):
    # Centroid 0. Without r00000 (at 0) the radius is 2, and r00000 is 2 from both.
    corpus = corpus_frame(spark, np.array([[0.0], [-2.0], [2.0]]), [0, 0, 0])
    queries = as_queries(corpus)
    distances = duplicates.centroid_distances(corpus, clusters.centroid_table(corpus))
    radius = duplicates.cluster_radius(queries, duplicates.farthest_two(distances))
    decisions = duplicates.duplicate_decision(
        radius, duplicates.nearest_member(queries, corpus)
    )
    assert {r.duplicate_id for r in decisions.collect()} == {None}


def test_plan_limits_before_the_shuffle(spark, capsys):
    corpus = corpus_frame(spark, np.eye(4), [0, 0, 1, 1])
    neighbors._fold_copies(corpus.withColumn("cell", F.col("cluster_id")), "record_id", "vec", 2).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan
    duplicates.nearest_member(as_queries(corpus), corpus).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def brute_silhouette(vectors, groups):
    dist = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    scores = []
    for i in range(len(vectors)):
        own = groups == groups[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = dist[i][own].sum() / (own.sum() - 1)
        b = min(dist[i][groups == g].mean() for g in set(groups.tolist()) - {groups[i]})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(scores)


@pytest.mark.parametrize("block_rows", [9, 8192])
def test_silhouette_equals_brute_force(spark, block_rows):
    vectors, groups = skewed(np.random.default_rng(3), n=60, copies=20)
    corpus = corpus_frame(spark, vectors, groups)
    got = silhouette.silhouette(corpus, block_rows).first()[0]
    assert got == pytest.approx(brute_silhouette(vectors, groups), abs=1e-6)
    # Overlapping clusters, singles, and cells that hold several clusters.
    rng = np.random.default_rng(4)
    vectors, groups = rng.normal(size=(150, 4)), rng.integers(0, 40, 150)
    corpus = corpus_frame(spark, vectors, groups).withColumn("cell", F.col("cluster_id") % 7)
    got = silhouette.silhouette(corpus, block_rows).first()[0]
    assert got == pytest.approx(brute_silhouette(vectors, groups), abs=1e-6)


def test_silhouette_edges(spark):
    one = corpus_frame(spark, np.eye(3), [0, 0, 0])
    assert silhouette.silhouette(one).first()[0] is None
    assert silhouette.silhouette(one.limit(0)).first()[0] is None
    singles = corpus_frame(spark, np.eye(3), [0, 1, 2])
    assert silhouette.silhouette(singles).first()[0] == 0.0
    same = corpus_frame(spark, np.ones((4, 2)), [0, 0, 1, 1])
    assert silhouette.silhouette(same).first()[0] == pytest.approx(0.0, abs=1e-6)


def test_silhouette_opens_few_clusters(spark):
    rng = np.random.default_rng(5)
    n, k = 3000, 150
    groups = rng.integers(0, k, n)
    outer = 100 * rng.normal(size=(15, 6))
    centres = outer[np.arange(k) % 15] + 12 * rng.normal(size=(k, 6))
    vectors = centres[groups] + rng.normal(size=(n, 6))
    corpus = corpus_frame(spark, vectors, groups).withColumn("cell", F.col("cluster_id") % 15)
    points = silhouette._points(corpus)
    spheres = silhouette._spheres(points)
    opened = silhouette.opened_clusters(points, spheres)
    compared = opened.join(spheres.select(F.col("cluster_id").alias("cell"), "n"), "cell").agg(F.sum("n")).first()[0]
    near = silhouette._near_cells(points, silhouette._cells(spheres), None).count() * 10
    assert opened.count() < 3 * n and compared + near < n * n / 20
    # The nearest cluster is always among those opened.
    mean = np.stack([np.sqrt(((vectors[:, None] - vectors[groups == g]) ** 2).sum(-1)).mean(1) for g in range(k)], 1)
    mean[np.arange(n), groups] = np.inf
    keys = {r.row: tuple(r.vec) for r in points.collect()}
    place = {tuple(v): i for i, v in enumerate(vectors.tolist())}
    found = {(place[keys[r.row]], r.cell) for r in opened.collect()}
    assert all((i, int(g)) in found for i, g in enumerate(mean.argmin(1)))

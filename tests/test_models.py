import collections
import dataclasses

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kindred.config import Config
from kindred.operators import clusters, embedding, exact, scaling, skipgram
from kindred.session import scratch_path
from kindred.sources.artifacts import ArtifactStore


def frame(spark, matrix, name="features"):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"record_id LONG, {name} ARRAY<DOUBLE>")


def values(df, column):
    return np.array([r[column] for r in df.orderBy("record_id").collect()])


def test_scaler_uses_the_population_deviation(spark):
    matrix = np.random.default_rng(0).normal(size=(30, 4)) * [1, 5, 0, 2] + 3
    df = frame(spark, matrix)
    got = values(scaling.apply_scaler(df, scaling.fit_scaler(df)), "scaled")
    std = matrix.std(0)
    want = np.where(std > 0, (matrix - matrix.mean(0)) / np.where(std > 0, std, 1), 0)
    assert np.allclose(got, want, atol=1e-9)


def test_pca_equals_the_eigenvectors(spark):
    matrix = np.random.default_rng(1).normal(size=(80, 5)) @ np.diag([5, 3, 1, 0.5, 0.1])
    matrix -= matrix.mean(0)
    df = frame(spark, matrix, "scaled")
    model = scaling.fit_pca(df, 3)
    got = values(scaling.apply_pca(df, model), "features")
    variance = np.sort(np.linalg.eigvalsh(np.cov(matrix.T)))[::-1][:3]
    assert np.allclose(got.var(0, ddof=1), variance, atol=1e-6)
    loadings = np.linalg.lstsq(matrix, got, rcond=None)[0]
    assert (loadings[np.abs(loadings).argmax(0), range(3)] > 0).all()


def test_covariance_of_large_values_keeps_digits(spark):
    matrix = np.random.default_rng(2).normal(size=(50, 3)) + 1e6
    rows = scaling.covariance(frame(spark, matrix)).collect()
    got = np.zeros((3, 3))
    for r in rows:
        got[r.i, r.j] = r.value
    assert np.allclose(got, np.cov(matrix.T), atol=1e-6)


def test_saved_model_gives_the_same_result(spark):
    df = frame(spark, np.random.default_rng(3).normal(size=(20, 4)), "scaled")
    store = ArtifactStore(spark, scratch_path(spark, "store"))
    model = store.save_model("pca", scaling.fit_pca(df, 2))
    first = values(scaling.apply_pca(df, model), "features")
    assert np.array_equal(first, values(scaling.apply_pca(df, store.model("pca")), "features"))
    with pytest.raises(Exception):
        store.model("missing")


def test_embedding_ignores_unknown_words(spark):
    records = spark.createDataFrame(
        [("a", ["x", "x", "y", "zzz"]), ("b", ["zzz"]), ("c", [])],
        "record_id STRING, tokens ARRAY<STRING>",
    )
    words = spark.createDataFrame(
        [("x", [1.0, 0.0]), ("y", [4.0, 3.0])], "word STRING, vector ARRAY<DOUBLE>"
    )
    got = {r.record_id: r.vector for r in embedding.embed(records, words, 2).collect()}
    assert got["a"] == pytest.approx([2.0, 1.0])
    assert got["b"] == got["c"] == [0.0, 0.0]


def test_field_embeddings_are_means(spark):
    rng = np.random.default_rng(6)
    names = [f"w{i}" for i in range(30)]
    rows = [
        (f"r{i}", list(rng.choice(names, rng.integers(0, 9))), list(rng.choice(names, 3)))
        for i in range(25)
    ]
    rows = [(a, [str(x) for x in b], [str(x) for x in c]) for a, b, c in rows]
    records = spark.createDataFrame(rows, "record_id STRING, f ARRAY<STRING>, g ARRAY<STRING>")
    vectors = {w: rng.normal(size=4).tolist() for w in names[:20]}
    words = spark.createDataFrame(list(vectors.items()), "word STRING, vector ARRAY<DOUBLE>")
    got = {r.record_id: r for r in embedding.embed_fields(records, words, 4, ["f", "g"]).collect()}
    for name, f, g in rows:
        for column, tokens in (("f", f), ("g", g)):
            known = [vectors[t] for t in tokens if t in vectors]
            want = np.mean(known, axis=0) if known else np.zeros(4)
            assert np.allclose(got[name][column], want)


def test_word_vectors_cover_the_vocabulary(spark):
    records = spark.createDataFrame(
        [("a", ["x", "y"] * 5), ("b", ["y", "z"] * 5)],
        "record_id STRING, tokens ARRAY<STRING>",
    )
    config = Config(vector_size=8, word2vec_iterations=1)
    got = embedding.fit_word_vectors(records, config).collect()
    assert {r.word for r in got} == {"x", "y", "z"} and all(len(r.vector) == 8 for r in got)


def test_word_vectors_are_a_table_dealt_out_in_chunks(spark):
    # Two kinds of records: words of a kind share their contexts and come to lie together.
    rng = np.random.default_rng(21)
    rows = [(f"r{i}", [f"{'ab'[i % 2]}{j}" for j in rng.integers(0, 12, 40)]) for i in range(900)]
    rows += [("null", None), ("none", []), (None, [None, "alone"]), ("a0", ["a0", None, "b0"])]
    records = spark.createDataFrame(rows, "record_id STRING, tokens ARRAY<STRING>")
    config = Config(vector_size=8, word2vec_iterations=10, word2vec_partitions=3)
    vectors = embedding.fit_word_vectors(records, config)
    # The driver holds no table of the words.
    assert vectors.inputFiles()
    got = {r.word: np.array(r.vector) for r in vectors.collect()}
    assert vectors.count() == len(got) == 25 and all(np.isfinite(v).all() and len(v) == 8 for v in got.values())
    unit = {w: v / np.linalg.norm(v) for w, v in got.items()}
    alike = [unit[f"{k}{i}"] @ unit[f"{k}{j}"] for k in "ab" for i in range(12) for j in range(i)]
    apart = [unit[f"a{i}"] @ unit[f"b{j}"] for i in range(12) for j in range(12)]
    assert min(alike) > max(apart)
    few = embedding.fit_word_vectors(records, dataclasses.replace(config, min_count=3))
    assert {r.word for r in few.collect()} == set(got) - {"alone"}


def test_a_pass_follows_the_gradient_of_its_pairs():
    rng = np.random.default_rng(5)
    n, words, size = 200, 30, 6
    ids, record = rng.integers(0, words, n), np.sort(rng.integers(0, 20, n))
    vectors, contexts = rng.normal(size=(2, words, size)).astype(np.float32) / 3
    after, around = vectors.copy(), contexts.copy()
    skipgram.train(ids, record, after, around, 1, (0.01, 0.01), np.random.default_rng(7))
    same = np.random.default_rng(7)
    same.integers(1, 2, n + skipgram.CENTRES)
    chances = np.cumsum(np.bincount(ids, minlength=words) ** 0.75)
    others = np.searchsorted(chances / chances[-1], same.random(skipgram.SHARED), "right")
    want, want_around = vectors.astype(float), contexts.astype(float)
    share = skipgram.NEGATIVES / skipgram.SHARED
    load, load_around = np.zeros(words), np.zeros(words)
    move, move_around = np.zeros((words, size)), np.zeros((words, size))
    for i in range(n):
        for j in (i - 1, i + 1):
            if 0 <= j < n and record[i] == record[j]:
                targets = [(ids[j], 1, 1)] + [(o, 0, share) for o in others]
                for target, label, weight in targets:
                    x, y = vectors[ids[i]].astype(float), contexts[target].astype(float)
                    pull = weight * (label - 1 / (1 + np.exp(-x @ y)))
                    move[ids[i]] += pull * y
                    move_around[target] += pull * x
                    load_around[target] += weight
                load[ids[i]] += 1 + skipgram.NEGATIVES
    want += 0.01 * move / np.maximum(1, load / skipgram.LOAD)[:, None]
    want_around += 0.01 * move_around / np.maximum(1, load_around / skipgram.LOAD)[:, None]
    assert np.allclose(after, want, atol=1e-5) and np.allclose(around, want_around, atol=1e-5)


def test_later_passes_draw_no_first_vectors(monkeypatch):
    size, words = 2, ["a", "b", "c"]
    known = np.arange(12).reshape(3, 4).astype(skipgram.SENT) / 16
    columns = [
        pa.array([0] * 4, pa.int32()),
        pa.array([None, None, None, 7], pa.int64()),
        pa.array([None, None, None, ["a", "b", "c", "a"]], pa.list_(pa.string())),
        pa.array([*words, None]),
        pa.array([*(v.tobytes() for v in known), None], pa.binary()),
    ]
    batch = pa.RecordBatch.from_arrays(columns, ["chunk", "_row", "tokens", "word", "vec"])
    monkeypatch.setattr(skipgram, "first_vectors", None)
    monkeypatch.setattr(skipgram, "train", lambda *a: None)
    [out] = skipgram._passed(size, 1, (0.01, 0.01), 1, False)(iter([batch]))
    assert out.column("word").to_pylist() == words and out.column("n").to_pylist() == [2, 1, 1]
    assert out.column("vec").to_pylist() == [v.tobytes() for v in known]


def test_frequent_words_are_thinned_out_at_the_expected_rates(spark):
    rng = np.random.default_rng(12)
    names = ["the", "of", *(f"w{i}" for i in range(2000))]
    chances = np.array([0.3, 0.1, *[0.6 / 2000] * 2000])
    rows = [(f"r{i}", [names[j] for j in rng.choice(2002, 50, p=chances)]) for i in range(1200)]
    rows += [("null", None), ("none", []), (None, [None, "w1"])]
    records = spark.createDataFrame(rows, "record_id STRING, tokens ARRAY<STRING>")
    thinned = embedding.subsample(records, 1e-2, 42)
    got = {r.record_id: r.tokens for r in thinned.collect()}
    assert got == {r.record_id: r.tokens for r in embedding.subsample(records.repartition(3), 1e-2, 42).collect()}
    assert got["null"] is None and got["none"] == [] and got[None] == [None, "w1"]
    before = collections.Counter(t for _, tokens in rows for t in tokens or [] if t)
    after = collections.Counter(t for tokens in got.values() for t in tokens or [] if t)
    total = sum(before.values())
    for word in ("the", "of"):
        f = before[word] / total / 1e-2
        p = (f**0.5 + 1) / f
        assert abs(after[word] - p * before[word]) < 4 * (before[word] * p * (1 - p)) ** 0.5
    assert all(after[w] == n for w, n in before.items() if w not in ("the", "of"))
    # Left out by default, and a fit with it still covers every word that is left.
    assert Config().word2vec_sample == 0
    few = records.where("record_id < 'r11'")
    vectors = embedding.fit_word_vectors(few, Config(vector_size=4, word2vec_iterations=1, word2vec_sample=1e-2))
    assert {"the", "of"} <= {r.word for r in vectors.collect()}


def test_number_of_clusters(spark):
    rows = spark.createDataFrame([(0,), (1,), (5,), (100,), (419,)], "n LONG")
    picked = rows.select("n", clusters.number_of_clusters(F.col("n")).alias("k"))
    got = {r.n: r.k for r in picked.collect()}
    assert got == {0: 0, 1: 1, 5: 2, 100: 5, 419: 20}


@pytest.mark.parametrize("members", [20, 3])
def test_clusters_cover_every_record_once(spark, members):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(8, 3)) * 30
    matrix = np.repeat(centers, 40, axis=0) + rng.normal(size=(320, 3))
    matrix[:110] = matrix[0]  # a third of the rows are copies
    config = Config(kmeans_iterations=20, kmeans_inits=3, members_per_cluster=members)
    df = frame(spark, matrix, "vec")
    got = clusters.fit_clusters(df, config).collect()
    assert sorted(r.record_id for r in got) == list(range(320))
    labels = {r.record_id: r.cluster_id for r in got}
    assert len({labels[i] for i in range(110)}) == 1
    sizes = collections.Counter(labels.values())
    assert all(n < 2 * members for c, n in sizes.items() if c != labels[0])
    cost = sum(
        ((rows - rows.mean(0)) ** 2).sum()
        for c in set(labels.values())
        for rows in [matrix[[i for i in range(320) if labels[i] == c]]]
    )
    assert cost < 0.05 * ((matrix - matrix.mean(0)) ** 2).sum()
    assert len({(r.cell, r.cluster_id) for r in got}) == len(set(labels.values()))


def spread_sum(matrix, labels):
    return sum(((rows - rows.mean(0)) ** 2).sum() for c in set(labels) for rows in [matrix[np.array(labels) == c]])


def test_small_cells_are_split_to_the_end_within_one_task(spark, monkeypatch):
    points = np.random.default_rng(31).normal(size=(500, 3)).round(2)
    points[40:60] = points[40]
    config = Config(members_per_cluster=10, kmeans_inits=3)
    written, real, left = [], clusters.through_table, []
    monkeypatch.setattr(clusters, "through_table", lambda df, name: written.append(name) or real(df, name))
    for limit in (0, 60, 10_000):
        monkeypatch.setattr(clusters, "TASK_POINTS", limit)
        written.clear()
        rows = clusters.fit_clusters(frame(spark, points, "vec"), config).collect()
        assert sorted(r.record_id for r in rows) == list(range(500))
        assert ("pool" in written) == (limit < 500)
        members, cells = {}, {}
        for r in rows:
            members.setdefault(r.cluster_id, []).append(r.vec)
            cells.setdefault(r.cluster_id, set()).add(r.cell)
        assert all(len(m) < 20 or len({tuple(v) for v in m}) == 1 for m in members.values())
        assert all(len(c) == 1 for c in cells.values()) and 25 <= len(members) <= 100
        assert len({r.cluster_id for r in rows if r.vec == points[40].tolist()}) == 1
        left.append(sum(((np.array(m) - np.mean(m, axis=0)) ** 2).sum() for m in members.values()))
    assert max(left) < 1.25 * min(left)
    nothing = spark.createDataFrame([(1, [0.0]), (2, None), *((i, [float(i)]) for i in range(3, 60))], "record_id LONG, vec ARRAY<DOUBLE>")
    with pytest.raises(Exception, match="no vector"):
        clusters.fit_clusters(nothing, config).collect()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_centers_cost_no_more_than_those_of_a_plain_kmeans(spark, seed):
    # Blobs of very different sizes and widths, which starts drawn evenly miss.
    rng = np.random.default_rng(seed)
    sizes = rng.integers(3, 200, 24)
    blobs = [rng.normal(size=6) * 40 + rng.normal(size=(n, 6)) * rng.uniform(0.2, 3) for n in sizes]
    matrix = np.concatenate(blobs)
    points = frame(spark, matrix, "vec").select(
        F.lit(7).cast("long").alias("cell"), F.col("record_id").alias("pid"), "vec", F.lit(1.0).alias("weight")
    )
    wanted = points.select("cell", F.lit(16).alias("k")).distinct()
    centers = clusters._best_centers(points, wanted, Config())
    mine = [r.part for r in clusters._parts(centers, points).orderBy("pid").collect()]
    vectors = points.select("pid", array_to_vector("vec").alias("features"))
    plain = KMeans(k=16, seed=seed, tol=1e-6, maxIter=200).fit(vectors).transform(vectors)
    theirs = [r.prediction for r in plain.orderBy("pid").collect()]
    assert spread_sum(matrix, mine) <= spread_sum(matrix, theirs) * 1.0001


def test_points_of_one_cell_are_measured_in_slices(spark, monkeypatch):
    monkeypatch.setattr(clusters, "SLICE_ROWS", 40)
    monkeypatch.setattr(clusters, "MOST_NUMBERS", 300)
    rng = np.random.default_rng(31)
    x, c = rng.integers(-3, 4, (400, 3)).astype(float), rng.integers(-3, 4, (7, 3)).astype(float)
    rows = [(int(i >= 350), i, [float(v) for v in r], float(1 + i % 3)) for i, r in enumerate(x)]
    points = spark.createDataFrame(rows, "cell LONG, pid LONG, vec ARRAY<DOUBLE>, weight DOUBLE")
    lists = [(cell, 0, [(j, r.tolist()) for j, r in enumerate(c) if j > cell]) for cell in (0, 1)]
    centers = spark.createDataFrame(lists, "cell LONG, start INT, centers ARRAY<STRUCT<part: INT, center: ARRAY<DOUBLE>>>")
    slices = {r.cell: r.slices for r in clusters._slices(points).collect()}
    assert slices == {0: 9, 1: 2}
    d = ((x[:, None] - c) ** 2).sum(2)
    d[:, 0], d[350:, 1] = np.inf, np.inf
    got = {r.pid: r for r in clusters._parts(centers, points).collect()}
    assert [got[i].part for i in range(400)] == d.argmin(1).tolist()
    assert np.allclose([got[i].cost for i in range(400)], d.min(1) * [r[3] for r in rows])
    for r in clusters._moved(centers, points).collect():
        mine = [i for i in range(400) if rows[i][0] == r.cell]
        assert np.isclose(r.cost, sum(got[i].cost for i in mine))
        for part, center in r.centers:
            of = [i for i in mine if got[i].part == part]
            assert np.allclose(center, np.average(x[of], axis=0, weights=[rows[i][3] for i in of]))


@pytest.mark.parametrize("odd", [None, [1.0, None]])
def test_points_without_a_whole_vector_are_refused(spark, odd):
    rows = [(0, i, odd if i == 3 else [float(i), 0.0], 1.0) for i in range(5)]
    points = spark.createDataFrame(rows, "cell LONG, pid LONG, vec ARRAY<DOUBLE>, weight DOUBLE")
    centers = spark.createDataFrame(
        [(0, 0, [(0, [0.0, 0.0])])], "cell LONG, start INT, centers ARRAY<STRUCT<part: INT, center: ARRAY<DOUBLE>>>"
    )
    with pytest.raises(Exception, match="no vector or a null"):
        clusters._moved(centers, points).collect()


def test_pool_weighs_all_points_and_draws_distinct_ones(spark):
    rng = np.random.default_rng(11)
    rows = [(i % 3, i, rng.normal(size=4).tolist(), float(1 + i % 5)) for i in range(600)]
    # One cell has fewer points than are drawn, one has a point far away, which must be drawn.
    rows += [(9, 1000 + i, [float(i)] * 4, 2.0) for i in range(5)] + [(0, 2000, [1e4] * 4, 1.0)]
    points = spark.createDataFrame(rows, "cell LONG, pid LONG, vec ARRAY<DOUBLE>, weight DOUBLE")
    pool = clusters._pool(points, 42).collect()
    assert len({(r.cell, r.pid) for r in pool}) == len(pool)
    assert {r.pid for r in pool if r.cell == 9} == {1000, 1001, 1002, 1003, 1004}
    assert 2000 in {r.pid for r in pool if r.cell == 0}
    for cell in (0, 1, 2, 9):
        of = [r for r in pool if r.cell == cell]
        assert len(of) <= 1 + clusters.ROUNDS * clusters.DRAWN
        mine = [(np.array(v), w) for c, _, v, w in rows if c == cell]
        want = collections.Counter()
        for v, w in mine:
            want[min(of, key=lambda r: (((v - np.array(r.center)) ** 2).sum(), r.pid)).pid] += w
        assert {r.pid: r.weight for r in of} == dict(want)


def test_a_cluster_may_hold_only_copies(spark):
    got = clusters.fit_clusters(frame(spark, np.ones((200, 2)), "vec"), Config()).collect()
    assert len(got) == 200 and len({r.cluster_id for r in got}) == 1
    assert clusters.fit_clusters(frame(spark, np.ones((1, 2)), "vec").limit(0), Config()).count() == 0


@pytest.mark.parametrize("block_rows", [8192, 7])
def test_nearest_centroid_in_blocks(spark, block_rows):
    rng = np.random.default_rng(5)
    points, table = rng.normal(size=(40, 3)), rng.normal(size=(25, 3))
    table[7] = table[3]
    centroids = frame(spark, table, "centroid").withColumnRenamed("record_id", "cluster_id")
    found = clusters.nearest_centroid(frame(spark, points, "vec"), centroids, block_rows)
    for r in found.collect():
        distances = np.round(np.sqrt(((points[r.record_id] - table) ** 2).sum(1)), 9)
        assert r.cluster_id == distances.argmin() and r.distance == pytest.approx(distances.min())


def test_repeated_and_null_ids_keep_their_own_vectors(spark):
    rows = [("a", ["x", "x"]), ("a", ["y"]), (None, ["x", None, "y"]), ("b", None), ("a", ["x", "x"])]
    records = spark.createDataFrame(rows, "record_id STRING, tokens ARRAY<STRING>")
    words = spark.createDataFrame(
        [("x", [1.0]), ("y", [4.0]), (None, [9.0])], "word STRING, vector ARRAY<DOUBLE>"
    )
    got = [(r.record_id, r.vector[0]) for r in embedding.embed(records, words, 1).collect()]
    assert sorted(got, key=str) == sorted([("a", 1.0), ("a", 4.0), (None, 2.5), ("b", 0.0), ("a", 1.0)], key=str)
    fields = records.withColumn("other", F.lit(None).cast("array<string>"))
    got = embedding.embed_fields(fields, words, 1, ["tokens", "other"]).collect()
    assert sorted(r.tokens[0] for r in got) == [0.0, 1.0, 1.0, 2.5, 4.0] and all(r.other == [0.0] for r in got)
    assert embedding.embed(records.limit(0), words, 1).collect() == []


def test_word_table_in_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    names = [f"w{i}" for i in range(200)]
    vectors = {w: rng.normal(size=6) * 10.0 ** rng.integers(-6, 4) for w in names}
    words = spark.createDataFrame([(w, v.tolist()) for w, v in vectors.items()], "word STRING, vector ARRAY<DOUBLE>")
    rows = [(i, [str(w) for w in rng.choice(names, rng.integers(1, 400))]) for i in range(60)]
    records = spark.createDataFrame(rows, "record_id LONG, tokens ARRAY<STRING>")
    found = []
    for numbers, tokens, parts in ((100, 50, 2), (4_000_000, 1_000_000, 8)):
        monkeypatch.setattr(embedding, "BLOCK_NUMBERS", numbers)
        monkeypatch.setattr(embedding, "TOKENS", tokens)
        frame = records.repartition(parts, F.rand(parts))
        found.append({r.record_id: r.vector for r in embedding.embed(frame, words, 6).collect()})
    # The same bytes for any blocks and partitions.
    assert found[0] == found[1]
    for i, tokens in rows:
        assert np.allclose(found[0][i], np.mean([vectors[t] for t in tokens], axis=0), rtol=1e-12, atol=1e-14)


def test_chunks_fetch_vectors_and_send_no_sums(spark, monkeypatch):
    rng = np.random.default_rng(12)
    # Vectors of whole numbers travel in four bytes, the others in eight.
    vectors = {f"w{i}": (rng.integers(-9, 9, 5) if i % 2 else rng.normal(size=5)).tolist() for i in range(90)}
    vectors = {w: [float(x) for x in v] for w, v in vectors.items()}
    words = spark.createDataFrame(list(vectors.items()), "word STRING, vector ARRAY<DOUBLE>")
    rows = [(i % 7 or None, [f"w{j}" for j in rng.integers(0, 99, i)], [f"w{j}" for j in rng.integers(0, 99, 3)]) for i in range(50)]
    rows += [(3, None, ["w1", None]), (None, [], None)]
    records = spark.createDataFrame(rows, "record_id LONG, f ARRAY<STRING>, g ARRAY<STRING>").repartition(3)
    found = []
    for limits in ((60, 20, 40, 30), (4_000_000, 1_000_000, 32_000_000, 4_000_000)):
        for name, limit in zip(("BLOCK_NUMBERS", "TOKENS", "HELD", "MEANS"), limits):
            monkeypatch.setattr(embedding, name, limit)
        means = embedding.embed_fields(records, words, 5, ["f", "g"])
        # No sums of records between the tasks, and nothing is joined to them.
        plan = means._jdf.queryExecution().executedPlan().toString()
        assert "_hi" not in plan and "SortMergeJoin" not in plan and "Aggregate" not in plan
        found.append(sorted(map(str, means.collect())))
    assert found[0] == found[1]
    got = sorted((r.record_id or 0, tuple(np.round(r.f + r.g, 9))) for r in means.collect())
    mean = lambda ts: np.mean([vectors[t] for t in ts or () if t in vectors] or [[0.0] * 5], axis=0)
    want = sorted((k or 0, tuple(np.round(np.concatenate([mean(f), mean(g)]), 9))) for k, f, g in rows)
    assert [k for k, _ in got] == [k for k, _ in want]
    assert np.allclose([v for _, v in got], [v for _, v in want])


def test_copies_of_the_word_table_do_not_grow_with_the_chunks(spark, monkeypatch):
    words = spark.createDataFrame([(f"w{i}", [float(i)]) for i in range(40)], "word STRING, vector ARRAY<DOUBLE>")
    records = spark.createDataFrame([(i, [f"w{i % 40}", "w1"]) for i in range(1500)], "record_id INT, tokens ARRAY<STRING>")
    asked, real = [], F.sequence
    monkeypatch.setattr(embedding, "TOKENS", 2)
    monkeypatch.setattr(embedding.F, "sequence", lambda a, b: asked.append((a, b)) or real(a, b))
    got = embedding.embed(records, words, 1)
    [(low, high)] = asked
    copies = spark.range(1).select(F.lit(0).alias("_block")).select((high - low + 1).alias("n")).first()[0]
    assert copies <= spark.sparkContext.defaultParallelism
    assert {r.record_id: r.vector[0] for r in got.collect()} == {i: (i % 40 + 1) / 2 for i in range(1500)}


def test_mean_vectors_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(3000, 5)) * 10.0 ** rng.integers(-8, 6, size=(3000, 1))
    # One key holds most rows; some ids are null.
    rows = [(None if i % 50 == 0 else 1 if i % 3 else i % 40, i % 4 + 1.0, p.tolist()) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "k LONG, w DOUBLE, vec ARRAY<DOUBLE>")
    got = []
    for parts in (1, 2, 8):
        means = exact.mean_vectors(frame.repartition(parts, F.rand(parts)), ["k"], "vec", "m", "w")
        got.append({r.k: r.m for r in means.collect()})
    assert got[0] == got[1] == got[2]
    for k in (None, 1, 6):
        mine = [(w, v) for key, w, v in rows if key == k]
        assert np.allclose(got[0][k], np.average([v for _, v in mine], axis=0, weights=[w for w, _ in mine]), atol=1e-9)
    plain = {r.k: r.m for r in exact.mean_vectors(frame, ["k"], "vec", "m").collect()}
    assert np.allclose(plain[1], np.mean([v for k, _, v in rows if k == 1], axis=0), atol=1e-9)


def test_split_keeps_every_digit():
    x = np.concatenate([np.random.default_rng(4).normal(size=500) * 10.0**e for e in range(-4, 9)])
    hi, lo = exact.split(x)
    assert np.allclose(exact.value(hi, lo), x, rtol=2**-52, atol=2**-52)
    a, b = exact.carried(hi * 7, lo * 7)
    assert (b >= 0).all() and (b < 2**40).all() and np.allclose(exact.value(a, b), 7 * x, rtol=1e-15, atol=1e-15)


def test_words_of_all_chunks_are_looked_up_at_once(monkeypatch):
    names, size = [f"w{i}" for i in range(40)], 3
    vectors = np.random.default_rng(5).integers(-9, 9, (40, size)).astype(float)
    chunks = [(["w3", "new", "w7"], [(0, 0, 2), (0, 1, 1), (1, 2, 4)]), (["w7", "w39"], [(2, 1, 1), (3, 0, 5)]), (["no"], [(4, 0, 1)])]
    rows = [(p, names[:25], vectors[:25].tobytes(), None, None, None) for p in (0, 1)]
    rows += [(p, names[25:], vectors[25:].tobytes(), None, None, None) for p in (0, 1)]
    for p in (0, 1):
        for words, cells in chunks:
            of, at, counts = (np.array(x) for x in zip(*cells))
            rows.append((p, words, None, (of + 10 * p).astype(np.int64).tobytes(), at.astype(np.int32).tobytes(), counts.astype(np.int32).tobytes()))
    rows.sort(key=lambda r: (r[0], r[2] is None))
    kinds = [pa.int32(), pa.list_(pa.string()), *[pa.binary()] * 4]
    names_ = ["_place", "_words", "_vectors", "_rows", "_at", "_counts"]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names_)
    calls, real = [], embedding.pc.index_in
    monkeypatch.setattr(embedding.pc, "index_in", lambda *a: calls.append(1) or real(*a))
    got = {}
    for cut in ([batch], [batch.slice(0, 4), batch.slice(4)]):
        calls.clear()
        out = [b for b in embedding._multiplied(size, 1)(iter(cut))]
        got = {r["_row"]: exact.value(np.array(r["_hi"]), np.array(r["_lo"])).tolist() for b in out for r in b.to_pylist()}
        for p in (0, 1):
            assert got[10 * p] == (2 * vectors[3]).tolist() and got[10 * p + 1] == (4 * vectors[7]).tolist()
            assert got[10 * p + 2] == vectors[39].tolist() and got[10 * p + 3] == (5 * vectors[7]).tolist()
        assert len(got) == 8 and len(calls) == 1 + len(cut)

"""Clusters: number, fit, assignment and quality."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.config import Config
from kindred.functions.vectors import squared_euclidean
from kindred.operators.blocks import BLOCK_ROWS, block_join, nearest_rows
from kindred.operators.exact import lists, matrix, mean_vectors
from kindred.session import through_table


def number_of_clusters(n: Column, members: int = 20) -> Column:
    """n / 20, at least 2 and at most n."""
    return F.least(F.greatest(F.floor(n / members).cast("int"), F.lit(2)), n.cast("int"))


def centroid_table(records: DataFrame) -> DataFrame:
    """(cluster_id, centroid): mean vector per cluster, the same for any partitioning."""
    return mean_vectors(records, ["cluster_id"], "vec", "centroid")


def nearest_centroid(
    records: DataFrame, centroids: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(record_id, cluster_id, distance): lowest id on ties.

    Blocks of records meet blocks of centroids; a task hands on the nearest centroid of
    its block for every record.
    """
    types = dict(records.dtypes) | dict(centroids.dtypes)

    def best(a: pa.Table, am: np.ndarray, b: pa.Table, bm: np.ndarray) -> pa.Table:
        order = np.argsort(np.argsort(b["cluster_id"].to_numpy(), kind="stable"))
        i, j, distance = nearest_rows(am, bm, order, 1)
        return pa.table(
            {
                "record_id": a["record_id"].take(pa.array(i)),
                "cluster_id": b["cluster_id"].take(pa.array(j)),
                "distance": pa.array(distance),
            }
        )

    found = block_join(
        records.select(F.lit(0).alias("cell"), "vec", "record_id"),
        centroids.select(F.lit(0).alias("cell"), F.col("centroid").alias("vec"), "cluster_id"),
        best,
        f"record_id {types['record_id']}, cluster_id {types['cluster_id']}, distance DOUBLE",
        block_rows,
    )
    least = F.min(F.struct("distance", "cluster_id")).alias("_b")
    return found.groupBy("record_id").agg(least).select(
        "record_id", "_b.cluster_id", "_b.distance"
    )


def cluster_count(records: DataFrame) -> DataFrame:
    """(n_clusters): distinct ids, -1 not counted."""
    return records.agg(
        F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))).alias("n_clusters")
    )


def calinski_harabasz(records: DataFrame) -> DataFrame:
    """(calinski_harabasz): dispersion between clusters over dispersion within.

    Null where it is not defined: one cluster, as many as records, or no dispersion within.
    """
    mean = records.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col("vec"))))).scalar()
    between = F.col("n") * squared_euclidean(F.col("centroid"), F.col("_mean"))
    centroids = centroid_table(records)
    measured = (
        records.join(centroids, "cluster_id")
        .select("cluster_id", squared_euclidean(F.col("vec"), F.col("centroid")).alias("d"))
        .groupBy("cluster_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("within"))
    )
    per_cluster = measured.join(centroids, "cluster_id")
    totals = per_cluster.withColumn("_mean", mean).agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum("within").alias("within"),
        F.sum(between).alias("between"),
    )
    ratio = F.try_divide(
        F.try_divide("between", F.col("k") - 1), F.try_divide("within", F.col("n") - F.col("k"))
    )
    return totals.select(ratio.alias("calinski_harabasz"))


FAN = 16  # parts that a cell is split into at once
ROUNDS, DRAWN = 3, 2 * FAN  # draws for the pool of possible centres, and points per draw


SLICE_ROWS = 20_000  # points of a cell that a task measures, on average
MOST_NUMBERS = 2_000_000  # differences that are held at once
TASK_POINTS = 10_000  # points of a cell that one task splits to the end


def _slices(points: DataFrame) -> DataFrame:
    """(cell, slices): into how many parts the points of a cell are dealt."""
    return points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / SLICE_ROWS).cast("int").alias("slices"))


def _sliced(points: DataFrame, slices: DataFrame) -> DataFrame:
    if "slice" in points.columns:
        return points
    dealt = F.pmod(F.xxhash64("pid"), F.col("slices")).cast("int")
    return points.join(slices, "cell").select(*points.columns, dealt.alias("slice"))


def _nearest_of(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the nearest centre, squared distance) of every row, the first centre on ties."""
    best, least = np.zeros(len(x), int), np.full(len(x), np.inf)
    step = max(1, MOST_NUMBERS // max(1, x.size))
    for low in range(0, len(centers), step):
        diff = x[:, None] - centers[low : low + step]
        d = np.einsum("ijk,ijk->ij", diff, diff)
        at = d.argmin(1)
        d = d[np.arange(len(x)), at]
        nearer = d < least
        best[nearer], least[nearer] = at[nearer] + low, d[nearer]
    return best, least


def _measuring(columns: list[str], moved: bool):
    """Points of a slice against the centres of its cell, which come before them."""

    def run(batches):
        now, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, part = (batch.column(c).to_numpy() for c in ("cell", "slice"))
            given = np.array(batch.column("centers").is_valid())
            vectors = batch.column("vec").drop_null()
            if len(vectors) < len(given) - given.sum() or vectors.flatten().null_count:
                raise ValueError("a point has no vector or a null in it")
            x = matrix(vectors).astype(float)
            weight = batch.column("weight").drop_null().to_numpy()
            place = np.cumsum(~given) - 1
            change = (np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(given.astype(int)) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1), len(cell)]
            out = []
            for low, high in zip(cuts, cuts[1:]):
                if now != (cell[low], part[low]):
                    now, held = (cell[low], part[low]), []
                if given[low]:
                    for i in range(low, high):
                        centers = batch.column("centers")[i].values
                        names = centers.field("name").to_numpy()
                        order = np.argsort(names, kind="stable")
                        vectors = matrix(centers.field("center")).astype(float)[order]
                        held.append((batch.column("start")[i].as_py(), names[order], vectors))
                    continue
                mine, w = x[place[low] : place[low] + high - low], weight[place[low] : place[low] + high - low]
                for start, names, centers in held:
                    at, d = _nearest_of(mine, centers)
                    if not moved:
                        out.append((np.arange(low, high), np.full(high - low, start), names[at], d))
                        continue
                    order = np.argsort(at, kind="stable")
                    first = np.flatnonzero(np.diff(at[order], prepend=-1))
                    sums = np.add.reduceat((mine * w[:, None])[order], first, axis=0)
                    n, cost = (np.add.reduceat(v[order], first) for v in (w, w * d))
                    same = np.full(len(first), 1)
                    out.append((same * now[0], same * start, names[at[order][first]], cost, n, sums / n[:, None]))
            if not out:
                continue
            first, start, name, d, *rest = (np.concatenate(c) for c in zip(*out))
            found = [pa.array(start, pa.int32()), pa.array(name, pa.int64()), pa.array(d, pa.float64())]
            if moved:
                n, centers = rest
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first, pa.int64()), *found, pa.array(n), lists(centers)],
                    ["cell", "start", "name", "cost", "weight", "center"],
                )
            else:
                rows = batch.select(columns).take(pa.array(first))
                yield pa.RecordBatch.from_arrays([*rows.columns, *found], [*columns, "start", "name", "d"])

    return run


def _measured(centers: DataFrame, name: str, points: DataFrame, slices: DataFrame | None, moved: bool) -> DataFrame:
    """Every point with the nearest centre of its own cell for each start, lowest name on ties.

    With ``moved`` the partial means of the points of each centre instead. Centres go to every slice of
    their cell, so that a task holds those of one cell, and a large cell is measured by many tasks.
    """
    slices = _slices(points) if slices is None else slices
    columns, types = points.columns, dict(points.dtypes)
    points = _sliced(points, slices)
    wanted = F.transform(
        "centers", lambda c: F.struct(c[name].cast("long").alias("name"), c.center.alias("center"))
    )
    given = centers.join(slices, "cell").select(
        "cell",
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        F.col("start").cast("int").alias("start"),
        wanted.alias("centers"),
    )
    rows = given.unionByName(points, allowMissingColumns=True)
    kinds = [f"{c} {types[c]}" for c in columns] + ["start int", "name long", "d double"]
    if moved:
        kinds = ["cell long", "start int", "name long", "cost double", "weight double", "center array<double>"]
    tasks = 2 * points.sparkSession.sparkContext.defaultParallelism
    return (
        rows.repartition(tasks, "cell", "slice")
        .sortWithinPartitions("cell", "slice", F.col("centers").isNull())
        .mapInArrow(_measuring(columns, moved), ", ".join(kinds))
    )


def _parts(centers: DataFrame, points: DataFrame, slices: DataFrame | None = None) -> DataFrame:
    """The nearest centre of the own cell for every point, lowest number on ties."""
    return _measured(centers, "part", points, slices, False).select(
        *points.columns,
        "start",
        F.col("name").cast("int").alias("part"),
        (F.col("d") * F.col("weight")).alias("cost"),
    )


def _moved(centers: DataFrame, points: DataFrame, slices: DataFrame | None = None) -> DataFrame:
    """One Lloyd step: (cell, start, centers, cost) with the cost before the move."""
    means = (
        _measured(centers, "part", points, slices, True)
        .groupBy("cell", "start", F.col("name").cast("int").alias("part"))
        .agg(
            vector_to_array(Summarizer.mean(array_to_vector("center"), F.col("weight"))).alias("center"),
            F.sum("cost").alias("cost"),
        )
    )
    return means.groupBy("cell", "start").agg(
        F.sort_array(F.collect_list(F.struct("part", "center"))).alias("centers"),
        F.sum("cost").alias("cost"),
    )


def _pool(points: DataFrame, seed: int, slices: DataFrame | None = None) -> DataFrame:
    """(cell, pid, center, weight): possible centres of every cell and the weight of the points nearest.

    The first is drawn by weight, then ``ROUNDS`` times ``DRAWN`` points by weight times squared
    distance to the pool so far. Exponential keys draw without replacement, in all cells at once: the
    points with the least keys are those drawn, and tasks hand on only their own least.
    """

    def drawn(rows: DataFrame, chance: Column, number: int, n: int) -> DataFrame:
        bits = F.shiftrightunsigned(F.xxhash64("pid", F.lit(number), F.lit(seed)), 11)
        key = -F.log((bits + 0.5) / 2.0**53) / chance
        place = F.row_number().over(Window.partitionBy("cell").orderBy("key", "pid"))
        keyed = rows.where(chance > 0).select("cell", "pid", "vec", key.alias("key"))
        return keyed.withColumn("place", place).where(F.col("place") <= n).select(
            "cell", "pid", F.col("vec").alias("center")
        )

    def nearest(pool: DataFrame) -> DataFrame:
        held = pool.groupBy("cell").agg(F.collect_list(F.struct("pid", "center")).alias("centers"))
        return _measured(held.withColumn("start", F.lit(0)), "pid", points, slices, False)

    pool = through_table(drawn(points, F.col("weight"), 0, 1), "pool")
    for number in range(1, ROUNDS + 1):
        more = drawn(nearest(pool), F.col("weight") * F.col("d"), number, DRAWN)
        pool = through_table(pool.unionByName(more), "pool")
    weights = nearest(pool).groupBy("cell", F.col("name").alias("pid")).agg(F.sum("weight").alias("weight"))
    return pool.join(weights, ["cell", "pid"])


def _drawn_starts(config: Config):
    """``kmeans_inits`` weighted k-means of one cell's pool; the ``kmeans_starts`` best are handed on."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by("pid")
        k, weight = cell["k"][0].as_py(), cell["weight"].to_numpy()
        x = np.array(cell["center"].to_pylist(), float)
        rng = np.random.default_rng([config.seed, cell["cell"][0].as_py()])
        found = {}

        def distances(centers):
            return ((x[:, None] - centers) ** 2).sum(2)

        for _ in range(config.kmeans_inits):
            chance, picked = weight.astype(float), []
            while len(picked) < min(k, len(x)) and chance.sum() > 0:
                picked.append(rng.choice(len(x), p=chance / chance.sum()))
                chance = weight * distances(x[picked]).min(1)
            centers, before = x[picked], np.inf
            while True:
                d = distances(centers)
                part, cost = d.argmin(1), float((weight * d.min(1)).sum())
                if not cost < before * (1 - config.kmeans_tolerance):
                    break
                before = cost
                centers = np.array([np.average(x[part == c], axis=0, weights=weight[part == c]) for c in np.unique(part)])
            # Starts that part the pool alike are one start.
            found.setdefault(tuple(np.unique(part, return_index=True)[1][part]), (cost, centers))
        best = sorted(found.values(), key=lambda f: f[0])[: config.kmeans_starts]
        lists = [[{"part": i, "center": c.tolist()} for i, c in enumerate(centers, 1)] for _, centers in best]
        kind = pa.list_(pa.struct([("part", pa.int32()), ("center", pa.list_(pa.float64()))]))
        names = pa.array([cell["cell"][0].as_py()] * len(best), pa.int64())
        return pa.table({"cell": names, "start": pa.array(range(len(best)), pa.int32()), "centers": pa.array(lists, kind)})

    return run


def _best_centers(points: DataFrame, wanted: DataFrame, config: Config) -> DataFrame:
    """(cell, start, centers) of a k-means in every cell.

    ``wanted``: (cell, k). Every point is measured against a pool of at most 1 + ROUNDS * DRAWN points
    of its cell; ``kmeans_inits`` starts are drawn from that weighted pool by squared distance, and
    the ``kmeans_starts`` best take their steps over all points to the end. A start ends when its cost
    falls by no more than ``kmeans_tolerance`` of itself, or after ``kmeans_iterations``; the one with
    the least cost stays.
    """
    slices = wanted.select("cell", "slices") if "slices" in wanted.columns else _slices(points)
    starts = (
        _pool(points, config.seed, slices)
        .join(wanted.select("cell", "k"), "cell")
        .groupBy("cell")
        .applyInArrow(
            _drawn_starts(config),
            "cell long, start int, centers array<struct<part: int, center: array<double>>>",
        )
    )
    now, done, steps = _moved(through_table(starts, "centers"), points, slices), [], 1
    now = through_table(now, "centers")
    while steps < config.kmeans_iterations:
        # Two steps at a time: fewer passes through tables.
        middle = _moved(now.drop("cost"), points, slices)
        after = _moved(middle.drop("cost"), points, slices).join(
            middle.select("cell", "start", F.col("cost").alias("before")), ["cell", "start"]
        )
        after = through_table(after, "centers")
        steps += 2
        still = F.col("cost") >= F.col("before") * (1 - config.kmeans_tolerance)
        done.append(after.where(still).drop("before"))
        now = after.where(~still).drop("before")
        if now.isEmpty():
            break
    ended = reduce(DataFrame.unionByName, [*done, now])
    best = F.min_by(F.struct("start", "centers"), F.struct("cost", "start")).alias("best")
    return ended.groupBy("cell").agg(best).select("cell", "best.*")


def _task_centers(x, weight, pid, k: int, cell: int, config: Config) -> np.ndarray:
    """What ``_best_centers`` does, for one cell whose points are at hand in the order of ``pid``."""
    rng = np.random.default_rng([config.seed, cell, len(x)])

    def drawn(chance, n):
        some = np.flatnonzero(chance > 0)
        key = rng.exponential(size=len(chance))[some] / chance[some]
        return some[np.argsort(key, kind="stable")[:n]]

    def nearest(pool):
        at, d = _nearest_of(x, x[pool])
        return at, d

    pool = np.sort(drawn(weight, 1))
    for _ in range(ROUNDS):
        pool = np.sort(np.concatenate([pool, drawn(weight * nearest(pool)[1], DRAWN)]))
    loads = np.bincount(nearest(pool)[0], weights=weight, minlength=len(pool))
    # A pool point with the vector of another has no weight.
    pool, loads = pool[loads > 0], loads[loads > 0]
    held = pa.table(
        {
            "cell": pa.array(np.full(len(pool), cell)),
            "pid": pa.array(pid[pool]),
            "k": pa.array(np.full(len(pool), k, np.int32)),
            "center": lists(x[pool]),
            "weight": pa.array(loads),
        }
    )

    def moved(centers):
        at, d = _nearest_of(x, centers)
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        sums = np.add.reduceat((x * weight[:, None])[order], first, axis=0)
        return sums / np.add.reduceat(weight[order], first)[:, None], float((weight * d).sum())

    found = []
    for start in _drawn_starts(config)(held)["centers"].to_pylist():
        (centers, cost), steps = moved(np.array([c["center"] for c in start])), 1
        while steps < config.kmeans_iterations:
            middle, before = moved(centers)
            centers, cost = moved(middle)
            steps += 2
            if cost >= before * (1 - config.kmeans_tolerance):
                break
        found.append((cost, centers))
    return min(found, key=lambda f: f[0])[1]


def _task_split(config: Config, coarse: float):
    """(pid, cell, cluster_id) of the points of one cell, split to the end by the steps of ``fit_clusters``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pid")
        vectors = table["vec"].combine_chunks()
        if vectors.null_count or vectors.flatten().null_count:
            raise ValueError("a point has no vector or a null in it")
        x, weight = matrix(vectors).astype(float), table["weight"].to_numpy()
        pid, outer = table["pid"].to_numpy(), table["outer"][0].as_py()
        cells, clusters = np.zeros(len(pid), np.int64), np.zeros(len(pid), np.int64)
        waiting = [(np.arange(len(pid)), outer)]
        while waiting:
            mine, outer = waiting.pop()
            n, name = weight[mine].sum(), int(pid[mine[0]])
            if outer is None and n <= coarse:
                outer = name
            k = min(FAN, math.floor(n / config.members_per_cluster + 0.5), len(mine))
            parts = []
            if k >= 2:
                own = x[mine]
                part = _nearest_of(own, _task_centers(own, weight[mine], pid[mine], k, name, config))[0]
                parts = [mine[part == p] for p in np.unique(part)]
            # Points too close to be told apart stay together.
            if len(parts) < 2:
                cells[mine], clusters[mine] = name if outer is None else outer, name
            waiting += [(p, outer) for p in parts] if len(parts) > 1 else []
        return pa.table({"pid": pa.array(pid), "cell": pa.array(cells), "cluster_id": pa.array(clusters)})

    return run


def fit_clusters(records: DataFrame, config: Config) -> DataFrame:
    """(record_id, vec, cell, cluster_id): about ``members_per_cluster`` records each.

    Equal vectors are folded into one weighted point first, so they always share a cluster. Then
    all cells are split by k-means at once, level by level, into up to ``FAN`` parts each, until a
    cell has less than twice ``members_per_cluster`` records or one point. Centres are rows of a
    table, the same steps serve any number of records, and nothing but geometry parts two records.
    A cell of at most ``TASK_POINTS`` points takes the same steps within one task.
    ``cell`` is the first ancestor with at most the square root of all records times
    ``members_per_cluster``, or a five-hundredth of all records if that is more: at most 8000 cells.
    """
    members = config.members_per_cluster
    folded = records.groupBy("vec").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    points = through_table(
        folded.select(F.monotonically_increasing_id().alias("pid"), "vec", "weight"), "points"
    )
    total = points.agg(F.sum("weight")).first()[0] or 0
    coarse = max(math.sqrt(total * members), total / 500)
    level = points.withColumns({"cell": F.lit(0).cast("long"), "outer": F.lit(None).cast("long")})
    final = []
    while True:
        sizes = level.groupBy("cell").agg(
            F.sum("weight").alias("n"), F.count(F.lit(1)).alias("points"), F.min("pid").alias("name")
        )
        parts = F.round(F.col("n") / members).cast("int")
        k = F.least(F.lit(FAN), parts, F.col("points").cast("int"))
        named = level.join(sizes.withColumn("k", k), "cell").withColumn(
            "outer", F.coalesce("outer", F.when(F.col("n") <= coarse, F.col("name")))
        )
        named = named.withColumn("slices", F.ceil(F.col("points") / SLICE_ROWS).cast("int"))
        named = named.withColumn("slice", F.pmod(F.xxhash64("pid"), F.col("slices")).cast("int"))
        named = through_table(named, "level")
        final.append(
            named.where("k < 2").select("pid", F.coalesce("outer", "name").alias("cell"), F.col("name").alias("cluster_id"))
        )
        few = named.where(f"k >= 2 AND points <= {TASK_POINTS}").select("cell", "outer", "pid", "vec", "weight")
        # More tasks than cores, as each cell is much work and few share a task then.
        tasks = 8 * records.sparkSession.sparkContext.defaultParallelism
        ended = few.repartition(tasks, "cell").groupBy("cell").applyInArrow(
            _task_split(config, coarse), "pid long, cell long, cluster_id long"
        )
        final.append(through_table(ended, "ended"))
        open_ = named.where(f"k >= 2 AND points > {TASK_POINTS}")
        if open_.isEmpty():
            break
        wanted = through_table(open_.select("cell", "k", "slices").distinct(), "wanted")
        columns = ["pid", "vec", "weight", "outer"]
        best = through_table(
            _best_centers(open_.select("cell", "slice", "pid", "vec", "weight"), wanted, config), "best"
        )
        split = _parts(best, open_.select("cell", "slice", *columns), wanted.select("cell", "slices"))
        split = through_table(split, "split")
        heads = split.groupBy("cell", "part").agg(F.min("pid").alias("head"))
        several = heads.groupBy("cell").agg(F.count(F.lit(1)).alias("parts"))
        split = split.join(heads, ["cell", "part"]).join(several, "cell")
        # Points too close to be told apart stay together.
        alone = split.where("parts = 1")
        final.append(
            alone.select("pid", F.coalesce("outer", "head").alias("cell"), F.col("head").alias("cluster_id"))
        )
        level = through_table(
            split.where("parts > 1").select(*columns, F.col("head").alias("cell")), "level"
        )
    placed = points.join(reduce(DataFrame.unionByName, final), "pid")
    key = F.xxhash64("vec")
    return (
        records.withColumn("_key", key)
        .join(placed.select(key.alias("_key"), F.col("vec").alias("_vec"), "cell", "cluster_id"), "_key")
        .where(F.col("vec") == F.col("_vec"))
        .select("record_id", "vec", "cell", "cluster_id")
    )

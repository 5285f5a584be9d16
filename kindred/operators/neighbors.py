"""Exact nearest records.

Copies of a vector are folded into one row before any distance is computed, with the
lowest ids that a result can need. Each query keeps one neighbour more than asked for and
drops itself at the end, so copies never have to be compared with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.vectors import euclidean
from kindred.operators.blocks import BLOCK_ROWS, block_join, nearest_rows
from kindred.operators.exact import mean_vectors
from kindred.session import through_table


# Cells whose centroids every task may hold.
MAX_CELLS = 10_000


def _fold_copies(df: DataFrame, id_col: str, vec_col: str, keep: int) -> DataFrame:
    """(cell, vec, ids): one row per distinct vector of a cell, its lowest ids in order.

    The rank filter is applied per task before the shuffle, so a vector copied a billion
    times sends ``keep`` ids per task.
    """
    order = Window.partitionBy("cell", "vec").orderBy("id")
    return (
        df.select("cell", F.col(vec_col).alias("vec"), F.col(id_col).alias("id"))
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= keep)
        .groupBy("cell", "vec")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )


def _fold_queries(df: DataFrame, id_col: str, vec_col: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct query vectors with a representative id, map from each id to it)."""
    named = df.select(*keys, F.col(vec_col).alias("vec"), F.col(id_col).alias("qid"))
    distinct = through_table(
        named.groupBy(*keys, "vec").agg(F.min("qid").alias("q_key")), "queries"
    )
    mapping = named.join(distinct, [*keys, "vec"]).select("qid", "q_key")
    return distinct, mapping


def _nearest_in_cells(
    routed: DataFrame, folded: DataFrame, k: int, block_rows: int
) -> DataFrame:
    """(q_key, dist, id): candidates for the k nearest, at most k folded rows per block."""
    id_type = dict(folded.dtypes)["ids"]
    key_type = dict(routed.dtypes)["q_key"]

    def nearest(q: pa.Table, qm: np.ndarray, c: pa.Table, cm: np.ndarray) -> pa.Table:
        lowest = pc.list_element(c["ids"], 0)
        order = np.empty(len(cm), np.int64)
        order[pc.sort_indices(lowest).to_numpy()] = np.arange(len(cm))
        qi, ci, dist = nearest_rows(qm, cm, order, k)
        return pa.table(
            {
                "q_key": q["q_key"].take(pa.array(qi)),
                "dist": pa.array(dist),
                "ids": c["ids"].take(pa.array(ci)),
            }
        )

    found = block_join(
        routed.select("cell", "vec", "q_key"),
        folded,
        nearest,
        f"q_key {key_type}, dist DOUBLE, ids {id_type}",
        block_rows,
    )
    return found.select("q_key", "dist", F.explode("ids").alias("id"))


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """(q_key, neighbours): the nearest ``keep`` over all blocks, in order."""
    order = Window.partitionBy("q_key").orderBy("dist", "id")
    return (
        found.withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= keep)
        .groupBy("q_key")
        .agg(F.array_sort(F.collect_list(F.struct("dist", "id"))).alias("neighbours"))
    )


def _unfold(
    ranked: DataFrame, mapping: DataFrame, k: int, query_id: str, exclude_self: bool = True
) -> DataFrame:
    """(query id, rank, id, dist) without the query itself.

    The ranking is stored first: both sides of the join then come straight from a
    shuffle, the form in which adaptive execution splits a key with very many copies.
    """
    ranked = through_table(ranked, "ranked")
    others = F.col("neighbours")
    if exclude_self:
        others = F.filter(others, lambda n: n.id != F.col("qid"))
    return (
        mapping.join(ranked, "q_key")
        .select("qid", F.posexplode(F.slice(others, 1, k)).alias("pos", "n"))
        .select(
            F.col("qid").alias(query_id),
            (F.col("pos") + 1).alias("rank"),
            F.col("n.id").alias("related_id"),
            F.col("n.dist").alias("distance"),
        )
    )


def nearest_in_group(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    group_col: str,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    id_col: str = "record_id",
    vec_col: str = "vec",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, related_id, distance): k nearest members of the query's own group."""
    grouped = queries.withColumn("cell", F.col(group_col))
    distinct, mapping = _fold_queries(grouped, query_id, query_vec, ["cell"])
    # A vector may occur in several groups: the representative id is one per group already.
    folded = through_table(
        _fold_copies(corpus.withColumn("cell", F.col(group_col)), id_col, vec_col, k + 1),
        "folded",
    )
    found = _nearest_in_cells(distinct, folded, k + 1, block_rows)
    return _unfold(_ranked(found, k + 1), mapping, k, query_id)


def cell_table(
    corpus: DataFrame, centroids: DataFrame, cell_col: str, vec_col: str = "vec"
) -> DataFrame:
    """(cell, centroid, radius, n): what the search must know about each cell.

    ``centroids`` holds (cell, centroid). The radius is the largest distance of a member.
    """
    measured = (
        corpus.select(F.col(cell_col).alias("cell"), F.col(vec_col).alias("_v"))
        .join(centroids, "cell")
        .select("cell", euclidean(F.col("_v"), F.col("centroid")).alias("d"))
        .groupBy("cell")
        .agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("n"))
    )
    return centroids.join(measured, "cell").select("cell", "centroid", "radius", "n")


def mean_cells(corpus: DataFrame, cell_col: str, vec_col: str = "vec") -> DataFrame:
    """(cell, centroid): mean vector per cell."""
    rows = corpus.select(F.col(cell_col).alias("cell"), F.col(vec_col).alias("vec"))
    return mean_vectors(rows, ["cell"], "vec", "centroid")


def _bounds(cells: DataFrame):
    """Cell summaries as one array, read once. One entry per cell of the search."""
    return cells.agg(F.collect_list(F.struct("cell", "centroid", "radius", "n"))).scalar()


def _with_cells(queries: DataFrame, cells: DataFrame, need: int) -> DataFrame:
    """Adds ``_cells`` (distance to each centroid, radius, n) and ``_limit``.

    ``_limit`` bounds the distance of the ``need``-th nearest record: the cells whose
    farthest possible member lies within it hold that many records together.
    """
    with_cells = queries.withColumn("_bounds", _bounds(cells)).withColumn(
        "_cells",
        F.transform(
            "_bounds",
            lambda c: F.struct(
                euclidean(c.centroid, F.col("vec")).alias("d"),
                c.cell.alias("cell"),
                c.radius.alias("radius"),
                c.n.alias("n"),
            ),
        ),
    )
    reach = F.array_sort(
        F.transform("_cells", lambda c: F.struct((c.d + c.radius).alias("far"), c.n.alias("n")))
    )
    limit = F.aggregate(
        reach,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("far")),
        lambda acc, c: F.struct(
            (acc.n + c.n).alias("n"),
            F.coalesce(acc.far, F.when(acc.n + c.n >= need, c.far)).alias("far"),
        ),
    )
    return with_cells.drop("_bounds").withColumn("_limit", limit["far"])


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    cells: DataFrame,
    k: int,
    cell_col: str = "cluster_id",
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    id_col: str = "record_id",
    vec_col: str = "vec",
    block_rows: int = BLOCK_ROWS,
    exclude_self: bool = True,
) -> DataFrame:
    """(query_id, rank, related_id, distance): exact k nearest records of the whole corpus.

    A query first searches the cell with the nearest centroid. The distance of its k-th
    hit there, or the bound from the cell radii when that is smaller, limits the second
    step: a cell can only hold a nearer record when the distance to its centroid minus
    its radius is within the limit. All other cells are skipped without a comparison.

    The folded corpus and the first step are written to the scratch folder, because both
    steps read them.
    """
    count = cells.count()
    if count > MAX_CELLS:
        raise ValueError(f"{count} cells exceed {MAX_CELLS}; group them into coarser cells")
    keep = k + 1
    distinct, mapping = _fold_queries(queries, query_id, query_vec, [])
    folded = through_table(
        _fold_copies(corpus.withColumn("cell", F.col(cell_col)), id_col, vec_col, keep),
        "folded",
    )
    by_distance = F.transform(
        "_cells", lambda c: F.struct(c.d.alias("d"), c.cell.alias("cell"))
    )
    placed = through_table(
        _with_cells(distinct, cells, keep).withColumn("_home", F.array_min(by_distance)),
        "placed",
    )
    at_home = placed.select("q_key", "vec", F.col("_home.cell").alias("cell"))
    home_found = _nearest_in_cells(at_home, folded, keep, block_rows)
    home_ranked = through_table(_ranked(home_found, keep), "home")
    home_limit = home_ranked.where(F.size("neighbours") == keep).select(
        "q_key", F.element_at("neighbours", -1)["dist"].alias("_kth")
    )
    # The kept distances are rounded to 9 digits.
    limit = F.least(F.col("_limit"), F.col("_kth")) + 1e-8
    away = (
        placed.join(home_limit, "q_key", "left")
        .withColumn("_bound", limit)
        .select(
            "q_key",
            "vec",
            F.explode(
                F.filter(
                    "_cells",
                    lambda c: (c.cell != F.col("_home.cell"))
                    & (F.col("_bound").isNull() | (c.d - c.radius <= F.col("_bound"))),
                )
            ).alias("c"),
        )
        .select("q_key", "vec", F.col("c.cell").alias("cell"))
    )
    away_found = _nearest_in_cells(away, folded, keep, block_rows)
    first = home_ranked.select("q_key", F.explode("neighbours").alias("n")).select(
        "q_key", "n.dist", "n.id"
    )
    ranked = _ranked(first.unionByName(away_found), keep)
    return _unfold(ranked, mapping, k, query_id, exclude_self)

"""Joins of vectors within cells, in blocks of bounded size.

Both sides carry a ``cell``. A cell with more rows than fit one block is cut into chunks
by hash on both sides, and every chunk of one side meets every chunk of the other, so no
task ever holds more than ``block_rows`` rows per side of a large cell. Small cells
share a task. The pairs of a block exist only as a matrix inside the task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kindred.session import through_table

BLOCK_ROWS = 8192
_BATCH = 512


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = len(column)
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if rows else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(rows, -1)


def _cell_slices(table: pa.Table) -> dict[tuple, np.ndarray]:
    """Row numbers per (cell, left chunk, right chunk)."""
    frame = table.select(["cell", "_lb", "_rb"]).to_pandas()
    return frame.groupby(["cell", "_lb", "_rb"], sort=False).indices


def block_join(
    left: DataFrame,
    right: DataFrame,
    fn: Callable[[pa.Table, np.ndarray, pa.Table, np.ndarray], pa.Table | None],
    schema: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Calls ``fn(left rows, left matrix, right rows, right matrix)`` per block.

    ``left`` and ``right`` hold ``cell``, ``vec`` and what ``fn`` needs. Cells without rows
    on both sides never meet.
    """
    left_n = left.groupBy("cell").agg(F.count(F.lit(1)).alias("_ln"))
    right_n = right.groupBy("cell").agg(F.count(F.lit(1)).alias("_rn"))
    # One row per cell, read several times below.
    sizes = through_table(
        left_n.join(right_n, "cell").select(
            "cell",
            "_ln",
            "_rn",
            F.ceil(F.col("_ln") / block_rows).cast("int").alias("_lc"),
            F.ceil(F.col("_rn") / block_rows).cast("int").alias("_rc"),
        ),
        "sizes",
    )
    spark = left.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    # Small cells fill bins of about a block; every block of a large cell is a bin.
    wanted = sizes.agg(F.sum(F.col("_lc") * F.col("_rc")), F.sum(F.greatest("_ln", "_rn"))).first()
    tasks = max(tasks, -(-(wanted[1] or 0) // block_rows))
    bins = F.lit(max(tasks, wanted[0] or 0)).cast("long")
    # Small cells share a bin; each block of a large cell has its own.
    bin_of = F.when(
        (F.col("_lc") > 1) | (F.col("_rc") > 1),
        F.xxhash64("cell", "_lb", "_rb"),
    ).otherwise(F.pmod(F.xxhash64("cell"), bins))

    def chunked(df: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        columns = df.columns
        return (
            df.join(sizes, "cell")
            .withColumn(own, F.pmod(F.xxhash64(*columns), F.col(own_n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
            .select(*columns, "_lb", "_rb", bin_of.alias("_bin"))
            # A fixed number: the blocks are small in bytes and heavy in work, so
            # coalescing by size would leave cores idle.
            .repartition(tasks, "_bin")
        )

    def run(l: pa.Table, r: pa.Table) -> pa.Table:
        parts = []
        if l.num_rows and r.num_rows:
            l_rows, r_rows = _cell_slices(l), _cell_slices(r)
            for key, li in l_rows.items():
                ri = r_rows.get(key)
                if ri is not None:
                    lt, rt = l.take(pa.array(li)), r.take(pa.array(ri))
                    out = fn(lt, _matrix(lt["vec"]), rt, _matrix(rt["vec"]))
                    if out is not None and out.num_rows:
                        parts.append(out.cast(arrow_schema))
        return pa.concat_tables(parts) if parts else arrow_schema.empty_table()

    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))
    l = chunked(left, "_lb", "_lc", "_rb", "_rc").groupBy("_bin")
    r = chunked(right, "_rb", "_rc", "_lb", "_lc").groupBy("_bin")
    return l.cogroup(r).applyInArrow(run, schema)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances of two blocks; small ones lose digits to cancellation."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0, out=d)


def nearest_rows(
    a: np.ndarray, b: np.ndarray, order: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest rows of ``b`` for every row of ``a``: (row of a, row of b, distance).

    The matrix product only proposes candidates, with a margin above its rounding error;
    their distances are computed again from the differences, rounded to 9 digits, and
    ranked by (distance, ``order``).
    """
    rows_a, rows_b, distances = [], [], []
    k = min(k, len(b))
    norms_b = (b * b).sum(1)
    for start in range(0, len(a), _BATCH):
        part = a[start : start + _BATCH]
        d2 = squared_distances(part, b)
        kth = np.partition(d2, k - 1, axis=1)[:, k - 1]
        margin = 1e-8 * np.sqrt(kth) + 1e-12 * ((part * part).sum(1) + norms_b.max()) + 1e-15
        i, j = np.nonzero(d2 <= (kth + margin)[:, None])
        diff = part[i] - b[j]
        dist = np.round(np.sqrt(np.einsum("ij,ij->i", diff, diff)), 9)
        by = np.lexsort((order[j], dist, i))
        i, j, dist = i[by], j[by], dist[by]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < k
        rows_a.append(i[keep] + start)
        rows_b.append(j[keep])
        distances.append(dist[keep])
    return np.concatenate(rows_a), np.concatenate(rows_b), np.concatenate(distances)

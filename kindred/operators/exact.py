"""Means of vectors that do not depend on how rows are dealt to tasks.

A coordinate is split into a whole multiple of 2^-12 and a rest in whole multiples of 2^-52. Whole
numbers add up to the same sum in any order; one division at the end gives the mean. Coordinates must
stay below 2^50 in sum; what is smaller than 2^-52 is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COARSE, FINE = 12, 52
_CARRY = FINE - COARSE
PARTS = ("_n", "_hi", "_lo")
PART_TYPES = "_n long, _hi array<long>, _lo array<long>"


def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers hi, lo with x = hi / 2^12 + lo / 2^52."""
    hi = np.rint(np.ldexp(x, COARSE))
    lo = np.rint(np.ldexp(x - np.ldexp(hi, -COARSE), FINE))
    return hi.astype(np.int64), lo.astype(np.int64)


def carried(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same numbers with 0 <= lo < 2^40, so that millions of them can be added."""
    over = lo >> _CARRY
    return hi + over, lo - (over << _CARRY)


def value(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return np.ldexp(hi.astype(float), -COARSE) + np.ldexp(lo.astype(float), -FINE)


def matrix(column) -> np.ndarray:
    """A list column as a matrix."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    if not len(column):
        return np.empty((0, 0))
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks])
    return flat.reshape(len(column), -1)


def lists(values: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel())
    )


def _codes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """The same number for rows with equal keys."""
    code = np.zeros(batch.num_rows, np.int64)
    for key in keys:
        column = batch.column(key).dictionary_encode(null_encoding="encode")
        code = code * (len(column.dictionary) + 1) + column.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    return code


def _summed(keys, vec, weight):
    """One partial sum per key and batch."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            code = _codes(batch, keys)
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.diff(code[order], prepend=-1))
            n = np.ones(len(order), np.int64)
            if weight is not None:
                n = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            hi, lo = (x * n[:, None] for x in split(matrix(batch.column(vec)).astype(float)))
            hi, lo = (np.add.reduceat(x[order], first) for x in (hi, lo))
            hi, lo = carried(hi, lo)
            at = pa.array(order[first])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in keys), pa.array(np.add.reduceat(n[order], first)), lists(hi), lists(lo)],
                [*keys, *PARTS],
            )

    return run


def _combined(keys, out):
    """Means of rows that are sorted by keys; the last key of a batch waits for the next batch."""

    def run(batches):
        held = None

        def rows(table, n, hi, lo):
            mean = value(hi, lo) / n[:, None]
            return pa.RecordBatch.from_arrays([*table.columns, lists(mean)], [*keys, out])

        for batch in batches:
            if not batch.num_rows:
                continue
            code = _codes(batch, keys)
            first = np.flatnonzero(np.diff(code, prepend=-1))
            n = np.add.reduceat(batch.column("_n").to_numpy(), first)
            hi, lo = (np.add.reduceat(matrix(batch.column(c)), first) for c in ("_hi", "_lo"))
            hi, lo = carried(hi, lo)
            names = pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(first)) for k in keys], list(keys))
            if held is not None:
                if held[0].to_pylist() == names.slice(0, 1).to_pylist():
                    n[0] += held[1][0]
                    hi[0], lo[0] = carried(hi[0] + held[2][0], lo[0] + held[3][0])
                else:
                    yield rows(*held)
            last = len(first) - 1
            if last:
                yield rows(names.slice(0, last), n[:last], hi[:last], lo[:last])
            held = names.slice(last), n[last:], hi[last:], lo[last:]
        if held is not None:
            yield rows(*held)

    return run


def combine(partials: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """(keys, out): means from rows with ``keys``, ``_n``, ``_hi`` and ``_lo``."""
    types = dict(partials.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys)
    return (
        partials.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_combined(list(keys), out), f"{schema}, {out} array<double>")
    )


def mean_vectors(
    rows: DataFrame, keys: Sequence[str], vec: str, out: str, weight: str | None = None
) -> DataFrame:
    """(keys, out): mean vector per key; ``weight``, a column of whole numbers, repeats a row.

    Tasks add up what they read before anything is shuffled, so a key that holds most rows sends one
    row per batch. The same rows give the same bytes, however they are partitioned.
    """
    keys = list(keys)
    columns = [*keys, vec] + ([weight] if weight else [])
    types = dict(rows.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys)
    partials = rows.select(*columns).mapInArrow(
        _summed(keys, vec, weight), f"{schema}, {PART_TYPES}"
    )
    return combine(partials, keys, out)

"""Arithmetic on ARRAY<DOUBLE> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-10


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def squared_euclidean(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x * x)))


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def cosine(a: Column, b: Column) -> Column:
    """Cosine with 1e-10 added to each norm, so a zero vector scores 0."""
    return dot(a, b) / ((norm(a) + F.lit(EPSILON)) * (norm(b) + F.lit(EPSILON)))


def parse_vector(text: Column) -> Column:
    """``"[0, 1]"`` to an array."""
    return F.from_json(text, "array<double>")


def cosine_of_text(a: Column, b: Column) -> Column:
    return cosine(parse_vector(a), parse_vector(b))


def vector_text(vector: Column) -> Column:
    """An array to ``"[0, 1]"``."""
    return F.concat(
        F.lit("["), F.array_join(vector.cast("array<string>"), ", "), F.lit("]")
    )

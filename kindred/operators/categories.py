"""Category dictionaries and 0/1 vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_features(df: DataFrame, id_col: str) -> tuple[list[str], list[str]]:
    """(numeric columns passed through, other columns to encode), by declared type."""
    numeric, other = [], []
    for field in df.schema.fields:
        if field.name != id_col:
            is_number = isinstance(field.dataType, T.NumericType)
            (numeric if is_number else other).append(field.name)
    return numeric, other


def category_dictionary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, category, idx): sorted distinct values per feature, from 0.

    One pass over the table: the values of all features are stacked, and copies of a value
    meet in the map-side aggregate, so only distinct values are shuffled. A dictionary is
    as wide as the vectors it encodes and therefore small.
    """
    stacked = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category"))
                    for f in features
                ]
            )
        )
    )
    order = Window.partitionBy("feature").orderBy("category")
    return (
        stacked.where("category is not null")
        .distinct()
        .withColumn("idx", F.row_number().over(order) - 1)
    )


def categories_of(dictionary: DataFrame, feature: str) -> Column:
    """The categories of one feature as an array, read once as a scalar subquery."""
    return (
        dictionary.where(F.col("feature") == feature)
        .agg(F.array_sort(F.collect_list(F.struct("idx", "category")))["category"].alias("c"))
        .scalar()
    )


def multi_hot(value: Column, categories: Column, mode: str = "value") -> Column:
    """0/1 array over the categories; unseen values give zeros.

    ``mode="value"`` looks the whole value up. ``mode="words"`` looks up each word of the
    value, so that a category of several words is never set by itself.
    """
    if mode == "value":
        return F.transform(categories, lambda c: F.coalesce((c == value).cast("int"), F.lit(0)))
    words = F.split(F.trim(value), r"\s+")
    hot = F.transform(
        categories, lambda c: F.coalesce(F.array_contains(words, c).cast("int"), F.lit(0))
    )
    # Most values of several words set nothing, which one look at the categories tells.
    return F.when(~F.arrays_overlap(words, categories), F.array_repeat(F.lit(0), F.size(categories))).otherwise(hot)


def encode(
    df: DataFrame, dictionary: DataFrame, features: Sequence[str], mode: str = "value"
) -> DataFrame:
    """Replaces each listed column by its 0/1 array. Works for new rows as well."""
    known = {f"_known_{f}": categories_of(dictionary, f) for f in features}
    return (
        df.withColumns(known)
        .withColumns(
            {
                f: multi_hot(F.col(f).cast("string"), F.col(f"_known_{f}"), mode)
                for f in features
            }
        )
        .drop(*known)
    )


def flatten(df: DataFrame, columns: Sequence[str], out: str = "category_vector") -> DataFrame:
    """Arrays and numbers, in the given order, as one ARRAY<DOUBLE>."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in columns:
        if isinstance(types[name], T.ArrayType):
            parts.append(F.col(name).cast("array<double>"))
        elif isinstance(types[name], T.StringType):
            parts.append(F.from_json(F.col(name), "array<double>"))
        else:
            parts.append(F.array(F.col(name).cast("double")))
    return df.withColumn(out, F.concat(*parts))

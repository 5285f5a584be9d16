"""Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Scan with projection; the reader fetches the listed columns only."""
    return spark.read.parquet(path).select(*columns)


def read_all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)

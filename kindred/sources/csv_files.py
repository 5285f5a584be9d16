"""CSV with a header: quoted throughout, quotes doubled, line breaks inside values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# An empty value and a null must stay distinct in text form.
_NULL = "\\N"


def write_csv(df: DataFrame, path: str, encoding: str = "utf-8") -> None:
    df.write.csv(
        path,
        header=True,
        quoteAll=True,
        escape='"',
        encoding=encoding,
        nullValue=_NULL,
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    encoding: str = "utf-8",
    null_value: str = _NULL,
) -> DataFrame:
    """Files written elsewhere mark nulls their own way: pass ``null_value``."""
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        multiLine=True,
        quote='"',
        escape='"',
        encoding=encoding,
        nullValue=null_value,
        emptyValue="",
    )

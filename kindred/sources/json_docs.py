"""Nested JSON documents: four kinds, read and written as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- Fixed values: document layouts -----------------------------------------
SCHEMAS = {
    "repro": "bug_id STRING, repro_step STRING",
    "log": (
        "bug_id STRING, list_log_info ARRAY<STRUCT<"
        "log_name: STRING, err_msg: STRING, file_path: STRING>>"
    ),
    "related": (
        "bug_id STRING, list_of_rel_bugs ARRAY<STRUCT<"
        "bug_id: STRING, keywords: STRING, bug_distance: STRING, key_feature: STRING, "
        "key_phrase: STRING, description: STRING, severity: STRING, de_mgr: STRING, "
        "de: STRING>>"
    ),
    "users": "bug_id STRING, list_of_users ARRAY<STRUCT<user_email: STRING>>",
}
# -----------------------------------------------------------------------------


def write_documents(docs: DataFrame, path: str, double_encoded: bool = False) -> None:
    """JSON lines; ``double_encoded`` wraps each document as one JSON string."""
    if not double_encoded:
        docs.write.json(path, ignoreNullFields=False)
        return
    line = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    escaped = F.replace(
        F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')
    )
    docs.select(F.concat(F.lit('"'), escaped, F.lit('"')).alias("value")).write.text(path)


def read_documents(
    spark: SparkSession,
    path: str,
    kind: str,
    double_encoded: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Documents of one kind. ``multi_line`` reads files that hold one JSON array.

    Double-encoded lines hold one JSON string; ``from_json`` unwraps it twice.
    """
    schema = SCHEMAS[kind]
    if not double_encoded:
        return spark.read.schema(schema).json(path, multiLine=multi_line)
    unwrapped = F.from_json(
        F.concat(F.lit('{"doc":'), F.col("value"), F.lit("}")), "doc STRING"
    )["doc"]
    return (
        spark.read.text(path)
        .select(F.from_json(unwrapped, schema).alias("doc"))
        .select("doc.*")
    )

"""Scans, sinks and row operators on the record table and on orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.config import TEXT_FIELDS
from kindred.functions import scalars as sc
from kindred.operators import rows
from kindred.session import scratch_path
from kindred.sources import csv_files, tables
from suite import views
from suite.registry import query
from suite.sql import RID, with_ctes


@query("scan_project", "SELECT doc_id, lang, n_chars FROM documents")
def scan_project(spark, sf):
    return tables.read_columns(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "n_chars"])


@query("scan_full", "SELECT * FROM documents")
def scan_full(spark, sf):
    return tables.read_all(spark, f"{sf}/documents.parquet")


@query("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf):
    """Texts with line breaks and quotes through CSV and back."""
    documents = views.table(spark, sf, "documents")
    path = scratch_path(spark, "csv")
    csv_files.write_csv(documents, path)
    return csv_files.read_csv(spark, path, documents.schema)


@query(
    "csv_latin1_roundtrip",
    r"SELECT doc_id, regexp_replace(text, '[^\x00-\xff]', ' ', 'g') AS text FROM documents",
)
def csv_latin1_roundtrip(spark, sf):
    documents = views.table(spark, sf, "documents").select(
        "doc_id", F.regexp_replace("text", r"[^\x00-\xff]", " ").alias("text")
    )
    path = scratch_path(spark, "csv-latin1")
    csv_files.write_csv(documents, path, encoding="ISO-8859-1")
    return csv_files.read_csv(spark, path, documents.schema, encoding="ISO-8859-1")


@query(
    "rename_drop",
    with_ctes(
        "records",
        """SELECT record_id AS input_id, project, product, manager AS query_manager,
               severity AS query_severity FROM records""",
    ),
)
def rename_drop(spark, sf):
    picked = rows.project(
        views.records(spark, sf),
        ["record_id", "component", "submitted_on", "project", "product", "manager", "severity"],
    )
    names = {"record_id": "input_id", "manager": "query_manager", "severity": "query_severity"}
    return rows.rename(picked, names).drop("component", "submitted_on")


@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def dedup_rows(spark, sf):
    return rows.distinct_rows(views.table(spark, sf, "documents").select("text", "lang"))


@query(
    "null_fill",
    f"""SELECT {RID.replace('doc_id', 'd.doc_id')} AS record_id,
               coalesce(quality, 999) AS quality, coalesce(toxic, 999) AS toxic,
               coalesce(string_split(d.text, chr(10))[3], 'Missing') AS symptoms,
               coalesce(CASE WHEN quality = 1 THEN 'good' END, '999') AS grade
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def null_fill(spark, sf):
    joined = views.table(spark, sf, "documents").join(
        views.table(spark, sf, "labels"), "doc_id", "left"
    )
    picked = joined.select(
        views.record_id().alias("record_id"),
        "quality",
        "toxic",
        F.get(F.split("text", "\n"), 2).alias("symptoms"),
        F.when(F.col("quality") == 1, F.lit("good")).alias("grade"),
    )
    return rows.fill_nulls(picked, text_columns=["symptoms"])


@query("message_concat", with_ctes("messages", "SELECT record_id, message FROM messages"))
def message_concat(spark, sf):
    return views.messages(spark, sf)


@query(
    "message_concat_compat",
    with_ctes(
        "records",
        "SELECT record_id, concat(record_id, "
        + ", ".join(f"coalesce({f}, 'Missing')" for f in TEXT_FIELDS)
        + ", coalesce(duplicate_of, 'Missing')) AS message FROM records",
    ),
)
def message_concat_compat(spark, sf):
    return views.records(spark, sf).select(
        "record_id",
        sc.message_compat(["record_id", *TEXT_FIELDS, "duplicate_of"]).alias("message"),
    )


@query(
    "cast_string",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(quality AS VARCHAR) AS quality,
           CAST(toxic AS VARCHAR) AS toxic FROM labels""",
)
def cast_string(spark, sf):
    labels = views.table(spark, sf, "labels")
    return labels.select(*[F.col(c).cast("string").alias(c) for c in labels.columns])


@query(
    "parse_ts",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS parsed,
           TRY_CAST(o_orderpriority AS TIMESTAMP) IS NULL AS bad_is_null FROM orders""",
)
def parse_ts(spark, sf):
    orders = views.table(spark, sf, "orders")
    as_text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return orders.select(
        "o_orderkey",
        F.date_format(sc.parse_timestamp(as_text), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        sc.parse_timestamp(F.col("o_orderpriority")).isNull().alias("bad_is_null"),
    )


@query(
    "age_weeks",
    """SELECT o_orderkey, CAST(trunc(floor((epoch_us(TIMESTAMP '2002-01-01') - epoch_us(o_orderdate))
           / 86400000000.0) / 7) AS INTEGER) AS age_weeks FROM orders""",
)
def age_weeks(spark, sf):
    as_of = F.lit("2002-01-01").cast("timestamp")
    return views.table(spark, sf, "orders").select(
        "o_orderkey", sc.age_in_weeks(F.col("o_orderdate"), as_of).alias("age_weeks")
    )


@query(
    "pin_prefix",
    "SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS pin FROM orders",
)
def pin_prefix(spark, sf):
    return views.table(spark, sf, "orders").select(
        "o_orderkey", sc.prefix_before_dash(F.col("o_orderpriority")).alias("pin")
    )


@query("filter_eq", "SELECT doc_id, source, n_chars FROM documents WHERE source = 'src7'")
def filter_eq(spark, sf):
    documents = views.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return rows.where_equal(documents, "source", "src7")


@query(
    "known_id_gate",
    f"""
    WITH q AS (SELECT {RID} AS record_id FROM labels
               UNION ALL SELECT printf('B%07d', item_id) FROM benchmark)
    SELECT record_id, record_id IN (SELECT {RID} FROM documents) AS known FROM q""",
)
def known_id_gate(spark, sf):
    """Labelled records are in the corpus, the items of ``benchmark`` are not."""
    corpus = views.table(spark, sf, "documents").select(views.record_id().alias("record_id"))
    labelled = views.table(spark, sf, "labels").select(views.record_id().alias("record_id"))
    queries = labelled.unionByName(views.new_records(spark, sf).select("record_id"))
    known = rows.known_ids(queries, corpus).withColumn("known", F.lit(True))
    return known.unionByName(rows.unknown_ids(queries, corpus).withColumn("known", F.lit(False)))


@query(
    "dup_label",
    with_ctes(
        "records",
        """SELECT record_id, CASE WHEN duplicate_of IS NOT NULL THEN record_id || '- duplicate'
               ELSE record_id END AS related_label FROM records""",
    ),
)
def dup_label(spark, sf):
    return views.records(spark, sf).select(
        "record_id",
        sc.duplicate_label(F.col("record_id"), F.col("duplicate_of").isNotNull()).alias(
            "related_label"
        ),
    )


@query(
    "query_key",
    f"SELECT {RID} AS record_id, 'review' AS input_list FROM labels WHERE toxic = 1",
)
def query_key(spark, sf):
    return rows.constant(views.flagged(spark, sf), "input_list", "review")

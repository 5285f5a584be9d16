"""Related records for the records under review, and the JSON documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.config import EXPLAIN_FEATURES, TEXT_FIELDS
from kindred.operators import categories as cat
from kindred.operators import cleaning, clusters, explain, neighbors, related
from kindred.plans.report import Corpus, Queries, explained, related_report
from kindred.session import scratch_path, through_table
from kindred.sources import json_docs
from suite import views
from suite.feature_queries import field_vectors
from suite.label_queries import named_clusters
from suite.registry import query
from suite.sql import with_ctes


def _vectors(docs):
    """Document vectors as a stored table, with the source as search cell."""
    source = F.substring_index("cluster_id", "-", 1).alias("cell")
    return through_table(views.document_vectors(docs).select("*", source), "vectors")


def _reviewed(spark, sf, corpus):
    return views.as_queries(corpus.join(views.flagged(spark, sf), "record_id", "left_semi"))


def _cells(corpus):
    return neighbors.cell_table(corpus, neighbors.mean_cells(corpus, "cell"), "cell")


def _candidates(spark, sf, docs=None):
    corpus = _vectors(views.tokens(spark, sf) if docs is None else docs)
    return related.candidates(
        _reviewed(spark, sf, corpus), corpus, _cells(corpus), cell_col="cell"
    )


def _categories(spark, sf):
    as_of = F.lit(views.AS_OF).cast("timestamp")
    clean = cleaning.clean_category_table(views.records(spark, sf), as_of)
    return cat.encode(clean, cat.category_dictionary(clean, EXPLAIN_FEATURES), EXPLAIN_FEATURES)


def _fields(spark, sf, docs):
    """Field vectors as a stored table: both sides of a pair read them."""
    return through_table(field_vectors(spark, sf, docs), "fields")


def _of_queries(table):
    return table.withColumnRenamed("record_id", "query_id")


def _tags(docs):
    return docs.select("record_id", "cluster_id").join(named_clusters(docs), "cluster_id")


@query(
    "candidate_union",
    with_ctes(
        "candidates",
        "SELECT query_id, related_id, round(distance, 6) + 0.0 AS distance FROM candidates",
    ),
)
def candidate_union(spark, sf):
    return _candidates(spark, sf).withColumn("distance", F.round("distance", 6) + F.lit(0.0))


@query(
    "related_ranked",
    with_ctes(
        "candidates records named",
        """SELECT query_id, related_id, round(distance, 6) + 0.0 AS distance, description,
               r.severity AS related_severity, r.manager AS related_manager,
               array_to_string(key_word, ',') AS key_word, array_to_string(key_phrase, ';') AS key_phrase
        FROM candidates c JOIN records r ON r.record_id = c.related_id
        JOIN named n ON n.cluster_id = r.project ORDER BY query_id, distance, related_id""",
    ),
)
def related_ranked(spark, sf):
    docs = views.tokens(spark, sf)
    corpus = _vectors(docs)
    found = related.candidates(
        _reviewed(spark, sf, corpus), corpus, _cells(corpus), cell_col="cell"
    )
    full = related.enrich(found, views.records(spark, sf), _tags(docs))
    return related.by_distance(
        full.withColumns(
            {
                "distance": F.round("distance", 6) + F.lit(0.0),
                "key_word": F.array_join("key_word", ","),
                "key_phrase": F.array_join("key_phrase", ";"),
            }
        )
    )


def _scores(found, vectors, names):
    scored = explain.pair_scores(found, _of_queries(vectors), vectors, names, "scores")
    return scored.select("query_id", "related_id", F.inline("scores")).withColumn(
        "score", F.round("score", 6) + F.lit(0.0)
    )


@query(
    "field_scores",
    with_ctes(
        "text_scores", "SELECT query_id, related_id, name, round(score, 6) + 0.0 AS score FROM text_scores"
    ),
)
def field_scores(spark, sf):
    docs = views.tokens(spark, sf)
    return _scores(_candidates(spark, sf, docs), _fields(spark, sf, docs), TEXT_FIELDS)


@query(
    "category_scores",
    with_ctes(
        "category_scores",
        "SELECT query_id, related_id, name, round(score, 6) + 0.0 AS score FROM category_scores",
    ),
)
def category_scores(spark, sf):
    return _scores(_candidates(spark, sf), _categories(spark, sf), EXPLAIN_FEATURES)


def _corpus_and_queries(spark, sf):
    docs = views.tokens(spark, sf)
    vectors = _vectors(docs)
    fields = _fields(spark, sf, docs)
    records = through_table(views.records(spark, sf), "records")
    categories = _categories(spark, sf)
    corpus = Corpus(
        vectors=vectors,
        cells=_cells(vectors),
        centroids=clusters.centroid_table(vectors),
        texts=records.select("record_id", "description", "severity", "manager"),
        tags=_tags(docs),
        fields=fields,
        categories=categories,
    )
    queries = Queries(
        vectors=_reviewed(spark, sf, vectors),
        metadata=_of_queries(
            records.select("record_id", "duplicate_of", "severity", "manager", "engineer")
        ),
        fields=_of_queries(fields),
        categories=_of_queries(categories),
    )
    return corpus, queries


def _report(spark, sf):
    corpus, queries = _corpus_and_queries(spark, sf)
    return related_report(queries, corpus)


@query("key_feature", with_ctes("explained", "SELECT query_id, related_id, key_feature FROM explained"))
def key_feature(spark, sf):
    corpus, queries = _corpus_and_queries(spark, sf)
    found = related.candidates(queries.vectors, corpus.vectors, corpus.cells, 20, corpus.cell_col)
    return explained(found, queries, corpus).select("query_id", "related_id", "key_feature")


@query(
    "query_metadata",
    with_ctes(
        "candidates records",
        """SELECT query_id, related_id, q.duplicate_of, q.severity AS query_severity,
               q.manager AS query_manager, q.engineer AS query_engineer,
               r.severity AS related_severity, r.manager AS related_manager
        FROM candidates c JOIN records q ON q.record_id = c.query_id
        JOIN records r ON r.record_id = c.related_id""",
    ),
)
def query_metadata(spark, sf):
    records = views.records(spark, sf)
    metadata = _of_queries(
        records.select("record_id", "duplicate_of", "severity", "manager", "engineer")
    )
    theirs = records.select(
        F.col("record_id").alias("related_id"),
        F.col("severity").alias("related_severity"),
        F.col("manager").alias("related_manager"),
    )
    found = related.query_metadata(_candidates(spark, sf).drop("distance"), metadata)
    return found.join(theirs, "related_id")


_NESTED = with_ctes(
    "flat",
    """SELECT query_id AS bug_id, page, string_agg(related_id || ':' || printf('%.9f', distance) || ':'
           || key_feature || ':' || array_to_string(key_word, ',') || ':' || array_to_string(key_phrase, ';')
           || ':' || query_severity || ':' || query_manager || ':' || query_engineer || ':' || description,
           '|' ORDER BY distance, related_id) AS list_of_rel_bugs
    FROM (SELECT *, ((row_number() OVER (PARTITION BY query_id ORDER BY distance, related_id) - 1)
            // 10000)::INTEGER AS page FROM flat) GROUP BY query_id, page""",
)


@query("related_nested", _NESTED)
def related_nested(spark, sf):
    """One document per query, shown as text for the comparison."""
    nested = related.nested_report(_report(spark, sf))
    items = F.transform(
        "list_of_rel_bugs",
        lambda i: F.concat_ws(
            ":",
            i.related_id,
            i.bug_distance,
            i.key_feature,
            i.keywords,
            i.key_phrase,
            i.severity,
            i.de_mgr,
            i.de,
            i.description,
        ),
    )
    return nested.select("bug_id", "page", F.array_join(items, "|").alias("list_of_rel_bugs"))


_FLAT_SQL = """SELECT query_id, duplicate_of, query_severity, query_manager, query_engineer, related_id,
    is_duplicate, round(distance, 6) + 0.0 AS distance, description, related_severity, related_manager, key_feature,
    array_to_string(key_word, ',') AS key_word, array_to_string(key_phrase, ';') AS key_phrase FROM flat"""


@query("related_flat", with_ctes("flat", _FLAT_SQL))
def related_flat(spark, sf):
    return _report(spark, sf).withColumns(
        {
            "distance": F.round("distance", 6) + F.lit(0.0),
            "key_word": F.array_join("key_word", ","),
            "key_phrase": F.array_join("key_phrase", ";"),
        }
    )


@query(
    "batch_related",
    with_ctes(
        "flat",
        """SELECT query_id, count(*) AS n_related, count(*) FILTER (is_duplicate) AS n_duplicates,
               round(min(distance), 6) + 0.0 AS nearest, round(max(distance), 6) + 0.0 AS farthest
        FROM flat GROUP BY query_id""",
    ),
)
def batch_related(spark, sf):
    """All queries in one job, summed up per query."""
    return (
        _report(spark, sf)
        .groupBy("query_id")
        .agg(
            F.count(F.lit(1)).alias("n_related"),
            F.count(F.when(F.col("is_duplicate"), 1)).alias("n_duplicates"),
            (F.round(F.min("distance"), 6) + F.lit(0.0)).alias("nearest"),
            (F.round(F.max("distance"), 6) + F.lit(0.0)).alias("farthest"),
        )
    )


# JSON documents, from the tables that have the parts of each kind.


def _related_documents(spark, sf):
    """Known duplicates listed under their first copy."""
    records = views.records(spark, sf).where("duplicate_of is not null")
    return _nest(
        records.select(
            F.col("duplicate_of").alias("bug_id"),
            F.struct(
                F.col("record_id").alias("bug_id"),
                F.col("product").alias("keywords"),
                F.lit("0.0").alias("bug_distance"),
                F.lit("description").alias("key_feature"),
                F.col("attribute").alias("key_phrase"),
                F.col("headline").alias("description"),
                F.col("severity").alias("severity"),
                F.col("manager").alias("de_mgr"),
                F.col("engineer").alias("de"),
            ).alias("item"),
        ),
        "list_of_rel_bugs",
    )


PAGE_ROWS = 10_000


def _nest(rows, name):
    """Items listed per bug_id, every ``PAGE_ROWS`` in their order a document."""
    rank = F.row_number().over(Window.partitionBy("bug_id").orderBy("item"))
    return (
        rows.withColumn("_page", F.floor((rank - 1) / PAGE_ROWS))
        .groupBy("bug_id", "_page")
        .agg(F.array_sort(F.collect_list("item")).alias(name))
        .drop("_page")
    )


def _log_documents(spark, sf):
    events = views.table(spark, sf, "events")
    return _nest(
        events.select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("bug_id"),
            F.struct(
                F.concat(F.col("event_type"), F.lit("-"), F.col("event_id").cast("string")).alias(
                    "log_name"
                ),
                F.col("props").alias("err_msg"),
                F.concat(F.lit("/"), F.col("event_type")).alias("file_path"),
            ).alias("item"),
        ),
        "list_log_info",
    )


def _user_documents(spark, sf):
    customers = views.table(spark, sf, "customer")
    return _nest(
        customers.select(
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("bug_id"),
            F.struct(
                F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias(
                    "user_email"
                )
            ).alias("item"),
        ),
        "list_of_users",
    )


def _repro_documents(spark, sf):
    return views.records(spark, sf).select(
        F.col("record_id").alias("bug_id"), F.col("description").alias("repro_step")
    )


def _round_trip(spark, docs, kind, double_encoded=False):
    path = scratch_path(spark, f"json-{kind}")
    json_docs.write_documents(docs, path, double_encoded)
    return json_docs.read_documents(spark, path, kind, double_encoded)


_RELATED_SQL = with_ctes(
    "records",
    """SELECT duplicate_of AS bug_id, string_agg(concat_ws(':', record_id, product, '0.0', 'description',
           attribute, headline, severity, manager, engineer), '|' ORDER BY record_id) AS items
    FROM records WHERE duplicate_of IS NOT NULL GROUP BY duplicate_of""",
)


def _related_items(docs):
    items = F.transform(
        "list_of_rel_bugs",
        lambda i: F.concat_ws(
            ":", i.bug_id, i.keywords, i.bug_distance, i.key_feature, i.key_phrase,
            i.description, i.severity, i.de_mgr, i.de,
        ),
    )
    return docs.select("bug_id", F.array_join(items, "|").alias("items"))


@query("json_write", _RELATED_SQL)
def json_write(spark, sf):
    """Written in the double-encoded form and read back."""
    return _related_items(_round_trip(spark, _related_documents(spark, sf), "related", True))


@query("json_scan_related", _RELATED_SQL)
def json_scan_related(spark, sf):
    return _related_items(_round_trip(spark, _related_documents(spark, sf), "related"))


@query(
    "json_scan_repro",
    with_ctes("records", "SELECT record_id AS bug_id, description AS repro_step FROM records"),
)
def json_scan_repro(spark, sf):
    return _round_trip(spark, _repro_documents(spark, sf), "repro")


@query(
    "json_scan_log",
    """SELECT 'U' || CAST(user_id AS VARCHAR) AS bug_id, count(*) AS n_logs,
           string_agg(n || ':' || props || ':/' || event_type, '|' ORDER BY n, props) AS items
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n, props) AS r
        FROM (SELECT *, event_type || '-' || CAST(event_id AS VARCHAR) AS n FROM events))
    GROUP BY user_id, (r - 1) // 10000""",
)
def json_scan_log(spark, sf):
    docs = _round_trip(spark, _log_documents(spark, sf), "log")
    items = F.transform(
        "list_log_info", lambda i: F.concat_ws(":", i.log_name, i.err_msg, i.file_path)
    )
    return docs.select(
        "bug_id",
        F.size("list_log_info").cast("long").alias("n_logs"),
        F.array_join(items, "|").alias("items"),
    )


@query(
    "json_scan_users",
    """SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS bug_id,
           string_agg(lower(replace(c_name, '#', '.')) || '@example.com', '|' ORDER BY c_name) AS items
    FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY lower(c_name)) AS r FROM customer)
    GROUP BY c_nationkey, (r - 1) // 10000""",
)
def json_scan_users(spark, sf):
    docs = _round_trip(spark, _user_documents(spark, sf), "users")
    return docs.select("bug_id", F.array_join("list_of_users.user_email", "|").alias("items"))

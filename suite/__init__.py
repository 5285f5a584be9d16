"""Registered queries over the test tables and the SQL that checks them."""

from suite import (  # noqa: F401
    feature_queries,
    job_queries,
    label_queries,
    related_queries,
    row_queries,
    text_queries,
    vector_queries,
    vocabulary_queries,
)
from suite.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

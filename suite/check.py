"""Compares registered queries with their SQL: ``python -m suite.check [sf dir] [names]``."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def compare(spark, con, name: str, fn, sql: str | None, sf: str) -> str:
    """Empty when equal, otherwise what differs."""
    frame = fn(spark, sf)
    columns = sorted(frame.columns)
    ours = sorted(map(repr, (tuple(r) for r in frame.select(*columns).collect())))
    if sql is None:
        return "" if ours else "no rows"
    relation = con.sql(sql)
    if sorted(relation.columns) != columns:
        return f"columns {columns} != {sorted(relation.columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    theirs = sorted(
        map(repr, con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
    )
    spark_types = dict(frame.dtypes)
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    odd = [
        f"{c}: {spark_types[c]} / {types[c]}"
        for c in columns
        if names.get(types[c], types[c]) != spark_types[c]
    ]
    problems = [f"types {odd}"] if odd else []
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        problems.append(f"{len(ours)} / {len(theirs)} rows; first: {[(a[:300], b[:300]) for a, b in pairs]}")
    return "; ".join(problems)


def main() -> None:
    from kindred.session import local_session
    from suite import QUERIES, SQL

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), duck(sf)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, name, QUERIES[name], SQL.get(name), sf)
        except Exception as error:  # noqa: BLE001
            problem = "".join(traceback.format_exception_only(error))[:1500]
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} of {len(wanted)} differ")


if __name__ == "__main__":
    main()

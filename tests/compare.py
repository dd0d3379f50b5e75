"""Results of Spark and DuckDB, made comparable."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))


def duck_rows(connection, query):
    result = connection.execute(query)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())

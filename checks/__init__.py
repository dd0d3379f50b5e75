"""Every operator on the given tables, each beside the SQL that says what it must give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query and its SQL under one name."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        ORACLES[name] = sql
        return query

    return register


from checks import enrich, measure, report, run, scalar, source, stream, table  # noqa: E402, F401

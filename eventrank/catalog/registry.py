"""Where queries and the SQL for their expected result are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def register(expected: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        key = name or query.__name__
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = query
        if expected is not None:
            EXPECTED[key] = expected
        return query

    return keep

"""The registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register

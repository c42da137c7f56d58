"""Where the queries of the seat-auction domain and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "window_participation"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name; ``sql`` gives the same rows on the same tables."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register

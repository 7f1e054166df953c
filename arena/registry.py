"""Query registry: every entry reads the driver tables below one scale folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, when SQL can express it, its equivalent statement."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register

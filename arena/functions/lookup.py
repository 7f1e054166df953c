"""Lookup tables from configuration rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def lookup_table(spark: SparkSession, rows: Sequence[tuple[Any, ...]], schema: str) -> DataFrame:
    """Configuration rows as a table; its known size decides whether a join sends it to every task."""
    return spark.createDataFrame(list(rows), schema)

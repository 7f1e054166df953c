"""Row work that must not be repeated by later projections, and tasks as many as the rows ask for."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 250_000  # rows that one task keeps in its hash tables


def parse_json(df: DataFrame, body: str, schema: str, out: str = "r") -> DataFrame:
    """Adds the parsed document; filters on its fields are not pushed below, so a text is parsed once."""
    parsed: Column = F.explode(F.array(F.from_json(body, schema)))
    return df.select(*[c for c in df.columns if c != body], parsed.alias(out))


def tasks_for(df: DataFrame, rows: int = ROWS_PER_TASK) -> int:
    """Tasks for the rows of a table (Parquet tells their number from its footers).

    Partitions named by number keep it; those of a plain aggregate are merged by
    their compressed bytes, which are few where the hash tables are large.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows))

"""Helpers shared by the operators: words, let-bindings, tables, the shared scratch folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.session import scratch_dir

# fixed values: a word is a run of characters other than ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds a column that later projections and filters read but never compute again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scalar(df: DataFrame):
    """The only value of a one-row aggregate."""
    return df.first()[0]

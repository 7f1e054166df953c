"""Export bundles: tables as JSON, a manifest with counts and checksums, and reading them back."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.sources.tables import Star

MAX_ROWS_PER_FILE = 200_000


def next_data_version(current: str | None, today: date) -> str:
    """'vYYYYMMDD.N': N counts up inside a day."""
    stamp = f"v{today:%Y%m%d}."
    if current and current.startswith(stamp):
        return f"{stamp}{int(current.rsplit('.', 1)[1]) + 1}"
    return f"{stamp}1"


def vocabulary_hash(vocabulary: object) -> str:
    """Hash of a vocabulary, stable under key order."""
    text = json.dumps(vocabulary, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _file_sums(spark: SparkSession, path: str, table: str) -> DataFrame:
    """table, file, checksum: sums of two hashes of every line with its count, so files of any size are read line by line."""
    lines = spark.read.option("pathGlobFilter", "*.json").text(path).select("value", F.col("_metadata.file_name").alias("file"))
    sums = [F.sum(F.xxhash64(F.lit(salt), "value").cast("decimal(38,0)")).cast("string") for salt in (1, 2)]
    return lines.groupBy("file").agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("checksum")).select(
        F.lit(table).alias("table"), "file", "checksum"
    )


def write_bundle(tables: Mapping[str, DataFrame], root: str, version: str, hashes: Mapping[str, str] | None = None) -> DataFrame:
    """Writes each table as JSON below ``root`` and a manifest row per part file; returns per-table counts.

    Rerunning with the same root overwrites, so the result is the same.
    """
    spark = next(iter(tables.values())).sparkSession
    counts, sums = None, None
    for name, df in tables.items():
        path = f"{root}/{name}"
        df.write.mode("overwrite").option("maxRecordsPerFile", MAX_ROWS_PER_FILE).option("ignoreNullFields", "false").json(path)
        rows = spark.read.schema(df.schema).json(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        files = _file_sums(spark, path, name)
        counts = rows if counts is None else counts.unionByName(rows)
        sums = files if sums is None else sums.unionByName(files)
    manifest = counts.withColumn("version", F.lit(version)).withColumn("vocabulary", F.lit(json.dumps(dict(hashes or {}), sort_keys=True)))
    sums.write.mode("overwrite").json(f"{root}/checksums")
    manifest.write.mode("overwrite").json(f"{root}/manifest")
    return spark.read.schema(manifest.schema).json(f"{root}/manifest")


def verify_bundle(spark: SparkSession, root: str) -> DataFrame:
    """(table, files, bad): part files whose checksum differs or that are missing."""
    stored = spark.read.schema("table string, file string, checksum string").json(f"{root}/checksums")
    names = [r["table"] for r in stored.select("table").distinct().orderBy("table").collect()]
    found = None
    for name in names:
        files = _file_sums(spark, f"{root}/{name}", name).withColumnRenamed("checksum", "now")
        found = files if found is None else found.unionByName(files)
    joined = stored.join(found, ["table", "file"], "full_outer")
    return joined.groupBy("table").agg(
        F.count("checksum").alias("files"), F.count_if(~F.coalesce(F.col("checksum") == F.col("now"), F.lit(False))).alias("bad")
    )


def star_tables(star: Star) -> dict[str, DataFrame]:
    out = {"tournaments": star.tournaments, "decks": star.decks, "appearances": star.appearances, "deck_cards": star.deck_cards}
    if star.card_groups is not None:
        out["card_groups"] = star.card_groups
    return out


def read_star(spark: SparkSession, root: str, like: Star) -> Star:
    """The star of a bundle, with the schemas of ``like`` (no inference)."""
    return Star(**{n: spark.read.schema(df.schema).json(f"{root}/{n}") for n, df in star_tables(like).items()})


def denormalised_items(deck_cards: DataFrame, card_groups: DataFrame) -> DataFrame:
    """Basket rows with the group key repeated, so readers need no join."""
    return deck_cards.join(card_groups.select("card_id", "group_key"), "card_id", "left")


def adhoc_sql(spark: SparkSession, statement: str, limit: int = 500) -> DataFrame:
    """At most ``limit`` rows of a statement over the registered views, with a ``truncated`` flag."""
    rows = spark.sql(statement)
    more = rows.limit(limit + 1).agg(F.count(F.lit(1))).scalar() > limit
    return rows.limit(limit).withColumn("truncated", more)

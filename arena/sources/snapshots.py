"""Raw snapshot files: scan with rejects, content hashes, append-only merge, paged indexes, embedded CSV."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arena.functions.rank import latest_per_key

META = "_meta struct<fetched_at: string, source: string, content_hash: string>"
CORRUPT = "_corrupt"


def scan_snapshots(spark: SparkSession, path: str, schema: str, *, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(well-formed documents with their envelope and file, rejects with reason).

    ``schema`` lists the payload fields. Whole-file documents need ``multi_line``.
    """
    reader = spark.read.schema(f"{META}, {schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.option("multiLine", multi_line).json(path).withColumn("file", F.col("_metadata.file_path"))
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(F.col("_meta").isNull(), "no_envelope")
    marked = rows.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull()).drop(CORRUPT, "reason")
    return good, marked.filter(F.col("reason").isNotNull()).select("file", CORRUPT, "reason")


def _canonical_hash(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        payload = json.loads(text)
    except ValueError:
        return None
    canonical = json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(canonical.encode("utf-8")).hexdigest()


@F.pandas_udf(T.StringType())
def canonical_hash(bodies: pd.Series) -> pd.Series:
    """sha256 of the JSON text with sorted keys and compact separators; NULL when it does not parse."""
    return bodies.map(_canonical_hash)


def audit_hashes(docs: DataFrame, body: str, stored: str) -> DataFrame:
    """Adds ``state``: valid / mismatch / malformed."""
    computed = docs.withColumn("_hash", canonical_hash(body))
    state = F.when(F.col("_hash").isNull(), "malformed").when(F.col("_hash") == F.col(stored), "valid").otherwise("mismatch")
    return computed.withColumn("state", state).drop("_hash")


def append_only_merge(existing: DataFrame, incoming: DataFrame, key: str, order: str, *, force: bool = False) -> DataFrame:
    """State after the merge with ``action`` kept / added / replaced.

    ``existing`` has a boolean ``valid``: valid keys are never overwritten unless
    forced, invalid ones are. Among incoming duplicates the latest wins.
    """
    fresh = latest_per_key(incoming, [key], [F.col(order)])
    payload = [c for c in fresh.columns if c not in (key, order)]
    new = fresh.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in payload])
    joined = existing.join(new, F.col(key) == F.col("_k"), "full_outer")
    blocked = F.lit(False) if force else F.coalesce(F.col("valid"), F.lit(False))
    take = F.col("_k").isNotNull() & ~blocked
    action = F.when(F.col(key).isNull(), "added").when(take, "replaced").otherwise("kept")
    return joined.select(
        F.coalesce(F.col(key), F.col("_k")).alias(key), *[F.when(take, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in payload],
        action.alias("action"),
    )


def paged_index(pages: DataFrame, items: str, id_col: Column, context: Column) -> DataFrame:
    """Flattens list pages to one row per id; the last page by path wins and adds its context."""
    rows = pages.select("path", context.alias("context"), F.explode(items).alias("item")).withColumn("id", id_col)
    return latest_per_key(rows.filter(F.col("id").isNotNull()), ["id"], [F.col("path"), F.col("item")])


def csv_names(docs: DataFrame, text: str, languages: Sequence[Sequence[int]], names: Sequence[str]) -> DataFrame:
    """CSV text (species id, language id, name; with header) -> key and one name column per preference list.

    The first language of a list that has a name wins; later rows win inside a language.
    """
    schema = "pokemon_species_id long, local_language_id int, name string"
    lines = docs.select(F.posexplode(F.split(text, "\r?\n")).alias("pos", "line")).filter((F.col("pos") > 0) & (F.col("line") != ""))
    rows = lines.select("pos", F.from_csv("line", schema).alias("r")).select("pos", "r.*").filter(F.col("pokemon_species_id").isNotNull())
    wanted = sorted({lang for prefs in languages for lang in prefs})
    per_lang = rows.groupBy("pokemon_species_id").agg(
        *[F.max_by("name", F.when(F.col("local_language_id") == lang, F.col("pos"))).alias(f"_l{lang}") for lang in wanted]
    )
    picked = [F.coalesce(*[F.col(f"_l{lang}") for lang in prefs]).alias(n) for prefs, n in zip(languages, names, strict=True)]
    return per_lang.select(F.col("pokemon_species_id").alias("key"), *picked)

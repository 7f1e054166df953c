"""Corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, packing.

Each stage is one operator of ``arena.llm`` and takes (spark, docs, sf_dir). All
but the last return the columns of documents. ``run`` writes every stage to the
shared scratch folder and reads it again for the next one, so a lost executor
costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.llm.block_anchors import keyed, remove_repeats
from arena.llm.common import stored, table, words
from arena.llm.prob_minhash import near_classes
from arena.llm.quality_rules import keep_quality
from arena.llm.split_mix import mix
from arena.llm.tier_packing import pack_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

WEIGHTS = (5, 2, 1)  # of the sources in turn, by code point order


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies, the one of the smallest id; of equal rows, one."""
    kept = stored(near_classes(docs).filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")), "pipeline-kept")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("fp"))
    left = rows.join(kept.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
    once = left.filter("_n = 1").select("row.*")
    if kept.filter("_n > 1").isEmpty():
        return once
    return once.unionByName(left.filter("_n > 1").dropDuplicates(["doc_id", "fp"]).select("row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that stand in an earlier document; untouched texts stay as they are."""
    cut = remove_repeats(docs).filter("kept is not null").select("id", "fp", F.col("kept").alias("_kept"))
    cut = cut.dropDuplicates(["id", "fp"]).withColumnsRenamed({"id": "_id", "fp": "_fp"})
    rows = keyed(docs.select(F.struct("*").alias("row"), "doc_id", "text"))
    joined = rows.join(cut, (F.col("id") == F.col("_id")) & (F.col("fp") == F.col("_fp")), "left")
    text = F.coalesce("_kept", "row.text")
    return joined.select(F.col("row").withField("text", text).withField("n_chars", F.length(text).cast("long")).alias("row")).select("row.*")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn texts, in files by shard and shuffled inside a shard: a row for each document, pass and shard.

    A document that a block ends in goes to two shards, in parts.
    """
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text", F.xxhash64("text").alias("fp"))
    plan = mix(rows, weights=WEIGHTS, keep=("doc_id", "fp"))
    drawn = plan.draws.groupBy("row", "sid", "begin").agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "start", "length", "order"))).alias("draws"))
    # equal rows are drawn alike
    drawn = drawn.select(F.col("row.doc_id").alias("_id"), F.col("row.fp").alias("_fp"), "draws").groupBy("_id", "_fp").agg(F.max("draws").alias("draws"))
    joined = rows.join(drawn, rows["doc_id"].eqNullSafe(drawn["_id"]) & rows["fp"].eqNullSafe(drawn["_fp"]))
    turns = F.array_distinct(F.transform("draws", lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"))))
    each = joined.select("row", "draws", F.inline(turns).alias("_pass", "_shard"))
    mine = lambda d: (d["pass"] == F.col("_pass")) & (d["shard"] == F.col("_shard"))
    each = each.withColumn("parts", F.filter("draws", mine))
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda a, d: a + d["length"])
    said = words(F.col("row.text"))
    part = F.array_join(F.flatten(F.transform("parts", lambda d: F.slice(F.col("said"), (d["start"] + 1).cast("int"), d["length"].cast("int")))), " ")
    cut = each.select("row", "parts", "_shard", size.alias("taken"), F.explode(F.array(said)).alias("said"))
    text = F.when(F.col("taken") == F.size("said"), F.col("row.text")).otherwise(part)
    first = F.get(F.col("parts"), F.lit(0))
    out = cut.select("row", "_shard", first["order"].alias("_order"), F.explode(F.array(text)).alias("text"))
    shuffled = out.repartitionByRange("_shard", "_order").sortWithinPartitions("_shard", "_order")
    return shuffled.select(F.col("row").withField("text", F.col("text")).withField("n_chars", F.length("text").cast("long")).alias("row")).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", mixed_sources),
    ("packing", packed),
]

# duplicates, draws and token ids are beyond SQL; the tests compare with plain Python
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of one folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

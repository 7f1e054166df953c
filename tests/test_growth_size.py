"""Growth at size: small files of parts, records normalised once, whole cards and baskets dealt out once."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from arena.operators import checks as ch
from arena.queries.quality import growing_records
from arena.sources.tables import Tables
from arena.streaming import growth as gw
from test_findings import parts
from test_growth import grown, raws, record, run  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_of_one_small_file_are_made_by_many_tasks(spark, tmp_path):
    parts(spark, range(40)).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    raw = growing_records(Tables(spark, str(tmp_path)))
    dealt = [int(n) for n in re.findall(r"Exchange hashpartitioning\([^\n]*, (\d+)\), REPARTITION_BY_NUM", plan(raw))]
    assert dealt and min(dealt) >= spark.sparkContext.defaultParallelism > 1
    assert raw.count() == 40


def test_records_are_normalised_once(spark):
    """The lookup of parents reads cards that are already normalised."""
    records = [record("001", name="egg"), record("002", attr={"evolvesFrom": "egg"}), record("003", attr={"evolvesFrom": "nobody"})]
    cards = gw.drafts(raws(spark, records))
    text = plan(cards)
    assert "FileScan parquet" in text and "Scan ExistingRDD" not in text and "LocalTableScan" not in text
    assert {(r["card_id"], r["evolves_from_id"]) for r in cards.collect()} == {("A-001", None), ("A-002", "A-001"), ("A-003", None)}


def test_parents_are_looked_up_by_ids_alone(spark):
    """No whole card is dealt out by its parent, which most cards lack: those would all go to one task."""
    records = [record(f"{i:03d}") for i in range(4)]
    parent = F.when(F.col("number") == "001", "A-000").when(F.col("number") == "002", "nowhere-0")
    cards = gw.ordered_cards(raws(spark, records)).withColumn("evolves_from_id", parent)
    # a second row of the same id has a parent that is known
    cards = cards.unionByName(cards.filter("number = '002'").withColumn("evolves_from_id", F.lit("A-000")))
    only = [c for c in ch.CHECKS if c.rule == "parent_key"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bad = ch.card_failures(cards, raws(spark, records), cards.select("card_id"), "seq", [], ch.Vocabulary(), only)
        lines = plan(bad).split("\n")
        dealt = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning(evolves_from_id" in line]
        assert not [below for below in dealt if "set_id#" in below]
        assert [(r["card_id"], r["field"], r["stored"]) for r in bad.collect()] == [("A-002", "evolves_from_id", "nowhere-0")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_baskets_with_a_hit_go_on(spark, grown):  # noqa: F811
    store, older = grown
    out = run(spark, store, older + [record("005", name="twin")], [("A", 3), ("B", 2)])
    row = store.manifest().filter("version = 1").first()
    # the open item of a basket without a hit counts as attempted
    assert out.version == 1 and (row["attempted"], row["resolved"], row["decks_affected"], row["decks_upgraded"]) == (2, 1, 1, 0)
    touched = spark.read.parquet(f"{store.root}/runs/*/touched")
    assert {(r["deck_id"], r["raw_name"]) for r in touched.collect()} == {(1, "Mon A001"), (1, "Mon A005")}
    assert store.items().count() == 5

"""Cases of the third round of findings: long numbers, open character references, groups of four union parts, tasks by rows."""

from __future__ import annotations

import re

import duckdb
from pyspark.sql import functions as F

import check
from arena.functions.parallel import tasks_for
from arena.operators import baskets as k
from arena.operators import pages as p
from arena.queries.ingest import ingest_site
from arena.queries.quality import activation_gate, prefix_pack_counts
from arena.queries.resolve import longest_prefix_rollup
from arena.registry import ORACLES
from arena.session import stored_rows


def matches(spark, query, name, folder, **tables):
    """None when a query over hand-made tables equals its SQL."""
    con = duckdb.connect()
    for table, df in tables.items():
        path = f"{folder}/{table}.parquet"
        df.coalesce(1).write.parquet(path)
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return check.compare(query(spark, str(folder)), con, ORACLES[name])


def parts(spark, keys, brand="Brand#4"):
    return spark.createDataFrame(
        [(k, "hot bolt", brand, "ECONOMY", 12, 1.0) for k in keys], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    )


def test_numbers_longer_than_the_padding_stay_apart(spark, tmp_path):
    keys = [7, 123456, *range(1_039_000, 1_039_025)]
    assert matches(spark, prefix_pack_counts, "prefix_pack_counts", tmp_path, part=parts(spark, keys)) is None


def test_four_union_parts_of_one_name_are_a_fault_as_planted(spark, tmp_path):
    keys = [239 * i for i in (1, 2, 3, 4)]
    assert matches(spark, activation_gate, "activation_gate", tmp_path, part=parts(spark, [*keys, *range(1, 30)])) is None


def test_references_without_a_semicolon_stay_text(spark):
    html = "<article><p>a&amp;b &copy; &#65; &nope; cut&amp</p><p>&amp;quot; &notit; &lt</p></article>"
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    texts = lambda closed: [b["text"] for b in p.block_texts(pages, "article", closed=closed).first()["blocks"]]
    assert texts(True) == ["a&b © A &nope; cut&amp", "&quot; &notit; &lt"]
    assert texts(False) == ["a&b © A &nope; cut&", "&quot; ¬it; <"]


def hash_inputs(df):
    """Partitions of the shuffles below the aggregates of a plan, those that adaptive execution may merge left out."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [int(n) for n in re.findall(r"Exchange hashpartitioning\([^\n]*, (\d+)\), REPARTITION_BY_NUM", text)], re.findall(r"Exchange hashpartitioning\([^\n]*ENSURE_REQUIREMENTS", text)


def test_baskets_go_to_tasks_by_their_number(spark):
    """One shuffle of whole baskets into a fixed number of tasks; no later one that would be merged by compressed bytes."""
    lines = spark.createDataFrame([(1, 5, 2), (1, 6, 2), (2, 5, 1)], "deck_id long, card_id long, count long")
    cards = spark.createDataFrame([(5, 4, False, None, False, False)], "card_id long, deck_limit int, is_basic_energy boolean, rule_box_type string, is_ace_spec boolean, is_prism boolean")
    rules = stored_rows(k.rule_table(cards, cards.select("card_id", F.lit("g").alias("group_key"))), "rules")
    made, merged = hash_inputs(k.basket_report(k.judged_baskets(lines, F.broadcast(rules), 4, tasks=37)))
    assert made == [37] and not merged
    made, merged = hash_inputs(k.content_entities(lines.withColumnRenamed("card_id", "item"), "s", tasks=37))
    assert made == [37] and not merged
    assert tasks_for(spark.range(10), rows=2) == max(spark.sparkContext.defaultParallelism, 5)
    assert tasks_for(spark.range(1000), rows=10) == 100


SF = "/root/testdata/sf0.001"


def test_texts_and_entries_are_prepared_once(spark):
    """What many results ask for is read from the scratch folder, not made again from the tables."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "/documents.parquet" not in plan(longest_prefix_rollup(spark, SF))
    assert "/orders.parquet" not in plan(ingest_site(spark, SF))

"""Operators that were rebuilt for size: one hot key, long values, deep pages, late data; against plain Python."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from arena.functions import literals
from arena.functions.rank import page_bounds
from arena.functions.tag_vocab import EFFECT_FLAGS, EFFECT_TAGS
from arena.operators import legality as lg
from arena.operators import quality as q
from arena.operators import resolve as r
from arena.operators import tags as tg
from arena.queries.pages import DOC_FLAGS, DOC_TAGS, EFFECT_TEXTS
from arena.sources import tables as b
from arena.sources.tables import Tables
from arena.streaming import refresh as rf

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    return [x for x in plan(df).split("\n") if "FileScan parquet" in x and f"/{table}.parquet" in x]


def test_snapshots_of_one_format(spark):
    """Nested, open, equal and reversed intervals; all rows have one format."""
    rng = random.Random(3)
    first = date(2000, 1, 1)
    rows = [("only", f"s{i:03d}", first + timedelta(days=rng.randrange(900)), rng.choice([None, 0, 5, 60, 500, -3])) for i in range(300)]
    rows = [(f, s, a, None if n is None else a + timedelta(days=n)) for f, s, a, n in rows] + [("only", "old", date(1, 1, 1), date(1, 1, 2)), ("only", "end", date(9999, 12, 31), None)]
    days = [first + timedelta(days=i * 7 - 100) for i in range(180)] + [date(1, 1, 1), date(9999, 12, 31)]
    snapshots = spark.createDataFrame(rows, "format string, snapshot_id string, effective_from date, effective_to date")
    asked = spark.createDataFrame([("only", d) for d in days * 2] + [("none", first)], "format string, day date")
    got = {(x["format"], x["day"]): x["snapshot_id"] for x in lg.snapshot_as_of(asked, snapshots).collect()}
    for d in days:
        covering = [(-a.toordinal(), s) for _, s, a, e in rows if a <= d and (e is None or d <= e)]
        assert got["only", d] == (min(covering)[1] if covering else None), d
    assert got["none", first] is None and len(got) == len(set(days)) + 1


def test_snapshot_join_has_only_equal_keys_and_grows_with_the_snapshots(spark):
    at = lambda n: spark.range(n).select(
        F.lit("f").alias("format"), F.col("id").cast("string").alias("snapshot_id"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 3000).cast("int")).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"))
    days = spark.createDataFrame([("f", date(2001, 1, 1))], "format string, day date")
    out = lg.snapshot_as_of(days, at(20_000))
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)
    assert out.first()["snapshot_id"] == "12366"  # of the newest start the smallest id as text


def test_long_paths_meet_by_hash(spark):
    words = [f"w{i % 97}" for i in range(20_000)]
    keys = [(1, words), (2, words[:9_999] + ["x"]), (3, ["other"]), (4, []), (5, words[:3])]
    targets = [("a", words[:10_000]), ("b", words[:2]), ("c", words[:2] + ["no"]), ("d", ["x"])]
    out = r.longest_prefix(
        spark.createDataFrame(keys, "key_id long, path array<string>"), spark.createDataFrame(targets, "target_id string, path array<string>")
    )
    assert {tuple(x) for x in out.collect()} == {(1, "a", 10_000), (2, "b", 2), (3, None, None), (4, None, None), (5, "b", 2)}


def test_vocabulary_prefers_the_own_name(spark):
    cards = spark.createDataFrame(
        [(1, "甲", "A", None), (2, "乙", "A", None), (3, "甲", "B", "old"), (4, "丙", "C", None), (5, "丙", None, None), (6, "丁", "D", None), (7, "戊", "D", None)],
        "card_id long, name_full string, name_en string, name_ja string",
    )
    vocab = spark.createDataFrame([("A", "ja-jia", "甲"), ("A", "ja-yi", "乙"), ("B", "ja-b", None), ("C", "ja-own", "丙"), ("C", "ja-open", None), ("D", "ja-d", None)], "en string, ja string, cn string")
    out, usage = r.vocab_fill(cards, vocab)
    assert {tuple(x) for x in out.collect()} == {
        (1, "ja-jia", "filled"), (2, "ja-yi", "filled"), (3, "old", "conflict"), (4, "ja-own", "filled"), (5, None, "no_en_bridge"), (6, None, "ambiguous"), (7, None, "ambiguous"),
    }
    assert {(x["en"], x["cn"], x["cards"]) for x in usage.collect()} == {("A", "甲", 1), ("A", "乙", 1), ("B", None, 1), ("C", "丙", 1), ("C", None, 0), ("D", None, 0)}
    assert " OR " not in plan(out)


@pytest.mark.parametrize("offset, limit", [(1, 1), (500, 40), (2_990, 40), (3_000, 5), (77, 2_000)])
def test_pages_read_their_ranges(spark, monkeypatch, offset, limit):
    monkeypatch.setattr("arena.functions.rank.PAGE_ROWS", 50)
    monkeypatch.setattr("arena.functions.rank.PAGE_RANGES", 16)
    ids = sorted({f"k{(i * 7919) % 100_003}" for i in range(3_000)})
    df = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "card_id string, n int").repartition(5)
    got = [x["card_id"] for x in q.page(df, "card_id", limit, offset).collect()]
    assert got == ids[offset : offset + limit]
    if 0 < limit <= 40 and offset < 2_990:
        low, high, before = page_bounds(df, "card_id", offset, limit)
        inside = [x for x in ids if (low is None or x > low) and (high is None or x <= high)]
        assert len(inside) <= 3_000 / 4 and ids.index(inside[0]) == before


def test_pages_of_one_key_and_of_nothing(spark):
    df = spark.createDataFrame([("a",)] * 30, "card_id string")
    assert q.page(df, "card_id", 4, 28).count() == 2
    assert q.page(df.limit(0), "card_id", 4, 28).count() == 0


@pytest.mark.parametrize("pattern", sorted({p for vocabulary in (DOC_TAGS, DOC_FLAGS, EFFECT_TAGS, EFFECT_FLAGS) for _, ps, _ in vocabulary for p in ps}))
def test_a_pattern_is_found_only_with_its_literals(pattern):
    needs = literals.needs_of(pattern)
    rng = random.Random(pattern)
    pieces = [c for s in needs.sets for c in s] + list("抽张牌库自己对手的伤害+-13 .,\n!?éèñ") + ["手牌", "能量", "宝可梦", "license", "The ", "a@b"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        hit = re.search(pattern, text) is not None
        folded = text.lower() if needs.folded else text
        has = all(any(x in folded for x in s) for s in needs.sets)
        assert not hit or has
        if needs.exact:
            assert hit == has
        elif has:
            assert (re.search(needs.pattern, text) is not None) == hit


def test_tagged_texts_equal_plain_search(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(EFFECT_TEXTS) for _ in range(rng.randrange(4))) + rng.choice(["", "抽3张", " 1234 x@y.z", "\n- point", "A" * 700]) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    tags, flags = EFFECT_TAGS + [(t, p, None) for t, p, _ in DOC_TAGS], EFFECT_FLAGS + DOC_FLAGS
    for x in tg.tag_texts(df, "text", tags, flags).collect():
        assert x["tags"] == [t for t, ps, _ in tags if any(re.search(p, texts[x["id"]]) for p in ps)]
        assert x["flags"] == [t for t, ps, _ in flags if any(re.search(p, texts[x["id"]]) for p in ps)]


def test_coverage_lists_texts_of_no_tag_and_of_many(spark):
    df = spark.createDataFrame([("x", ["a"], []), ("y", [], ["f"]), ("z", ["a", "b", "c"], [])], "id string, tags array<string>, flags array<string>")
    rows = {(x["section"], x["label"], x["n"]) for x in tg.tag_coverage(df, "id").collect()}
    assert {("zero_hit", "y", 0), ("multi_hit", "z", 3), ("texts", "zero_hit", 1), ("tags", "a", 2)} <= rows and not any(l == "x" for _, l, _ in rows)


SCHEMA = "event_id long, ts timestamp, amount long"


def test_late_rows_restart_and_rerun(spark, tmp_path, monkeypatch):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
    run = lambda: rf.daily_totals(spark, source, target, checkpoint, SCHEMA, "event_id")
    start = datetime(2026, 1, 1, 12)

    def deliver(rows):
        spark.createDataFrame([(i, start + timedelta(days=d, hours=h), a) for i, d, h, a in rows], SCHEMA).write.mode("append").parquet(source)

    deliver([(1, 0, 0, 5), (2, 0, 1, 7), (3, 20, 0, 1)])
    run()
    run()
    totals = lambda: {x["day"].isoformat(): (x["n"], x["amount"]) for x in rf.current_totals(spark, target, SCHEMA).collect()}
    assert totals() == {"2026-01-01": (2, 12), "2026-01-21": (1, 1)}
    # the watermark stands at January 7, noon: the sixth is over, the seventh is not
    deliver([(4, 0, 0, 100), (5, 5, 11, 2), (6, 6, 0, 3), (7, 20, 0, 4)])
    real, fails = rf.pd.DataFrame, iter([True])

    class Torn(Exception):
        pass

    writer = rf.DataFrame.write

    def broken(self):
        if next(fails, False):
            raise Torn
        return writer.fget(self)

    monkeypatch.setattr(type(spark.range(1)), "write", property(broken))
    with pytest.raises(Exception):  # noqa: B017  the sink fails once; the batch is replayed
        run()
    monkeypatch.undo()
    run()
    run()
    assert totals() == {"2026-01-01": (2, 12), "2026-01-07": (1, 3), "2026-01-21": (2, 5)}
    assert {x["event_id"] for x in rf.late_rejects(spark, target, SCHEMA).collect()} == {4, 5}
    assert rf.pd.DataFrame is real


def test_the_star_of_a_window_reads_each_table_once(spark):
    window = ("2000-08-01", "2001-08-01")
    t = Tables(spark, SF)
    played = b.entries(t, window)
    (orders,) = scans(played, "orders")
    assert "GreaterThanOrEqual(o_orderdate" in orders and "LessThan(o_orderdate" in orders
    from arena.session import stored_rows

    groups = b.group_lines(t, stored_rows(played, "test-entries"))
    assert len(scans(groups, "lineitem")) == len(scans(groups, "part")) == 1 and not scans(groups, "orders")


@pytest.mark.parametrize("key", ["weighted_usage", "weighted_win_score", "win_rate_records", "topcut_conversion", "group_drilldown", "carry_per_entry", "layer_auto_detect"])
def test_metrics_read_no_driver_table_again(spark, key):
    import __spark_entry__ as entry

    df = entry.queries()[key](spark, SF)
    assert not any(scans(df, x) for x in ("orders", "lineitem", "part", "customer"))


def test_rules_and_remap_read_the_lines_once(spark):
    import __spark_entry__ as entry

    for key, lines in (("basket_legality_report", 1), ("remap_misses", 1), ("basket_rule_violations", 1)):
        df = entry.queries()[key](spark, SF)
        assert len(scans(df, "lineitem")) == lines, key
    report, remap = entry.queries()["basket_legality_report"](spark, SF), entry.queries()["remap_misses"](spark, SF)
    assert not scans(report, "part") and "SortAggregate" not in plan(remap)

"""The nine checks case by case, the sample against its source, and growth as a staged publish."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from arena.functions.parallel import parse_json
from arena.operators import baskets as k
from arena.operators import checks as ch
from arena.sources import catalogue as c
from arena.streaming import growth as gw


def record(number, set_id="A", **change):
    attr = {
        "energyType": "R", "stage": "Basic", "hp": 60, "evolvesFrom": None, "ability": [], "weakness": {"energy": "W", "value": "×2"}, "retreatCost": 1,
        "attack": [{"name": "bite", "text": "", "cost": "RC", "damage": "20"}, {"name": "burn", "text": "", "cost": "0", "damage": ""}],
    }
    attr.update(change.pop("attr", {}))
    base = {
        "name": f"mon {set_id}{number}", "cardType": "Pokemon", "mechanic": None, "label": [], "description": "text", "setCode": set_id, "cardIndex": number,
        "rarity": "C", "regulationMark": "G", "nameEn": f"Mon {set_id}{number}", "pokemonAttr": attr,
    }
    return {**base, **change}


def raws(spark, records):
    import json

    rows = [(r["setCode"], r["cardIndex"], json.dumps(r)) for r in records]
    return parse_json(spark.createDataFrame(rows, "set_id string, number string, body string"), "body", c.RAW_SCHEMA)


def stored(spark, records, **columns):
    cards = gw.drafts(raws(spark, records))
    return cards.withColumns(columns) if columns else cards


def found(spark, cards, raw, relations=None, checks=ch.CHECKS):
    relations = relations if relations is not None else spark.createDataFrame([], "card_id string, related_id string")
    rows = ch.run(cards, raw, cards.select("card_id"), relations, "seq", [], checks=checks).collect()
    return {(r["card_id"], r["rule"], r["field"]) for r in rows}


def test_every_rule_finds_its_fault_and_nothing_else(spark):
    energy = {"cardType": "Basic Energy", "pokemonAttr": None, "regulationMark": "", "description": "", "name": "基本草能量"}
    records = [record(f"{i:03d}") for i in range(1, 12)] + [record("900", **energy), record("901", description="")]
    raw = raws(spark, records + [record("999")])  # one record of the source was never stored
    at = lambda n, value, old: F.when(F.col("number") == n, value).otherwise(F.col(old))
    first = F.get("attacks", F.lit(0))
    cards = stored(
        spark, records, name_full=at("002", F.lit(" "), "name_full"), rarity=at("003", F.lit("XXX"), "rarity"),
        weakness=at("004", F.struct(F.lit("光").alias("type"), F.lit("×2").alias("value")), "weakness"), regulation_mark=at("005", F.lit("g1"), "regulation_mark"),
        hp=at("006", F.lit(350), "hp"), evolves_from_id=at("007", F.lit("A-404"), "evolves_from_id"),
        attacks=F.when(F.col("number") == "008", F.concat(F.array(first.withField("cost", F.reverse(first["cost"]))), F.slice("attacks", 2, 9)))
        .when(F.col("number") == "009", F.slice("attacks", 1, 1)).otherwise(F.col("attacks")),
        retreat_cost=at("010", F.lit(9), "retreat_cost"), types=at("011", F.array(F.lit("火"), F.lit("电")), "types"),
    )
    assert found(spark, cards, raw) == {
        ("A-002", "required", "name_full"), ("A-003", "enum", "rarity"), ("A-004", "enum", "weakness"), ("A-005", "mark_format", "regulation_mark"),
        ("A-006", "hp_range", "hp"), ("A-007", "parent_key", "evolves_from_id"), ("A-008", "energy", "attacks[0].cost"), ("A-009", "energy", "attacks"),
        ("A-010", "energy", "retreat_cost"), ("A-011", "enum", "types"), (None, "reconciliation", "count"),
    }


def test_blank_text_is_ours_only_if_the_source_has_one(spark):
    cards = stored(spark, [record("001", description=""), record("002")], text_raw=F.lit(""))
    rules = [x for x in ch.CHECKS if x.rule == "required"]
    raw = raws(spark, [record("001", description=""), record("002")])
    assert found(spark, cards, raw, checks=rules) == {("A-002", "required", "text_raw")}


@pytest.mark.parametrize("positions, reasons", [
    (("左上", "右上", "左下", "右下"), None), ((None,) * 4, None), (("左上", "右上", "左下"), "size"),
    (("左上", "左上", "左下", "右下"), "position_repeated,position_lacking"),
])
def test_union_parts(spark, positions, reasons):
    n = len(positions)
    records = [record(f"{i}", attr={"stage": "V-UNION"}) for i in range(n)]
    place = F.element_at(F.array(*[F.lit(p).cast("string") for p in positions]), F.col("number").cast("int") + 1)
    cards = stored(spark, records, union_position=place)
    relations = spark.createDataFrame([(f"A-{i}", "A-0") for i in range(1, n)], "card_id string, related_id string")
    rows = ch.union_failures(cards, relations).collect()
    assert {r["source"] for r in rows} == ({reasons} if reasons else set())
    assert len(rows) == (n if reasons else 0)


def test_sample_is_compared_field_by_field(spark):
    records = [record(f"{i:03d}") for i in range(40)]
    cards = stored(spark, records)
    sample = {r["card_id"] for r in ch.sample_compare(cards, raws(spark, records), "seq", []).collect()}
    assert sample == {"A-000", "A-020"}  # five percent, equidistant
    other = [record("000", name="changed", attr={"hp": 70, "attack": []}), *records[1:20], *records[21:]]
    rows = {(r["card_id"], r["field"], r["stored"], r["source"]) for r in ch.sample_compare(cards, raws(spark, other), "seq", []).collect()}
    assert rows == {
        ("A-000", "name_full", "mon A000", "changed"), ("A-000", "hp", "60", "70"), ("A-000", "attacks.name", "bite|burn", ""), ("A-020", "raw", None, None),
    }


ITEMS = gw.ITEMS


@pytest.fixture
def grown(spark, tmp_path):
    older = [record("001"), record("002", name="twin"), record("003", set_id="B"), record("004", set_id="B")]
    base = gw.drafts(raws(spark, older))
    items = spark.createDataFrame(
        [(1, "A-001", "Mon A001", 59, "pokemon"), (1, None, "Mon A005", 1, "other"), (2, "B-003", "Mon B003", 50, "pokemon"), (2, None, "Mon C006", 10, "other"),
         (3, "A-001", "Mon A001", 60, "pokemon")], ITEMS,
    )
    overrides = spark.createDataFrame([("open", "A-001", "stale"), ("closed", "A-002", "kept")], gw.OVERRIDES)
    store = gw.Store(spark, str(tmp_path / "store"))
    gw.seed(store, base, spark.createDataFrame([("A", 2), ("B", 2)], "set_id string, expected long"), items, overrides, "v20260101.1")
    return store, older


def run(spark, store, records, sizes, **options):
    products = spark.createDataFrame(sizes, "set_id string, n long")
    releases = spark.createDataFrame([("A", date(2026, 1, 1)), ("B", None), ("C", date(2025, 1, 1))], "set_id string, release_date date")
    snapshots = spark.createDataFrame([("open", None), ("closed", date(2025, 1, 1))], "snapshot_id string, effective_to date")
    whitelists = spark.createDataFrame([("open", "twin"), ("closed", "twin")], "snapshot_id string, group_key string")
    return gw.grow(store, products, raws(spark, records), releases, snapshots, whitelists, "v20260102.1", **options)


def test_growth_publishes_clean_sets_and_leaves_no_trace_of_others(spark, grown):
    store, older = grown
    fresh = older + [record("005", name="twin"), record("006", set_id="C"), record("007", set_id="C", cardType="Odd")]
    sizes = [("A", 3), ("B", 1), ("C", 2)]
    looked = run(spark, store, fresh, sizes, dry_run=True)
    assert looked.version is None and store.version() == 0
    assert {(r["set_id"], r["state"]) for r in looked.sets.collect()} == {("A", "detected"), ("B", "suspicious"), ("C", "detected")}

    out = run(spark, store, fresh, sizes)
    assert {(r["set_id"], r["kind"], r["state"], r["rules"]) for r in out.sets.collect()} == {
        ("A", "grown", "activated", None), ("B", "shrunk", "suspicious", None), ("C", "new", "blocked", "reconciliation"),
    }
    assert out.version == store.version() == 1
    assert {(r["card_id"], r["status"]) for r in store.cards().collect()} == {(x, "active") for x in ("A-001", "A-002", "A-005", "B-003", "B-004")}
    assert {r["set_id"]: r["expected"] for r in store.pointers().collect()} == {"A": 3, "B": 2}
    row = store.manifest().filter("version = 1").first()
    assert (row["data_version"], row["activated"], row["attempted"], row["resolved"], row["decks_affected"], row["decks_upgraded"]) == ("v20260102.1", 1, 2, 1, 1, 0)
    lines = {(r["deck_id"], r["card_id"], r["raw_name"], r["count"], r["stat_scope"]) for r in store.items().collect()}
    assert (1, "A-005", "Mon A005", 1, "pokemon") in lines and (2, None, "Mon C006", 10, "other") in lines and len(lines) == 5
    assert {tuple(r) for r in store.overrides().collect()} == {("open", "A-002", "A-005"), ("closed", "A-002", "kept")}

    # the blocked set comes up again, and nothing else does
    again = run(spark, store, fresh, sizes)
    assert again.version is None and store.version() == 1
    assert {(r["set_id"], r["state"]) for r in again.sets.collect()} == {("B", "suspicious"), ("C", "blocked")}
    # once its record is right it is published, and the open item is resolved
    mended = fresh[:-1] + [record("007", set_id="C")]
    last = run(spark, store, mended, [("A", 3), ("B", 2), ("C", 2)])
    assert last.version == 2 and store.cards().filter("set_id = 'C'").count() == 2
    assert store.items().filter("card_id is null").count() == 0 and store.manifest().filter("version = 2").first()["decks_upgraded"] == 1


def test_a_version_without_its_manifest_row_is_not_seen(spark, grown):
    store, _ = grown
    before = sorted(map(tuple, store.items().collect()), key=repr)
    spark.createDataFrame([(1, None, "lost", 1, "other")], ITEMS).write.parquet(f"{store.root}/items/version=1")
    store.pointers().filter("set_id = 'A'").write.parquet(f"{store.root}/pointers/version=1")
    store.stage(store.cards().drop("status").withColumn("status", F.lit("draft")))
    assert store.version() == 0 and store.cards().count() == 4
    assert sorted(map(tuple, store.items().collect()), key=repr) == before


def test_remap_touches_only_baskets_with_a_hit(spark):
    items = spark.createDataFrame([(1, "a", None, 40, "pokemon"), (1, None, "x", 20, "other"), (2, None, "y", 60, "other")], ITEMS)
    hits = spark.createDataFrame([(1, "x", "a", "pokemon")], "deck_id long, raw_name string, card_id string, stat_scope string")
    after, status = k.remap_misses(items, hits)
    assert {(r["deck_id"], r["card_id"], r["count"]) for r in after.collect()} == {(1, "a", 60), (2, None, 60)}
    assert {(r["deck_id"], r["status_before"], r["mapping_status"]) for r in status.collect()} == {(1, "partial", "full"), (2, "unmapped", "unmapped")}

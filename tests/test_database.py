"""The query facade and the channel ingest on a small hand-made catalogue."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from arena import schema as sc
from arena.database import Database
from arena.plans.ingest import ingest_channel
from arena.sources.tables import Star


def frame(spark, schema, rows):
    """Rows as dicts; columns left out are NULL."""
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(r.get(f.name) for f in empty.schema) for r in rows], empty.schema)


def card(card_id, name, mark, **more):
    base = {
        "card_id": card_id, "set_id": card_id.split("-")[0], "number": card_id.split("-")[1], "name_full": name, "species": name, "mark": mark,
        "card_type": "pokemon", "rarity": "C", "deck_limit": 4, "prize_cards": 1, "is_ace_spec": False, "is_basic_energy": False, "is_tera": False,
        "has_rule_box": False, "text_raw": f"text {card_id}", "name_en": name.title(), "status": "active", "release_date": date(2026, 1, 1),
    }
    return {**base, **more}


@pytest.fixture(scope="module")
def db(spark):
    cards = [
        card("A-1", "fox", "G"), card("A-2", "owl", "D"), card("B-1", "owl", "D", release_date=date(2026, 5, 1)), card("B-2", "elk", "G"),
        card("E-1", "basic", None, card_type="energy", is_basic_energy=True, provides=["草"]), card("B-3", "draft fox", "G", status="draft"),
    ]
    df = frame(spark, sc.CARDS, cards).withColumn("skills", F.array(F.lit("bite")))
    groups = spark.createDataFrame([(c["card_id"], c["name_full"]) for c in cards], sc.CARD_GROUPS)
    snapshots = frame(spark, sc.SNAPSHOTS, [
        {"snapshot_id": "s1", "format": "standard", "effective_from": date(2026, 1, 1), "effective_to": date(2026, 6, 30), "allowed_marks": ["D"],
         "allowed_energies": [], "whitelist": [], "banned": [], "mark_overrides": [], "latest_text_overrides": {}},
        {"snapshot_id": "s2", "format": "standard", "effective_from": date(2026, 7, 1), "allowed_marks": ["G"], "allowed_energies": ["草"],
         "whitelist": [("owl", None)], "banned": [("elk", "bite", None)], "mark_overrides": [], "latest_text_overrides": {"A-2": "B-1"}},
    ])
    errata = spark.createDataFrame([("e1", "B-1", date(2026, 7, 2), "corrected")], sc.ERRATA)
    sets = frame(spark, sc.SETS, [{"set_id": "A", "era": "x"}, {"set_id": "B", "era": "y"}])
    tours = frame(spark, sc.TOURNAMENTS, [
        {"tournament_id": "t1", "source": "mik_moe", "name": "one", "tier": "city", "tier_coef": 1.0, "division": "master", "date": date(2026, 7, 20),
         "participant_count": 100, "topcut_slots": 1, "is_qual": False, "is_team": False},
    ])
    decks = frame(spark, sc.DECKS, [{"deck_id": "d1", "mapping_status": "full"}, {"deck_id": "d2", "mapping_status": "full"}])
    apps = frame(spark, sc.APPEARANCES, [
        {"deck_id": "d1", "tournament_id": "t1", "rank": 1, "source": "mik_moe"}, {"deck_id": "d2", "tournament_id": "t1", "rank": 2, "source": "mik_moe"},
    ])
    items = frame(spark, sc.DECK_CARDS, [
        {"deck_id": "d1", "card_id": "A-1", "raw_name": "fox", "count": 4, "stat_scope": "pokemon"},
        {"deck_id": "d2", "card_id": "A-1", "raw_name": "fox", "count": 2, "stat_scope": "pokemon"},
        {"deck_id": "d2", "card_id": "B-2", "raw_name": "elk", "count": 2, "stat_scope": "pokemon"},
    ])
    return Database(df, sets, groups, snapshots, errata, Star(tours, decks, apps, items, groups))


def test_legal_at(db):
    steps = {r["card_id"]: r["step"] for r in db.legal_at(date(2026, 8, 1), "standard").collect()}
    assert steps == {"A-1": "mark", "A-2": "whitelist", "B-1": "whitelist", "B-2": "banned", "E-1": "basic_energy"}
    old = {r["card_id"]: r["step"] for r in db.legal_at(date(2026, 2, 1), "standard").collect()}
    assert old["A-2"] == "mark" and old["A-1"] == "not_legal"


def test_no_snapshot_is_an_error(db):
    with pytest.raises(LookupError):
        db.legal_at(date(2020, 1, 1), "standard")


def test_effective_text(db):
    texts = {r["card_id"]: (r["resolved_id"], r["text"], r["source"]) for r in db.effective_text(date(2026, 8, 1)).collect()}
    assert texts["A-2"] == ("B-1", "corrected", "errata")
    assert texts["A-1"] == ("A-1", "text A-1", "text_raw")
    early = {r["card_id"]: r["source"] for r in db.effective_text(date(2026, 7, 1)).collect()}
    assert early["A-2"] == "latest_print"


def test_search(db):
    assert [r["card_id"] for r in db.search_cards(name="owl").collect()] == ["A-2", "B-1"]
    assert [r["card_id"] for r in db.search_cards(marks=["G"], set_ids=["B"], limit=1).collect()] == ["B-2"]
    assert [r["set_id"] for r in db.list_sets("y").collect()] == ["B"]
    assert db.get_card("A-1").first()["name_full"] == "fox"
    assert [r["snapshot_id"] for r in db.snapshots("standard").collect()] == ["s1", "s2"]


def test_validate_decks(spark, db):
    baskets = spark.createDataFrame([("x", "E-1", 56), ("x", "A-1", 4), ("y", "E-1", 55), ("y", "B-2", 5)], "deck_id string, card_id string, count long")
    violations, report = db.validate_decks(baskets, date(2026, 8, 1), "standard")
    assert {r["deck_id"]: r["ok"] for r in report.collect()} == {"x": True, "y": False}
    assert {(r["kind"], r["subject"]) for r in violations.collect()} == {("name_limit", "elk"), ("banned", "B-2")}


def test_stats(db):
    opts = {"as_of": "2026-08-01"}
    usage = db.stats_usage(**opts).collect()
    assert [r["group_key"] for r in usage] == ["fox", "elk"]
    assert usage[0]["value"] == pytest.approx(1.0) and usage[1]["value"] == pytest.approx(1 / 3)
    assert db.stats_winrate(**opts).first()["q0"] == pytest.approx(0.01)
    assert db.stats_wws(**opts).count() == 2
    assert db.stats_card("fox", **opts).first()["n_decks"] == 2
    assert db.stats_meta(**opts).first()["n_tournaments"] == 1


def test_ingest_channel(spark, db):
    comps = spark.createDataFrame(
        [("t1", "Regional", date(2025, 6, 1)), ("t2", "Friendly", date(2025, 7, 1)), ("t3", "Regional", date(2020, 1, 1))],
        "tournament_id string, tier string, date date",
    )
    entries = spark.createDataFrame(
        [("b1", "t1", 1), ("b2", "t1", 2), ("b3", "t2", 1), ("b4", "t2", 2), ("b5", "t3", 1), ("b6", "t2", None)], "basket_id string, tournament_id string, rank int"
    )
    whole = [("Fox", 40), ("Owl (old)", 20)]
    rows = [(b, None, None, n, c) for b in ("b1", "b3", "b5", "b6") for n, c in whole]
    rows += [("b2", None, None, "Fox", 59), ("b4", None, None, "Fox", 30), ("b4", "ZZ", "7", "Ghost", 30)]
    items = spark.createDataFrame(rows, "basket_id string, raw_set string, raw_number string, raw_name string, count long")
    out = ingest_channel("limitless", comps, entries, items, db.cards, window=(date(2025, 4, 11), date(2026, 4, 9)))
    assert out.window.first().asDict() == {"kept": 2, "skipped": 1, "undated": 0}
    assert [(r["basket_id"], r["total"]) for r in out.blocked.collect()] == [("b2", 59)]
    decks = {r["deck_id"]: r["mapping_status"] for r in out.star.decks.collect()}
    assert sorted(decks.values()) == ["full", "partial"]  # b1 and b3 are one content
    apps = sorted((r["tournament_id"], r["rank"], decks[r["deck_id"]]) for r in out.star.appearances.collect())
    assert apps == [("t1", 1, "full"), ("t2", 1, "full"), ("t2", 2, "partial")]
    assert [(r["raw_name"], r["raw_set"], r["miss_kind"]) for r in out.misses.collect()] == [("Ghost", "ZZ", "ptcd_miss")]
    tiers = {r["tournament_id"]: (r["tier"], r["tier_coef"]) for r in out.star.tournaments.collect()}
    assert tiers == {"t1": ("regional", 1.5), "t2": ("Friendly", None)}
    mapped = {r["raw_name"]: r["card_id"] for r in out.star.deck_cards.collect()}
    assert mapped["Owl (old)"] == "B-1" and mapped["Ghost"] is None
    assert {r["rule"] for r in out.rules.collect()} == {"name_fallback+unique", "name_fallback+paren_strip+latest", "unmapped"}


def test_ingest_counts_whole_baskets_and_keeps_what_it_drops(spark, db):
    comps = spark.createDataFrame([("t1", "Regional", date(2025, 6, 1))], "tournament_id string, tier string, date date")
    entries = spark.createDataFrame(
        [("b1", "t1", 1), ("b2", "t1", 2), ("b3", "t1", 3), ("b4", "t1", None), ("b5", "t1", 5), ("b6", "t1", 6), ("b6", "t1", 6)],
        "basket_id string, tournament_id string, rank int",
    )
    rows = [("b1", None, None, "Fox", 56), ("b1", "S1", "1", "Ghost", 2), ("b1", "S2", "2", "Ghost", 2)]
    rows += [("b2", "S1", None, "Fox", 60), ("b3", None, "S1", "Fox", 60), ("b4", None, None, "Fox", 60), ("b6", None, None, "Fox", 59)]
    items = spark.createDataFrame(rows, "basket_id string, raw_set string, raw_number string, raw_name string, count long")
    out = ingest_channel("limitless", comps, entries, items, db.cards)
    shares = {r["total"]: (r["mapped"], r["mapping_status"]) for r in out.star.decks.filter("mapped < total").collect()}
    assert shares == {60: (56, "partial")}  # 56 of 60, although two lines of one unknown name are kept as one
    ids = {r["rank"]: r["deck_id"] for r in out.star.appearances.collect()}
    assert ids[2] != ids[3]  # a set without a number is not a number without a set
    lost = sorted((r["basket_id"], r["reason"]) for r in out.lost_entries.collect())
    assert lost == [("b4", "no_rank"), ("b5", "no_basket"), ("b6", "basket_blocked"), ("b6", "basket_blocked")]

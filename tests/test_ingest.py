"""The four result channels on small cases: what is taken, what is lost and why, slots, mapping and misses."""

from __future__ import annotations

import hashlib
from datetime import date

import pytest

from arena.operators import quality as q
from arena.plans import ingest as i

CARD = "card_id string, name_en string, name_ja string, group_key string, mark string, release_date date, card_type string, trainer_subtype string"


@pytest.fixture(scope="module")
def cards(spark):
    return spark.createDataFrame(
        [
            ("A-1", "Fox", "キツネ", "g1", "G", date(2024, 1, 1), "pokemon", None),
            ("A-2", "Fox", "キツネ", "g1", "H", date(2025, 1, 1), "pokemon", None),
            ("B-1", "Owl", "フクロウ", "g2", "G", date(2024, 1, 1), "trainer", "支援者"),
            ("C-1", "Elk", "シカ", "g3", "H", date(2024, 1, 1), "energy", None),
            ("C-2", "Elk Prime", "シカ", "g4", "H", date(2025, 1, 1), "pokemon", None),
        ],
        CARD,
    )


def report(result):
    return {(r["section"], r["key"]): r["n"] for r in i.ingest_report(result).collect()}


def test_own_ids_keep_the_source_basket_and_fill_slots(spark, cards):
    comps = spark.createDataFrame(
        [("t1", "超级赛", date(2026, 8, 1), 100, None, False), ("t2", "城市赛", date(2020, 1, 1), 100, 8, False), ("t3", "友谊赛", None, 3, None, False)],
        "tournament_id string, tier string, date date, participant_count int, topcut_slots int, is_team boolean",
    )
    entries = spark.createDataFrame(
        [("d1", "t1", 1), ("d1", "t1", 2), ("d1", "t2", 1), ("d2", "t1", 3), ("d3", "t1", 4), ("d4", "t2", None), ("d5", "t2", 5), ("d5", "t2", 5)],
        "basket_id string, tournament_id string, rank int",
    )
    items = spark.createDataFrame(
        [("d1", "A-1", "Fox", 40), ("d1", "Z-9", "Ghost", 10), ("d1", None, "Ghost", 10), ("d2", "A-1", "Fox", 59), ("d4", "B-1", "Owl", 60),
         ("d5", "C-1", "Elk", 58), ("d5", "Z-9", "Ghost", 2), ("d9", "A-1", "Fox", 60)],
        "basket_id string, raw_card_id string, raw_name string, count long",
    )
    static = spark.createDataFrame([("t1", [1, 1, 2, 2, 4]), ("t1", [0, 1, 2, 2, 4]), ("t2", [1, 1, 1, 1, 4]), ("t3", [1, 1, 1, 1, 4])], "tournament_id string, topcut_times array<int>")
    out = i.ingest_cn(comps, entries, items, cards, static)
    assert {r["tournament_id"]: (r["tier"], r["tier_coef"], r["topcut_slots"], r["env_marks"]) for r in out.star.tournaments.collect()} == {
        "t1": ("super", 2.0, 8, ["G", "H", "I"]), "t2": ("city", 1.0, 8, None), "t3": ("友谊赛", None, None, None),
    }
    assert {(r["deck_id"], r["tournament_id"], r["rank"]) for r in out.star.appearances.collect()} == {
        ("mik_moe:d1", "t1", 1), ("mik_moe:d1", "t1", 2), ("mik_moe:d1", "t2", 1), ("mik_moe:d5", "t2", 5),
    }
    assert {(r["basket_id"], r["reason"]) for r in out.lost_entries.collect()} == {("d2", "basket_blocked"), ("d3", "no_basket"), ("d4", "no_rank")}
    status = {r["deck_id"]: (r["mapped"], r["mapping_status"]) for r in out.star.decks.collect()}
    assert status == {"mik_moe:d1": (40, "partial"), "mik_moe:d4": (60, "full"), "mik_moe:d5": (58, "full")}  # a basket stays without a rank
    lines = {(r["deck_id"], r["raw_name"]): (r["card_id"], r["count"], r["stat_scope"]) for r in out.star.deck_cards.collect()}
    assert lines["mik_moe:d1", "Ghost"] == (None, 10, "other") and lines["mik_moe:d4", "Owl"] == ("B-1", 60, "supporter")
    assert {(r["tournament_id"], r["outcome"], r["reason"]) for r in out.slot_outcomes.collect()} == {
        ("t1", "materialized", None), ("t2", "skipped", "has_value"), ("t3", "question", "larger_than_field"),
    }
    counts = report(out)
    assert counts["miss", "unknown_card_id"] == 2 and counts["repeated", "entry"] == 1 and counts["blocked", "size"] == 1


def test_site_cuts_ranks_by_tier_and_counts_slots(spark, cards):
    index = spark.createDataFrame(
        [("1", "Friendly", 900, date(2025, 6, 1), 0), ("1", "League Cup Rome", 64, date(2025, 6, 1), 1), ("2", "Regional Lyon", 31, date(2025, 6, 1), 0),
         ("3", "Regional Bonn", 500, date(2020, 1, 1), 0), ("5", "Japan Championships", 900, None, 0)],
        "tournament_id string, name string, players int, date date, seq int",
    )
    standings = spark.createDataFrame(
        [("1", 1, "b1"), ("1", 8, "b2"), ("1", 9, "b1"), ("1", None, "b1"), ("1", 2, None), ("1", 3, ""), ("1", 4, "b3"), ("1", 5, "bx"), ("1", 8, "b1"),
         ("2", 900, "b1"), ("3", 1, "b1"), ("4", 70, "b2"), ("5", 33, "b4")],
        "tournament_id string, placing int, basket_id string",
    )
    items = spark.createDataFrame(
        [("b1", "S1", "7", "Volpe", 60), ("b2", "S1", "007", "Volpe", 60), ("b3", "S1", "7", "Volpe", 61), ("b4", "S1", "8", "Ghost", 30), ("b4", None, None, "Owl (S1)", 30)],
        "basket_id string, raw_set string, raw_number string, raw_name string, count long",
    )
    prints = spark.createDataFrame([("S1", "7", "Fox", 1), ("S1", "07", "Elk", 2), ("S1", "8", "Ghost", 3)], "set_code string, number string, located_name string, seq int")
    out = i.ingest_site(index, standings, items, cards, prints, window=(date(2025, 4, 11), date(2026, 4, 9)))
    assert {r["tournament_id"]: (r["tier"], r["tier_reason"], r["topcut_slots"]) for r in out.star.tournaments.collect()} == {
        "1": ("league_cup", "accepted", 3), "2": (None, "too_few_players", 1), "4": (None, "not_listed", 1), "5": (None, "domestic", 1),
    }
    assert out.window.first().asDict() == {"kept": 4, "skipped": 1, "undated": 2}
    assert [(r["tournament_id"], r["reason"]) for r in out.rejects.collect()] == [("3", "out_of_window")]
    counts = report(out)
    lost = {key: n for (section, key), n in counts.items() if section == "lost"}
    assert lost == {"beyond_cut": 1, "no_rank": 1, "no_basket_id": 2, "basket_blocked": 1, "no_basket": 1}
    mapped = {(r["raw_name"], r["card_id"]) for r in out.star.deck_cards.collect()}
    # the place in the set decides before the printed name; the newest mark of the environment wins
    assert mapped == {("Volpe", "A-2"), ("Ghost", None), ("Owl (S1)", "B-1")}
    assert {(r["raw_name"], r["resolved_name"], r["miss_kind"]) for r in out.misses.collect()} == {("Ghost", "Ghost", "no_cn_printing")}


def jp_case(spark):
    events = spark.createDataFrame(
        [("9", 1, "city-league", "結果", "渋谷", date(2025, 6, 1)), ("9", 2, "city-league", "結果", "渋谷", date(2025, 6, 1)),
         ("9", 3, "city-league", "結果", "ジャパンチャンピオンシップス", date(2025, 6, 1)), ("10", 1, "champions", None, "大阪", None),
         ("11", 1, "extra", "結果", "渋谷", date(2025, 6, 1)), ("12", 1, "news", "結果", "渋谷", date(2025, 6, 1)),
         ("13", 1, "champions", "ジャパンチャンピオンシップス 2025", "愛知", date(2020, 6, 1))],
        "article_id string, seq int, category string, article_title string, event_title string, date date",
    )
    refs = spark.createDataFrame(
        [("9", 1, "c1", "優勝"), ("9", 1, "c2", "準優勝"), ("9", 1, "c2", "準優勝"), ("9", 1, "c3", "参加"), ("9", 2, "c1", None), ("9", 3, "c4", "TOP4"),
         ("9", 3, "c9", "TOP8"), ("10", 1, "c5", "ベスト4"), ("11", 1, "c1", "優勝"), ("13", 1, "c1", "優勝")],
        "article_id string, seq int, basket_id string, placement string",
    )
    items = spark.createDataFrame(
        [("c1", 501, "キツネ", 30), ("c1", 502, "キツネ", 30), ("c2", 501, "キツネ別名", 30), ("c2", 502, "キツネ", 30), ("c3", 503, "フクロウ", 60),
         ("c4", 504, "シカ", 20), ("c4", 505, None, 20), ("c4", 506, "幽霊", 20), ("c5", 503, "フクロウ", 59)],
        "basket_id string, official_id int, raw_name string, count long",
    ).selectExpr("*", "cast(null as string) as raw_set", "cast(null as string) as raw_number")
    return events, refs, items


def sha(title):
    return hashlib.sha1(title.encode()).hexdigest()[:10]


def test_articles_tell_twins_apart_raise_tiers_and_map_by_group(spark, cards):
    out = i.ingest_jp(*jp_case(spark), cards, window=(date(2025, 1, 24), date(2025, 12, 18)))
    first, twin, national, open_day = (
        f"pokemon_card_jp:9:{sha('渋谷')}", f"pokemon_card_jp:9:{sha('渋谷')}#2", f"pokemon_card_jp:9:{sha('ジャパンチャンピオンシップス')}", f"pokemon_card_jp:10:{sha('大阪')}",
    )
    assert {r["tournament_id"]: (r["name"], r["tier"], r["topcut_slots"]) for r in out.star.tournaments.collect()} == {
        first: ("結果 / 渋谷", "city", 2), twin: ("結果 / 渋谷", "city", 0), national: ("結果 / ジャパンチャンピオンシップス", "pjcs", 1), open_day: ("大阪", "cl", 0),
    }
    assert sorted(r["reason"] for r in out.rejects.collect()) == ["out_of_window", "refused_category", "unknown_category"]
    counts = report(out)
    # c1 and c2 hold the same ids and copies, so they are one content whatever the names say
    decks = {r["deck_id"]: r["mapping_status"] for r in out.star.decks.collect()}
    assert sorted(decks.values()) == ["full", "full", "unmapped"]
    lost = {key: n for (section, key), n in counts.items() if section == "lost"}
    assert lost == {"unknown_placement": 2, "no_basket": 1, "basket_blocked": 1}
    assert counts["repeated", "entry"] == 1
    kinds = {(r["raw_name"], r["miss_kind"]) for r in out.misses.collect()}
    assert kinds == {("シカ", "ambiguous_ja_name"), ("card_id:505", "unknown_card_id"), ("幽霊", "no_ja_name_match")}
    assert {r["card_id"] for r in out.star.deck_cards.filter("raw_name = 'キツネ'").collect()} == {"A-2"}


@pytest.mark.parametrize("gate, taken", [(100, 4), (3, 1)])
def test_a_degraded_plan_takes_the_priority_category_alone(spark, cards, gate, taken):
    events, refs, items = jp_case(spark)
    wanted = refs.join(events.select("article_id", "seq", "category"), ["article_id", "seq"])
    plan = q.budget_guard(wanted, "basket_id", "category", i.PRIORITY_CATEGORY, gate)
    out = i.ingest_jp(events, refs, items, cards, plan, window=(date(2025, 1, 24), date(2025, 12, 18)))
    assert out.star.tournaments.count() == taken
    assert report(out).get(("rejected", "degraded"), 0) == 4 - taken


def test_interface_slots_come_from_the_knock_out_phase(spark, cards):
    comps = spark.createDataFrame([("t1", "Regional Championships", date(2025, 6, 1)), ("t2", "Special Event", date(2025, 6, 1))], "tournament_id string, tier string, date date")
    entries = spark.createDataFrame([("b1", "t1", 1), ("b1", "t2", None)], "basket_id string, tournament_id string, rank int")
    items = spark.createDataFrame([("b1", None, None, "Owl", 60)], "basket_id string, raw_set string, raw_number string, raw_name string, count long")
    pairings = spark.createDataFrame([("t1", 2, "a", "b"), ("t1", 2, "a", "c"), ("t1", 1, "a", "z"), ("t2", 1, "a", "b")], "tournament_id string, phase int, player1 string, player2 string")
    out = i.ingest_channel("limitless", comps, entries, items, cards, pairings=pairings)
    assert {r["tournament_id"]: r["topcut_slots"] for r in out.star.tournaments.collect()} == {"t1": 3, "t2": None}
    assert [(r["tournament_id"], r["reason"]) for r in out.lost_entries.collect()] == [("t2", "no_rank")]


def test_channels_without_rows(spark, cards):
    events, refs, items = (df.limit(0) for df in jp_case(spark))
    assert i.ingest_report(i.ingest_jp(events, refs, items, cards)).count() == 0

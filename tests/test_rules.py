"""Text functions, deck rules, legality, pages and incremental jobs, case by case."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from arena.functions import text as x
from arena.functions.tag_vocab import EFFECT_FLAGS, EFFECT_TAGS
from arena.functions.vocab import CALENDAR, SITE_REJECT_RULES, SITE_TIER_RULES
from arena.operators import baskets as k
from arena.operators import legality as lg
from arena.operators import normalise as n
from arena.operators import pages as p
from arena.operators import resolve as r
from arena.sources.export import next_data_version
from arena.streaming import refresh as rf


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("cost, want, modifier", [
    ("WWC+", [("水", 2), ("无", 1)], "+"), ("0", [], None), ("", [], None), ("0+", [], "+"), ("GWG", [("草", 1), ("水", 1), ("草", 1)], None),
])
def test_cost(spark, cost, want, modifier):
    got = one(spark, cost, x.run_length_cost)
    assert [(c["type"], c["count"]) for c in got] == want
    assert one(spark, cost, x.cost_modifier) == modifier
    assert one(spark, cost, x.cost_is_known)


@pytest.mark.parametrize("cost", ["WQ", "W+W", "?"])
def test_unknown_cost_is_refused(spark, cost):
    assert not one(spark, cost, x.cost_is_known)


@pytest.mark.parametrize("text, base, modifier, known", [
    ("20", 20, None, True), ("20+", 20, "+", True), ("20×", 20, "×", True), ("", None, None, True), ("x20", None, None, False),
])
def test_amount(spark, text, base, modifier, known):
    assert one(spark, text, x.amount_base) == base
    assert one(spark, text, x.amount_modifier) == modifier
    assert one(spark, text, x.amount_is_known) is known


@pytest.mark.parametrize("text, want", [
    ("2026-06-10", date(2026, 6, 10)), ("2026-03-15T02:10:00.000Z", date(2026, 3, 15)), ("10 Jun 26", date(2026, 6, 10)),
    ("1 Jan 51", date(1951, 1, 1)), ("31 Feb 26", None), ("soon", None), (None, None),
])
def test_text_date(spark, text, want):
    assert one(spark, text, x.text_date) == want


@pytest.mark.parametrize("day, want", [(date(2026, 4, 9), "2526"), (date(2025, 8, 1), "2526"), (date(2025, 4, 11), "2425"), (date(1999, 9, 1), "9900")])
def test_season(spark, day, want):
    assert one(spark, day, x.season_label, "date") == want


def test_set_suffix(spark):
    got = one(spark, "ナンジャモ(SV4a 079/098)", x.set_suffix)
    assert (got["name"], got["set"], got["number"], got["total"]) == ("ナンジャモ", "SV4a", "079", "098")
    plain = one(spark, "プライムキャッチャー(ACE SPEC)", x.set_suffix)
    assert (plain["name"], plain["set"]) == ("プライムキャッチャー", None)


@pytest.mark.parametrize("a, b, same", [
    ("Charizard-GX", "Charizard GX", True), ("Poké Ball", "Poke Ball", True), ("Professor's Research", "Professor's Research (Professor Magnolia)", True),
    ("Giratina Prism Star", "Giratina ◇", True), ("Pikachu", "Raichu", False),
])
def test_names_equivalent(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(r.names_equivalent(F.col("a"), F.col("b")).alias("s")).first()["s"] is same


def test_owner_and_suffix(spark):
    name = "火箭队的超梦ex"
    assert one(spark, name, lambda c: x.owner_prefix(c, ["火箭队", "N"])) == "火箭队"
    assert one(spark, name, lambda c: x.species_name(c, ["火箭队", "N"])) == "超梦"
    assert one(spark, "喷火龙VMAX", lambda c: x.species_name(c, [])) == "喷火龙"


def test_name_group(spark):
    assert one(spark, "博士的研究（木兰）", lambda c: x.name_group_key(c, ["博士的研究"])) == "博士的研究"
    assert one(spark, "博士的研究所", lambda c: x.name_group_key(c, ["博士的研究"])) == "博士的研究所"


@pytest.mark.parametrize("text, tags", [
    ("从自己牌库上方抽取2张卡牌。", ["draw"]), ("选择自己牌库中的1张卡牌，加入手牌。", ["search"]),
    ("将对手的战斗宝可梦【中毒】。", ["status"]), ("没有效果。", []),
])
def test_effect_tags(spark, text, tags):
    assert one(spark, text, lambda c: x.regex_tags(c, EFFECT_TAGS)) == tags


def test_effect_flags(spark):
    assert one(spark, "抛掷1次硬币。如果为正面，则在这个回合可以使用1次。", lambda c: x.regex_tags(c, EFFECT_FLAGS)) == ["coin_flip", "once_per_turn", "conditional"]


def test_tag_vocabulary_size():
    assert (len(EFFECT_TAGS), len(EFFECT_FLAGS)) == (28, 3)


@pytest.mark.parametrize("name, players, tier, reason", [
    ("Regional Baltimore", 900, "regional", "accepted"), ("2026 NAIC, New Orleans", 3000, "international", "accepted"),
    ("League Cup", 31, None, "too_few_players"), ("Champions League Osaka", 900, None, "domestic"), ("Friendly", 64, None, "no_match"),
])
def test_classify(spark, name, players, tier, reason):
    df = spark.createDataFrame([(name, players)], "n string, p int")
    rules = [(t, pat) for t, pat, _ in SITE_TIER_RULES]
    got = df.select(n.classify_first_match(F.col("n"), F.col("p"), rules, SITE_REJECT_RULES, 32).alias("c")).first()["c"]
    assert (got["tier"], got["reason"]) == (tier, reason)


def test_alignment_windows():
    assert lg.alignment_window("en") == (date(2025, 4, 11), date(2026, 4, 9))
    assert lg.alignment_window("ja") == (date(2025, 1, 24), date(2026, 1, 22))
    with pytest.raises(ValueError):
        lg.alignment_window("cn")


def test_calendar_segment(spark):
    df = spark.createDataFrame([("ja", date(2025, 12, 20)), ("en", date(2020, 1, 1)), (None, date(2026, 1, 1))], "r string, d date")
    got = [row["m"] for row in df.select(lg.env_marks(F.col("r"), F.col("d"), CALENDAR).alias("m")).collect()]
    assert got == [["G", "H", "I", "J"], None, None]


def test_data_versions():
    assert next_data_version(None, date(2026, 8, 9)) == "v20260809.1"
    assert next_data_version("v20260809.9", date(2026, 8, 9)) == "v20260809.10"
    assert next_data_version("v20260808.4", date(2026, 8, 9)) == "v20260809.1"


@pytest.fixture(scope="module")
def legal_cards(spark):
    rows = [
        ("A-1", ["普通"], ["x"], "G", False, None), ("A-2", ["旧卡"], ["x"], "D", False, None), ("A-3", ["白名单"], ["x"], "D", False, None),
        ("A-4", ["禁卡", "白名单"], ["坏招"], "G", False, None), ("A-5", ["禁卡"], ["好招"], "G", False, None),
        ("E-1", ["基本草能量"], [], None, True, ["草"]), ("E-2", ["基本妖能量"], [], None, True, ["妖"]), ("A-6", ["覆盖"], [], "D", False, None),
    ]
    return spark.createDataFrame(rows, "card_id string, names array<string>, skills array<string>, mark string, is_basic_energy boolean, provides array<string>")


def test_legal_order(spark, legal_cards):
    rules = lg.Snapshot("s", ("G", "H"), ("草",), ("白名单",), (("禁卡", "坏招"),))
    overrides = spark.createDataFrame([("A-6", "H")], "card_id string, mark string")
    got = {row["card_id"]: row["step"] for row in lg.legal_decisions(legal_cards, rules, overrides).collect()}
    assert got == {
        "A-1": "mark", "A-2": "not_legal", "A-3": "whitelist", "A-4": "banned", "A-5": "mark", "E-1": "basic_energy", "E-2": "not_legal", "A-6": "mark",
    }


def rule_table(spark):
    cards = [
        ("p1", 4, False, None, False, False, "甲"), ("p2", 4, False, None, False, False, "甲"), ("e1", 4, True, None, False, False, "草能量"),
        ("a1", 1, False, None, True, False, "王牌"), ("a2", 1, False, None, True, False, "王牌2"), ("u1", 1, False, "v_union", False, False, "合体"),
        ("u2", 1, False, "v_union", False, False, "合体"), ("r1", 1, False, "radiant", False, False, "光辉1"), ("r2", 1, False, "radiant", False, False, "光辉2"),
    ]
    df = spark.createDataFrame(cards, "card_id string, deck_limit int, is_basic_energy boolean, rule_box_type string, is_ace_spec boolean, is_prism boolean, name string")
    return df, df.select("card_id", F.col("name").alias("group_key"))


@pytest.mark.parametrize("basket, want", [
    ({"e1": 56, "p1": 4}, set()),
    ({"e1": 55, "p1": 4}, {("deck_size", "", 59)}),
    ({"e1": 55, "p1": 3, "p2": 2}, {("name_limit", "甲", 5)}),
    ({"e1": 58, "a1": 1, "a2": 1}, {("ace_spec_limit", "", 2)}),
    ({"e1": 58, "u1": 1, "u2": 1}, set()),
    ({"e1": 58, "u1": 2}, {("name_limit", "u1", 2)}),
    ({"e1": 58, "r1": 1, "r2": 1}, {("radiant_limit", "", 2)}),
    ({"e1": 59, "zz": 1}, {("unknown_card", "", 1)}),
])
def test_deck_rules(spark, basket, want):
    cards, groups = rule_table(spark)
    lines = spark.createDataFrame([("d", c, m) for c, m in basket.items()], "deck_id string, card_id string, count long")
    out = k.rule_violations(lines, cards, groups)
    assert {(v["kind"], v["subject"], v["count"]) for v in out.collect()} == want


def test_legality_report_marks_banned_and_not_legal(spark):
    cards, groups = rule_table(spark)
    lines = spark.createDataFrame([("d", "e1", 58), ("d", "p1", 1), ("d", "a1", 1), ("ok", "e1", 60)], "deck_id string, card_id string, count long")
    decided = spark.createDataFrame([("e1", True, False), ("p1", False, True), ("a1", False, False)], "card_id string, legal boolean, banned boolean")
    violations, report = k.legality_report(lines, cards, groups, decided)
    assert {(v["kind"], v["subject"]) for v in violations.collect()} == {("banned", "p1"), ("not_legal", "a1")}
    assert {v["deck_id"]: v["ok"] for v in report.collect()} == {"d": False, "ok": True}


def test_remap_only_upgrades(spark):
    items = spark.createDataFrame(
        [("d", "c1", "n1", 40, "pokemon"), ("d", None, "n2", 15, "other"), ("d", None, "n3", 5, "other")],
        "deck_id string, card_id string, raw_name string, count long, stat_scope string",
    )
    fresh = spark.createDataFrame([("d", "n2", "c1", "pokemon"), ("d", "n3", "c9", "stadium")], "deck_id string, raw_name string, card_id string, stat_scope string")
    after, status = k.remap_misses(items, fresh)
    assert {(v["card_id"], v["count"]) for v in after.collect()} == {("c1", 55), ("c9", 5)}
    row = status.first()
    assert (row["status_before"], row["mapping_status"], row["total"]) == ("partial", "full", 60)


def test_same_content_has_one_id(spark):
    rows = [("a", "x", 2), ("a", "y", 1), ("b", "y", 1), ("b", "x", 1), ("b", "x", 1), ("c", "x", 1), ("c", "y", 2)]
    out = {v["deck_id"]: v["content_id"] for v in k.content_entities(spark.createDataFrame(rows, "deck_id string, item string, count int"), "s").collect()}
    assert out["a"] == out["b"] != out["c"]


def test_rule_page(spark):
    blocks = [
        ("h3", "标准赛制"), ("p", "（自2026年7月16日起）"), ("p", "赛制标记为G、H、I"), ("li", "各种基本能量卡"), ("li", "特典卡“小火龙”（PROMO_002/30th-P）"),
        ("h3", "开放赛制"), ("p", "更新日期：2025年1月2日"), ("li", "甲"), ("p", "以下卡牌无法加入卡组中"), ("li", "乙（特性：丙）"), ("li", "丁"), ("h4", "其他"), ("li", "戊"),
    ]
    pages = spark.createDataFrame([(1, blocks)], "page_id long, blocks array<struct<tag:string,text:string>>")
    got = {row["format"]: row for row in p.parse_rule_pages(pages).collect()}
    assert got["standard"]["effective_from"] == date(2026, 7, 16)
    assert got["standard"]["marks"] == ["G", "H", "I"] and [tuple(w) for w in got["standard"]["whitelist"]] == [("小火龙", "特典卡 PROMO_002/30th-P")]
    assert [tuple(w) for w in got["open"]["whitelist"]] == [("甲", None), ("戊", None)]
    assert [(b["name"], b["ability_or_attack"]) for b in got["open"]["banned"]] == [("乙", "丙"), ("丁", None)]


def test_blocks_of_long_and_broken_pages(spark):
    html = "<article><h1>T</h1><p>" + "ab &amp; " * 50_000 + "</p><p>one<li>two</li><p>never closed</article>"
    blocks = p.block_texts(spark.createDataFrame([(1, html)], "page_id long, html string"), "article").first()["blocks"]
    assert [b["tag"] for b in blocks] == ["h1", "p", "p", "li"]
    assert len(blocks[1]["text"]) == 50_000 * 5 - 1


def test_ingest_is_idempotent(spark, tmp_path):
    source, target, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))
    schema = "id long, v string"
    run = lambda: rf.ingest_files(spark, source, target, progress, schema, "id")
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.mode("append").parquet(source)
    run()
    run()
    spark.createDataFrame([(2, "late"), (3, "c")], schema).write.mode("append").parquet(source)
    run()
    assert {(row["id"], row["v"]) for row in rf.stored_rows(spark, target, schema).collect()} == {(1, "a"), (2, "b"), (3, "c")}


def test_rollback_skips_incomplete_versions(spark, tmp_path):
    root = str(tmp_path / "versions")
    rf.write_version(spark.range(10), root, 1)
    spark.range(3).write.parquet(f"{root}/data/version=2")  # no manifest row: never finished
    rf.write_version(spark.range(8), root, 3)
    version, data = rf.rollback(spark, root, 3)
    assert (version, data.count()) == (1, 10)


def test_contract_differences(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert {(d["only_in"], d["v"], d["times"]) for d in rf.contract_differences(a, b).collect()} == {("left", 1, 1), ("right", 3, 1)}


def test_recaliber_without_drift_changes_nothing(spark):
    from arena.sources.export import vocabulary_hash

    tours = spark.createDataFrame([("t", "city", 7.0)], "tournament_id string, tier string, tier_coef double")
    tiers = [("city", 1.0, [])]
    same, summary = rf.recaliber(tours, tiers, vocabulary_hash(tiers))
    assert same.first()["tier_coef"] == 7.0 and summary.first()["drift"] is False
    new, summary = rf.recaliber(tours, tiers, "other")
    assert new.first()["tier_coef"] == 1.0 and summary.first()["changed"] == 1


def test_name_chain_rules(spark):
    cards = spark.createDataFrame(
        [("A-1", "Boss's Orders", "G", date(2024, 1, 1)), ("A-2", "Boss's Orders", "H", date(2023, 1, 1)), ("A-3", "Psychic Energy", None, None)],
        "card_id string, name_en string, mark string, release_date date",
    )
    probes = spark.createDataFrame(
        [("Boss's Orders (Ghetsis)", ["H"]), ("Boss's Orders", None), ("Basic Psychic Energy", ["H"]), ("Nothing", ["H"])], "name string, env_marks array<string>"
    )
    out = {row["name"]: (row["card_id"], row["rule"]) for row in r.map_by_name(probes, r.name_index(cards, "name_en"), F.lit("ptcd")).collect()}
    assert out == {
        "Boss's Orders (Ghetsis)": ("A-2", "ptcd+paren_strip+env+latest"), "Boss's Orders": ("A-1", "ptcd+latest"),
        "Basic Psychic Energy": ("A-3", "ptcd+basic_energy_alias+unique"), "Nothing": (None, "unmapped"),
    }


@pytest.mark.parametrize("name, dex, want", [
    ("Mega Lopunny & Jigglypuff-GX", [39, 428], "メガミミロップ&プリンGX"), ("Bloodmoon Ursaluna ex", [901], "ガチグマ アカツキex"),
    ("Alolan Exeggutor", [103], "アローラ ナッシー"), ("N's Zoroark ex", [571], "Nのゾロアークex"), ("Team Rocket's Zoroark", [571], "ロケット団のゾロアーク"),
    ("Nobody's Zoroark", [571], None), ("Grass Energy", [], "基本草エネルギー"), ("Exeggutor", [], "ナッシー"), ("Exeggutor", [571], None),
    ("Lopunny & Jigglypuff", [], None),
])
def test_composed_names(spark, name, dex, want):
    species = spark.createDataFrame(
        [(39, "Jigglypuff", "プリン"), (103, "Exeggutor", "ナッシー"), (428, "Lopunny", "ミミロップ"), (571, "Zoroark", "ゾロアーク"), (901, "Ursaluna", "ガチグマ")],
        "dex long, name string, translated string",
    )
    cards = spark.createDataFrame([("c", name, dex)], "card_id string, name string, dex_ids array<long>")
    assert r.compose_names(cards, species, r.JAPANESE_NAMES).first()["translated"] == want


def test_partitioned_ingest(spark, tmp_path):
    source, target, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))
    schema = "id long, day string"
    for rows in ([(1, "a"), (2, "b")], [(2, "b"), (3, "b"), (4, "c")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        rf.ingest_files(spark, source, target, progress, schema, "id", partition="day")
    assert sorted(row["id"] for row in rf.stored_rows(spark, target, schema).collect()) == [1, 2, 3, 4]

"""Fixed vocabularies. Values that decide results are stated plainly here.

Every vocabulary is open: callers may pass their own rows instead.
"""

from __future__ import annotations

# Competition tier, coefficient, aliases (matched in lower case).
TIERS: list[tuple[str, float, list[str]]] = [
    ("master", 4.0, ["大师赛"]),
    ("pjcs", 4.0, ["ポケモンジャパンチャンピオンシップス"]),
    ("super", 2.0, ["超级赛", "great"]),
    ("cl", 2.0, ["champions league", "チャンピオンズリーグ"]),
    ("advanced", 1.5, ["高级赛", "ultra"]),
    ("regional", 1.5, ["regional championships"]),
    ("international", 4.0, ["international championships", "ic"]),
    ("worlds", 6.0, ["world championships"]),
    ("special", 1.5, ["special event"]),
    ("league_cup", 1.0, ["league cup"]),
    ("master_ball_league", 1.5, ["master ball league", "mbl"]),
    ("korean_league", 1.5, ["korean league", "kl"]),
    ("premier_ball_league", 1.0, ["premier ball league", "pbl"]),
    ("city", 1.0, ["城市赛", "シティリーグ", "city league"]),
]

# Divisions and their aliases.
DIVISIONS: list[tuple[str, list[str]]] = [
    ("master", ["公开组"]),
    ("senior", ["少年组"]),
    ("junior", ["儿童组"]),
]

# Data source -> statistics basis and calendar region.
SOURCE_BASIS: dict[str, str] = {
    "mik_moe": "cn",
    "limitless": "intl_aligned",
    "limitless_site": "intl_aligned",
    "pokemon_card_jp": "jp",
}
SOURCE_REGION: dict[str, str] = {
    "mik_moe": "cn",
    "limitless": "en",
    "limitless_site": "en",
    "pokemon_card_jp": "ja",
}

# Rotation calendar (region, from, to, marks); an open end is None.
CALENDAR: list[tuple[str, str, str | None, list[str]]] = [
    ("cn", "2026-07-16", None, ["G", "H", "I"]),
    ("en", "2025-04-11", "2026-04-09", ["G", "H", "I"]),
    ("en", "2026-04-10", None, ["H", "I", "J"]),
    ("ja", "2025-01-24", "2025-12-18", ["G", "H", "I"]),
    ("ja", "2025-12-19", "2026-01-22", ["G", "H", "I", "J"]),
    ("ja", "2026-01-23", None, ["H", "I", "J"]),
]

# Name rules of the result-site channel, in order (tier, pattern, rank cut).
SITE_MIN_PLAYERS = 32
SITE_TIER_RULES: list[tuple[str, str, int]] = [
    ("worlds", r"World Championships", 32),
    ("international", r"\b(NAIC|EUIC|LAIC|OCIC)\b|International Championship", 32),
    ("master_ball_league", r"Master Ball League", 32),
    ("korean_league", r"Korean League", 32),
    ("premier_ball_league", r"Premier Ball League", 8),
    ("special", r"Special Event", 32),
    ("regional", r"\bRegional\b", 32),
    ("league_cup", r"League Cup", 8),
]
SITE_REJECT_RULES: list[tuple[str, str]] = [
    ("domestic", r"Japan Championships|Champions League|\bJCS\b"),
]
API_TIER_RULES: list[tuple[str, str]] = [
    ("regional", r"Regional Championship"),
    ("international", r"International Championship"),
    ("special", r"Special Event"),
    ("league_cup", r"League Cup"),
]

# Article category -> tier (None = rejected), placement words, title overrides.
ARTICLE_CATEGORIES: list[tuple[str, str | None]] = [
    ("champions", "cl"),
    ("city-league", "city"),
    ("jim-battle", None),
    ("extra", None),
]
PLACEMENT_RANKS: dict[str, int] = {
    "優勝": 1,
    "準優勝": 2,
    "TOP4": 4,
    "TOP8": 8,
    "TOP16": 16,
    "TOP32": 32,
    "32位": 32,
    "ベスト4": 4,
}
TITLE_TIER_OVERRIDES: list[tuple[str, str]] = [("ジャパンチャンピオンシップス", "pjcs")]

# Energy code letters, card types, stages, eras.
ENERGY_CODES: dict[str, str] = {
    "G": "草",
    "R": "火",
    "W": "水",
    "L": "雷",
    "P": "超",
    "F": "斗",
    "D": "恶",
    "M": "钢",
    "Y": "妖",
    "N": "龙",
    "C": "无",
}
BASIC_ENERGY_TYPES = ["草", "火", "水", "雷", "超", "斗", "恶", "钢", "妖"]
CARD_TYPES: dict[str, tuple[str, str | None]] = {
    "Pokemon": ("pokemon", None),
    "Supporter": ("trainer", "支援者"),
    "Item": ("trainer", "物品"),
    "Tool": ("trainer", "宝可梦道具"),
    "Stadium": ("trainer", "竞技场"),
    "Basic Energy": ("energy", None),
    "Special Energy": ("energy", None),
}
SCOPE_SUBTYPES: dict[str, str] = {
    "支援者": "supporter",
    "竞技场": "stadium",
    "物品": "other",
    "宝可梦道具": "other",
}
STAGES: dict[str, str] = {
    "Basic": "基础",
    "Stage 1": "1阶",
    "Stage 2": "2阶",
    "VMAX": "VMAX",
    "V-UNION": "V-UNION",
    "VSTAR": "VSTAR",
}
ERAS: dict[str, str] = {
    "Sun & Moon": "太阳&月亮",
    "Sword & Shield": "剑&盾",
    "Scarlet & Violet": "朱&紫",
    "Promo": "特典",
    "30th": "特典",
}
UNKNOWN_ERA = "未划分"
OWNERS = ["火箭队", "莉莉艾", "竹兰", "玛俐", "N"]
RULE_SUFFIXES = ["GX", "◇", "ex", "V-UNION", "VMAX", "VSTAR", "V"]

# Mechanic, stage and label maps of the rule-box derivation.
MECHANIC_RULE_BOX: dict[str, str] = {
    "GX": "gx",
    "Prism Star": "prism_star",
    "V": "v",
    "Radiant": "radiant",
    "ex": "ex",
}
STAGE_RULE_BOX: dict[str, str] = {"VMAX": "vmax", "V-UNION": "v_union", "VSTAR": "vstar"}
LABEL_TAGS: dict[str, str] = {
    "Ultra Beast": "究极异兽",
    "Single Strike": "一击",
    "Rapid Strike": "连击",
    "Fusion Strike": "汇流",
    "Ancient": "古代",
    "Future": "未来",
}
PRIZE_BY_RULE_BOX: dict[str, int] = {
    "ex": 2,
    "gx": 2,
    "tag_team_gx": 3,
    "v_union": 3,
    "mega_ex": 3,
    "v": 2,
    "vmax": 3,
    "vstar": 2,
}
RULE_BOX_TYPES = ["ex", "gx", "tag_team_gx", "prism_star", "radiant", "v", "vmax", "vstar", "v_union", "mega_ex"]
RARITIES = [
    "C", "U", "R", "RR", "RRR", "SR", "HR", "UR", "TR", "CHR", "CSR", "AR", "SAR", "S", "SSR", "K", "PR", "FUR", "无标记", "A",
    "●", "◆", "★", "★★", "★★★", "ACE",
]
LIMIT_BY_RULE_BOX: dict[str, int] = {"prism_star": 1, "radiant": 1, "v_union": 1}
SAME_NAME_BASES = ["博士的研究", "老大的指令"]
UNION_POSITIONS = ["左上", "右上", "左下", "右下"]
TOPCUT_SIZES = [4, 8, 16, 32]

# Composition of Japanese item names from English ones, and set code overrides.
JA_PREFIXES: dict[str, str] = {
    "Team Rocket's": "ロケット団の",
    "Shadow Rider": "こくば",
    "Ice Rider": "はくば",
    "Rapid Strike": "れんげき",
    "Single Strike": "いちげき",
    "Fusion Strike": "フュージョン",
    "Origin Forme": "オリジン",
    "Ultra": "ウルトラ",
    "Surfing": "なみのり",
    "Flying": "そらをとぶ",
    "Shining": "ひかる",
    "Alolan": "アローラ ",
    "Galarian": "ガラル ",
    "Hisuian": "ヒスイ ",
    "Paldean": "パルデア ",
    "Radiant": "かがやく",
    "Mega": "メガ",
    "Black": "ブラック",
    "White": "ホワイト",
    "Mow": "カット",
    "Heat": "ヒート",
    "Wash": "ウォッシュ",
    "Fan": "スピン",
    "Frost": "フロスト",
}
JA_MODIFIERS: dict[str, str] = {
    "Hearthflame Mask": "かまどのめん",
    "Cornerstone Mask": "いしずえのめん",
    "Wellspring Mask": "いどのめん",
    "Teal Mask": "みどりのめん",
    "Bloodmoon": "アカツキ",
}
JA_OWNERS: dict[str, str] = {
    "N": "N",
    "Ethan": "ヒビキ",
    "Hop": "ホップ",
    "Cynthia": "シロナ",
    "Iono": "ナンジャモ",
    "Arven": "ペパー",
    "Marnie": "マリィ",
    "Misty": "カスミ",
    "Steven": "ダイゴ",
    "Lillie": "リーリエ",
    "Lance": "ワタル",
}
JA_SUFFIXES: dict[str, str] = {
    " Prism Star": "◇",
    " V-UNION": "V-UNION",
    " VMAX": "VMAX",
    " VSTAR": "VSTAR",
    "-GX": "GX",
    "-EX": "EX",
    " ex": "ex",
    " V": "V",
}
JA_BASIC_ENERGIES: dict[str, str] = {
    "Grass Energy": "基本草エネルギー",
    "Fire Energy": "基本炎エネルギー",
    "Water Energy": "基本水エネルギー",
    "Lightning Energy": "基本雷エネルギー",
    "Psychic Energy": "基本超エネルギー",
    "Fighting Energy": "基本闘エネルギー",
    "Darkness Energy": "基本悪エネルギー",
    "Metal Energy": "基本鋼エネルギー",
    "Fairy Energy": "基本フェアリーエネルギー",
}
SET_OVERRIDES: list[tuple[str, str]] = [("SMP", "smp"), ("SP", "swshp"), ("SVP", "svp"), ("Energy", "sve"), ("SVE", "sve")]

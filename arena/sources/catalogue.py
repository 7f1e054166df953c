"""part as an item catalogue, flat and as raw nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.functions.parallel import tasks_for
from arena.sources.tables import Tables, lookup

EPOCH = "1995-01-01"
CARDS_PER_TASK = 50_000  # documents that one task writes and parses; a part is a few bytes on disk and seconds of work by the hundred thousand


def _mark() -> Column:
    band = F.ceil(F.col("p_size") / 10).cast("int")
    return F.when(F.col("p_type") != "PROMO", F.element_at(F.array(*[F.lit(m) for m in "EFGHI"]), band))


def release_date(key: Column) -> Column:
    day = F.date_add(F.lit(EPOCH).cast("date"), F.pmod(key * 37, F.lit(2400)).cast("int"))
    return F.when(F.pmod(key, F.lit(50)) != 0, day)


TYPE_OF = {"ECONOMY": "pokemon", "STANDARD": "pokemon", "SMALL": "trainer", "MEDIUM": "trainer",
           "LARGE": "trainer", "PROMO": "energy"}
SUBTYPE_OF = {"SMALL": "支援者", "MEDIUM": "物品", "LARGE": "竞技场"}


def catalogue(t: Tables) -> DataFrame:
    """card_id, set, number, names, type, mark, release day and the derived rule columns."""
    key, kind = F.col("p_partkey"), F.col("p_type")
    basic = (kind == "PROMO") & (F.col("p_size") % 2 == 0)
    words = F.split("p_name", " ")
    return t.part.select(
        F.concat("p_brand", F.lit("-"), key.cast("string")).alias("card_id"),
        key.alias("num"),
        F.col("p_brand").alias("set_id"),
        key.cast("string").alias("number"),
        F.col("p_name").alias("name_full"),
        words[0].alias("first_word"),
        words[1].alias("species"),
        lookup(kind, TYPE_OF).alias("card_type"),
        lookup(kind, SUBTYPE_OF).alias("trainer_subtype"),
        _mark().alias("mark"),
        release_date(key).alias("release_date"),
        basic.alias("is_basic_energy"),
        F.when(basic, F.array(words[0])).alias("provides"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


RAW_SCHEMA = """
name string, cardType string, mechanic string, label array<string>, description string, setCode string,
cardIndex string, rarity string, regulationMark string, nameEn string,
pokemonAttr struct<energyType: string, stage: string, hp: int, evolvesFrom: string,
  ability: array<struct<name: string, text: string>>,
  attack: array<struct<name: string, text: string, cost: string, damage: string>>,
  weakness: struct<energy: string, value: string>, resistance: struct<energy: string, value: string>,
  retreatCost: int>
"""


def brand_number() -> Column:
    return F.substr("p_brand", F.lit(7)).cast("int")


def growing_cards(t: Tables) -> DataFrame:
    """set_id, number, num and one JSON document per part; records are right, but for faults planted in two sets of three."""
    key, size, kind = F.col("p_partkey"), F.col("p_size"), F.col("p_type")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(by, F.lit(len(values))) + 1).cast("int"))  # noqa: E731,E501
    bad = lambda mod: (F.pmod(brand_number(), F.lit(3)) != 0) & (key % mod == 0)
    pokemon = kind.isin("ECONOMY", "STANDARD")
    attack = lambda i: F.struct(
        F.concat(F.lit(f"hit {i} "), size.cast("string")).alias("name"), F.col("p_name").alias("text"),
        F.concat(pick("GRWLPFDMYC", key + i), F.repeat(F.lit("C"), F.pmod(size, F.lit(3))), F.when(key % 11 == 0, "+").otherwise("")).alias("cost"),
        F.concat((size * 10).cast("string"), pick(["", "+", "×", "-"], key)).alias("damage"),
    )
    attr = F.struct(
        pick("GRWLPFDMYNC", size).alias("energyType"),
        F.when(bad(239), "V-UNION").otherwise(pick(["Basic", "Stage 1", "Stage 2", "VMAX", "VSTAR"], key)).alias("stage"),
        F.when(bad(227), 400).otherwise(60 + size * 5).cast("int").alias("hp"), F.when(key % 4 == 0, F.col("p_name")).alias("evolvesFrom"),
        F.array(F.struct(F.lit("gift").alias("name"), F.col("p_name").alias("text"))).alias("ability"),
        F.array(attack(0), attack(1)).alias("attack"), F.struct(pick("RWG", key).alias("energy"), F.lit("×2").alias("value")).alias("weakness"),
        F.pmod(size, F.lit(4)).cast("int").alias("retreatCost"),
    )
    card_type = lookup(kind, {"ECONOMY": "Pokemon", "STANDARD": "Pokemon", "SMALL": "Supporter", "MEDIUM": "Item", "LARGE": "Stadium", "PROMO": "Basic Energy"})
    record = F.struct(
        F.when(bad(233), "").otherwise(F.col("p_name")).alias("name"), F.when(bad(211), "Mystery").otherwise(card_type).alias("cardType"),
        pick(["GX", "V", "ex", "Radiant", "Prism Star", "ACE SPEC"], size).alias("mechanic"), F.array(pick(["TAG TEAM", "Ancient"], key)).alias("label"),
        F.col("p_name").alias("description"), F.col("p_brand").alias("setCode"), key.cast("string").alias("cardIndex"),
        F.when(bad(229), "XX").otherwise(pick(["C", "U", "R"], size)).alias("rarity"),
        F.when(bad(223) & (kind != "PROMO"), "x").otherwise(F.coalesce(_mark(), F.lit(""))).alias("regulationMark"),
        F.concat_ws(" ", "p_name", key.cast("string")).alias("nameEn"), F.when(pokemon, attr).alias("pokemonAttr"),
    )
    # a file of parts is too small to be read by many tasks
    part = t.part.repartition(tasks_for(t.part, CARDS_PER_TASK), "p_partkey")
    return part.select(F.col("p_brand").alias("set_id"), key.cast("string").alias("number"), key.alias("num"), F.to_json(record).alias("body"))


def raw_cards(t: Tables) -> DataFrame:
    """One JSON document per part in the shape of a raw card record, some of them faulty."""
    key, size, kind = F.col("p_partkey"), F.col("p_size"), F.col("p_type")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(by, F.lit(len(values))) + 1).cast("int"))  # noqa: E731,E501
    cost = F.concat(
        F.repeat(pick("GRWLPFDMYC", key), F.pmod(key, F.lit(3)).cast("int")), F.repeat(F.lit("C"), F.pmod(size, F.lit(3))),
        F.when(key % 11 == 0, "+").when(key % 97 == 0, "?").otherwise(""),
    )
    attack = F.struct(
        F.concat(F.lit("hit "), size.cast("string")).alias("name"), F.col("p_name").alias("text"), cost.alias("cost"),
        F.concat((size * 10).cast("string"), pick(["", "+", "×", "-"], key)).alias("damage"),
    )
    attr = F.struct(
        pick("GRWLPFDMYNC", size).alias("energyType"),
        pick(["Basic", "Stage 1", "Stage 2", "VMAX", "V-UNION", "VSTAR"], key).alias("stage"),
        (size * 7).cast("int").alias("hp"),
        F.when(key % 4 == 0, F.col("p_name")).alias("evolvesFrom"),
        F.array(F.struct(F.lit("gift").alias("name"), F.col("p_name").alias("text"))).alias("ability"),
        F.array(attack).alias("attack"),
        F.struct(pick("RWG", key).alias("energy"), F.lit("×2").alias("value")).alias("weakness"),
        F.pmod(size, F.lit(4)).cast("int").alias("retreatCost"),
    )
    card_type = lookup(kind, {"ECONOMY": "Pokemon", "STANDARD": "Pokemon", "SMALL": "Supporter", "MEDIUM": "Item",
                              "LARGE": "Stadium", "PROMO": "Special Energy"})
    record = F.struct(
        F.col("p_name").alias("name"),
        F.when(key % 101 == 0, "Mystery").otherwise(card_type).alias("cardType"),
        pick(["GX", "V", "ex", "Radiant", "Prism Star", "ACE SPEC", "Odd"], size).alias("mechanic"),
        F.array(pick(["TAG TEAM", "Ancient", "Strange"], key)).alias("label"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("setCode"),
        key.cast("string").alias("cardIndex"),
        pick(["C", "U", "R", "XX"], size).alias("rarity"),
        F.coalesce(_mark(), F.lit("")).alias("regulationMark"),
        F.initcap("p_name").alias("nameEn"),
        F.when(kind.isin("ECONOMY", "STANDARD"), attr).alias("pokemonAttr"),
    )
    return t.part.select(key.alias("num"), F.to_json(record).alias("body"))

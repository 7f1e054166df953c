"""Raw records to typed rows. Unknown values are never guessed: NULL plus a reason, or a reject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.functions import text as x
from arena.functions import vocab as v
from arena.functions.lookup import lookup_table
from arena.functions.rank import latest_per_key
from arena.sources.tables import lookup


def alias_rows(entries: Sequence[tuple]) -> list[tuple]:
    """(name, ..., aliases) -> one row per lower-cased alias, the name itself included."""
    return [(a.lower(), *entry[:-1]) for entry in entries for a in dict.fromkeys([entry[0], *entry[-1]])]


def tier_of(df: DataFrame, raw: str, tiers: Sequence[tuple[str, float, list[str]]] = v.TIERS) -> DataFrame:
    """Adds tier, tier_coef and tier_known; an unknown value is kept raw without coefficient."""
    table = lookup_table(df.sparkSession, alias_rows(tiers), "_alias string, _tier string, _coef double")
    cleaned = F.nullif(F.trim(F.col(raw)), F.lit(""))
    joined = df.withColumn("_raw", cleaned).join(table, F.lower("_raw") == F.col("_alias"), "left")
    return joined.select(
        *df.columns,
        F.coalesce("_tier", "_raw").alias("tier"),
        F.col("_coef").alias("tier_coef"),
        (F.col("_raw").isNull() | F.col("_alias").isNotNull()).alias("tier_known"),
    )


def division_of(df: DataFrame, raw: str, divisions: Sequence[tuple[str, list[str]]] = v.DIVISIONS) -> DataFrame:
    table = lookup_table(df.sparkSession, alias_rows(divisions), "_alias string, _canonical string")
    cleaned = F.nullif(F.trim(F.col(raw)), F.lit(""))
    joined = df.withColumn("_raw", cleaned).join(table, F.lower("_raw") == F.col("_alias"), "left")
    return joined.select(*df.columns, F.coalesce("_canonical", "_raw").alias("division"))


def stat_scope(card_type: Column, subtype: Column) -> Column:
    """Statistics scope; combinations outside the vocabulary are 'other'."""
    trainer = F.coalesce(lookup(subtype, v.SCOPE_SUBTYPES), F.lit("other"))
    return F.when(card_type == "pokemon", "pokemon").when(card_type == "trainer", trainer).otherwise("other")


def scope_is_known(card_type: Column, subtype: Column) -> Column:
    trainer = (card_type == "trainer") & subtype.isin(*v.SCOPE_SUBTYPES)
    return F.coalesce(card_type.isin("pokemon", "energy") | trainer, F.lit(False))


def rule_box(mechanic: Column, labels: Column, stage: Column) -> Column:
    """Rule type from mechanic and label; the stage map has the last word."""
    by_mechanic = F.when(
        (mechanic == "GX") & F.coalesce(F.array_contains(labels, "TAG TEAM"), F.lit(False)), "tag_team_gx"
    ).otherwise(lookup(mechanic, v.MECHANIC_RULE_BOX))
    return F.coalesce(lookup(stage, v.STAGE_RULE_BOX), by_mechanic)


def label_tags(labels: Column) -> Column:
    tags = F.array_compact(F.transform(labels, lambda item: lookup(item, v.LABEL_TAGS)))
    return F.when(F.size(tags) > 0, tags)


def mentions(words: Sequence[str], *texts: Column) -> Column:
    out = F.lit(False)
    for text in texts:
        for word in words:
            out = out | F.coalesce(F.contains(text, F.lit(word)), F.lit(False))
    return out


def is_ace_spec(mechanic: Column, labels: Column, name: Column) -> Column:
    return mentions(["ACE SPEC"], mechanic, F.array_join(labels, "|"), name)


def is_tera(mechanic: Column, labels: Column, name: Column) -> Column:
    return mentions(["太晶", "Tera"], mechanic, F.array_join(labels, "|"), name)


def deck_limit(rule: Column, ace: Column) -> Column:
    return F.when(ace, 1).otherwise(F.coalesce(lookup(rule, v.LIMIT_BY_RULE_BOX), F.lit(4)))


def prize_cards(rule: Column) -> Column:
    return F.coalesce(lookup(rule, v.PRIZE_BY_RULE_BOX), F.lit(1))


def basic_energy_type(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind in reversed(v.BASIC_ENERGY_TYPES):
        out = F.when(F.contains(name, F.lit(kind)), F.lit(kind)).otherwise(out)
    return out


def normalise_cards(
    raw: DataFrame, denominators: DataFrame | None = None, owners: Sequence[str] = v.OWNERS, rarities: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Parsed records (column ``r``) -> (cards, rejects).

    Rejected: a card type, stage, energy code or damage form outside the
    vocabulary. Kept but questioned: mechanic, label, rarity (column ``questions``).
    """
    r, attr = F.col("r"), F.col("r.pokemonAttr")
    types = {k: t for k, (t, _) in v.CARD_TYPES.items()}
    subtypes = {k: s for k, (_, s) in v.CARD_TYPES.items() if s}
    card_type = lookup(r["cardType"], types)
    rule = rule_box(r["mechanic"], r["label"], attr["stage"])
    ace = is_ace_spec(r["mechanic"], r["label"], r["name"])
    basic = r["cardType"].isin("Basic Energy", "Energy")
    energy = lambda code: lookup(code, v.ENERGY_CODES)
    known = lambda code: code.isNull() | code.isin(*v.ENERGY_CODES)
    reason = (
        F.when(card_type.isNull(), "card_type")
        .when(attr["stage"].isNotNull() & ~attr["stage"].isin(*v.STAGES), "stage")
        .when(~known(attr["energyType"]), "energy_type")
        .when(~known(attr["weakness"]["energy"]) | ~known(attr["resistance"]["energy"]), "weakness")
        .when(F.exists(F.coalesce(attr["attack"], F.array()), lambda a: ~x.cost_is_known(a["cost"])), "cost")
        .when(F.exists(F.coalesce(attr["attack"], F.array()), lambda a: ~x.amount_is_known(a["damage"])), "damage")
    )
    questions = F.array_compact(F.array(
        F.when(r["mechanic"].isNotNull() & ~r["mechanic"].isin(*v.MECHANIC_RULE_BOX, "ACE SPEC"), "mechanic"),
        F.when(F.exists(F.coalesce(r["label"], F.array()), lambda i: ~i.isin(*v.LABEL_TAGS, "TAG TEAM")), "label"),
        F.when(~r["rarity"].isin(*rarities), "rarity") if rarities else F.lit(None).cast("string"),
        F.when(r["cardType"] == "Special Energy", "provides"),
    ))
    attacks = F.transform(attr["attack"], lambda a: F.struct(
        F.coalesce(a["name"], F.lit("")).alias("name"),
        x.run_length_cost(a["cost"]).alias("cost"),
        x.cost_modifier(a["cost"]).alias("cost_modifier"),
        x.amount_base(a["damage"]).alias("damage_base"),
        x.amount_modifier(a["damage"]).alias("damage_modifier"),
        F.coalesce(a["text"], F.lit("")).alias("effect_text"),
    ))
    pair = lambda p: F.when(p.isNotNull(), F.struct(energy(p["energy"]).alias("type"), p["value"].alias("value")))  # noqa: E731,E501
    marked = raw.filter(r.isNotNull()).withColumn("_reason", reason)
    cards = marked.filter(F.col("_reason").isNull())
    total = F.lit(None).cast("int")
    if denominators is not None:
        cards = cards.join(denominators, r["setCode"] == F.col("set_id"), "left").drop("set_id")
        total = F.col("face_total")
    cards = cards.select(
        F.concat(r["setCode"], F.lit("-"), r["cardIndex"]).alias("card_id"),
        r["setCode"].alias("set_id"),
        r["cardIndex"].alias("number"),
        F.concat_ws("/", r["cardIndex"], total.cast("string")).alias("number_display"),
        r["name"].alias("name_full"),
        F.when(card_type == "pokemon", x.species_name(r["name"], owners)).alias("species"),
        x.owner_prefix(r["name"], owners).alias("owner"),
        card_type.alias("card_type"),
        lookup(r["cardType"], subtypes).alias("trainer_subtype"),
        F.nullif(r["regulationMark"], F.lit("")).alias("regulation_mark"),
        r["rarity"].alias("rarity"),
        lookup(attr["stage"], v.STAGES).alias("stage"),
        attr["hp"].alias("hp"),
        F.when(attr["energyType"].isNotNull(), F.array(energy(attr["energyType"]))).alias("types"),
        F.nullif(attr["evolvesFrom"], F.lit("")).alias("evolves_from_text"),
        rule.alias("rule_box_type"),
        rule.isNotNull().alias("has_rule_box"),
        is_tera(r["mechanic"], r["label"], r["name"]).alias("is_tera"),
        prize_cards(rule).alias("prize_cards"),
        deck_limit(rule, ace).alias("deck_limit"),
        ace.alias("is_ace_spec"),
        attr["ability"].alias("abilities"),
        attacks.alias("attacks"),
        pair(attr["weakness"]).alias("weakness"),
        pair(attr["resistance"]).alias("resistance"),
        attr["retreatCost"].alias("retreat_cost"),
        basic.alias("is_basic_energy"),
        F.when(basic, F.array_compact(F.array(basic_energy_type(r["name"])))).alias("provides"),
        F.coalesce(r["description"], F.lit("")).alias("text_raw"),
        label_tags(r["label"]).alias("effect_tags"),
        F.nullif(r["nameEn"], F.lit("")).alias("name_en"),
        F.lit("draft").alias("status"),
        questions.alias("questions"),
    )
    rejects = marked.filter(F.col("_reason").isNotNull()).select(
        F.concat(r["setCode"], F.lit("-"), r["cardIndex"]).alias("card_id"), F.col("_reason").alias("reason")
    )
    return cards, rejects


def normalise_sets(products: DataFrame, marks: DataFrame) -> DataFrame:
    """Set rows. A placeholder year is no release date; an unknown series is questioned.

    ``products``: set_id, name, series, release_text, cards_num; ``marks``: the
    mark summary per set.
    """
    day = x.text_date(F.col("release_text"))
    era = lookup(F.col("series"), v.ERAS)
    joined = products.join(marks.select("set_id", "marks", F.col("question").alias("_several")), "set_id", "left")
    questions = F.array_compact(F.array(F.when(era.isNull(), "series"), F.when(F.col("_several"), "regulation_mark")))
    return joined.select(
        "set_id", F.col("name").alias("name_zh"), F.coalesce(era, F.lit(v.UNKNOWN_ERA)).alias("era"),
        F.when(F.year(day) > 1, day).alias("release_date"), F.coalesce("marks", F.lit("")).alias("regulation_mark"),
        F.col("cards_num").alias("expected_count"), questions.alias("questions"),
    )


def classify_first_match(
    name: Column, players: Column, tiers: Sequence[tuple[str, str]], rejects: Sequence[tuple[str, str]], min_players: int
) -> Column:
    """struct(tier, reason): size gate, then accepted names in order, then refused names."""
    tier = F.when(players >= min_players, x.first_match(name, tiers))
    refused = x.first_match(name, rejects) if rejects else F.lit(None).cast("string")
    reason = (
        F.when(players.isNull() | (players < min_players), "too_few_players")
        .when(tier.isNotNull(), "accepted")
        .otherwise(F.coalesce(refused, F.lit("no_match")))
    )
    return F.struct(tier.alias("tier"), reason.alias("reason"))


def title_override_tier(
    titles: Sequence[Column], category: Column, categories: Sequence[tuple[str, str | None]],
    overrides: Sequence[tuple[str, str]],
) -> Column:
    """struct(tier, reason): a title override beats the category; refused and unknown categories differ."""
    base = lookup(category, {slug: tier for slug, tier in categories if tier})
    out = base
    for title in reversed(titles):
        for word, tier in reversed(overrides):
            out = F.when(F.coalesce(F.contains(title, F.lit(word)), F.lit(False)), F.lit(tier)).otherwise(out)
    refused = [slug for slug, tier in categories if tier is None]
    is_refused = category.isin(*refused) if refused else F.lit(False)
    reason = F.when(base.isNotNull(), "accepted").when(is_refused, "refused_category").otherwise("unknown_category")
    return F.struct(F.when(base.isNotNull(), out).alias("tier"), reason.alias("reason"))


def normalise_competitions(listing: DataFrame, detail: DataFrame, source: str = "mik_moe") -> DataFrame:
    """List rows overlaid with detail rows; the detail wins for size, place and date."""
    l, d = listing.alias("l"), detail.alias("d")
    joined = l.join(d, F.col("l.id") == F.col("d.id"), "left")
    first = lambda *cols: F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in cols])
    flat = joined.select(
        F.concat(F.lit(f"{source}:"), F.col("l.id").cast("string")).alias("tournament_id"),
        F.lit(source).alias("source"),
        F.coalesce(first("l.name", "d.name"), F.lit("")).alias("name"),
        F.col("l.type").alias("_type"),
        F.col("l.division").alias("_division"),
        x.text_date(first("d.date", "l.endDate")).alias("date"),
        first("d.location", "l.location").alias("location"),
        F.coalesce(F.col("d.participantCount").try_cast("int"), F.col("l.participantCount").try_cast("int")).alias("participant_count"),
        F.lower(first("d.regulation", "l.regulation")).alias("format"),
        F.coalesce("l.isQual", "d.isQual").alias("is_qual"),
        F.coalesce("l.isTeam", "d.isTeam").alias("is_team"),
    )
    return division_of(tier_of(flat, "_type"), "_division").drop("_type", "_division")


ENTRY_SCHEMA = """rank string, points string, players array<struct<nickname: string, pinCode: string>>,
decks array<struct<deckId: long, variantId: string>>"""


def explode_entries(standings: DataFrame) -> DataFrame:
    """Standings rows (column ``r``) -> one row per (entry, deck); a NULL deck is skipped."""
    return (
        standings.withColumn("_deck", F.explode("r.decks"))
        .filter(F.col("_deck.deckId").isNotNull())
        .select(
            "tournament_id",
            F.col("_deck.deckId").alias("deck_id"),
            F.col("r.rank").try_cast("int").alias("rank"),
            F.col("r.points").try_cast("double").alias("points"),
            F.get("r.players", F.lit(0))["pinCode"].alias("player_ref"),
            F.col("_deck.variantId").alias("archetype_id"),
        )
    )


ITEM = "array<struct<count: string, set: string, number: string, name: string>>"
BASKET_SCHEMA = f"cards {ITEM}, pokemon {ITEM}, trainer {ITEM}, energy {ITEM}"


def explode_basket_items(docs: DataFrame) -> DataFrame:
    """Basket documents (column ``r``, one list or three sections) -> item rows, raw name kept."""
    empty = F.array().cast(ITEM)
    items = F.concat(*[F.coalesce(F.col(f"r.{s}"), empty) for s in ("cards", "pokemon", "trainer", "energy")])
    count = F.col("_item.count").try_cast("int")
    return (
        docs.withColumn("_item", F.explode(items))
        .filter((F.coalesce("_item.name", F.lit("")) != "") & count.isNotNull())
        .select(
            "deck_id", F.col("_item.set").alias("raw_set"), F.col("_item.number").alias("raw_number"),
            F.col("_item.name").alias("raw_name"), count.alias("count"),
        )
    )


PAIRING_SCHEMA = "round string, phase string, table string, winner string, player1 string, player2 string"


def normalise_pairings(raw: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(pairings, rejects); a blank winner is NULL and the later row wins a key."""
    typed = raw.select(
        "tournament_id", order,
        F.col("r.phase").try_cast("int").alias("phase"),
        F.col("r.round").try_cast("int").alias("round"),
        F.col("r.table").try_cast("int").alias("table_no"),
        F.nullif(F.col("r.player1"), F.lit("")).alias("player1"),
        F.nullif(F.col("r.player2"), F.lit("")).alias("player2"),
        F.nullif(F.col("r.winner"), F.lit("")).alias("winner"),
    )
    numbers = F.col("phase").isNotNull() & F.col("round").isNotNull() & F.col("table_no").isNotNull()
    players = F.col("player1").isNotNull() & F.col("player2").isNotNull()
    reason = F.when(~numbers, "number").when(~players, "player")
    marked = typed.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull()).drop("reason")
    keys = ["tournament_id", "phase", "round", "table_no"]
    return latest_per_key(good, keys, [F.col(order)]), marked.filter(F.col("reason").isNotNull())

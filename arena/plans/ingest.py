"""Result channels from parsed tables to the star: window, gate, mapping, content, entries, slots, misses.

The steps are the operators of this package; nothing loops over competitions or
baskets. ``assemble`` is what all channels share, each channel says which
competitions and entries it takes, what makes two baskets one, and how an item
finds its card. Whatever is not taken is a row with its reason.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.functions import vocab as v
from arena.functions.rank import latest_per_key, quantile_splits, split_rank
from arena.operators import baskets as k
from arena.operators import legality as lg
from arena.operators import normalise as n
from arena.operators import resolve as r
from arena.session import stored_rows
from arena.sources.tables import Star, lookup


@dataclass(frozen=True)
class Ingested:
    """The star of a channel and everything that was not taken, with its reason.

    ``rejects``: competitions (tournament_id, reason); ``slot_outcomes``: what the
    column sums said about each competition (the channel that has them).
    """

    star: Star
    window: DataFrame
    blocked: DataFrame
    misses: DataFrame
    rules: DataFrame
    env_warnings: DataFrame
    lost_entries: DataFrame
    repeated: DataFrame
    rejects: DataFrame | None = None
    slot_outcomes: DataFrame | None = None


Resolve = Callable[[DataFrame], DataFrame]


def assemble(
    source: str,
    comps: DataFrame,
    counts: DataFrame,
    entries: DataFrame,
    items: DataFrame,
    cards: DataFrame,
    resolve: Resolve,
    *,
    identity: Column | None,
    calendar: Sequence[lg.Segment],
    size: int,
    slots: DataFrame | None = None,
    card_groups: DataFrame | None = None,
    rejects: DataFrame | None = None,
    slot_outcomes: DataFrame | None = None,
) -> Ingested:
    """The star of the competitions that were taken.

    ``comps``: tournament_id, tier, date and env_marks; ``entries``: basket_id,
    tournament_id, rank, ``early`` (reason of an entry that was not taken before
    its basket was looked at) and ``late`` (reason of an entry whose basket is
    kept all the same). ``identity`` is what a line adds to the content of its
    basket; without it the source's own basket id is the content. ``resolve``
    adds card_id, rule, located_name and miss_kind to basket lines. Slots are those
    given, or, without any, the entries that were kept. Entries, lines and their
    cards are written once, all results read them from there.
    """
    played = entries.join(comps.select("tournament_id", "date"), "tournament_id")
    asked = played.filter(F.col("early").isNull()).select(F.col("basket_id").alias("deck_id")).distinct()
    lines = stored_rows(items.withColumnRenamed("basket_id", "deck_id").join(asked, "deck_id", "left_semi"), f"{source}-lines")
    kept, blocked = k.size_gate(lines, size)
    if identity is None:
        content = kept.select("deck_id").distinct().withColumn("content_id", F.concat(F.lit(f"{source}:"), F.col("deck_id").cast("string")))
    else:
        content = k.content_entities(kept.select("deck_id", identity.alias("item"), "count"), source)
    with_lines = lines.select(F.col("deck_id").alias("basket_id"), F.lit(True).alias("_lines")).distinct()
    found = played.join(content.withColumnRenamed("deck_id", "basket_id"), "basket_id", "left").join(with_lines, "basket_id", "left")
    basket = F.when(F.col("content_id").isNotNull(), None).when(F.col("_lines").isNull(), "no_basket").otherwise("basket_blocked")
    judged = stored_rows(found.withColumn("reason", F.coalesce("early", basket, "late")).drop("_lines", "late"), f"{source}-entries")
    lost = judged.filter(F.col("reason").isNotNull()).select("basket_id", "tournament_id", "rank", "reason")
    with_deck = judged.filter(F.col("early").isNull() & F.col("content_id").isNotNull()).drop("early").withColumnRenamed("content_id", "deck_id")
    entry_rows = with_deck.filter(F.col("reason").isNull()).drop("reason")

    # one basket stands for all of equal content; its first competition decides the environment
    first = with_deck.groupBy("deck_id").agg(F.min("basket_id").alias("_basket"), F.min("date").alias("_first_day"))
    deck_items = kept.withColumnRenamed("deck_id", "_basket").join(first, "_basket").withColumn(
        "env_marks", lg.env_marks(F.lit(v.SOURCE_REGION.get(source)), F.col("_first_day"), calendar)
    )
    info = cards.select(F.col("card_id").alias("_card"), n.stat_scope(F.col("card_type"), F.col("trainer_subtype")).alias("_scope"))
    mapped = resolve(deck_items).join(info, F.col("card_id") == F.col("_card"), "left").withColumn("stat_scope", F.coalesce("_scope", F.lit("other")))
    scoped = stored_rows(
        mapped.select("deck_id", "card_id", "raw_name", "raw_set", "raw_number", "count", "stat_scope", "located_name", "rule", "miss_kind"),
        f"{source}-cards",
    )
    deck_cards = k.merge_same_item(scoped.select("deck_id", "card_id", "raw_name", "count", "stat_scope"))
    misses = scoped.filter(F.col("card_id").isNull()).select(
        "deck_id", "raw_name", F.coalesce("raw_set", F.lit("")).alias("raw_set"), F.coalesce("raw_number", F.lit("")).alias("raw_number"),
        F.col("located_name").alias("resolved_name"), "miss_kind",
    ).distinct()

    # shares are taken over the whole basket, before lines of one name are merged
    decks = k.mapping_status(scoped).withColumn("source", F.lit(source))
    appearances = latest_per_key(
        entry_rows.drop("date").withColumn("source", F.lit(source)), ["deck_id", "tournament_id", "rank"], [F.col("basket_id")]
    ).drop("basket_id")
    appearances = stored_rows(appearances, f"{source}-appearances")
    known = slots if slots is not None else appearances.groupBy("tournament_id").agg(F.count(F.lit(1)).alias("slots"))
    filled = F.col("slots") if slots is not None else F.coalesce("slots", F.lit(0))
    if "topcut_slots" in comps.columns:
        filled = F.coalesce("topcut_slots", filled)
    competitions = comps.join(known.select("tournament_id", "slots"), "tournament_id", "left").withColumn("topcut_slots", filled.cast("long")).drop("slots")
    warned = k.env_mark_warnings(
        deck_cards.filter(F.col("card_id").isNotNull()), cards,
        appearances.select("deck_id", "tournament_id").distinct().join(comps.select("tournament_id", "env_marks"), "tournament_id"),
    )
    return Ingested(
        Star(competitions, decks, appearances, deck_cards, card_groups), counts, blocked.withColumnRenamed("deck_id", "basket_id"), misses,
        k.rule_distribution(scoped), warned, lost,
        entry_rows.groupBy("deck_id", "tournament_id", "rank").agg(F.count(F.lit(1)).alias("seen")).filter(F.col("seen") > 1),
        rejects, slot_outcomes,
    )


def with_environment(comps: DataFrame, source: str, calendar: Sequence[lg.Segment]) -> DataFrame:
    """Competitions with their source and the marks of its region's calendar on their day."""
    marks = lg.env_marks(F.lit(v.SOURCE_REGION.get(source)), F.col("date"), calendar)
    return comps.withColumn("source", F.lit(source)).withColumn("env_marks", marks)


def with_tier(comps: DataFrame) -> DataFrame:
    """Canonical tier and coefficient of the raw ``tier``."""
    raw = comps.withColumnRenamed("tier", "_raw_tier").drop("tier_coef")
    return n.tier_of(raw, "_raw_tier").drop("_raw_tier", "tier_known")


def in_window(comps: DataFrame, window: tuple | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(competitions inside the window or undated, counts, those outside as rejects)."""
    if window is None:
        return comps, comps.agg(F.count(F.lit(1)).alias("kept")), comps.select("tournament_id", F.lit("out_of_window").alias("reason")).limit(0)
    inside, counts = lg.window_guard(comps, "date", window)
    outside = comps.filter(~F.coalesce(F.col("date").between(F.lit(window[0]), F.lit(window[1])), F.lit(True)))
    return inside, counts, outside.select("tournament_id", F.lit("out_of_window").alias("reason"))


def printed() -> Column:
    """Set, number and name as written; absent parts are written out, so they cannot be taken for each other."""
    return F.to_json(F.struct("raw_set", "raw_number", "raw_name"), {"ignoreNullFields": "false"})


def no_reason() -> Column:
    return F.lit(None).cast("string")


def ranked_late(entries: DataFrame) -> DataFrame:
    """Entries of which the baskets are kept even without a rank."""
    return entries.withColumn("early", no_reason()).withColumn("late", F.when(F.col("rank").isNull(), "no_rank"))


def english_names(cards: DataFrame, prints: DataFrame | None, name_column: str) -> Resolve:
    """Items through the print of the other catalogue when there is one, else by the printed name."""

    def resolve(lines: DataFrame) -> DataFrame:
        if prints is not None:
            located = r.locate_prints(lines, r.print_index(prints, "seq"))
        else:
            located = lines.withColumn("located_name", F.lit(None).cast("string"))
        probes = located.withColumn("name", F.coalesce("located_name", "raw_name"))
        stage = F.when(F.col("located_name").isNotNull(), "ptcd").otherwise("name_fallback")
        mapped = r.map_by_name(probes, r.name_index(cards, name_column), stage)
        return mapped.withColumn("miss_kind", k.classify_miss(F.col("located_name")))

    return resolve


def japanese_names(cards: DataFrame) -> Resolve:
    """Items by their Japanese name; several cards of one name must be of one name group.

    An item without a name keeps its official id as raw name.
    """

    def resolve(lines: DataFrame) -> DataFrame:
        probes = lines.withColumn("name", F.nullif("raw_name", F.lit("")))
        mapped = r.map_within_group(probes, r.name_index(cards, "name_ja", "group_key" if "group_key" in cards.columns else None))
        own = F.concat(F.lit("card_id:"), F.col("official_id").cast("string")) if "official_id" in lines.columns else F.lit("")
        return (
            mapped.withColumn("raw_name", F.coalesce("name", own)).withColumn("located_name", F.lit(None).cast("string"))
            .withColumn("miss_kind", lookup(F.col("rule"), k.MISS_KINDS))
        )

    return resolve


def own_ids(cards: DataFrame) -> Resolve:
    """Items that carry an id of our catalogue (``raw_card_id``); nothing is guessed for the others."""

    def resolve(lines: DataFrame) -> DataFrame:
        known = cards.select(F.col("card_id")).distinct()
        joined = lines.join(known, F.col("raw_card_id") == F.col("card_id"), "left")
        rule = F.when(F.col("card_id").isNull(), "unknown_card_id").otherwise("card_id")
        return (
            joined.withColumn("rule", rule).withColumn("located_name", F.lit(None).cast("string"))
            .withColumn("miss_kind", F.when(F.col("card_id").isNull(), k.MISS_KINDS["unknown_card_id"]))
        )

    return resolve


def ingest_channel(
    source: str,
    competitions: DataFrame,
    entries: DataFrame,
    items: DataFrame,
    cards: DataFrame,
    *,
    prints: DataFrame | None = None,
    pairings: DataFrame | None = None,
    card_groups: DataFrame | None = None,
    calendar: Sequence[lg.Segment] = v.CALENDAR,
    window: tuple | None = None,
    name_column: str = "name_en",
    size: int = k.DECK_SIZE,
) -> Ingested:
    """The channel of an interface with typed standings.

    competitions: tournament_id, tier, date and the metric columns; entries:
    basket_id, tournament_id, rank, points, record_*; items: basket_id, raw_set,
    raw_number, raw_name, count; cards: card_id, the name column, mark,
    release_date, card_type, trainer_subtype. ``prints`` locates canonical names
    by (set, number): set_code, number, located_name, seq. ``pairings`` fill slots
    that are not known with the players of the knock-out phase.
    """
    comps, counts, outside = in_window(with_environment(with_tier(competitions), source, calendar), window)
    if pairings is not None:
        slots = k.topcut_from_pairings(pairings)
    else:
        slots = comps.select("tournament_id", F.lit(None).cast("long").alias("slots"))
    return assemble(
        source, comps, counts, ranked_late(entries), items, cards,
        japanese_names(cards) if name_column == "name_ja" else english_names(cards, prints, name_column),
        identity=printed(), calendar=calendar, size=size, slots=slots, card_groups=card_groups, rejects=outside,
    )


def ingest_cn(
    competitions: DataFrame,
    entries: DataFrame,
    items: DataFrame,
    cards: DataFrame,
    static: DataFrame,
    *,
    calendar: Sequence[lg.Segment] = v.CALENDAR,
    size: int = k.DECK_SIZE,
    source: str = "mik_moe",
) -> Ingested:
    """The channel whose items carry ids of our own catalogue.

    competitions: as ``normalise_competitions`` gives them, with topcut_slots; items:
    basket_id, raw_card_id, raw_name, count. A basket id of the source is its
    content: one basket may stand at several ranks and in several competitions.
    ``static`` (tournament_id, topcut_times) fills slots that are not known.
    """
    # competitions and their slots are asked for by many results; whatever makes them is done once
    comps = stored_rows(with_environment(with_tier(competitions), source, calendar), f"{source}-competitions")
    outcomes = stored_rows(k.topcut_from_columns(static, comps), f"{source}-slots")
    absent = F.lit(None).cast("string")
    return assemble(
        source, comps, comps.agg(F.count(F.lit(1)).alias("kept")), ranked_late(entries),
        items.withColumn("raw_set", absent).withColumn("raw_number", absent), cards, own_ids(cards),
        identity=None, calendar=calendar, size=size, slots=outcomes.select("tournament_id", "slots"), slot_outcomes=outcomes,
    )


def ingest_site(
    index: DataFrame,
    standings: DataFrame,
    items: DataFrame,
    cards: DataFrame,
    prints: DataFrame | None,
    *,
    calendar: Sequence[lg.Segment] = v.CALENDAR,
    window: tuple | None = None,
    size: int = k.DECK_SIZE,
    source: str = "limitless_site",
) -> Ingested:
    """The channel of result pages, where a competition is known by its standings.

    index: tournament_id, name, players, date, seq (the last entry of a competition
    wins); standings: tournament_id, placing, basket_id. A competition without an
    index entry is taken with what there is. Its tier comes from name and size;
    entries below the rank cut of the tier are not taken, and an unknown tier
    has no cut. Slots are the entries that were kept.
    """
    listed = latest_per_key(index.select("tournament_id", "name", "players", "date", "seq"), ["tournament_id"], [F.col("seq")])
    verdict = n.classify_first_match(
        F.coalesce("name", F.lit("")), F.col("players"), [(t, p) for t, p, _ in v.SITE_TIER_RULES], v.SITE_REJECT_RULES, v.SITE_MIN_PLAYERS
    )
    known = standings.select("tournament_id").distinct().join(listed.withColumn("_listed", F.lit(True)), "tournament_id", "left")
    judged = known.withColumn("_v", verdict).select(
        "tournament_id", F.coalesce("name", F.lit("")).alias("name"), F.col("players").alias("participant_count"), "date", F.col("_v.tier").alias("tier"),
        F.when(F.col("_listed").isNull(), "not_listed").otherwise(F.col("_v.reason")).alias("tier_reason"),
    )
    judged = stored_rows(judged, f"{source}-competitions")
    comps, counts, outside = in_window(with_environment(with_tier(judged), source, calendar), window)
    cut = lookup(F.col("tier"), {tier: limit for tier, _, limit in v.SITE_TIER_RULES})
    early = (
        F.when(F.col("rank").isNull(), "no_rank").when(F.col("rank") > cut, "beyond_cut")
        .when(F.coalesce(F.col("basket_id").cast("string"), F.lit("")) == "", "no_basket_id")
    )
    entries = standings.withColumnRenamed("placing", "rank").join(comps.select("tournament_id", "tier"), "tournament_id")
    return assemble(
        source, comps, counts, entries.withColumn("early", early).withColumn("late", no_reason()).drop("tier"), items, cards,
        english_names(cards, prints, "name_en"), identity=printed(), calendar=calendar, size=size, rejects=outside,
    )


def event_key(title: Column, twin: Column) -> Column:
    """Ten hexadecimal digits of the title's hash; the second event of a title in an article is '#2', and so on."""
    digits = F.substring(F.sha1(F.coalesce(title, F.lit(""))), 1, 10)
    return F.when(twin > 1, F.concat(digits, F.lit("#"), twin.cast("string"))).otherwise(digits)


PRIORITY_CATEGORY = "champions"


def ingest_jp(
    events: DataFrame,
    refs: DataFrame,
    items: DataFrame,
    cards: DataFrame,
    plan: DataFrame | None = None,
    *,
    calendar: Sequence[lg.Segment] = v.CALENDAR,
    window: tuple | None = None,
    size: int = k.DECK_SIZE,
    source: str = "pokemon_card_jp",
) -> Ingested:
    """The channel of articles, each with several events, and baskets by official item ids.

    events: article_id, seq, category, article_title, event_title, date; refs:
    article_id, seq, basket_id, placement; items: basket_id, official_id, raw_set,
    raw_number, raw_name, count; cards also name_ja and group_key. ``plan`` is what
    ``budget_guard`` decided for the fetch: when it is degraded, only events of
    the priority category are taken. The title of the event, then that of the
    article, may raise the tier of the category. Equal titles in an article are
    told apart by their order. Slots are the entries that were kept.
    """
    named = events.withColumn("_title", F.coalesce("event_title", F.lit("")))
    numbered = split_rank(named, ["article_id", "_title"], "seq", splits=quantile_splits(events, "seq"), name="_twin")
    verdict = n.title_override_tier([F.col("event_title"), F.col("article_title")], F.col("category"), v.ARTICLE_CATEGORIES, v.TITLE_TIER_OVERRIDES)
    tid = F.concat_ws(":", F.lit(source), F.col("article_id").cast("string"), event_key(F.col("_title"), F.col("_twin")))
    heading = F.coalesce("article_title", F.lit(""))
    degraded = F.lit(False)
    if plan is not None:
        degraded = F.coalesce(plan.agg(F.max(F.col("decision") == "degraded")).scalar(), F.lit(False))
    judged = numbered.withColumn("_v", verdict).select(
        tid.alias("tournament_id"), "article_id", "seq", "date", F.col("_v.tier").alias("tier"),
        F.when(heading == "", F.col("_title")).otherwise(F.concat_ws(" / ", heading, F.col("_title"))).alias("name"),
        F.lit(None).cast("int").alias("participant_count"),
        F.when(F.col("_v.reason") != "accepted", F.col("_v.reason")).when(degraded & (F.col("category") != PRIORITY_CATEGORY), "degraded").alias("_reason"),
    )
    judged = stored_rows(judged, f"{source}-events")
    taken = judged.filter(F.col("_reason").isNull()).drop("_reason")
    comps, counts, outside = in_window(with_environment(with_tier(taken), source, calendar), window)
    refused = judged.filter(F.col("_reason").isNotNull()).select("tournament_id", F.col("_reason").alias("reason"))
    rank = lookup(F.col("placement"), v.PLACEMENT_RANKS).cast("int")
    entries = refs.join(comps.select("article_id", "seq", "tournament_id"), ["article_id", "seq"]).select(
        "basket_id", "tournament_id", rank.alias("rank"), no_reason().alias("early"), F.when(rank.isNull(), "unknown_placement").alias("late")
    )
    return assemble(
        source, comps, counts, entries, items, cards, japanese_names(cards),
        identity=F.col("official_id").cast("string"), calendar=calendar, size=size, rejects=refused.unionByName(outside),
    )


def ingest_report(result: Ingested) -> DataFrame:
    """(section, key, n): slots by competition, and counts of what a channel took, lost and refused by reason."""
    row = lambda df, section, key, n: df.select(F.lit(section).alias("section"), F.coalesce(key.cast("string"), F.lit("none")).alias("key"), n.cast("long").alias("n"))  # noqa: E731,E501
    by = lambda df, section, key: row(df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n")), section, F.col("_key"), F.col("_n"))  # noqa: E731,E501
    comps = result.star.tournaments
    parts = [
        row(comps, "slots", F.col("tournament_id"), F.col("topcut_slots")), by(comps, "tier", F.col("tier")),
        by(result.star.decks, "deck", F.col("mapping_status")), by(result.star.appearances, "entry", F.lit("kept")),
        by(result.lost_entries, "lost", F.col("reason")), by(result.blocked, "blocked", F.col("reason")),
        by(result.misses, "miss", F.col("miss_kind")), row(result.rules, "rule", F.col("rule"), F.col("n")),
        by(result.env_warnings, "env", F.lit("outside")), by(result.repeated, "repeated", F.lit("entry")),
    ]
    if result.rejects is not None:
        parts.append(by(result.rejects, "rejected", F.col("reason")))
    if result.slot_outcomes is not None:
        parts.append(by(result.slot_outcomes, "slots_from_columns", F.coalesce("reason", "outcome")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

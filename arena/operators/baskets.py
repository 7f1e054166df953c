"""Basket gates, item resolution, mapping status, misses, content entities and deck rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.functions import text as x
from arena.functions.parallel import tasks_for
from arena.functions.rank import earliest_per_key
from arena.functions.vocab import TOPCUT_SIZES

DECK_SIZE = 60


def size_gate(items: DataFrame, size: int = DECK_SIZE) -> tuple[DataFrame, DataFrame]:
    """(items of baskets with exactly ``size`` copies, blocked baskets with total and reason)."""
    totals = items.groupBy("deck_id").agg(F.sum("count").alias("total"))
    kept = items.join(totals.filter(F.col("total") == size).select("deck_id"), "deck_id", "left_semi")
    return kept, totals.filter(F.col("total") != size).withColumn("reason", F.lit("size"))


def resolve_items(items: DataFrame, cards: DataFrame) -> DataFrame:
    """Items with a known card keep it; unknown ones keep the raw name once per basket.

    ``cards``: card_id and stat_scope. Resolved lines of one card merge their
    copies; the first raw name in text order is kept.
    """
    known = cards.select(F.col("card_id").alias("_card"), "stat_scope")
    joined = items.join(known, F.col("card_id") == F.col("_card"), "left").drop("card_id")
    rows = joined.select(
        "deck_id", F.col("_card").alias("card_id"), "raw_name", "count",
        F.coalesce("stat_scope", F.lit("other")).alias("stat_scope"),
    )
    return merge_same_item(rows)


def merge_same_item(rows: DataFrame) -> DataFrame:
    """One row per (basket, card) with summed copies; NULL cards once per (basket, raw name)."""
    missing = F.col("card_id").isNull()
    key = F.when(missing, F.col("raw_name"))
    return rows.groupBy("deck_id", "card_id", "stat_scope", key.alias("_null_name")).agg(
        F.when(F.max(missing), F.max("count")).otherwise(F.sum("count")).alias("count"),
        F.min("raw_name").alias("raw_name"),
    ).select("deck_id", "card_id", "raw_name", "count", "stat_scope")


# Outcome of a resolution rule when no card was found.
MISS_KINDS = {
    "unknown_card_id": "unknown_card_id",
    "ja_name+ambiguous": "ambiguous_ja_name",
    "ja_name+unmapped": "no_ja_name_match",
}


def classify_miss(located_name: Column) -> Column:
    """An unresolved item either has no print in the other catalogue or no print in ours."""
    return F.when(located_name.isNull(), "ptcd_miss").otherwise("no_cn_printing")


MISS_KEY = ["deck_id", "raw_name", "raw_set", "raw_number"]


def record_misses(stored: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Upsert: new rows get first_seen, open rows refresh their class, resolved rows stay.

    ``action`` tells what happened (new / refreshed / kept).
    """
    key = [F.coalesce(F.col(k), F.lit("")).alias(k) if k in ("raw_set", "raw_number") else F.col(k) for k in MISS_KEY]
    fresh = found.select(*key, F.col("resolved_name").alias("_name"), F.col("miss_kind").alias("_kind"), F.lit(True).alias("_hit"))
    fresh = fresh.dropDuplicates(MISS_KEY)
    joined = stored.withColumn("_old", F.lit(True)).join(fresh, MISS_KEY, "full_outer")
    is_new, refresh = F.col("_old").isNull(), F.col("_hit") & F.col("resolved_at").isNull()
    return joined.select(
        *MISS_KEY,
        F.when(refresh, F.col("_name")).otherwise(F.col("resolved_name")).alias("resolved_name"),
        F.when(refresh, F.col("_kind")).otherwise(F.col("miss_kind")).alias("miss_kind"),
        "resolved_card_id",
        F.when(is_new, now).otherwise(F.col("first_seen_at")).alias("first_seen_at"),
        "resolved_at",
        F.when(is_new, "new").when(refresh, "refreshed").otherwise("kept").alias("action"),
    )


def backfill_misses(items: DataFrame, raw_items: DataFrame, order: str) -> DataFrame:
    """Raw set and number of every unresolved (basket, name); ``located`` is false when not found.

    The first raw line in ``order`` wins.
    """
    pending = items.filter(F.col("card_id").isNull()).select("deck_id", "raw_name").distinct()
    raw = earliest_per_key(
        raw_items.select("deck_id", "raw_name", "raw_set", "raw_number", order), ["deck_id", "raw_name"], [F.col(order)]
    )
    joined = pending.join(raw.withColumn("_found", F.lit(True)), ["deck_id", "raw_name"], "left")
    return joined.select("deck_id", "raw_name", "raw_set", "raw_number", F.col("_found").isNotNull().alias("located"))


def remap_misses(items: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Applies newly found cards to open items: (items after, basket status before and after).

    ``items``: one row per (basket, card), and per (basket, raw name) without a
    card. ``resolved``: deck_id, raw_name, card_id, stat_scope, one row a miss. An
    item that now has the card of another line is merged into it; baskets without
    a hit are passed on as they are. Nothing already mapped changes, so a basket
    can only go up. Both states are conditional sums of one pass.
    """
    marked = with_hits(items, resolved)
    status = remap_status(marked)
    touched = resolved.select("deck_id").distinct()
    plain = ["deck_id", "card_id", "raw_name", "count", "stat_scope"]
    renewed = marked.join(touched, "deck_id", "left_semi").select(
        "deck_id", F.coalesce("card_id", "_card").alias("card_id"), "raw_name", "count", F.coalesce("_scope", "stat_scope").alias("stat_scope")
    )
    after = items.join(touched, "deck_id", "left_anti").select(*plain).unionByName(merge_same_item(renewed))
    return after, status


def with_hits(items: DataFrame, resolved: DataFrame) -> DataFrame:
    """Items with ``_card`` and ``_scope`` where an open one is resolved."""
    hit = resolved.select(
        F.col("deck_id").alias("_deck"), F.col("raw_name").alias("_name"), F.col("card_id").alias("_card"), F.col("stat_scope").alias("_scope")
    )
    same = F.col("card_id").isNull() & (F.col("deck_id") == F.col("_deck")) & (F.col("raw_name") == F.col("_name"))
    return items.join(hit, same, "left").drop("_deck", "_name")


def remap_status(marked: DataFrame) -> DataFrame:
    """Per basket: total, mapped copies and status before and after the hits in ``_card``; one pass."""
    open_item, hit = F.col("card_id").isNull(), F.col("_card").isNotNull()
    sums = marked.groupBy("deck_id").agg(
        F.sum("count").alias("total"),
        F.sum(F.when(open_item, 0).otherwise(F.col("count"))).alias("_before"),
        F.sum(F.when(open_item & ~hit, 0).otherwise(F.col("count"))).alias("mapped"),
        F.count_if(open_item).alias("open_before"), F.count_if(open_item & hit).alias("resolved"),
    )
    status = lambda mapped: status_of(F.coalesce(F.try_divide(mapped, F.col("total")), F.lit(0.0)))
    return sums.select(
        "deck_id", "total", "mapped", status(F.col("_before")).alias("status_before"), status(F.col("mapped")).alias("mapping_status"),
        "open_before", "resolved",
    )


def status_of(ratio: Column) -> Column:
    return F.when(ratio >= 0.95, "full").when(ratio > 0, "partial").otherwise("unmapped")


def mapping_status(items: DataFrame) -> DataFrame:
    """Mapped copies over all copies: full from 0.95, partial above 0, else unmapped."""
    return with_status(items.groupBy("deck_id").agg(
        F.sum("count").alias("total"), F.sum(F.when(F.col("card_id").isNotNull(), F.col("count")).otherwise(0)).alias("mapped"),
    ))


def with_status(sums: DataFrame) -> DataFrame:
    """Adds ratio and state to (deck_id, total, mapped)."""
    ratio = F.coalesce(F.try_divide("mapped", "total"), F.lit(0.0))
    return sums.select("deck_id", "total", "mapped", ratio.alias("mapped_ratio"), status_of(ratio).alias("mapping_status"))


def content_entities(items: DataFrame, prefix: str, tasks: int | None = None) -> DataFrame:
    """basket -> content id: equal (item, copies) sets share one id.

    The id is a sum of per-line hashes (order does not matter), so the basket
    is combined map-side and never collected; four independent 64-bit sums
    (256 bits a line) and the line count make up the key, whose whole digest is kept. ``tasks``: whole baskets go to so
    many tasks, in one shuffle.
    """
    if tasks is not None:
        items = items.repartition(tasks, "deck_id")
    lines = items.groupBy("deck_id", "item").agg(F.sum("count").alias("count"))
    h = lambda salt: F.xxhash64(F.lit(salt), "item", "count").cast("decimal(38,0)")
    parts = [F.sum(h(salt)).cast("string").alias(f"_h{salt}") for salt in range(1, 5)]
    sums = lines.groupBy("deck_id").agg(*parts, F.count(F.lit(1)).cast("string").alias("_n"))
    digest = F.sha2(F.concat_ws(":", *[c for c in sums.columns if c != "deck_id"]), 256)
    return sums.select("deck_id", F.concat(F.lit(f"{prefix}:"), digest).alias("content_id"))


def topcut_from_columns(static: DataFrame, comps: DataFrame, sizes: Sequence[int] = TOPCUT_SIZES) -> DataFrame:
    """Slots from column sums of the cumulative arrays; outcome materialized / skipped / question.

    ``static``: tournament_id and topcut_times (five non-negative counts).
    """
    tiers = 5
    times = F.col("topcut_times")
    malformed = times.isNull() | (F.size(times) != tiers) | F.exists(times, lambda n: n.isNull() | (n < 0))
    safe = [F.coalesce(F.get(times, F.lit(i)), F.lit(0)) for i in range(tiers)]
    sums = static.groupBy("tournament_id").agg(
        F.max(malformed).alias("_malformed"), *[F.sum(col).alias(f"_c{i}") for i, col in enumerate(safe)]
    ).select("tournament_id", "_malformed", F.array(*[f"_c{i}" for i in range(tiers)]).alias("totals"))
    joined = comps.join(sums, "tournament_id", "left")
    outer = F.element_at("totals", tiers)
    falls = F.exists(F.arrays_zip(F.slice("totals", 1, tiers - 1).alias("a"), F.slice("totals", 2, tiers - 1).alias("b")),
                     lambda p: p["a"] > p["b"])
    skipped = (
        F.when(F.col("topcut_slots").isNotNull(), "has_value").when(F.col("is_team"), "team")
        .when(F.coalesce(F.col("participant_count"), F.lit(0)) == 0, "no_size").when(F.col("totals").isNull(), "no_data")
    )
    question = (
        F.when(F.col("_malformed"), "malformed").when(outer == 0, None).when(falls, "not_monotone")
        .when(outer > F.col("participant_count"), "larger_than_field").when(~outer.isin(*sizes), "size_not_allowed")
    )
    empty = F.when(~F.col("_malformed") & (outer == 0), "empty")
    reason = F.coalesce(skipped, empty, question)
    outcome = F.when(F.coalesce(skipped, empty).isNotNull(), "skipped").when(question.isNotNull(), "question").otherwise("materialized")
    return joined.select(
        "tournament_id", outcome.alias("outcome"), reason.alias("reason"),
        F.when(outcome == "materialized", outer).alias("slots"),
    )


def topcut_from_pairings(pairings: DataFrame) -> DataFrame:
    """Distinct players of the knock-out phase; competitions without one are absent."""
    ko = pairings.filter(F.col("phase") == 2)
    players = ko.select("tournament_id", F.explode(F.array("player1", "player2")).alias("player"))
    return players.groupBy("tournament_id").agg(F.count_distinct("player").alias("slots"))


def rank_cut(entries: DataFrame, tier: str, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries within the cut of their tier, dropped count per tier); a tier without a cut keeps all."""
    marked = entries.join(cuts, tier, "left").withColumn(
        "_kept", F.col("cut_limit").isNull() | (F.col("rank") <= F.col("cut_limit"))
    )
    dropped = marked.groupBy(tier).agg(F.count_if(F.col("_kept")).alias("kept"), F.count_if(~F.col("_kept")).alias("dropped"))
    return marked.filter(F.col("_kept")).drop("_kept", "cut_limit"), dropped


def collisions(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last row per key and ``seen``, how often the key came; one pass. Rows seen more than once are the warnings."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(last, F.count(F.lit(1)).alias("seen")).select(*keys, "_row.*", "seen")


def env_mark_warnings(items: DataFrame, cards: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries whose highest card mark is outside the marks of the competition's environment.

    ``entries``: deck_id, tournament_id, env_marks. Baskets without a marked card pass.
    """
    marks = items.join(cards.select("card_id", "mark"), "card_id").groupBy("deck_id").agg(F.max("mark").alias("max_mark"))
    joined = entries.join(marks.filter(F.col("max_mark").isNotNull()), "deck_id")
    return joined.filter(F.col("env_marks").isNotNull() & ~F.array_contains("env_marks", F.col("max_mark")))


# Copies of a name group when it holds union parts; global limits.
UNION_GROUP_LIMIT = 4
GLOBAL_LIMIT = 1


def group_limits(cards: DataFrame, card_groups: DataFrame) -> DataFrame:
    """Copies allowed per name group, decided by all catalogue members of the group."""
    members = card_groups.join(cards.select("card_id", "deck_limit", "is_basic_energy", "rule_box_type"), "card_id")
    return members.groupBy("group_key").agg(
        F.when(F.max(F.coalesce(F.col("rule_box_type"), F.lit("")) == "v_union"), UNION_GROUP_LIMIT)
        .otherwise(F.max("deck_limit")).alias("group_limit"),
        F.min("is_basic_energy").alias("all_basic"),
    )


LIMITED = {"ace_spec_limit": "ace", "radiant_limit": "radiant", "prism_star_limit": "prism"}


def rule_table(cards: DataFrame, card_groups: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """One row per card with all that the deck rules ask: limit, flags, name groups with their limits, and why it is refused.

    ``cards``: card_id, deck_limit, is_basic_energy, rule_box_type, is_ace_spec,
    is_prism; ``decisions``: card_id, legal, banned of a format on a day. Of the
    size of the catalogue; groups of basic energy alone have no limit.
    """
    limits = group_limits(cards, card_groups).filter(~F.col("all_basic"))
    of_card = card_groups.join(limits, "group_key").groupBy("card_id").agg(F.collect_list(F.struct("group_key", F.col("group_limit").cast("int").alias("group_limit"))).alias("groups"))
    table = cards.join(of_card, "card_id", "left")
    refused = F.lit(None).cast("string")
    if decisions is not None:
        why = decisions.filter(~F.col("legal")).select("card_id", F.when(F.col("banned"), "banned").otherwise("not_legal").alias("refused"))
        table, refused = table.join(why, "card_id", "left"), F.col("refused")
    flag = lambda col: F.coalesce(col, F.lit(False))
    return table.select(
        "card_id", F.col("deck_limit").cast("int").alias("deck_limit"), flag(F.col("is_ace_spec")).alias("ace"),
        flag(F.col("rule_box_type") == "radiant").alias("radiant"), flag(F.col("is_prism")).alias("prism"),
        F.coalesce("groups", F.array().cast("array<struct<group_key:string,group_limit:int>>")).alias("groups"), refused.alias("refused"),
    )


RULES = ["deck_limit", "ace", "radiant", "prism", "groups", "refused"]


def _ruled_lines(baskets: DataFrame, rules: DataFrame, tasks: int) -> DataFrame:
    """One row per (basket, card) with the rules of the card; ``known`` is false outside of the catalogue.

    Whole baskets go to a task, so what is summed by basket afterwards needs no further shuffle.
    """
    marked = rules.withColumnRenamed("card_id", "_id")
    joined = baskets.join(marked, F.col("card_id") == F.col("_id"), "left").withColumn("known", F.col("_id").isNotNull()).drop("_id")
    lines = joined.repartition(tasks, "deck_id").groupBy("deck_id", "card_id", "known", *RULES).agg(F.sum("count").alias("n"))
    return lines.withColumn("card", F.col("card_id").cast("string")).drop("card_id")


def _part(kind: str | Column, subject: Column, limit: Column | None = None) -> Column:
    """What a line counts for: the whole basket, a name group, or itself."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    none = F.lit(None).cast("int")
    return F.struct(kind.alias("kind"), subject.alias("subject"), (none if limit is None else limit).alias("limit"))


def _groups() -> Column:
    return F.coalesce(F.col("groups"), F.array().cast("array<struct<group_key:string,group_limit:int>>"))


def _over() -> Column:
    """The line alone breaks the limit of its card, which is below the one of its group."""
    return F.exists(_groups(), lambda g: (F.col("n") > F.col("deck_limit")) & (F.col("deck_limit") < g["group_limit"]))


def _parts() -> Column:
    empty = F.array().cast("array<struct<kind:string,subject:string,limit:int>>")
    return F.concat(
        F.array(_part("", F.lit(""))), F.transform(_groups(), lambda g: _part("group", g["group_key"], g["group_limit"])),
        F.when(_over(), F.array(_part("single", F.col("card")))).otherwise(empty),
        F.when(F.col("refused").isNotNull(), F.array(_part(F.col("refused"), F.col("card")))).otherwise(empty),
    )


def judged_baskets(baskets: DataFrame, rules: DataFrame, size: int = DECK_SIZE, tasks: int | None = None) -> DataFrame:
    """deck_id, kind, total and found, the violations, of every basket (kind '') and what is limited in it.

    One pass over the baskets and one aggregate of numbers. ``rules``: the output
    of ``rule_table``. Cards outside the catalogue count for the size only.
    ``tasks``: by the number of lines, unless given.
    """
    rows = _ruled_lines(baskets, rules, tasks or tasks_for(baskets)).withColumn("part", F.explode(_parts()))
    n, known = F.col("n"), F.col("known")
    summed = rows.groupBy("deck_id", "part.kind", "part.subject", "part.limit").agg(
        F.sum("n").alias("total"), F.count_if(~known).alias("unknown_card"),
        *[F.sum(F.when(known & F.col(flag), n).otherwise(0)).alias(kind) for kind, flag in LIMITED.items()],
    )
    row = lambda kind, subject, count: F.struct(F.lit(kind).alias("kind"), subject.alias("subject"), count.alias("count"))
    blank, total = F.lit(""), F.col("total")
    whole = F.array_compact(F.array(
        F.when(total != size, row("deck_size", blank, total)),
        F.when(F.col("unknown_card") > 0, row("unknown_card", blank, F.col("unknown_card"))),
        *[F.when(F.col(kind) > GLOBAL_LIMIT, row(kind, blank, F.col(kind))) for kind in LIMITED],
    ))
    kind, subject = F.col("kind"), F.col("subject")
    one = F.array_compact(F.array(
        F.when((kind == "group") & (total > F.col("limit")), row("name_limit", subject, total)),
        F.when(kind == "single", row("name_limit", subject, total)),
        F.when(kind.isin("banned", "not_legal"), F.struct(kind.alias("kind"), subject.alias("subject"), total.alias("count"))),
    ))
    return summed.select("deck_id", "kind", "total", F.when(kind == "", whole).otherwise(one).alias("found"))


def counted_violations(judged: DataFrame) -> DataFrame:
    """deck_id, kind, subject, count of every violation of judged baskets."""
    return judged.select("deck_id", F.explode("found").alias("v")).select("deck_id", "v.*")


def basket_report(judged: DataFrame) -> DataFrame:
    """deck_id, deck_size, violations, ok of every judged basket."""
    sums = judged.groupBy("deck_id").agg(
        F.max(F.when(F.col("kind") == "", F.col("total"))).alias("deck_size"), F.sum(F.size("found").cast("long")).alias("violations")
    )
    return sums.withColumn("ok", F.col("violations") == 0)


def with_cards(violations: DataFrame, baskets: DataFrame, rules: DataFrame, tasks: int | None = None) -> DataFrame:
    """Violations with the involved cards in order. Cards are listed for violating baskets alone."""
    none, tasks = F.array().cast("array<string>"), tasks or tasks_for(baskets)
    # violations grow with the baskets and come in many small rows: merged, not sent whole to every task
    sizes, wrong = violations.filter(F.col("kind") == "deck_size"), violations.filter(F.col("kind") != "deck_size")
    lines = _ruled_lines(baskets, rules, tasks).join(wrong.select("deck_id").repartition(tasks, "deck_id").hint("merge"), "deck_id", "left_semi")
    known = F.col("known")
    place = lambda kind, subject: F.struct(kind.alias("kind"), subject.alias("subject"))
    places = F.concat(
        F.array_compact(F.array(
            F.when(~known, place(F.lit("unknown_card"), F.lit(""))), *[F.when(known & F.col(flag), place(F.lit(kind), F.lit(""))) for kind, flag in LIMITED.items()],
            F.when(_over(), place(F.lit("name_limit"), F.col("card"))), F.when(F.col("refused").isNotNull(), place(F.col("refused"), F.col("card"))),
        )),
        F.transform(_groups(), lambda g: place(F.lit("name_limit"), g["group_key"])),
    )
    named = lines.select("deck_id", "card", F.explode(F.array_distinct(places)).alias("p")).select("deck_id", "card", "p.*")
    # every violation but that of the size has a card, so the join keeps them all
    keys = ["deck_id", "kind", "subject"]
    listed = named.repartition(tasks, *keys).join(wrong.repartition(tasks, *keys).hint("merge"), keys).groupBy("deck_id", "kind", "subject", "count").agg(
        F.sort_array(F.collect_list("card")).alias("cards")
    )
    return listed.unionByName(sizes.withColumn("cards", none))


def rule_violations(baskets: DataFrame, cards: DataFrame, card_groups: DataFrame, size: int = DECK_SIZE) -> DataFrame:
    """Violation rows of every basket: deck_id, kind, subject, count and the involved cards in order.

    ``baskets``: deck_id, card_id, count; see ``rule_table`` for the rest.
    """
    rules, tasks = rule_table(cards, card_groups), tasks_for(baskets)
    return with_cards(counted_violations(judged_baskets(baskets, rules, size, tasks)), baskets, rules, tasks)


def legality_report(baskets: DataFrame, cards: DataFrame, card_groups: DataFrame, decisions: DataFrame,
                    size: int = DECK_SIZE) -> tuple[DataFrame, DataFrame]:
    """(violations including banned / not_legal, one report row per basket with ``ok``).

    ``decisions``: card_id, legal, banned of the format on the day.
    """
    rules, tasks = rule_table(cards, card_groups, decisions), tasks_for(baskets)
    judged = judged_baskets(baskets, rules, size, tasks)
    return with_cards(counted_violations(judged), baskets, rules, tasks), basket_report(judged)


def rule_distribution(mapped: DataFrame) -> DataFrame:
    return mapped.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def delimited_items(groups: DataFrame) -> DataFrame:
    """'id_count_flag-id_count_flag' group strings -> rows (deck_id, group, official_id, count)."""
    token = F.split(F.col("_token"), "_")
    count = F.get(token, F.lit(1)).try_cast("int")
    exploded = groups.select("deck_id", "group", F.explode(F.split("value", "-")).alias("_token"))
    return exploded.filter((F.col("_token") != "") & count.isNotNull() & F.get(token, F.lit(1)).rlike(r"^\d+$")).select(
        "deck_id", "group", F.get(token, F.lit(0)).alias("official_id"), count.alias("count")
    )


def named_items(items: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with name, set, number and total; official ids the name table lacks)."""
    joined = items.join(names, ["deck_id", "official_id"], "left")
    parts = x.set_suffix(F.col("raw_name"))
    full = joined.withColumn("_s", F.when(F.col("raw_name").isNotNull(), parts)).select(
        *items.columns, "raw_name", F.col("_s.name").alias("item_name"), F.col("_s.set").alias("raw_set"),
        F.col("_s.number").alias("raw_number"), F.col("_s.total").alias("raw_total"),
    )
    unknown = full.filter(F.col("raw_name").isNull()).select("deck_id", "official_id").distinct()
    return full, unknown

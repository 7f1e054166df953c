"""Time-versioned legality: calendars, snapshots, pools, effective text, version changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arena.functions.rank import latest_per_key
from arena.functions.vocab import CALENDAR

Segment = tuple[str, str, "str | None", list[str]]


def env_marks(region: Column, day: Column, calendar: Sequence[Segment] = CALENDAR) -> Column:
    """Marks of the calendar segment covering the day; the first segment listed wins.

    Closed intervals, open ends allowed. A calendar is configuration of a few
    rows, so it becomes one CASE expression instead of a range join.
    """
    out = F.lit(None).cast("array<string>")
    for name, start, end, marks in reversed(calendar):
        inside = (region == name) & (day >= F.lit(start).cast("date"))
        if end is not None:
            inside = inside & (day <= F.lit(end).cast("date"))
        out = F.when(inside, F.array(*[F.lit(m) for m in marks])).otherwise(out)
    return out


def alignment_window(region: str, calendar: Sequence[Segment] = CALENDAR, current: str = "cn") -> tuple[date, date]:
    """[first start, last end] of the region's segments whose marks cover the newest current segment."""
    ours = [s for s in calendar if s[0] == current]
    if not ours:
        raise ValueError(f"calendar has no segment of {current}")
    wanted = set(max(ours, key=lambda s: s[1])[3])
    covering = [s for s in calendar if s[0] == region and wanted <= set(s[3])]
    ends = [s[2] for s in covering if s[2]]
    if not covering or not ends:
        raise ValueError(f"{region}: no bounded segment covers {sorted(wanted)}")
    return date.fromisoformat(min(s[1] for s in covering)), date.fromisoformat(max(ends))


def window_guard(df: DataFrame, day: str, window: tuple[date, date]) -> tuple[DataFrame, DataFrame]:
    """(rows inside the window or without a day, counts kept / skipped / undated)."""
    inside = F.col(day).isNull() | F.col(day).between(F.lit(window[0]), F.lit(window[1]))
    counts = df.agg(
        F.count_if(inside).alias("kept"), F.count_if(~inside).alias("skipped"), F.count_if(F.col(day).isNull()).alias("undated")
    )
    return df.filter(inside), counts


# Days are counted from the first of year 1; every calendar day fits below 2 to the LEVELS.
EPOCH_SHIFT, LEVELS = 719_162, 22


def _day_number(day: Column) -> Column:
    return (F.unix_date(day) + EPOCH_SHIFT).cast("long")


def _dyadic_cover(first: Column, last: Column) -> Column:
    """Nodes of the binary tree over all days that make up the days first..last, two a level at most; none if last < first."""
    start = F.struct(
        (first + (1 << LEVELS)).alias("l"), (last + 1 + (1 << LEVELS)).alias("r"), F.array().cast("array<bigint>").alias("nodes")
    )

    def climb(acc: Column, _: Column) -> Column:
        l, r = acc["l"], acc["r"]
        left, right = (l < r) & (l % 2 == 1), (l < r) & (r % 2 == 1)
        taken = F.array_compact(F.array(F.when(left, l), F.when(right, r - 1)))
        return F.struct(
            F.shiftright(F.when(left, l + 1).otherwise(l), 1).alias("l"), F.shiftright(F.when(right, r - 1).otherwise(r), 1).alias("r"),
            F.concat(acc["nodes"], taken).alias("nodes"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, climb, lambda acc: acc["nodes"])


def snapshot_as_of(days: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Newest snapshot covering each (format, day); ``snapshot_id`` is NULL when there is none.

    An interval is cut into nodes of a binary tree over the days, and of the
    snapshots on a node only the newest stays; a day asks the nodes above it. So
    both sides meet by equal keys: a day never meets the snapshots that do not
    cover it, and work grows with snapshots plus days. Ties go to the smallest id.
    """
    last = F.coalesce(_day_number(F.col("effective_to")), F.lit((1 << LEVELS) - 1).cast("long"))
    newest = F.struct((-F.unix_date("effective_from")).alias("age"), "snapshot_id")
    cover = snapshots.select("format", newest.alias("best"), F.explode(_dyadic_cover(_day_number(F.col("effective_from")), last)).alias("node"))
    cover = cover.groupBy("format", "node").agg(F.min("best").alias("best"))
    asked = days.select("format", "day").distinct()
    leaf = _day_number(F.col("day")) + (1 << LEVELS)
    above = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: F.floor(leaf / F.pow(F.lit(2.0), k)).cast("long"))
    found = asked.withColumn("node", F.explode(above)).join(cover, ["format", "node"]).groupBy("format", "day").agg(F.min("best").alias("best"))
    return asked.join(found, ["format", "day"], "left").select("format", "day", F.col("best.snapshot_id").alias("snapshot_id"))


@dataclass(frozen=True)
class Snapshot:
    """One format's rules: marks, energies, whitelist names, (name, qualifier) bans."""

    snapshot_id: str
    allowed_marks: tuple[str, ...]
    allowed_energies: tuple[str, ...]
    whitelist: tuple[str, ...] = ()
    banned: tuple[tuple[str, str | None], ...] = ()


def load_snapshot(snapshots: DataFrame, fmt: str, day: date) -> tuple[Snapshot, DataFrame]:
    """(rules, mark overrides) of the newest snapshot covering the day; LookupError without one.

    A snapshot row is configuration, so reading one row on the driver is bounded.
    """
    on = F.lit(day).cast("date")
    covering = snapshots.filter(
        (F.col("format") == fmt) & (F.col("effective_from") <= on) & (F.col("effective_to").isNull() | (on <= F.col("effective_to")))
    )
    row = covering.orderBy(F.col("effective_from").desc(), "snapshot_id").first()
    if row is None:
        raise LookupError(f"no {fmt} snapshot covers {day}")
    rules = Snapshot(
        row["snapshot_id"], tuple(row["allowed_marks"]), tuple(row["allowed_energies"]), tuple(w["name_full"] for w in row["whitelist"]),
        tuple((b["name"], b["ability_or_attack"]) for b in row["banned"]),
    )
    overrides = covering.filter(F.col("snapshot_id") == row["snapshot_id"]).select(F.explode("mark_overrides").alias("o")).select("o.card_id", "o.mark")
    return rules, overrides


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def banned_by(snapshot: Snapshot, names: Column, skills: Column) -> Column:
    out = F.lit(False)
    for name, qualifier in snapshot.banned:
        hit = F.array_contains(names, name)
        if qualifier:
            hit = hit & F.array_contains(skills, qualifier)
        out = out | F.coalesce(hit, F.lit(False))
    return out


def with_names(cards: DataFrame, card_groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Adds ``names``: the card's own name and those of its name groups the snapshot mentions.

    Only mentioned names can decide anything, so the collected set is bounded by
    the snapshot, however many groups a card is in.
    """
    mentioned = {*snapshot.whitelist, *(name for name, _ in snapshot.banned)}
    groups = card_groups.filter(F.col("group_key").isin(*sorted(mentioned))).groupBy("card_id").agg(F.collect_set("group_key").alias("_groups"))
    joined = cards.join(groups, "card_id", "left")
    names = F.array_union(F.coalesce("_groups", F.array().cast("array<string>")), F.array("name_full"))
    return joined.withColumn("names", names).drop("_groups")


def legal_decisions(cards: DataFrame, snapshot: Snapshot, mark_overrides: DataFrame | None = None) -> DataFrame:
    """card_id, step, legal, banned, whitelist_hits in the order ban, whitelist, mark, basic energy.

    ``cards``: card_id, names, skills, mark, is_basic_energy, provides. The
    snapshot is configuration and enters the plan as literals; one scan decides.
    """
    df = cards
    mark = F.col("mark")
    if mark_overrides is not None:
        df = df.join(mark_overrides.select("card_id", F.col("mark").alias("_override")), "card_id", "left")
        mark = F.coalesce("_override", "mark")
    hits = F.array_intersect("names", _strings(snapshot.whitelist))
    energies = F.col("provides")
    basic = F.col("is_basic_energy") & (F.size(energies) > 0) & (F.size(F.array_except(energies, _strings(snapshot.allowed_energies))) == 0)
    step = (
        F.when(banned_by(snapshot, F.col("names"), F.col("skills")), "banned")
        .when(F.size(hits) > 0, "whitelist")
        .when(mark.isin(*snapshot.allowed_marks), "mark")
        .when(basic, "basic_energy")
        .otherwise("not_legal")
    )
    decided = df.withColumn("step", step)
    return decided.select(
        "card_id", "step", (~F.col("step").isin("banned", "not_legal")).alias("legal"), (F.col("step") == "banned").alias("banned"),
        F.when(F.col("step") == "whitelist", F.array_sort(hits)).alias("whitelist_hits"),
    )


def pool_by_group(decisions: DataFrame) -> DataFrame:
    """Whitelist name -> legal prints, one row per print."""
    return decisions.filter(F.col("step") == "whitelist").select(F.explode("whitelist_hits").alias("group_key"), "card_id")


def whitelist_audit(cards: DataFrame, decisions: DataFrame, snapshot: Snapshot, energy_types: Sequence[str]) -> DataFrame:
    """One row per whitelist name and energy type: kind, name, prints, ok, detail."""
    spark = cards.sparkSession
    wanted = spark.createDataFrame([(w,) for w in snapshot.whitelist], "name string")
    named = cards.select("card_id", F.explode("names").alias("name")).filter(F.col("name").isin(*snapshot.whitelist))
    exists = named.groupBy("name").agg(F.count(F.lit(1)).alias("known"))
    prints = pool_by_group(decisions).groupBy(F.col("group_key").alias("name")).agg(F.count(F.lit(1)).alias("prints"))
    names = wanted.join(exists, "name", "left").join(prints, "name", "left").select(
        F.lit("whitelist").alias("kind"), "name", F.coalesce("prints", F.lit(0)).alias("prints"), (F.coalesce("prints", F.lit(0)) > 0).alias("ok"),
        F.when(F.col("prints") > 0, "legal").when(F.col("known").isNull(), "unknown_name").otherwise("no_legal_print").alias("detail"),
    )
    kinds = spark.createDataFrame([(e,) for e in energy_types], "name string")
    basics = cards.filter(F.col("is_basic_energy")).select("card_id", F.explode("provides").alias("name")).join(
        decisions.filter(F.col("legal")).select("card_id"), "card_id", "left_semi"
    ).groupBy("name").agg(F.count(F.lit(1)).alias("prints"))
    allowed = F.col("name").isin(*snapshot.allowed_energies)
    n = F.coalesce("prints", F.lit(0))
    energies = kinds.join(basics, "name", "left").select(
        F.when(allowed, "energy").otherwise("energy_negative").alias("kind"), "name", n.alias("prints"),
        F.when(allowed, n > 0).otherwise(n == 0).alias("ok"),
        F.when(allowed & (n == 0), "no_legal_basic").when(~allowed & (n > 0), "should_be_outside").otherwise("as_expected").alias("detail"),
    )
    return names.unionByName(energies)


def effective_text(cards: DataFrame, overrides: DataFrame, errata: DataFrame, day: date) -> DataFrame:
    """Text in force: newest erratum of the resolved print, else the override print, else the own text.

    ``overrides``: format, effective_from, effective_to, card_id, target (one row per map entry).
    """
    on = F.lit(day).cast("date")
    covers = (F.col("effective_from") <= on) & (F.col("effective_to").isNull() | (on <= F.col("effective_to")))
    target = overrides.filter(covers & (F.coalesce(F.col("target").cast("string"), F.lit("")) != "")).groupBy("card_id").agg(
        F.max_by("target", F.struct("effective_from", "format")).alias("target")
    )
    notices = errata.filter(F.col("effective_from") <= on).groupBy(F.col("card_id").alias("_rid")).agg(
        F.max_by("corrected_text", "effective_from").alias("corrected")
    )
    prints = cards.select(F.col("card_id").alias("_pid"), F.col("text").alias("_ptext"))
    joined = (
        cards.join(target, "card_id", "left").withColumn("resolved_id", F.coalesce("target", "card_id"))
        .join(prints, F.col("resolved_id") == F.col("_pid"), "left").join(notices, F.col("resolved_id") == F.col("_rid"), "left")
    )
    source = (
        F.when(F.col("_pid").isNull(), "missing_print").when(F.col("corrected").isNotNull(), "errata")
        .when(F.col("target").isNotNull(), "latest_print").otherwise("text_raw")
    )
    return joined.select("card_id", "resolved_id", F.coalesce("corrected", "_ptext").alias("text"), source.alias("source"))


def latest_print_overrides(cards: DataFrame, card_groups: DataFrame) -> DataFrame:
    """group_key, card_id, target: older prints of a group point to its newest one.

    Newest by release (missing last), then greatest id; groups of one print are absent.
    """
    members = card_groups.join(cards.select("card_id", "release_date"), "card_id")
    age = F.struct(F.coalesce("release_date", F.lit("0001-01-01").cast("date")), F.col("card_id"))
    newest = members.groupBy("group_key").agg(F.max_by("card_id", age).alias("target"), F.count(F.lit(1)).alias("_n"))
    return members.join(newest.filter(F.col("_n") > 1), "group_key").filter(F.col("card_id") != F.col("target")).select(
        "group_key", "card_id", "target"
    )


def apply_snapshots(current: DataFrame, proposals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SCD-2 apply: (history with the open row closed the day before, refused proposals with reason).

    Both tables: snapshot_id, format, effective_from (current also effective_to).
    Refused: known id, or a start not after the newest start of the format.
    """
    newest = current.groupBy("format").agg(F.max("effective_from").alias("_newest"))
    known = current.select("snapshot_id", F.lit(True).alias("_known")).distinct()
    # of proposals starting the same day only the smallest id can be applied
    first = proposals.groupBy("format", "effective_from").agg(F.min("snapshot_id").alias("_first"))
    checked = proposals.join(newest, "format", "left").join(known, "snapshot_id", "left").join(first, ["format", "effective_from"])
    reason = (
        F.when(F.col("_known"), "duplicate_id").when(F.col("effective_from") <= F.col("_newest"), "not_after_current")
        .when(F.col("snapshot_id") != F.col("_first"), "same_start")
    )
    marked = checked.select("snapshot_id", "format", "effective_from", reason.alias("reason"))
    accepted = marked.filter(F.col("reason").isNull()).drop("reason").withColumn("effective_to", F.lit(None).cast("date"))
    both = current.select("snapshot_id", "format", "effective_from", "effective_to").unionByName(accepted)
    # the next start closes an open row; history rows keep the end they had
    following = F.lead("effective_from").over(Window.partitionBy("format").orderBy("effective_from"))
    history = both.withColumn("effective_to", F.coalesce(F.col("effective_to"), F.date_sub(following, 1)))
    return history, marked.filter(F.col("reason").isNotNull())


def refresh_overrides(snapshots: DataFrame, whitelists: DataFrame, stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Override rows after a catalogue change: open snapshots recomputed, closed ones untouched.

    ``whitelists``: snapshot_id, group_key; ``stored``: snapshot_id, card_id,
    target; ``fresh``: the output of ``latest_print_overrides``.
    """
    is_open = snapshots.filter(F.col("effective_to").isNull()).select("snapshot_id")
    renewed = whitelists.join(is_open, "snapshot_id", "left_semi").join(fresh, "group_key").select(
        "snapshot_id", "card_id", "target"
    ).distinct()
    return stored.join(is_open, "snapshot_id", "left_anti").select("snapshot_id", "card_id", "target").unionByName(renewed)


def import_errata(stored: DataFrame, incoming: DataFrame, cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(errata after the upsert, incoming rows of unknown cards). Incoming rows replace equal ids."""
    known = incoming.join(cards.select("card_id"), "card_id", "left_semi")
    skipped = incoming.join(cards.select("card_id"), "card_id", "left_anti")
    both = stored.withColumn("_new", F.lit(0)).unionByName(known.withColumn("_new", F.lit(1)))
    rest = [F.col(x) for x in ("effective_from", "card_id", "corrected_text")]
    return latest_per_key(both, ["errata_id"], [F.col("_new"), *rest]).drop("_new"), skipped

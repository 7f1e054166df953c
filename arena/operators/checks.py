"""The nine checks of the catalogue as one registry and one run.

Card checks are array expressions over one joined row (the stored card, its raw
record, whether its parent is known and whether it is in the sample), so all of
them come out of a single pass over the stored records. Set and component checks
are aggregates next to it. Every failure is a row: set, card, rule, field, the
stored value and the value of the source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.functions import text as x
from arena.functions import vocab as v
from arena.operators.graph import connected_components
from arena.operators.quality import HP_RANGE, MARK_FORM, component_check, set_reconciliation, stride_sample

# Fields that may not be blank, those that basic energy cards may lack, and the sampled share.
REQUIRED = ["name_full", "number", "regulation_mark", "card_type", "text_raw"]
BLANK_ON_BASIC_ENERGY = ["regulation_mark", "text_raw"]
SAMPLE_PERCENT = 5

FAILURES = "set_id string, card_id string, rule string, field string, stored string, source string"


@dataclass(frozen=True)
class Vocabulary:
    """Allowed values of the enumerations."""

    rarities: tuple[str, ...] = tuple(v.RARITIES)
    card_types: tuple[str, ...] = tuple(dict.fromkeys(kind for kind, _ in v.CARD_TYPES.values()))
    trainer_subtypes: tuple[str, ...] = tuple(sub for _, sub in v.CARD_TYPES.values() if sub)
    rule_box_types: tuple[str, ...] = tuple(v.RULE_BOX_TYPES)
    stages: tuple[str, ...] = tuple(v.STAGES.values())
    energies: tuple[str, ...] = tuple(v.ENERGY_CODES.values())
    codes: Mapping[str, str] = field(default_factory=lambda: dict(v.ENERGY_CODES))


FINDING = "array<struct<field:string,stored:string,source:string>>"


def finding(name: str | Column, stored: Column | None = None, source: Column | None = None) -> Column:
    text = lambda c: (F.lit(None) if c is None else c).cast("string")
    return F.struct((F.lit(name) if isinstance(name, str) else name).alias("field"), text(stored).alias("stored"), text(source).alias("source"))


def findings(*found: Column) -> Column:
    """The conditions that hold, as an array."""
    return F.array_compact(F.array(*found)).cast(FINDING)


def _blank(col: Column) -> Column:
    return col.isNull() | (F.trim(col.cast("string")) == "")


def required(voc: Vocabulary) -> Column:
    """Blank fields. Basic energy has no mark and no text; a text the source lacks as well is no loss of ours."""
    out = []
    for name in REQUIRED:
        missing = _blank(F.col(name))
        if name in BLANK_ON_BASIC_ENERGY:
            missing = missing & ~F.coalesce(F.col("is_basic_energy"), F.lit(False))
        if name == "text_raw":
            missing = missing & ~(F.col("_raw") & _blank(F.col("_r.description")))
        out.append(F.when(missing, finding(name, F.col(name))))
    return findings(*out)


def enums(voc: Vocabulary) -> Column:
    """Values outside of their vocabulary; absent ones are fine but for card type and rarity."""
    outside = lambda name, allowed: F.when(F.col(name).isNotNull() & ~F.col(name).isin(*allowed), finding(name, F.col(name)))
    must = lambda name, allowed: F.when(F.col(name).isNull() | ~F.col(name).isin(*allowed), finding(name, F.col(name)))
    single = findings(
        must("card_type", voc.card_types), outside("trainer_subtype", voc.trainer_subtypes), must("rarity", voc.rarities),
        outside("rule_box_type", voc.rule_box_types), outside("stage", voc.stages),
        *[
            F.when(F.col(name).isNotNull() & F.coalesce(~F.col(f"{name}.type").isin(*voc.energies), F.lit(True)), finding(name, F.col(f"{name}.type")))
            for name in ("weakness", "resistance")
        ],
    )
    lists = [
        F.transform(F.filter(F.coalesce(F.col(name), F.array()), lambda e: ~e.isin(*voc.energies)), lambda e: finding(name, e))  # noqa: B023
        for name in ("types", "provides")
    ]
    return F.concat(single, *[rows.cast(FINDING) for rows in lists])


def mark_format(voc: Vocabulary) -> Column:
    mark = F.col("regulation_mark")
    return findings(F.when((mark != "") & ~mark.rlike(MARK_FORM), finding("regulation_mark", mark)))


def hp_range(voc: Vocabulary) -> Column:
    return findings(F.when((F.col("card_type") == "pokemon") & ~F.col("hp").between(*HP_RANGE), finding("hp", F.col("hp"))))


def parent_key(voc: Vocabulary) -> Column:
    return findings(F.when(F.col("evolves_from_id").isNotNull() & ~F.col("_parent"), finding("evolves_from_id", F.col("evolves_from_id"))))


def energy_costs(voc: Vocabulary) -> Column:
    """Cost symbols in the vocabulary; costs in the order of the source, their modifier, and the retreat cost."""
    none = F.array().cast("array<struct<type:string,count:int>>")
    shown = lambda cost: F.array_join(F.transform(F.coalesce(cost, none), lambda p: F.concat(p["type"], p["count"].cast("string"))), ",")
    mine = F.coalesce(
        F.transform("attacks", lambda a: F.struct(a["cost"].alias("cost"), a["cost_modifier"].alias("cost_modifier"))),
        F.array().cast("array<struct<cost:array<struct<type:string,count:int>>,cost_modifier:string>>"),
    )
    theirs = F.coalesce(F.transform("_r.pokemonAttr.attack", lambda a: a["cost"]), F.array().cast("array<string>"))
    odd = F.flatten(F.transform(mine, lambda a, i: F.transform(
        F.filter(F.coalesce(a["cost"], none), lambda p: ~p["type"].isin(*voc.energies)),
        lambda p: finding(F.concat(F.lit("attacks["), i.cast("string"), F.lit("].cost")), p["type"]),
    )))
    place = lambda i, what: F.concat(F.lit("attacks["), i.cast("string"), F.lit(f"].{what}"))

    def compared(pair: Column, i: Column) -> Column:
        stored, raw = pair["mine"], pair["theirs"]
        known = x.cost_is_known(raw, dict(voc.codes))
        expected = x.run_length_cost(raw, dict(voc.codes))
        return F.array_compact(F.array(
            F.when(~known, finding(place(i, "cost"), shown(stored["cost"]), raw)),
            F.when(known & (shown(stored["cost"]) != shown(expected)), finding(place(i, "cost"), shown(stored["cost"]), shown(expected))),
            F.when(known & ~stored["cost_modifier"].eqNullSafe(x.cost_modifier(raw)), finding(place(i, "cost_modifier"), stored["cost_modifier"], x.cost_modifier(raw))),
        ))

    pairs = F.arrays_zip(mine.alias("mine"), theirs.alias("theirs"))
    ordered = F.when(F.size(mine) == F.size(theirs), F.flatten(F.transform(pairs, compared))).otherwise(
        F.array(finding("attacks", F.size(mine), F.size(theirs)))
    )
    retreat = findings(F.when(
        ~F.col("retreat_cost").eqNullSafe(F.col("_r.pokemonAttr.retreatCost")), finding("retreat_cost", F.col("retreat_cost"), F.col("_r.pokemonAttr.retreatCost"))
    ))
    against = F.when(F.col("_raw"), F.concat(ordered.cast(FINDING), F.when(F.size(mine) == F.size(theirs), retreat).otherwise(findings())))
    return F.concat(odd.cast(FINDING), F.coalesce(against, F.array(finding("raw")).cast(FINDING)))


def source_fields(voc: Vocabulary | None = None) -> Column:
    """Name, hit points and attack names that differ from the raw record; a record that is not there differs as well."""
    names = lambda col: F.coalesce(F.array_join(F.transform(col, lambda a: F.coalesce(a["name"], F.lit(""))), "|"), F.lit(""))
    mine, theirs = names("attacks"), names("_r.pokemonAttr.attack")
    differs = lambda name, a, b: F.when(~a.eqNullSafe(b), finding(name, a, b))
    return F.when(~F.col("_raw"), F.array(finding("raw")).cast(FINDING)).otherwise(findings(
        differs("name_full", F.col("name_full"), F.col("_r.name")), differs("hp", F.col("hp"), F.col("_r.pokemonAttr.hp")),
        differs("attacks.name", mine, theirs),
    ))


def sampled(voc: Vocabulary) -> Column:
    return F.when(F.col("_sampled"), source_fields()).otherwise(findings())


@dataclass(frozen=True)
class Check:
    """A rule of the registry: what it looks at, and for card rules its findings on the joined row."""

    rule: str
    scope: str  # card, set or component
    findings: Callable[[Vocabulary], Column] | None = None


CHECKS = (
    Check("required", "card", required),
    Check("enum", "card", enums),
    Check("mark_format", "card", mark_format),
    Check("hp_range", "card", hp_range),
    Check("parent_key", "card", parent_key),
    Check("energy", "card", energy_costs),
    Check("reconciliation", "set"),
    Check("union", "component"),
    Check("sample", "card", sampled),
)


def sample_ids(cards: DataFrame, order: str, splits: Sequence[float], percent: int = SAMPLE_PERCENT) -> DataFrame:
    """card_id of the equidistant sample of every set."""
    return stride_sample(cards.select("set_id", "card_id", order), ["set_id"], order, splits, percent).select("card_id")


def with_raw(cards: DataFrame, raw: DataFrame) -> DataFrame:
    """Adds the raw record ``_r`` of (set, number) and whether there is one. ``raw``: set_id, number, r; one row a record."""
    found = raw.select(F.col("set_id").alias("_rs"), F.col("number").alias("_rn"), F.col("r").alias("_r"), F.lit(True).alias("_hit"))
    joined = cards.join(found, (F.col("set_id") == F.col("_rs")) & (F.col("number") == F.col("_rn")), "left")
    return joined.withColumn("_raw", F.col("_hit").isNotNull()).drop("_rs", "_rn", "_hit")


def sample_compare(cards: DataFrame, raw: DataFrame, order: str, splits: Sequence[float], percent: int = SAMPLE_PERCENT) -> DataFrame:
    """(set_id, card_id, field, stored, source) of the sample against its source; one row without a field where nothing differs.

    The sample is drawn first and only its own records are looked up.
    """
    ids = sample_ids(cards, order, splits, percent)
    chosen = cards.join(ids, "card_id", "left_semi")
    wanted = chosen.select("set_id", "number").distinct()
    joined = with_raw(chosen, raw.join(wanted, ["set_id", "number"], "left_semi"))
    rows = joined.select("set_id", "card_id", F.explode_outer(source_fields()).alias("f"))
    return rows.select("set_id", "card_id", "f.field", "f.stored", "f.source")


def card_failures(
    cards: DataFrame, raw: DataFrame, known_ids: DataFrame, order: str, splits: Sequence[float], voc: Vocabulary, checks: Sequence[Check]
) -> DataFrame:
    """All card checks from one pass over the joined rows."""
    wanted = [c for c in checks if c.scope == "card"]
    # unknown parents and the sample are found on ids alone; whole cards are dealt out for them once
    ids = sample_ids(cards, order, splits).select(F.col("card_id").alias("_sid"), F.lit(None).cast("string").alias("_lost"))
    linked = cards.filter(F.col("evolves_from_id").isNotNull()).select(F.col("card_id").alias("_sid"), F.col("evolves_from_id").alias("_lost"))
    lost = linked.join(known_ids.select(F.col("card_id").alias("_lost")), "_lost", "left_anti")
    marks = ids.withColumn("_in", F.lit(True)).unionByName(lost.withColumn("_in", F.lit(False)))
    marks = marks.groupBy("_sid").agg(F.max("_in").alias("_in"), F.collect_set("_lost").alias("_lost"))
    rows = with_raw(cards, raw).join(marks, F.col("card_id") == F.col("_sid"), "left")
    unknown = F.coalesce(F.array_contains("_lost", F.col("evolves_from_id")), F.lit(False))
    rows = rows.withColumns({"_parent": ~unknown, "_sampled": F.coalesce("_in", F.lit(False))})
    named = [
        F.transform(c.findings(voc), lambda f: F.struct(F.lit(c.rule).alias("rule"), f["field"].alias("field"), f["stored"].alias("stored"), f["source"].alias("source")))  # noqa: B023,E501
        for c in wanted
    ]
    return rows.select("set_id", "card_id", F.explode(F.concat(*named)).alias("f")).select("set_id", "card_id", "f.*")


def set_failures(cards: DataFrame, raw: DataFrame) -> DataFrame:
    """Sets whose cards are not as many as the distinct (set, number) of the source."""
    counts = set_reconciliation(raw.select("set_id", "number"), cards.select("set_id")).filter(~F.col("ok"))
    return counts.select(
        "set_id", F.lit(None).cast("string").alias("card_id"), F.lit("reconciliation").alias("rule"), F.lit("count").alias("field"),
        F.col("actual").cast("string").alias("stored"), F.col("expected").cast("string").alias("source"),
    )


def union_failures(cards: DataFrame, relations: DataFrame) -> DataFrame:
    """Members of union components that are not four parts with four positions. ``relations``: card_id, related_id.

    ``position`` of the cards may be missing as a whole.
    """
    position = F.col("union_position") if "union_position" in cards.columns else F.lit(None).cast("string")
    parts = cards.filter((F.col("rule_box_type") == "v_union") | position.isNotNull()).select(F.col("card_id").alias("id"), "set_id", position.alias("position"))
    inside = parts.select(F.col("id").alias("_id"))
    edges = relations.select(F.col("card_id").alias("src"), F.col("related_id").alias("dst"))
    edges = edges.join(inside, F.col("src") == F.col("_id"), "left_semi").join(inside, F.col("dst") == F.col("_id"), "left_semi")
    members = connected_components(parts.select("id"), edges).join(parts, "id")
    bad = component_check(members.select("component", "id", "position"))
    return members.join(bad, "component").select(
        "set_id", F.col("id").alias("card_id"), F.lit("union").alias("rule"), F.lit("union_part_of").alias("field"),
        F.col("n").cast("string").alias("stored"), F.col("reasons").alias("source"),
    )


def run(
    cards: DataFrame, raw: DataFrame, known_ids: DataFrame, relations: DataFrame, order: str, splits: Sequence[float],
    voc: Vocabulary | None = None, checks: Sequence[Check] = CHECKS,
) -> DataFrame:
    """Failures (set_id, card_id, rule, field, stored, source) of the stored cards under the registered checks.

    ``cards``: normalised cards with ``evolves_from_id`` and a numeric ``order``;
    ``raw``: set_id, number, r; ``known_ids``: card_id of the whole catalogue;
    ``relations``: union edges.
    """
    voc = voc or Vocabulary()
    rules = {c.rule for c in checks}
    out = card_failures(cards, raw, known_ids, order, splits, voc, checks)
    if "reconciliation" in rules:
        out = out.unionByName(set_failures(cards, raw))
    if "union" in rules:
        out = out.unionByName(union_failures(cards, relations))
    return out

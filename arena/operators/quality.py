"""Checks, reconciliation, sampling and catalogue reports. Each returns rows, never raises on data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arena.functions.rank import page_bounds, split_rank
from arena.functions.vocab import LIMIT_BY_RULE_BOX, UNION_POSITIONS
from arena.sources.tables import lookup

# Prize cards checked by the consistency audit, and the HP range.
AUDITED_PRIZES = {"ex": 2, "gx": 2, "tag_team_gx": 3, "v_union": 3, "mega_ex": 3}
HP_RANGE = (10, 340)
MARK_FORM = r"^[A-Z]$"


def required_fields(df: DataFrame, fields: Sequence[str], exempt: Mapping[str, Column] | None = None) -> DataFrame:
    """Per field: rows checked, blank values, pass rate. Exempt rows are not checked."""
    exempt = exempt or {}
    aggs = []
    for f in fields:
        value = F.col(f)
        blank = value.isNull() | (F.trim(value.cast("string")) == "")
        checked = ~F.coalesce(exempt[f], F.lit(False)) if f in exempt else F.lit(True)
        aggs += [F.count_if(checked).alias(f"{f}__n"), F.count_if(checked & blank).alias(f"{f}__bad")]
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"{f}__n").alias("checked"), F.col(f"{f}__bad").alias("failures")) for f in fields
    ])
    out = one.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("pass_rate", F.coalesce(F.try_divide(F.col("checked") - F.col("failures"), F.col("checked")), F.lit(1.0)))


def required_violations(df: DataFrame, key: str, fields: Sequence[str], exempt: Mapping[str, Column] | None = None) -> DataFrame:
    """(key, field) that is blank where it must not be."""
    blank = lambda f: F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == "")
    checked = lambda f: ~F.coalesce((exempt or {}).get(f, F.lit(False)), F.lit(False))
    return df.select(key, F.explode(F.array_compact(F.array(*[F.when(checked(f) & blank(f), F.lit(f)) for f in fields]))).alias("field"))


def enum_violations(df: DataFrame, key: str, values: Mapping[str, Column], allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key, field, value) outside its vocabulary. ``values`` are arrays, so scalars, lists and structs fit alike."""
    def outside(field: str, col: Column) -> Column:
        present = F.coalesce(col, F.array().cast("array<string>"))
        unknown = F.filter(present, lambda x: x.isNotNull() & ~x.isin(*allowed[field]))
        return F.transform(unknown, lambda x: F.struct(F.lit(field).alias("field"), x.alias("value")))

    bad = [outside(field, col) for field, col in values.items()]
    return df.select(key, F.explode(F.concat(*bad)).alias("v")).select(key, "v.field", "v.value")


def format_and_range(df: DataFrame, key: str, mark: str, hp: str, is_pokemon: Column) -> DataFrame:
    """Marks that are not one capital letter and hit points outside the range."""
    checks = F.array_compact(F.array(
        F.when((F.col(mark) != "") & ~F.col(mark).rlike(MARK_FORM), F.struct(F.lit("mark").alias("field"), F.col(mark).alias("value"))),
        F.when(is_pokemon & ~F.col(hp).between(*HP_RANGE), F.struct(F.lit("hp").alias("field"), F.col(hp).cast("string").alias("value"))),
    ))
    return df.select(key, F.explode(checks).alias("v")).select(key, "v.field", "v.value")


def recompute_compare(stored: DataFrame, recomputed: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, field) where the stored value differs from the recomputed one, arrays element by element."""
    other = recomputed.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = stored.join(other, F.col(key) == F.col("_k"), "left")
    diffs = F.array_compact(F.array(
        F.when(F.col("_k").isNull(), F.lit("raw")),
        *[F.when(F.col("_k").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in columns],
    ))
    return joined.select(key, F.explode(diffs).alias("field"))


def set_reconciliation(refs: DataFrame, cards: DataFrame) -> DataFrame:
    """Expected (distinct (set, number) references) against the actual cards of each set."""
    expected = refs.select("set_id", "number").distinct().groupBy("set_id").agg(F.count(F.lit(1)).alias("expected"))
    actual = cards.groupBy("set_id").agg(F.count(F.lit(1)).alias("actual"))
    zero = F.lit(0)
    return expected.join(actual, "set_id", "full_outer").select(
        "set_id", F.coalesce("expected", zero).alias("expected"), F.coalesce("actual", zero).alias("actual"),
        (F.coalesce("expected", zero) == F.coalesce("actual", zero)).alias("ok"),
    )


def set_mark_summary(cards: DataFrame) -> DataFrame:
    """Distinct marks of a set in order (an alphabet at most); more than one is questioned."""
    marks = F.array_sort(F.collect_set("mark"))
    return cards.groupBy("set_id").agg(F.array_join(marks, ",").alias("marks"), (F.size(marks) > 1).alias("question"))


def sequence_gaps(cards: DataFrame, official: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(set, official, reason) and all missing numbers of failing sets, as ranges.

    ``cards``: set_id, num; ``official``: set_id, official. Accepted when
    1..official is fully covered and official does not exceed the greatest number.
    """
    numbers = cards.select("set_id", "num").distinct()
    joined = numbers.join(official, "set_id").groupBy("set_id", "official").agg(
        F.max("num").alias("top"), F.count_if(F.col("num").between(1, F.col("official"))).alias("covered")
    )
    stats = official.join(joined.drop("official"), "set_id", "left")
    reason = (
        F.when(F.col("top").isNull(), "no_numbers").when(F.col("official") > F.col("top"), "above_top")
        .when(F.col("covered") < F.col("official"), "gap")
    )
    verdict = stats.select("set_id", "official", reason.alias("reason"))
    # the numbers of a failing set and both its ends; a gap lies between two neighbours that are not next to each other
    failing = verdict.filter(F.col("reason") == "gap").select("set_id", "official")
    inside = numbers.join(failing, "set_id").filter(F.col("num").between(1, F.col("official"))).select("set_id", F.col("num").cast("long").alias("num"))
    ends = failing.select("set_id", F.explode(F.array(F.lit(0).cast("long"), F.col("official").cast("long") + 1)).alias("num"))
    after = F.lead("num").over(Window.partitionBy("set_id").orderBy("num"))
    gaps = inside.unionByName(ends).withColumn("_next", after).filter(F.col("_next") > F.col("num") + 1)
    return verdict, gaps.select("set_id", (F.col("num") + 1).alias("gap_from"), (F.col("_next") - 1).alias("gap_to"))


def pack_counts(cards: DataFrame, measured: DataFrame, width: int = 2) -> DataFrame:
    """Cards per number prefix against the measured packs: ok / differs / not measured."""
    derived = cards.select("set_id", F.substr("number", F.lit(1), F.lit(width)).alias("pack"), "number").distinct().groupBy("set_id", "pack").agg(
        F.count(F.lit(1)).alias("derived")
    )
    joined = derived.join(measured, ["set_id", "pack"], "full_outer")
    status = F.when(F.col("measured").isNull(), "not_measured").when(F.col("derived").eqNullSafe(F.col("measured")), "ok").otherwise("differs")
    return joined.select("set_id", "pack", "derived", "measured", status.alias("status"))


def denominators(sets: DataFrame, measured: DataFrame, external: DataFrame, packs: DataFrame) -> DataFrame:
    """Denominator source per set: measured, then external when it passed its gate, then derived packs.

    ``external``: set_id, official, reason (NULL = passed).
    """
    joined = (
        sets.select("set_id").join(measured.select("set_id", F.col("total").alias("_m")), "set_id", "left")
        .join(external.select("set_id", F.col("official").alias("_e"), F.col("reason").alias("_why")), "set_id", "left")
        .join(packs.select("set_id", F.lit(True).alias("_p")), "set_id", "left")
    )
    passed = F.col("_e").isNotNull() & F.col("_why").isNull()
    source = F.when(F.col("_m").isNotNull(), "measured").when(passed, "external").when(F.col("_p"), "derived")
    return joined.select(
        "set_id", source.alias("source"), F.coalesce("_m", F.when(passed, F.col("_e"))).alias("total"),
        F.when(F.col("_m").isNull(), F.col("_why")).alias("conflict"),
    )


def field_survey(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, value, n): value frequencies of many fields in one pass."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("n"))


def top_values(survey: DataFrame, k: int) -> DataFrame:
    """The k most frequent values per field; Spark prunes to k rows per task before the shuffle."""
    order = Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    return survey.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def run_reconcile(expected: DataFrame, done: DataFrame, question: DataFrame, key: str) -> DataFrame:
    """One row: totals of the work list and an order-independent hash of the three outcomes."""
    d = done.select(key, F.lit(True).alias("_d")).distinct()
    q = question.select(key, F.lit(True).alias("_q")).distinct()
    joined = expected.select(key).distinct().join(d, key, "left").join(q, key, "left")
    outcome = F.when(F.col("_d"), "scraped").when(F.col("_q"), "question").otherwise("missing")
    marked = joined.select(key, outcome.alias("outcome"))
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), "outcome"))
    parts = [F.sum(F.conv(F.substr(digest, F.lit(i), F.lit(8)), 16, 10).cast("decimal(38,0)")).cast("string") for i in (1, 9, 17, 25)]
    return marked.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("outcome") == o).alias(o) for o in ("scraped", "question", "missing")],
        F.concat_ws(":", *parts).alias("run_hash"),
    )


def component_check(members: DataFrame, positions: Sequence[str] = UNION_POSITIONS) -> DataFrame:
    """Components that are not four members with the four positions.

    ``members``: component, id, position. A component without any position is
    judged by its size alone.
    """
    pos = F.col("position")
    stats = members.groupBy("component").agg(
        F.count(F.lit(1)).alias("n"), F.count(pos).alias("with_pos"), F.count_if(pos.isNotNull() & ~pos.isin(*positions)).alias("unknown"),
        *[F.count_if(pos == p).alias(f"_p{i}") for i, p in enumerate(positions)],
    )
    counts = [F.col(f"_p{i}") for i in range(len(positions))]
    any_pos = F.col("with_pos") > 0
    repeated = F.greatest(*counts) > 1
    lacking = F.least(*counts) == 0
    reasons = F.array_compact(F.array(
        F.when(F.col("n") != len(positions), F.lit("size")),
        F.when(any_pos & (F.col("with_pos") < F.col("n")), F.lit("position_null")),
        F.when(F.col("unknown") > 0, F.lit("position_unknown")),
        F.when(any_pos & repeated, F.lit("position_repeated")),
        F.when(any_pos & lacking & (F.col("n") == len(positions)), F.lit("position_lacking")),
    ))
    return stats.filter(F.size(reasons) > 0).select("component", "n", F.array_join(reasons, ",").alias("reasons"))


def mechanic_consistency(cards: DataFrame, key: str, owners: Sequence[str], joiner: str = "的") -> DataFrame:
    """(key, check) where prize, deck limit or owner differ from the rule table."""
    prize = lookup(F.col("rule_box_type"), AUDITED_PRIZES)
    prefix = F.lit(None).cast("string")
    for o in reversed(owners):
        prefix = F.when(F.col("name_full").startswith(o + joiner), F.lit(o)).otherwise(prefix)
    checks = F.array_compact(F.array(
        F.when(F.col("prize_cards") != prize, F.lit("prize")),
        F.when(F.col("is_ace_spec") & (F.col("deck_limit") != 1), F.lit("ace_limit")),
        F.when(F.col("deck_limit") != lookup(F.col("rule_box_type"), LIMIT_BY_RULE_BOX), F.lit("rule_limit")),
        F.when(~F.col("owner").eqNullSafe(prefix), F.lit("owner")),
    ))
    return cards.select(key, F.explode(checks).alias("check"))


def activation_gate(cards: DataFrame, failures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cards with drafts of clean sets made active, set verdicts). ``failures``: set_id, rule."""
    bad = failures.groupBy("set_id").agg(F.count(F.lit(1)).alias("failures"), F.count_distinct("rule").alias("rules"))
    verdict = cards.select("set_id").distinct().join(bad, "set_id", "left").select(
        "set_id", F.coalesce("failures", F.lit(0)).alias("failures"), F.coalesce("rules", F.lit(0)).alias("rules"), F.col("failures").isNull().alias("passed")
    )
    promoted = cards.join(verdict.select("set_id", "passed"), "set_id").withColumn(
        "status", F.when(F.col("passed") & (F.col("status") == "draft"), "active").otherwise(F.col("status"))
    )
    return promoted.drop("passed"), verdict


def stride_sample(df: DataFrame, keys: Sequence[str], order: str, splits: Sequence[float], percent: int = 5) -> DataFrame:
    """ceil(percent) of each group, at least one row, equidistant in ``order``."""
    ranked = split_rank(df, keys, order, splits=splits, name="_rn", total="_n")
    want = F.greatest(F.ceil(F.col("_n") * percent / 100), F.lit(1)).cast("long")
    pos = F.col("_rn") - 1
    # sample i sits at floor(i * n / want); invert it with integers
    nearest = F.expr("cast((_pos * _want + _n - 1) div _n as bigint)")
    marked = ranked.withColumn("_want", want).withColumn("_pos", pos).withColumn("_i", nearest)
    hit = (F.col("_i") < F.col("_want")) & (F.expr("(_i * _n) div _want") == F.col("_pos"))
    return marked.filter(hit).drop("_rn", "_n", "_want", "_pos", "_i")


def chunks_of(df: DataFrame, keys: Sequence[str], id_col: str, splits: Sequence[float], size: int = 4) -> DataFrame:
    """Star edges id -> hub: groups in id order, cut every ``size`` rows when divisible, else whole."""
    ranked = split_rank(df, keys, id_col, splits=splits, name="_rn", total="_n")
    chunk = F.when(F.col("_n") % size == 0, F.floor((F.col("_rn") - 1) / size)).otherwise(0)
    marked = ranked.withColumn("_chunk", chunk)
    hubs = marked.groupBy(*keys, "_chunk").agg(F.min(id_col).alias("hub"))
    return marked.join(hubs, [*keys, "_chunk"]).filter(F.col(id_col) != F.col("hub")).select(*keys, id_col, "hub")


def cyclic_positions(df: DataFrame, keys: Sequence[str], id_col: str, splits: Sequence[float],
                     labels: Sequence[str] = UNION_POSITIONS) -> DataFrame:
    """Position label by order modulo four; a different stored value is a conflict and kept."""
    ranked = split_rank(df, keys, id_col, splits=splits, name="_rn")
    label = F.element_at(F.array(*[F.lit(p) for p in labels]), (F.pmod(F.col("_rn") - 1, F.lit(len(labels))) + 1).cast("int"))
    state = F.when(F.col("position").isNull(), "filled").when(F.col("position") == label, "already").otherwise("conflict")
    return ranked.select(*keys, id_col, F.coalesce("position", label).alias("position"), state.alias("state"))


def monotone_check(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, first falling step or NULL) of an array that should never decrease."""
    a = F.col(column)
    steps = F.arrays_zip(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))).alias("x"), F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))).alias("y"))
    falls = F.transform(steps, lambda s: s["x"] > s["y"])
    at = F.array_position(falls, F.lit(True))
    return df.select(key, (at == 0).alias("monotone"), F.when(at > 0, at).alias("falls_at"))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int, only: Column | None = None) -> DataFrame:
    """n rows with the smallest md5(id, seed): the same rows for any partitioning."""
    pool = df if only is None else df.filter(only)
    order = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    return pool.orderBy(order, F.col(id_col)).limit(n)


def search_catalogue(
    cards: DataFrame, *, name: str | None = None, marks: Sequence[str] | None = None, card_type: str | None = None,
    set_ids: Sequence[str] | None = None, flags: Mapping[str, bool] | None = None, limit: int | None = None, offset: int = 0,
    order: str = "card_id",
) -> DataFrame:
    """Conjunctive search: all hits, or one page in id order. Only filters that are set enter the plan."""
    df = cards
    if name:
        df = df.filter(F.contains("name_full", F.lit(name)) | F.coalesce(F.contains("species", F.lit(name)), F.lit(False)))
    if marks is not None:
        df = df.filter(F.col("mark").isin(*marks))
    if card_type is not None:
        df = df.filter(F.col("card_type") == card_type)
    if set_ids is not None:
        df = df.filter(F.col("set_id").isin(*set_ids))
    for column, value in (flags or {}).items():
        df = df.filter(F.col(column) == value)
    return df if limit is None and not offset else page(df, order, limit, offset)


def page(df: DataFrame, order: str, limit: int | None, offset: int = 0) -> DataFrame:
    """Rows offset..offset + limit in the order of a text key.

    A page that starts inside is found by counts of key ranges: only rows between
    its bounds are read and sorted, however deep it lies.
    """
    if limit is None or not offset:
        rest = df.orderBy(order).offset(offset)
        return rest if limit is None else rest.limit(limit)
    low, high, before = page_bounds(df, order, offset, limit)
    rows = df if high is None else df.filter(F.col(order) <= F.lit(high))
    rows = rows if low is None else rows.filter(F.col(order) > F.lit(low))
    return rows.orderBy(order).offset(offset - before).limit(limit)


def catalogue_overview(cards: DataFrame, sets: DataFrame) -> DataFrame:
    """(section, key, n): totals by type and mark, and sets whose expected count differs."""
    count = F.count(F.lit(1)).alias("n")
    by = lambda label, col: cards.groupBy(F.coalesce(F.col(col), F.lit("none")).alias("key")).agg(count).select(F.lit(label).alias("section"), "key", "n")  # noqa: E731,E501
    actual = cards.groupBy("set_id").agg(count)
    off = sets.join(actual, "set_id", "left").filter(F.col("expected").isNotNull() & (F.col("expected") != F.coalesce("n", F.lit(0))))
    return by("type", "card_type").unionByName(by("mark", "mark")).unionByName(
        off.select(F.lit("mismatch").alias("section"), F.col("set_id").alias("key"), F.coalesce("n", F.lit(0)).alias("n"))
    )


def share_reconcile(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Counts per (competition, variant): equal under full coverage, else ours may not exceed theirs.

    Both tables: tournament_id, variant, n (NULL variant = ours without a mapping).
    """
    total = lambda df, name: df.groupBy("tournament_id").agg(F.sum("n").alias(name))
    covered = total(theirs, "_theirs").join(total(ours, "_ours"), "tournament_id", "left").withColumn("_ours", F.coalesce("_ours", F.lit(0)))
    o = ours.select("tournament_id", "variant", F.col("n").alias("_o"))
    t = theirs.select("tournament_id", "variant", F.col("n").alias("_t"))
    both = t.join(o, ["tournament_id", "variant"], "full_outer").join(covered, "tournament_id")
    full = F.col("_theirs") == F.col("_ours")
    bad = F.when(F.col("_t").isNull(), True).when(full, F.col("_t") != F.coalesce("_o", F.lit(0))).otherwise(F.col("_t") < F.coalesce("_o", F.lit(0)))
    return both.groupBy("tournament_id").agg(
        F.when(F.max(full), "full").otherwise("partial").alias("coverage"), F.count_if(bad).alias("differences")
    ).withColumn("ok", F.col("differences") == 0)


def work_estimate(occurrences: DataFrame, code: str, splits: Sequence[str]) -> DataFrame:
    """(dimension, key, codes): distinct codes in all and by each column."""
    # each occurrence is one row per dimension, distinct before it is counted: one scan, one exchange
    rows = F.array(
        F.struct(F.lit("all").alias("dimension"), F.lit("").alias("key")),
        *[F.struct(F.lit(s).alias("dimension"), F.col(s).cast("string").alias("key")) for s in splits],
    )
    pairs = occurrences.select(F.col(code).alias("_code"), F.explode(rows).alias("d")).select("_code", "d.dimension", "d.key").distinct()
    return pairs.groupBy("dimension", "key").agg(F.count("_code").alias("codes"))


def budget_guard(occurrences: DataFrame, code: str, category: str, priority: str, gate: int) -> DataFrame:
    """Distinct codes to fetch: all of them up to the gate, beyond it the priority category only."""
    total = occurrences.agg(F.count_distinct(code)).scalar()
    chosen = occurrences.filter((total <= gate) | (F.col(category) == priority))
    return chosen.select(code).distinct().withColumn("decision", F.when(total > gate, "degraded").otherwise("full"))

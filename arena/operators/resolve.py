"""Resolution of printed items and names against a catalogue.

Candidates are written as one table with a priority column and reduced by
``min_by`` aggregates; nothing enumerates the members of a name group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arena.functions import text as x
from arena.functions import vocab as v
from arena.functions.rank import earliest_per_key
from arena.session import stored_rows
from arena.sources.tables import lookup


def stripped_number(number: Column) -> Column:
    """Number without leading zeros ('000' -> '0').

    Two numbers share one of the written, stripped and three-digit forms
    exactly when their stripped forms are equal, so one join key is enough.
    """
    return F.regexp_replace(number, r"^0+(?=.)", "")


def print_index(cards: DataFrame, order: str) -> DataFrame:
    """(set, number key) -> first print seen in ``order``."""
    keyed = cards.select(F.col("set_code").alias("_set"), stripped_number(F.col("number")).alias("_num"), "located_name", order)
    return earliest_per_key(keyed, ["_set", "_num"], [F.col(order)]).drop(order)


def locate_prints(items: DataFrame, index: DataFrame) -> DataFrame:
    """Adds ``located_name`` (NULL when set or number is missing or unknown)."""
    keyed = items.withColumn("_num", stripped_number(F.col("raw_number")))
    joined = keyed.join(index, (F.col("raw_set") == F.col("_set")) & (keyed["_num"] == index["_num"]), "left")
    return joined.select(*items.columns, "located_name")


def _recency() -> Column:
    """Newest first, missing date oldest, then smallest id; the least struct is the best card."""
    ordinal = F.coalesce(F.datediff("release_date", F.lit("0001-01-01").cast("date")), F.lit(-1))
    return F.struct((-ordinal).alias("age"), F.col("card_id").alias("card_id"))


def name_index(cards: DataFrame, name: str, group: str | None = None) -> DataFrame:
    """Per (name, mark): number of prints, the best one, and the span of name groups.

    At most one row per mark letter and name, whatever the number of prints.
    """
    group_key = F.coalesce(F.col(group), F.col("card_id").cast("string")) if group else F.lit("")
    named = cards.filter(F.col(name).isNotNull())
    return named.groupBy(F.col(name).alias("_name"), F.col("mark").alias("_mark")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_recency()).alias("_best"),
        F.min(group_key).alias("_g_min"), F.max(group_key).alias("_g_max"),
    )


def _candidates(probes: DataFrame, index: DataFrame, forms: Column) -> DataFrame:
    """Per probe (name, env_marks): summary of the first name form that has candidates."""
    forms_df = probes.select("name", "env_marks").distinct().withColumn("_f", F.explode(forms))
    in_env = F.coalesce(F.array_contains("env_marks", F.col("_mark")), F.lit(False))
    per_form = forms_df.join(index, F.col("_f.form") == F.col("_name")).groupBy("name", "env_marks", "_f").agg(
        F.sum("_n").alias("n"),
        F.min("_best").alias("any_best"),
        F.min(F.when(in_env, F.col("_best"))).alias("env_best"),
        F.min("_g_min").alias("g_min"),
        F.max("_g_max").alias("g_max"),
    )
    summary = F.struct("_f.alias", "n", "any_best", "env_best", "g_min", "g_max")
    return per_form.groupBy("name", "env_marks").agg(F.min_by(summary, F.col("_f.priority")).alias("c"))


def _join_back(probes: DataFrame, found: DataFrame) -> DataFrame:
    f = found.withColumnsRenamed({"name": "_probe", "env_marks": "_env"})
    return probes.join(f, (F.col("name") == F.col("_probe")) & F.col("env_marks").eqNullSafe(F.col("_env")), "left").drop(
        "_probe", "_env"
    )


def map_by_name(probes: DataFrame, index: DataFrame, stage: Column) -> DataFrame:
    """Name chain: exact, then without the basic-energy prefix, then without a trailing bracket.

    ``probes`` carry name and env_marks. Adds card_id and the rule label; several
    candidates are decided by environment, recency and id.
    """
    name = F.col("name")
    basic = name.startswith(x.BASIC_PREFIX)
    bare = x.strip_bracket_suffix(name)
    form = lambda p, alias, value: F.struct(F.lit(p).alias("priority"), F.lit(alias).alias("alias"), value.alias("form"))  # noqa: E731,E501
    forms = F.array_compact(F.array(
        form(0, "", name),
        F.when(basic, form(1, "basic_energy_alias", F.substr(name, F.lit(len(x.BASIC_PREFIX) + 1)))),
        F.when((bare != name) & (bare != ""), form(2, "paren_strip", bare)),
    ))
    joined = _join_back(probes, _candidates(probes, index, forms))
    unique, in_env = F.col("c.n") == 1, F.col("c.env_best").isNotNull()
    decided = F.when(unique, "unique").when(in_env, "env+latest").otherwise("latest")
    label = F.concat_ws("+", stage, F.nullif(F.col("c.alias"), F.lit("")), decided)
    best = F.when(~unique & in_env, F.col("c.env_best")).otherwise(F.col("c.any_best"))
    return joined.select(
        *probes.columns, best["card_id"].alias("card_id"),
        F.when(F.col("c").isNull(), "unmapped").otherwise(label).alias("rule"),
    )


def map_within_group(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Names with several candidates map only when all of them are in one name group."""
    exact = F.array(F.struct(F.lit(0).alias("priority"), F.lit("").alias("alias"), F.col("name").alias("form")))
    joined = _join_back(probes, _candidates(probes, index, exact))
    c = F.col("c")
    unique, in_env, split = c["n"] == 1, c["env_best"].isNotNull(), c["g_min"] != c["g_max"]
    rule = (
        F.when(F.coalesce(F.col("name"), F.lit("")) == "", "unknown_card_id").when(c.isNull(), "ja_name+unmapped")
        .when(unique, "ja_name+unique").when(split, "ja_name+ambiguous").when(in_env, "ja_name+group_env")
        .otherwise("ja_name+group_latest")
    )
    best = F.when(~unique & in_env, c["env_best"]).otherwise(c["any_best"])
    return joined.select(
        *probes.columns, F.when(~rule.isin("ja_name+ambiguous", "unknown_card_id"), best["card_id"]).alias("card_id"), rule.alias("rule")
    )


def set_bridge(ours: DataFrame, theirs: DataFrame, overrides: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """code -> main and subset id by normalised set name.

    ``ours``: code, name; ``theirs``: set_id, name. Of several names under one
    code the shortest is the main set and the second shortest the subset.
    """
    right = theirs.select(x.normalise_name("name").alias("_norm"), "set_id")
    joined = ours.withColumn("_norm", x.normalise_name("name")).join(right, "_norm")
    by_length = Window.partitionBy("code").orderBy(F.length("name"), "name", "set_id")
    two = joined.withColumn("_rn", F.row_number().over(by_length)).filter(F.col("_rn") <= 2)
    bridge = two.groupBy("code").agg(
        F.max(F.when(F.col("_rn") == 1, F.col("set_id"))).alias("main_id"),
        F.max(F.when(F.col("_rn") == 2, F.col("set_id"))).alias("subset_id"),
    )
    if overrides:
        fixed = lookup(F.col("code"), dict(overrides))
        bridge = bridge.withColumn("main_id", F.coalesce(fixed, F.col("main_id")))
    return bridge


def names_equivalent(ours: Column, theirs: Column) -> Column:
    """Equal after normalisation; their trailing bracket and our 'Prism Star' do not count."""
    norm = F.regexp_replace(x.normalise_name(ours), "prismstar$", "")
    return norm == x.normalise_name(F.regexp_replace(theirs, r"\s*\([^)]*\)\s*$", ""))


def resolve_variants(items: DataFrame, bridge: DataFrame, cards: DataFrame) -> DataFrame:
    """External ids (set_code, number, name) -> target card over the ladder of written forms.

    Forms in order: as written, three digits, the only letter-prefixed id with
    these digits, then prefixed ids in main set and subset with two and three
    digits. ``cards``: set_id, local_id, card_id, card_name.
    """
    exact = cards.select("set_id", F.concat(F.lit("="), "local_id").alias("_key"), "card_id", "card_name")
    digits = F.regexp_extract("local_id", r"^[A-Za-z]+(\d+)$", 1)
    tails = cards.filter(digits != "").groupBy("set_id", F.concat(F.lit("~"), stripped_number(digits)).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("card_id").alias("card_id"), F.min("card_name").alias("card_name")
    )
    index = exact.unionByName(tails.filter(F.col("_n") == 1).drop("_n"))

    number, main, sub = F.col("number"), F.col("main_id"), F.col("subset_id")
    plain = number.rlike(r"^\d+$")
    letters, tail = F.regexp_extract(number, r"^([A-Za-z]+)\d+$", 1), F.regexp_extract(number, r"^[A-Za-z]+(\d+)$", 1)

    def trial(priority: int, set_id: Column, key: Column, when: Column | None = None) -> Column:
        s = F.struct(F.lit(priority).alias("p"), set_id.alias("s"), key.alias("k"))
        return s if when is None else F.when(when, s)

    eq = lambda col: F.concat(F.lit("="), col)
    pad = lambda col, width: F.when(F.length(col) >= width, col).otherwise(F.lpad(col, width, "0"))
    steps = [trial(0, main, eq(number)), trial(1, main, eq(pad(number, 3)), plain),
             trial(2, main, F.concat(F.lit("~"), stripped_number(number)), plain)]
    for i, set_id in enumerate((main, sub)):
        for j, local in enumerate((number, F.concat(letters, pad(tail, 2)), F.concat(letters, pad(tail, 3)))):
            steps.append(trial(3 + 3 * i + j, set_id, eq(local), (letters != "") & set_id.isNotNull()))

    probes = items.select("set_code", "number").distinct().join(bridge, F.col("set_code") == F.col("code"), "left").drop("code")
    trials = probes.filter(main.isNotNull()).withColumn("_t", F.explode(F.array_compact(F.array(*steps))))
    found = trials.join(index, (F.col("_t.s") == index["set_id"]) & (F.col("_t.k") == index["_key"])).groupBy("set_code", "number").agg(
        F.min_by(F.struct("card_id", "card_name"), F.col("_t.p")).alias("_hit")
    )
    known = probes.select("set_code", "number", main.isNotNull().alias("_bridged"))
    summary = known.join(found, ["set_code", "number"], "left")
    joined = items.join(summary, ["set_code", "number"], "left")
    same = names_equivalent(F.coalesce("name", F.lit("")), F.coalesce("_hit.card_name", F.lit("")))
    outcome = (
        F.when(~F.coalesce("_bridged", F.lit(False)), "unmapped_set").when(F.col("_hit").isNull(), "missing_card")
        .when(same, "resolved").otherwise("name_mismatch")
    )
    return joined.select(*items.columns, F.col("_hit.card_id").alias("target_id"), outcome.alias("outcome"))


def enrich_flag(cards: DataFrame, bridges: DataFrame, set_map: DataFrame, flags: DataFrame) -> DataFrame:
    """card -> flag of the bridged print; classes no_bridge / unmapped_set / missing_card keep the old flag.

    ``bridges``: card_id, set_code, ext_number. ``flags``: ext_set, number, flag;
    duplicates of one number are true when any is.
    """
    any_flag = flags.groupBy("ext_set", stripped_number(F.col("number")).alias("_num")).agg(F.bool_or("flag").alias("_flag"))
    joined = (
        cards.join(bridges, "card_id", "left").join(set_map, "set_code", "left")
        .withColumn("_num", stripped_number(F.col("ext_number"))).join(any_flag, ["ext_set", "_num"], "left")
    )
    state = (
        F.when(F.col("set_code").isNull(), "no_bridge").when(F.col("ext_set").isNull(), "unmapped_set")
        .when(F.col("_flag").isNull(), "missing_card").when(F.col("_flag"), "flagged").otherwise("resolved_negative")
    )
    return joined.select("card_id", F.coalesce("_flag", "flag").alias("flag"), state.alias("state"))


@dataclass(frozen=True)
class NameRules:
    """Word maps of the composed-name translation; longer phrases are tried first."""

    prefixes: dict[str, str] = field(default_factory=dict)
    suffixes: dict[str, str] = field(default_factory=dict)
    modifiers: dict[str, str] = field(default_factory=dict)
    owners: dict[str, str] = field(default_factory=dict)
    whole_names: dict[str, str] = field(default_factory=dict)
    variant_letters: tuple[str, ...] = ("X", "Y")
    joiner: str = "&"


JAPANESE_NAMES = NameRules(v.JA_PREFIXES, v.JA_SUFFIXES, v.JA_MODIFIERS, v.JA_OWNERS, v.JA_BASIC_ENERGIES)


def _longest_first(words: dict[str, str]) -> list[tuple[str, str]]:
    return sorted(words.items(), key=lambda w: -len(w[0]))


def _alternation(words: dict[str, str]) -> str:
    return "|".join(rf"\Q{w}\E" for w, _ in _longest_first(words)) or r"(?!)"


def compose_names(cards: DataFrame, species: DataFrame, rules: NameRules) -> DataFrame:
    """Translate composed names part by part; every part must be a species of the card's id pool.

    ``cards``: card_id, name, dex_ids; ``species``: dex, name, translated. With an
    empty pool a single part may be found by its unique name. NULL when any
    part is not covered.
    """
    clean = F.trim(F.regexp_replace("name", "​", ""))
    whole = lookup(clean, rules.whole_names) if rules.whole_names else F.lit(None).cast("string")
    stem, ending = clean, F.lit("")
    for written, translated in reversed(_longest_first(rules.suffixes)):
        hit = clean.endswith(written)
        stem = F.when(hit, F.substr(clean, F.lit(1), F.length(clean) - F.lit(len(written)))).otherwise(stem)
        ending = F.when(hit, F.lit(translated)).otherwise(ending)
    base = cards.select("card_id", "dex_ids", whole.alias("_whole"), ending.alias("_ending"), F.split(stem, " & ").alias("_parts"))
    parts = base.select(
        "card_id", "dex_ids", F.size("_parts").alias("_n"), F.posexplode("_parts").alias("_pos", "_raw")
    ).withColumn("_c", F.trim("_raw"))

    if rules.modifiers:
        modifier = F.nullif(F.regexp_extract("_c", rf"^({_alternation(rules.modifiers)}) ", 1), F.lit(""))
        post = F.coalesce(F.concat(F.lit(" "), lookup(modifier, rules.modifiers)), F.lit(""))
        rest = F.when(modifier.isNotNull(), F.substr("_c", F.length(modifier) + F.lit(2))).otherwise(F.col("_c"))
    else:
        post, rest = F.lit(""), F.col("_c")
    parts = parts.withColumn("_post", post).withColumn("_c", rest)
    if rules.prefixes:
        alternation = _alternation(rules.prefixes)
        lead = F.regexp_extract("_c", rf"^((?:(?:{alternation}) )*)", 1)
        table = F.create_map(*[F.lit(w) for pair in rules.prefixes.items() for w in pair])
        words = F.regexp_extract_all(lead, F.lit(rf"({alternation}) "), F.lit(1))
        parts = parts.withColumn("_pre", F.array_join(F.transform(words, lambda w: table[w]), "")).withColumn(
            "_c", F.substr("_c", F.length(lead) + F.lit(1))
        )
    else:
        parts = parts.withColumn("_pre", F.lit(""))
    owned = r"^([A-Za-z][A-Za-z. ]*?)'s\s+"
    owner = F.nullif(F.regexp_extract("_c", owned, 1), F.lit(""))
    owner_word = lookup(owner, rules.owners) if rules.owners else F.lit(None).cast("string")
    variant_form = rf"^(.+) ([{''.join(rules.variant_letters)}])$"
    parts = (
        parts.withColumn("_owner", owner).withColumn("_owner_word", owner_word)
        .withColumn("_c", F.regexp_replace("_c", owned, ""))
        .withColumn("_variant", F.regexp_extract("_c", variant_form, 2))
        .withColumn("_core", x.normalise_name(F.when(F.col("_variant") != "", F.regexp_extract("_c", variant_form, 1)).otherwise(F.col("_c"))))
    )
    known = species.select(x.normalise_name("name").alias("_core"), F.col("dex"), F.col("translated"))
    pool_empty = F.size("dex_ids") == 0
    hits = parts.join(known, "_core", "left").withColumn(
        "_ok",
        F.coalesce(F.array_contains("dex_ids", F.col("dex")), F.lit(False)) | (pool_empty & (F.col("_n") == 1) & F.col("dex").isNotNull()),
    )
    one = hits.groupBy("card_id", "_pos", "_n", "_pre", "_post", "_variant", "_owner", "_owner_word").agg(
        F.min_by("translated", F.when(F.col("_ok"), F.col("dex"))).alias("_word"), F.max("_ok").alias("_ok")
    )
    owner_ok = F.col("_owner").isNull() | F.col("_owner_word").isNotNull()
    owner_text = F.coalesce(F.concat("_owner_word", F.lit("の")), F.lit(""))
    piece = F.when(F.col("_ok") & owner_ok, F.concat("_pre", owner_text, "_word", "_variant", "_post"))
    whole_name = one.groupBy("card_id").agg(
        F.max("_n").alias("_n"), F.count(piece).alias("_found"),
        F.array_sort(F.collect_list(F.struct("_pos", piece.alias("w")))).alias("_pieces"),
    )
    joined = base.select("card_id", "_whole", "_ending").join(whole_name, "card_id")
    built = F.concat(F.array_join(F.transform("_pieces", lambda p: p["w"]), rules.joiner), F.col("_ending"))
    return joined.select(
        "card_id", F.coalesce("_whole", F.when(F.col("_found") == F.col("_n"), built)).alias("translated")
    )


def number_key(local_id: Column) -> Column:
    """'TG02' -> 'TG2', '045' -> '45'; NULL for other forms."""
    letters, tail = F.regexp_extract(local_id, r"^([A-Za-z]*)\d+$", 1), F.regexp_extract(local_id, r"^[A-Za-z]*(\d+)$", 1)
    return F.when(tail != "", F.concat(F.upper(letters), stripped_number(tail)))


def bridge_ids(cards: DataFrame, set_map: DataFrame, ids: DataFrame, order: str) -> DataFrame:
    """(set, local id) -> id array of the bridged set; the last row in ``order`` wins a number."""
    keyed = ids.join(set_map, "ext_set").withColumn("_key", number_key(F.col("number"))).filter(F.col("_key").isNotNull())
    index = keyed.groupBy("set_id", "_key").agg(F.max_by("ids", F.col(order)).alias("ids"))
    return cards.withColumn("_key", number_key(F.col("local_id"))).join(index, ["set_id", "_key"], "left").drop("_key")


def vocab_fill(cards: DataFrame, vocab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(card outcome and new name, vocabulary use).

    ``cards``: card_id, name_full, name_en, name_ja. ``vocab``: en, ja, cn. A
    vocabulary name without ``cn`` is ambiguous when the cards under it have
    several own names; an existing different value is kept as a conflict.
    """
    spread = cards.filter(F.col("name_en").isNotNull()).groupBy("name_en").agg(
        F.min("name_full").alias("_lo"), F.max("name_full").alias("_hi")
    )
    per_name = vocab.groupBy(F.col("en").alias("name_en")).agg(F.max(F.col("cn").isNull()).alias("_open"))
    status = spread.join(per_name, "name_en").select(
        "name_en", (F.col("_open") & (F.col("_lo") != F.col("_hi"))).alias("_ambiguous")
    )
    # an entry for the card's own name comes before one for the English name alone
    exact = vocab.filter(F.col("cn").isNotNull()).select(F.col("en").alias("_en1"), F.col("cn").alias("_cn"), F.col("ja").alias("_ja1"))
    general = vocab.filter(F.col("cn").isNull()).select(F.col("en").alias("_en2"), F.col("ja").alias("_ja2"))
    clear = ~F.col("_ambiguous")
    joined = cards.join(status, "name_en", "left").join(
        exact, (F.col("name_en") == F.col("_en1")) & (F.col("name_full") == F.col("_cn")) & clear, "left"
    ).join(general, (F.col("name_en") == F.col("_en2")) & clear, "left")
    joined = joined.withColumn("ja", F.coalesce("_ja1", "_ja2"))
    state = (
        F.when(F.col("name_en").isNull(), "no_en_bridge").when(F.col("_ambiguous").isNull(), "vocab_miss")
        .when(F.col("_ambiguous"), "ambiguous").when(F.col("ja").isNull(), "vocab_miss")
        .when(F.col("name_ja").isNull(), "filled").when(F.col("name_ja") == F.col("ja"), "already").otherwise("conflict")
    )
    out = joined.select("card_id", F.coalesce("name_ja", "ja").alias("name_ja"), state.alias("state"))
    used = joined.filter(F.col("ja").isNotNull()).groupBy(F.col("name_en").alias("_en"), "_cn").agg(F.count(F.lit(1)).alias("cards"))
    usage = vocab.select("en", "cn").join(used, (F.col("en") == F.col("_en")) & F.col("cn").eqNullSafe(F.col("_cn")), "left")
    return out, usage.select("en", "cn", F.coalesce("cards", F.lit(0)).alias("cards"))


def vocab_anchor_check(vocab: DataFrame, names: DataFrame) -> DataFrame:
    """Vocabulary values that are neither known names nor exempt."""
    return vocab.filter(~F.col("exempt")).join(names.select(F.col("name").alias("ja")).distinct(), "ja", "left_anti")


def bridge_fill(cards: DataFrame, bridge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(card with its bridged name and state, coverage per set). ``bridge``: card_id, bridged_name, external_id."""
    joined = cards.join(bridge, "card_id", "left")
    state = (
        F.when(F.col("bridged_name").isNull(), "no_bridge").when(F.col("name_en") == F.col("bridged_name"), "already").otherwise("filled")
    )
    out = joined.select("card_id", "set_id", F.coalesce("bridged_name", "name_en").alias("name_en"), "external_id", state.alias("state"))
    coverage = out.groupBy("set_id").agg(F.count_if(F.col("state") != "no_bridge").alias("mapped"), F.count(F.lit(1)).alias("total"))
    return out, coverage


def reconcile_sets(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Both catalogues side by side. ours: set_id, name, n; theirs: set_id, name, n."""
    o = ours.select("set_id", F.col("name").alias("our_name"), F.col("n").alias("our_n"), F.lit(True).alias("_o"))
    t = theirs.select("set_id", F.col("name").alias("their_name"), F.col("n").alias("their_n"), F.lit(True).alias("_t"))
    status = (
        F.when(F.col("_o").isNull(), "missing_in_ours").when(F.col("_t").isNull(), "missing_in_theirs")
        .when(F.col("their_n") != F.col("our_n"), "count_diff")
        .when((F.col("our_name") != F.col("their_name")) & (F.col("our_name") != "") & (F.col("their_name") != ""), "name_diff")
        .otherwise("ok")
    )
    return o.join(t, "set_id", "full_outer").select("set_id", "our_n", "their_n", status.alias("status"))


def resolve_parents(cards: DataFrame) -> DataFrame:
    """Parent by exact name in the set, then species in the set, then the same in the whole catalogue.

    ``cards``: card_id, set_id, name_full, species (NULL unless of the evolving
    type), parent_name. The smallest other id wins. Two smallest ids per key are
    enough to leave the card itself out.
    """
    def index(key: str, *scope: str) -> DataFrame:
        keyed = cards.filter(F.col(key).isNotNull()).select(*scope, F.col(key).alias("_k"), "card_id")
        first = Window.partitionBy(*scope, "_k").orderBy("card_id")
        two = keyed.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= 2)
        return two.groupBy(*scope, "_k").agg(
            F.min("card_id").alias("_a"), F.max(F.when(F.col("_rn") == 2, F.col("card_id"))).alias("_b")
        )

    def attach(df: DataFrame, key: str, scope: Sequence[str], out: str) -> DataFrame:
        idx = index(key, *scope)
        cond = F.col("parent_name") == idx["_k"]
        for s in scope:
            cond = cond & (df[s] == idx[s])
        joined = df.join(idx, cond, "left")
        other = F.when(F.col("_a") == F.col("card_id"), F.col("_b")).otherwise(F.col("_a"))
        return joined.select(*[df[c] for c in df.columns], other.alias(out), F.col("_k").isNotNull().alias(f"{out}_any"))

    df = cards.filter(F.col("parent_name").isNotNull())
    df = attach(df, "name_full", ["set_id"], "in_set_name")
    df = attach(df, "species", ["set_id"], "in_set_species")
    df = attach(df, "name_full", [], "all_name")
    df = attach(df, "species", [], "all_species")
    # a name with any print shadows the species, even when that print is the card itself
    in_set = F.when(F.col("in_set_name_any"), F.col("in_set_name")).otherwise(F.col("in_set_species"))
    anywhere = F.when(F.col("all_name_any"), F.col("all_name")).otherwise(F.col("all_species"))
    how = F.when(in_set.isNotNull(), "in_set").when(anywhere.isNotNull(), "catalogue").otherwise("unresolved")
    return df.select("card_id", F.coalesce(in_set, anywhere).alias("parent_id"), how.alias("how"))


def _marks(at: Column, word: Column) -> list[Column]:
    """Two hashes of a word at its place; the exclusive or over a path's start tells prefixes apart."""
    return [F.xxhash64(F.lit(salt), at, word) for salt in (1, 2)]


def longest_prefix(keys: DataFrame, targets: DataFrame) -> DataFrame:
    """key (array) -> target with the longest prefix equal to its own array.

    ``keys``: key_id (unique), path (any length); ``targets``: target_id, path.
    Every prefix of a key up to the longest target is two running hashes, 16
    bytes whatever its length, and meets the targets of that length by equality.
    Only the longest match of a key is compared as words, once; a collision of
    128 bits would be an error, not a wrong row.
    """
    longest = targets.agg(F.coalesce(F.max(F.size("path")), F.lit(0))).first()[0]
    # no target tells words beyond the longest one apart: paths are made once, and only their starts are written and moved
    keys = stored_rows(keys.select("key_id", F.slice("path", 1, max(longest, 1)).alias("path")), "prefix-starts")
    heads = keys.filter(F.size("path") > 0).select("key_id", F.posexplode("path").alias("_at", "_word"))
    a, b = _marks(F.col("_at"), F.col("_word"))
    so_far = Window.partitionBy("key_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = heads.select("key_id", "_at", a.alias("_a"), b.alias("_b"))
    prefixes = marked.select("key_id", "_at", F.bit_xor("_a").over(so_far).alias("_a"), F.bit_xor("_b").over(so_far).alias("_b"))
    whole = lambda which: F.aggregate(
        F.transform("path", lambda w, i: _marks(i, w)[which]), F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(h)
    )
    aims = targets.filter(F.size("path") > 0).select("target_id", (F.size("path") - 1).alias("_at"), whole(0).alias("_a"), whole(1).alias("_b"))
    met = prefixes.join(aims, ["_at", "_a", "_b"])
    hits = met.groupBy("key_id").agg(F.max(F.struct("_at", "target_id")).alias("_hit")).select(
        "key_id", F.col("_hit.target_id").alias("target_id"), (F.col("_hit._at") + 1).alias("depth")
    )
    found = keys.join(hits, "key_id", "left").join(targets.select("target_id", F.col("path").alias("_path")), "target_id", "left")
    same = F.slice("path", 1, F.greatest("depth", F.lit(0))) == F.col("_path")
    checked = F.when(F.col("target_id").isNull() | same, F.col("depth")).otherwise(F.raise_error(F.lit("two prefixes of one hash")).cast("int"))
    return found.select("key_id", "target_id", checked.alias("depth"))


def dangling(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    refs = parent.select(F.col(parent_key).alias("_ref"))
    return child.filter(F.col(key).isNotNull()).join(refs, F.col(key) == F.col("_ref"), "left_anti")


def mark_aliases(cards: DataFrame) -> DataFrame:
    """A letter-numbered card with exactly one numeric twin (same set and name) is its alias, else a question.

    ``cards``: card_id, set_id, name_full, number.
    """
    numeric = F.col("number").rlike(r"^\d+$")
    twins = cards.filter(numeric).groupBy("set_id", "name_full").agg(
        F.count(F.lit(1)).alias("twins"), F.min("card_id").alias("_twin")
    )
    joined = cards.filter(~numeric).join(twins, ["set_id", "name_full"], "left")
    reason = F.when(F.col("twins").isNull(), "no_twin").when(F.col("twins") > 1, "several_twins")
    return joined.select("card_id", F.when(F.col("twins") == 1, F.col("_twin")).alias("alias_of"), reason.alias("question"))

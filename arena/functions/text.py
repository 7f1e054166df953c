"""Name, code, date and tag expressions. All JVM-side but ``normalise_name``."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arena.functions.literals import Needs, needs_of
from arena.functions.vocab import ENERGY_CODES, RULE_SUFFIXES

# Forms of written suffixes.
BRACKET_SUFFIX = r"\s*\([^()]*\)\s*$"
EDITION_SUFFIX = r"(?i)\s*[(（]ACE SPEC[)）]\s*$"
SET_SUFFIX = r"\s*[（(]([A-Za-z0-9.\-]+)\s+([^）)]*)[）)]\s*$"
BASIC_PREFIX = "Basic "

COST_TYPE = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("count", T.IntegerType())]))


def owner_prefix(name: Column, owners: Sequence[str], joiner: str = "的") -> Column:
    """First owner whose ``owner + joiner`` starts the name, else NULL."""
    out = F.lit(None).cast("string")
    for owner in reversed(owners):
        out = F.when(name.startswith(owner + joiner), F.lit(owner)).otherwise(out)
    return out


def species_name(
    name: Column, owners: Sequence[str], joiner: str = "的", suffixes: Sequence[str] = RULE_SUFFIXES
) -> Column:
    """Name without its owner prefix and without the first rule suffix that matches."""
    owner = owner_prefix(name, owners, joiner)
    rest = F.when(owner.isNull(), name).otherwise(F.substr(name, F.length(owner) + F.lit(len(joiner) + 1)))
    out = rest
    for suffix in reversed(suffixes):
        cut = F.substr(rest, F.lit(1), F.length(rest) - F.lit(len(suffix)))
        out = F.when(rest.endswith(suffix), cut).otherwise(out)
    return out


def name_group_key(name: Column, bases: Sequence[str], opener: str = "（") -> Column:
    """A base or ``base(...)`` folds to the base; every other name is its own group."""
    out = name
    for base in reversed(bases):
        out = F.when((name == base) | name.startswith(base + opener), F.lit(base)).otherwise(out)
    return out


def cost_is_known(cost: Column, codes: dict[str, str] = ENERGY_CODES) -> Column:
    """False when a code letter is not in the vocabulary (also a '+' before the end)."""
    letters = "".join(codes)
    return cost.isNull() | cost.rlike(rf"^(0?|[{letters}]*)\+?$")


def cost_modifier(cost: Column) -> Column:
    return F.when(cost.endswith("+"), F.lit("+"))


def run_length_cost(cost: Column, codes: dict[str, str] = ENERGY_CODES) -> Column:
    """'WWC+' -> [{W,2},{C,1}] in order; '', '0' and '0+' -> []."""
    body = F.regexp_replace(F.coalesce(cost, F.lit("")), r"\+$|^0\+?$", "")
    runs = F.regexp_extract_all(body, F.lit("(" + "|".join(f"{c}+" for c in codes) + ")"), F.lit(1))
    names = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.transform(
        runs, lambda r: F.struct(names[F.substr(r, F.lit(1), F.lit(1))].alias("type"), F.length(r).alias("count"))
    ).cast(COST_TYPE)


# Fixed value: form of an amount with its modifier.
AMOUNT = r"^(\d+)([+\-×])?$"


def amount_base(text: Column) -> Column:
    return F.regexp_extract(F.trim(text), AMOUNT, 1).try_cast("int")


def amount_modifier(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(text), AMOUNT, 2), F.lit(""))


def amount_is_known(text: Column) -> Column:
    return text.isNull() | (text == "") | F.trim(text).rlike(AMOUNT)


def _normalise(value: str | None) -> str | None:
    if value is None:
        return None
    folded = unicodedata.normalize("NFKD", value.casefold())
    return "".join(c for c in folded if ("a" <= c <= "z") or ("0" <= c <= "9"))


@F.pandas_udf(T.StringType())
def _decomposed(names: pd.Series) -> pd.Series:
    return names.map(_normalise)


def normalise_name(name: Column | str) -> Column:
    """Case fold, decompose, drop marks and everything but [a-z0-9].

    Spark has no such decomposition, so names beyond ASCII go to Python; the others stay.
    """
    name = F.col(name) if isinstance(name, str) else name
    plain = name.rlike(r"^\p{ASCII}*$")
    return F.when(plain, F.regexp_replace(F.lower(name), "[^a-z0-9]", "")).otherwise(_decomposed(F.when(~plain, name)))


def strip_bracket_suffix(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, BRACKET_SUFFIX, ""))


def strip_edition_marker(name: Column) -> Column:
    return F.regexp_replace(F.trim(name), EDITION_SUFFIX, "")


def set_suffix(name: Column) -> Column:
    """'name(SET 079/098)' -> struct(name, set, number, total); parts are NULL when absent."""
    base = strip_edition_marker(name)
    code = F.nullif(F.regexp_extract(base, SET_SUFFIX, 1), F.lit(""))
    tail = F.regexp_extract(base, SET_SUFFIX, 2)
    halves = F.split(tail, "/", 2)
    number = F.when(code.isNotNull(), F.trim(F.get(halves, F.lit(0))))
    total = F.when(code.isNotNull(), F.trim(F.get(halves, F.lit(1))))
    return F.struct(
        F.trim(F.regexp_replace(base, SET_SUFFIX, "")).alias("name"),
        code.alias("set"), number.alias("number"), total.alias("total"),
    )


def season_start(day: Column) -> Column:
    return F.year(day) - F.when(F.month(day) >= 8, 0).otherwise(1)


def season_text(start: Column) -> Column:
    two = lambda y: F.lpad((F.pmod(y, F.lit(100))).cast("string"), 2, "0")
    return F.concat(two(start), two(start + 1))


def season_label(day: Column) -> Column:
    """August to July season: 2026-04-09 -> '2526'."""
    return season_text(season_start(day))


def seasons_spanned(first: Column, last: Column) -> Column:
    return F.transform(F.sequence(season_start(first), season_start(last)), season_text)


# English month abbreviations of result pages.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
DAY_MONTH_YEAR = r"(\d{1,2})\s+([A-Za-z]{3})\s+(\d{2})\b"


def text_date(text: Column) -> Column:
    """ISO prefix first, else '10 Jun 26' (two-digit years up to 50 are 20xx), else NULL."""
    iso = F.try_to_date(F.nullif(F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")
    day = F.regexp_extract(text, DAY_MONTH_YEAR, 1)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(text, DAY_MONTH_YEAR, 2)))
    yy = F.regexp_extract(text, DAY_MONTH_YEAR, 3).try_cast("int")
    year = yy + F.when(yy <= 50, 2000).otherwise(1900)
    written = F.format_string("%04d-%02d-%02d", year, month.cast("int"), day.try_cast("int"))
    return F.coalesce(iso, F.when(yy.isNotNull() & (month > 0), F.try_to_date(written, "yyyy-MM-dd")))


def first_match(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule whose pattern is found, ignoring case; NULL without one."""
    out = F.lit(None).cast("string")
    for label, pattern in reversed(rules):
        out = F.when(text.rlike(f"(?i){pattern}"), F.lit(label)).otherwise(out)
    return out


Has = Callable[[str, bool], Column]


def inline_has(text: Column) -> Has:
    """Tells whether a literal occurs, in lower case where asked, by a byte search of its own."""
    return lambda literal, folded: F.contains(F.lower(text) if folded else text, F.lit(literal))


def pattern_found(text: Column, needs: Needs, has: Has) -> Column:
    """True where the pattern is found; the expression runs only on texts that have all its literals."""
    out = None
    for one in needs.sets:
        any_of = None
        for literal in sorted(one):
            any_of = has(literal, needs.folded) if any_of is None else any_of | has(literal, needs.folded)
        out = any_of if out is None else out & any_of
    if needs.exact:
        return out
    run = text.rlike(needs.pattern)
    return run if out is None else out & run


def regex_tags(
    text: Column, tags: Sequence[tuple[str, Sequence[str], str | None]], kind: Column | None = None, has: Has | None = None
) -> Column:
    """All tags hit, in vocabulary order, from one pass over the rows.

    A tag may be limited to a scope; scope 'pokemon' covers attacks and abilities.
    """
    has = has or inline_has(text)
    hits = []
    for tag, patterns, scope in tags:
        needs = sorted((needs_of(p) for p in patterns), key=lambda n: (not n.exact, not n.sets))  # byte searches first
        found = F.lit(False)
        for one in needs:
            found = found | pattern_found(text, one, has)
        if scope is not None and kind is not None:
            kinds = ["attack", "ability"] if scope == "pokemon" else [scope]
            found = kind.isin(*kinds) & found
        hits.append(F.when(found, F.lit(tag)))
    return F.array_compact(F.array(*hits))

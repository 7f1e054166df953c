"""Regex tagging of texts and its coverage report."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arena.functions.literals import needs_of
from arena.functions.text import Has, regex_tags

Vocabulary = Sequence[tuple[str, Sequence[str], "str | None"]]


def literal_columns(df: DataFrame, text: str, vocabularies: Sequence[Vocabulary]) -> tuple[DataFrame, Has]:
    """Adds one truth column for each literal that several patterns need, and tells how to ask for any literal."""
    uses: Counter[tuple[str, bool]] = Counter()
    for tags in vocabularies:
        for _, patterns, _ in tags:
            for needs in map(needs_of, patterns):
                uses.update({(literal, needs.folded) for one in needs.sets for literal in one})
    if any(folded for _, folded in uses):
        df = df.withColumn("_low", F.lower(text))
    search = lambda literal, folded: F.contains(F.col("_low" if folded else text), F.lit(literal))
    shared = {use: f"_has{i}" for i, use in enumerate(sorted(u for u, n in uses.items() if n > 1))}
    df = df.withColumns({name: search(*use) for use, name in shared.items()}) if shared else df
    return df, lambda literal, folded: F.col(shared[literal, folded]) if (literal, folded) in shared else search(literal, folded)


def tag_texts(df: DataFrame, text: str, tags: Vocabulary, flags: Vocabulary = (), kind: str | None = None) -> DataFrame:
    """Adds ``tags`` and ``flags`` arrays; whole texts, one pass. A text runs the patterns whose literals it has, and no other."""
    k = F.col(kind) if kind else None
    marked, has = literal_columns(df, text, [tags, flags])
    flag_col = regex_tags(F.col(text), flags, has=has) if flags else F.array().cast("array<string>")
    return marked.select(*df.columns, regex_tags(F.col(text), tags, k, has).alias("tags"), flag_col.alias("flags"))


def card_texts(cards: DataFrame) -> DataFrame:
    """(card_id, kind, who, text) of active cards: rule text of trainer and energy cards, every attack and ability.

    ``cards``: card_id, name_full, card_type, status, text_raw, attacks and
    abilities (arrays of name, effect_text, text).
    """
    line = lambda kind, who, text: F.struct(kind.alias("kind"), who.alias("who"), F.trim(F.coalesce(text, F.lit(""))).alias("text"))
    owner = lambda x: F.concat(F.col("name_full"), F.lit("/"), F.coalesce(x["name"], F.lit("")))
    listed = lambda col, kind, text: F.transform(F.coalesce(F.col(col), F.array().cast(cards.schema[col].dataType)), lambda x: line(F.lit(kind), owner(x), text(x)))  # noqa: E731,E501
    own = F.when(F.col("card_type").isin("trainer", "energy"), F.array(line(F.col("card_type"), F.col("name_full"), F.col("text_raw")))).otherwise(F.array())
    attacks = listed("attacks", "attack", lambda x: x["effect_text"])
    abilities = listed("abilities", "ability", lambda x: F.coalesce(F.nullif(x["effect_text"], F.lit("")), x["text"]))
    rows = cards.filter(F.col("status") == "active").select("card_id", F.explode(F.concat(own, attacks, abilities)).alias("r"))
    return rows.select("card_id", "r.*").filter(F.col("text") != "")


def distinct_tagged(df: DataFrame, key: str, text: str, tags: Vocabulary, flags: Vocabulary = (), kind: str | None = None) -> DataFrame:
    """One row per distinct trimmed text (first key wins), tagged.

    Texts are tagged before the shuffle and deduplicated by hash, so only
    hashes and tags move between tasks.
    """
    cleaned = df.withColumn(text, F.trim(text)).filter(F.col(text) != "")
    tagged = tag_texts(cleaned, text, tags, flags, kind)
    return tagged.groupBy(F.sha2(text, 256).alias("text_hash")).agg(
        F.min(key).alias(key), F.min_by("tags", key).alias("tags"), F.min_by("flags", key).alias("flags")
    )


MULTI_HIT = 3  # tags from which on a text is listed as one of many effects


def tag_coverage(distinct: DataFrame, key: str | None = None) -> DataFrame:
    """(section, label, n): totals, covered, multi-hit, zero-hit, and hits per tag and flag.

    With ``key``, which names a distinct text, also the lists: sections zero_hit
    and multi_hit with the key as label and its number of tags. One pass.
    """
    line = lambda section, label, n: F.struct(F.lit(section).alias("section"), label.alias("label"), n.cast("long").alias("n"))
    size, one = F.size("tags"), F.lit(1)
    totals = {"total": one, "covered": (size > 0).cast("int"), "multi_hit": (size >= MULTI_HIT).cast("int"), "zero_hit": (size == 0).cast("int")}
    parts = [
        F.array(*[line("texts", F.lit(label), n) for label, n in totals.items()]),
        F.transform("tags", lambda x: line("tags", x, one)), F.transform("flags", lambda x: line("flags", x, one)),
    ]
    if key is not None:
        name = F.col(key).cast("string")
        listed = F.when(size == 0, line("zero_hit", name, size)).when(size >= MULTI_HIT, line("multi_hit", name, size))
        parts.append(F.array_compact(F.array(listed)))
    # totals are rows even where they are zero
    zeros = distinct.sparkSession.createDataFrame([("texts", label, 0) for label in totals], "section string, label string, n long")
    counted = distinct.select(F.explode(F.concat(*parts)).alias("r")).select("r.*").unionByName(zeros)
    return counted.groupBy("section", "label").agg(F.sum("n").alias("n"))

"""URL filter: pattern rules indexed by their rarest literal token.

A rule can only fit a url that holds all of its literal tokens, so it is filed
under one of them: the one that the fewest urls hold. The tokens of a url fetch
candidate rules from that index, and only the candidates run their regular
expression. Rules without a literal token are filed under the empty token, which
every url holds.

Defined cases: a null url, or one without ``://``, has an empty host and path
and fits no rule with a literal; repeated pages are judged row by row; equally
long fitting rules are decided by their text; no rules or no urls are fine.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a rule list up to this many rows is sent to every task; beyond it the join shuffles
BROADCAST_RULES = 50_000


@dataclass(frozen=True)
class UrlRule:
    """``regex`` is searched in host + path; ``literals`` are strings whose tokens every match holds whole."""

    name: str | None
    action: str
    regex: str
    literals: tuple[str, ...]
    weight: int


def site_rule(action: str, host: str, path: str) -> UrlRule:
    """Fits the host and its subdomains when the path starts with ``path``; longer rules outweigh shorter ones."""
    # the last token of a path prefix may go on in the url unless a delimiter ends it
    whole = path if re.search(r"[^a-z0-9]$", path.lower()) else re.sub(r"[A-Za-z0-9]+$", "", path)
    return UrlRule(host + path, action, rf"^(?:[^/]*\.)?\Q{host}\E\Q{path}\E", (host, whole), 1_000 + len(host + path))


def word_rule(action: str, word: str) -> UrlRule:
    """Fits urls that hold ``word`` between delimiters; weaker than every site rule."""
    return UrlRule(None, action, rf"(?i)(?:^|[^a-z0-9])\Q{word}\E(?:[^a-z0-9]|$)", (word,), len(word))


# fixed values: site types that are of no use as training text
BLOCKED_WORDS = ("casino", "porn", "xxx", "torrent", "escort", "viagra", "betting", "warez")
WORD_RULES = tuple(word_rule("block", w) for w in BLOCKED_WORDS)


def tokens(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), "[^a-z0-9]+")), "")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _rule_rows(rules: tuple[UrlRule, ...]) -> list[tuple]:
    return [
        (i, r.name, r.action, r.regex, r.weight, sorted({t for x in r.literals for t in re.split("[^a-z0-9]+", x.lower()) if t}))
        for i, r in enumerate(rules)
    ]


def judge_urls(df: DataFrame, rules: tuple[UrlRule, ...], url: str = "url", keep: tuple[str, ...] = (), default: str = "allow") -> DataFrame:
    """``keep`` columns, host, path, rule (name of the fitting rule) and verdict, one row per input row."""
    spark = df.sparkSession
    listed = spark.createDataFrame(
        _rule_rows(rules), "id int, name string, action string, regex string, weight int, tokens array<string>"
    )
    if len(rules) <= BROADCAST_RULES:
        listed = F.broadcast(listed)
    rows = df.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    sites = rows.select("host", "path").distinct().select("host", "path", F.concat("host", "path").alias("site"))
    held = sites.select("host", "path", "site", F.explode(F.array_append(tokens(F.col("site")), "")).alias("token"))

    wanted = listed.select("id", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    known = wanted.select("token").distinct()
    known = F.broadcast(known) if len(rules) <= BROADCAST_RULES else known
    counts = held.join(known, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = (
        wanted.join(counts, "token", "left")
        .groupBy("id").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    index = listed.join(filed, "id").select("token", "name", "action", "regex", "weight")
    index = F.broadcast(index) if len(rules) <= BROADCAST_RULES else index

    fits = held.join(index, "token").filter(F.regexp_like("site", F.col("regex")))
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct("weight", F.coalesce("name", F.lit("")).alias("order"), "name", "action")).alias("best")
    )
    return rows.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("best.name").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )

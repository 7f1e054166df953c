"""Extraction jobs over page tables. A page is one row; everything is cut inside the row, no page is regrouped."""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Mapping, Sequence
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUT = "\u0001"
LINK = r"(?s)<a\b([^>]*)>(.*?)</a>"
TAG = r"<[^>]*>"
# Block tags whose text is kept, tags whose content is dropped.
BLOCK_TAGS = ["h1", "h2", "h3", "h4", "h5", "p", "li", "td", "th", "dt", "dd"]
SKIP_TAGS = ["script", "style", "noscript"]


# a reference with its semicolon; without one, HTML reads the old names ("&amp" at the end of a cut text) all the same
CLOSED = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+)|([A-Za-z][A-Za-z0-9]*));")


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else html_lib.unescape(t))


@F.pandas_udf(T.StringType())
def _unescaped_closed(texts: pd.Series) -> pd.Series:
    known = lambda m: m[0] if m[1] and m[1] + ";" not in html5 else html_lib.unescape(m[0])
    return texts.map(lambda t: t if t is None else CLOSED.sub(known, t))


def unescape(text: Column, closed: bool = False) -> Column:
    """Character references to characters (Spark has no function for it); texts without one stay where they are.

    ``closed``: only references that end with a semicolon are read; others are text.
    """
    has = F.contains(text, F.lit("&"))
    run = _unescaped_closed if closed else _unescaped
    return F.when(has, run(F.when(has, text))).otherwise(text)


def attribute(attrs: Column, name: str) -> Column:
    """Value of one double-quoted attribute, NULL when absent."""
    return F.when(F.regexp_like(attrs, F.lit(rf'(?:^|\s){name}="')), F.regexp_extract(attrs, rf'(?:^|\s){name}="([^"]*)"', 1))


def plain_text(fragment: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(fragment, TAG, ""), r"\s+", " "))


def page_links(pages: DataFrame, id_pattern: str, class_token: str | None = None) -> DataFrame:
    """(page_id, pos, url, link_id, title) of every anchor, in document order."""
    both = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(LINK), F.lit(1)).alias("attrs"), F.regexp_extract_all("html", F.lit(LINK), F.lit(2)).alias("body")
    )
    rows = pages.select("page_id", F.posexplode(both).alias("pos", "a"))
    if class_token is not None:
        tokens = F.split(F.coalesce(attribute(F.col("a.attrs"), "class"), F.lit("")), r"\s+")
        rows = rows.filter(F.array_contains(tokens, class_token))
    url = attribute(F.col("a.attrs"), "href")
    return rows.select(
        "page_id", "pos", url.alias("url"), F.nullif(F.regexp_extract(url, id_pattern, 1), F.lit("")).alias("link_id"),
        plain_text(F.col("a.body")).alias("title"),
    )


def cut_at(text: Column, marker: str) -> Column:
    """Pieces of a text, each starting at a match of ``marker`` (the first piece may not)."""
    return F.split(F.regexp_replace(text, f"({marker})", f"{CUT}$1"), CUT)


def page_sections(pages: DataFrame, heading: str, heading_text: str) -> tuple[DataFrame, DataFrame]:
    """(page_id, section, title, body) per heading, and pages without a heading."""
    pieces = pages.select("page_id", cut_at(F.col("html"), heading).alias("pieces"))
    sections = pieces.select("page_id", F.posexplode(F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0)))).alias("section", "body"))
    rejects = pieces.filter(F.size("pieces") <= 1).select("page_id", F.lit("no_heading").alias("reason"))
    titled = sections.withColumn("title", plain_text(F.regexp_extract("body", heading_text, 1)))
    return titled.select("page_id", "section", "title", "body"), rejects


def section_links(sections: DataFrame, pattern: str) -> DataFrame:
    """Links assigned to the section they stand in."""
    hits = F.regexp_extract_all("body", F.lit(pattern), F.lit(1))
    return sections.select("page_id", "section", "title", F.posexplode(hits).alias("pos", "url"))


def nearest_headings(docs: DataFrame, key: str, text: str, heading: str) -> DataFrame:
    """(key, heading, pos, line): every line with the nearest heading line before it.

    The text is cut at its heading lines, so each piece already is one heading
    and the lines it owns; lines before the first heading have a NULL heading.
    """
    pieces = cut_at(F.col(text), rf"(?m)^(?:{heading})[^\n]*")
    rows = docs.select(key, F.posexplode(pieces).alias("_piece", "_text"))
    lines = rows.select(key, "_piece", F.split("_text", "\n").alias("_lines"))
    is_heading = F.col("_lines")[0].rlike(rf"^(?:{heading})")
    owned = lines.select(key, "_piece", F.when(is_heading, F.col("_lines")[0]).alias("heading"), F.posexplode("_lines").alias("pos", "line"))
    kept = owned.filter((F.trim("line") != "") & ~((F.col("pos") == 0) & F.col("heading").isNotNull()))
    return kept.select(key, F.col("_piece").alias("piece"), "heading", "pos", "line")


def attribute_rows(pages: DataFrame, tag: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per opening ``tag`` with typed attributes: column -> (attribute, type); bad values are NULL."""
    tags = F.regexp_extract_all("html", F.lit(rf"<{tag}\b([^>]*)>"), F.lit(1))
    rows = pages.select("page_id", F.posexplode(tags).alias("pos", "attrs"))
    typed = [
        attribute(F.col("attrs"), attr).alias(col) if kind == "string" else attribute(F.col("attrs"), attr).try_cast(kind).alias(col)
        for col, (attr, kind) in columns.items()
    ]
    return rows.select("page_id", "pos", *typed)


def block_texts(pages: DataFrame, container: str | None = None, tags: Sequence[str] = BLOCK_TAGS, closed: bool = False) -> DataFrame:
    """(page_id, blocks array<struct<tag,text>>, content_hash); scripts dropped, white space folded.

    A block ends at its closing tag or where a block of another kind opens; one
    that never ends is no block. ``closed``: see ``unescape``.
    """
    body = F.col("html")
    if container is not None:
        body = F.regexp_extract(body, rf"(?s)<{container}\b[^>]*>(.*)</{container}>", 1)
    clean = F.regexp_replace(body, rf"(?is)<({'|'.join(SKIP_TAGS)})\b[^>]*>.*?</\1>|<!--.*?-->", "")
    any_tag = "|".join(tags)
    # text is taken in runs; only an opening bracket is looked at twice
    pattern = rf"(?s)<({any_tag})\b[^>]*>(?:[^<]++|<(?!/\1>)(?!(?:(?!\1\b)(?:{any_tag}))\b))*+(?=.)"
    found = F.regexp_extract_all("_clean", F.lit(pattern), F.lit(0))
    # the opening tag goes with the others; separators survive unescaping, so one call per page does all blocks
    joined = F.array_join(F.transform("_z", lambda z: F.regexp_replace(F.regexp_replace(z, r"<br\s*/?>", "\n"), TAG, "")), CUT)
    staged = pages.select("page_id", clean.alias("_clean")).select("page_id", F.explode(F.array(found)).alias("_z"))
    staged = staged.select("page_id", "_z", F.explode(F.array(joined)).alias("_j")).select("page_id", "_z", unescape(F.col("_j"), closed).alias("_t"))
    texts = F.transform(F.split("_t", CUT), lambda t: F.trim(F.regexp_replace(t, r"\s+", " ")))
    tag = lambda z: F.regexp_extract(z, r"^<(\w+)", 1)
    pairs = F.zip_with("_z", texts, lambda z, t: F.struct(F.when(z.isNotNull(), tag(z)).alias("tag"), t.alias("text")))
    blocks = F.filter(pairs, lambda b: (b["text"] != "") & b["tag"].isNotNull())
    with_blocks = staged.select("page_id", blocks.alias("blocks"))
    return with_blocks.withColumn("content_hash", content_hash(F.col("blocks")))


def content_hash(blocks: Column) -> Column:
    return F.sha2(F.array_join(F.transform(blocks, lambda b: F.concat_ws("|", b["tag"], b["text"])), "\n"), 256)


# Wording of the rule page.
RULE_FORMATS = [("standard", "标准赛制", "开放赛制"), ("open", "开放赛制", None)]
SINCE = r"（自\s*(\d{4})年(\d{1,2})月(\d{1,2})日起）"
UPDATED = r"更新日期.*?(\d{4})年(\d{1,2})月(\d{1,2})日"
MARK_LIST = r"赛制标记为\s*([A-Z](?:\s*、\s*[A-Z])*)"
BANNED_START = "以下卡牌无法加入卡组中"
BANNED_ITEM = r"^(.+?)（(?:特性|招式)：(.+?)）$"
PROMO_NOTE = "特典卡 "
PROMO_ITEM = r"^特典卡“(.+?)”（(.+?)）$"
ANY_ENERGY = "各种基本能量卡"


def _page_date(texts: Column, pattern: str) -> Column:
    hit = F.get(F.filter(texts, lambda t: t.rlike(pattern)), F.lit(0))
    part = lambda i: F.lpad(F.regexp_extract(hit, pattern, i), 4 if i == 1 else 2, "0")
    return F.when(hit.isNotNull(), F.try_to_date(F.concat_ws("-", part(1), part(2), part(3)), "yyyy-MM-dd"))


def parse_rule_pages(pages: DataFrame) -> DataFrame:
    """(page_id, format, effective_from, marks, whitelist, banned, errors) from page blocks.

    A missing key sentence is an error entry, never a guess.
    """
    out = None
    for fmt, start, end in RULE_FORMATS:
        blocks = F.col("blocks")
        heads = F.transform(blocks, lambda b: F.when(b["tag"] == "h3", b["text"]))
        at = F.array_position(heads, start)
        rest = F.when(at > 0, F.slice(blocks, (at + 1).cast("int"), F.size(blocks)))
        if end is not None:
            rest_heads = F.transform(F.col("_rest"), lambda b: F.when(b["tag"] == "h3", b["text"]))
            stop = F.coalesce(F.array_position(rest_heads, end), F.lit(0))
            section = F.when(stop > 0, F.slice("_rest", 1, (stop - 1).cast("int"))).otherwise(F.col("_rest"))
        else:
            section = F.col("_rest")
        empty = F.array().cast("array<struct<tag:string,text:string>>")
        df = pages.select("page_id", "blocks").withColumn("_rest", F.coalesce(rest, empty)).withColumn("_s", section)
        # walk the blocks once: the banned mode switches on at its sentence and off at the next heading
        state = F.aggregate(
            "_s",
            F.struct(F.lit(False).alias("mode"), F.array().cast("array<string>").alias("ban"), F.array().cast("array<string>").alias("allow")),
            lambda acc, b: F.struct(
                F.when(b["tag"] == "li", acc["mode"]).when(F.contains(b["text"], F.lit(BANNED_START)), True)
                .when(b["tag"].isin("h3", "h4"), False).otherwise(acc["mode"]).alias("mode"),
                F.when((b["tag"] == "li") & acc["mode"], F.array_append(acc["ban"], b["text"])).otherwise(acc["ban"]).alias("ban"),
                F.when((b["tag"] == "li") & ~acc["mode"] & (b["text"] != ANY_ENERGY), F.array_append(acc["allow"], b["text"]))
                .otherwise(acc["allow"]).alias("allow"),
            ),
        )
        texts = F.transform("_s", lambda b: b["text"])
        marks_text = F.get(F.filter(texts, lambda t: F.contains(t, F.lit("赛制标记为"))), F.lit(0))
        marks = F.regexp_extract(F.coalesce(marks_text, F.lit("")), MARK_LIST, 1)
        df = df.withColumn("_state", state).withColumn("_from", F.coalesce(_page_date(texts, SINCE), _page_date(texts, UPDATED)))
        df = df.withColumn("_marks", F.when(marks != "", F.split(marks, r"\s*、\s*")) if fmt == "standard" else F.lit(None).cast("array<string>"))
        part = lambda t, i: F.nullif(F.regexp_extract(t, PROMO_ITEM, i), F.lit(""))
        allow = F.transform("_state.allow", lambda t: F.struct(
            F.coalesce(part(t, 1), t).alias("name_full"), F.concat(F.lit(PROMO_NOTE), part(t, 2)).alias("note")
        ))
        banned = F.transform("_state.ban", lambda t: F.struct(
            F.coalesce(F.nullif(F.regexp_extract(t, BANNED_ITEM, 1), F.lit("")), t).alias("name"),
            F.nullif(F.regexp_extract(t, BANNED_ITEM, 2), F.lit("")).alias("ability_or_attack"),
        ))
        errors = F.array_compact(F.array(
            F.when(F.size("_s") == 0, "no_section"),
            F.when(F.col("_from").isNull(), "no_date"),
            F.when(F.col("_marks").isNull(), "no_marks") if fmt == "standard" else F.lit(None).cast("string"),
            F.when(F.size("_state.allow") == 0, "empty_whitelist"),
        ))
        one = df.select(
            "page_id", F.lit(fmt).alias("format"), F.col("_from").alias("effective_from"), F.col("_marks").alias("marks"),
            allow.alias("whitelist"), banned.alias("banned"), errors.alias("errors"),
        )
        out = one if out is None else out.unionByName(one)
    return out

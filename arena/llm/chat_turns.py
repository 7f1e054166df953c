r"""Chat formatting: schema fingerprints select declarative mappings into canonical turns.

A record is a JSON text of any layout. Its nested field paths, without values
and types, are hashed; the hash selects the mapping that says where the turns
of that layout lie. All layouts become an array of (role, text), which one
template renders. Everything is a column expression, so formatting is a map
stage; only building records from turn rows groups by conversation.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn. Control strings inside
roles and texts are made harmless reversibly: backslashes are doubled, then a
backslash is put behind the first character of ``<|``, ``<s>``, ``</s>``,
``[INST]`` and ``[/INST]``. ``unescape`` undoes both exactly.

Defined cases: null roles and texts are empty; repeated rows of a conversation
stay separate turns, ordered by (turn, role, text); a record of an unknown
layout has null turns and its fingerprint, so nothing is guessed or lost. Spark
parses JSON strings up to 20 million characters and records up to 128 MB; a text
beyond that, or no JSON at all, has null turns unless the record comes with its
typed turns, which ``records_of`` gives.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.llm.common import computed, let

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

# fixed values: openings of control strings, the first character and what follows it
_OPENINGS = r"(?:(?<=<)(?=\||/?s>)|(?<=\[)(?=/?INST\]))"
_ESCAPED = r"(?:(?<=<)\\(?=\||/?s>)|(?<=\[)\\(?=/?INST\]))"

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """Field paths of a layout, and its turns from the parsed record."""

    name: str
    paths: str
    turns: Callable[[Column], Column]


def _field(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def _listed(field: str, role: str, text: str, roles: dict[str, str] | None = None) -> Callable[[Column], Column]:
    """Turns of an array of objects, with other role names if the layout has them."""

    def turns(record: Column) -> Column:
        items = F.try_variant_get(record, f"$.{field}", f"array<struct<{role}:string,{text}:string>>")

        def named(x: Column) -> Column:
            own = x[role]
            for theirs, ours in (roles or {}).items():
                own = F.when(x[role] == theirs, ours).otherwise(own)
            return F.struct(own.alias("role"), x[text].alias("text"))

        return F.transform(items, named)

    return turns


def _fields(*parts: tuple[str, str]) -> Callable[[Column], Column]:
    """Turns of single fields in a fixed order; an absent optional field gives no turn."""

    def turns(record: Column) -> Column:
        return F.array(*[F.struct(F.lit(role).alias("role"), _field(record, f"$.{field}").alias("text")) for role, field in parts])

    return turns


# layouts in public use; field paths are sorted, as a parsed record lists them
MAPPINGS = (
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", _listed("messages", "role", "content")),
    Mapping("conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>",
            _listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
    Mapping("prompt", "OBJECT<completion, prompt>", _fields(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", "OBJECT<instruction, output, system>",
            _fields(("system", "system"), ("user", "instruction"), ("assistant", "output"))),
)


def layout_of(record: Column) -> Column:
    """Nested field paths of a parsed record: its schema without the types of its leaves."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?!ARRAY|OBJECT)[A-Z]+(?:\([0-9, ]*\))?", "")


def fingerprint(layout: Column) -> Column:
    return F.xxhash64(layout)


def canonical_turns(
    df: DataFrame, record: str = "record", keep: tuple[str, ...] = (), mappings: tuple[Mapping, ...] = MAPPINGS, typed: str = "typed"
) -> DataFrame:
    """``keep``, ``layout_hash``, ``layout`` (null if unknown) and ``turns`` of JSON records.

    Where the text does not parse, the column ``typed`` of (paths, turns) stands for it, if the input has one.
    """
    kind = f"struct<paths:string,turns:{TURNS}>"
    other = F.col(typed) if typed in df.columns and df.schema[typed].dataType.simpleString() == kind else F.lit(None).cast(kind)
    read = df.select(*keep, F.try_parse_json(F.col(record)).alias("_v"), other.alias("_typed"))
    parsed = computed(read, F.when(F.col("_v").isNull() & F.col("_typed").isNotNull(), F.col("_typed.paths")).otherwise(layout_of(F.col("_v"))), "_paths")
    hashed = parsed.withColumn("layout_hash", fingerprint(F.col("_paths")))
    turns = name = F.lit(None)
    for m in mappings:
        mine = F.col("layout_hash") == fingerprint(F.lit(m.paths))
        turns = F.when(mine & F.col("_v").isNull(), F.col("_typed.turns")).when(mine, m.turns(F.col("_v"))).otherwise(turns)
        name = F.when(mine, F.lit(m.name)).otherwise(name)
    clean = let(turns.cast(TURNS), lambda t: F.transform(t, lambda x: F.struct(
        F.coalesce(x.role, F.lit("")).alias("role"), F.coalesce(x.text, F.lit("")).alias("text"))))
    return computed(hashed, clean, "turns").select(*keep, "layout_hash", name.alias("layout"), "turns")


def records_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turn rows as one JSON record per conversation, in the plainest layout that can hold it, and the same turns typed."""
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    grouped = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("t"))
    roles, said = F.col("t.role"), lambda i: F.get(F.col("t.text"), F.lit(i))
    as_is = lambda *names: roles == F.array(*map(F.lit, names))
    messages = F.transform("t", lambda x: F.struct(x.text.alias("content"), x.role.alias("role")))
    record = (
        F.when(as_is("user", "assistant"), F.to_json(F.struct(said(0).alias("prompt"), said(1).alias("completion"))))
        .when(as_is("system", "user", "assistant"),
              F.to_json(F.struct(said(0).alias("system"), said(1).alias("instruction"), said(2).alias("output"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    paths = {m.name: F.lit(m.paths) for m in MAPPINGS}
    layout = (
        F.when(as_is("user", "assistant"), paths["prompt"]).when(as_is("system", "user", "assistant"), paths["instruction"]).otherwise(paths["messages"])
    )
    turns = F.transform("t", lambda x: F.struct(x.role.alias("role"), x.text.alias("text")))
    return grouped.select("conv_id", record.alias("record"), F.struct(layout.alias("paths"), turns.alias("turns")).alias("typed"))


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _OPENINGS, r"\\")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _ESCAPED, ""), F.lit("\\\\"), F.lit("\\"))


def formatted(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds ``formatted`` and ``loss``: the (start, length) in code points of every assistant text, from 0."""
    parts = F.transform(turns, lambda x: F.struct(escape(x.role).alias("role"), escape(x.text).alias("text")))
    bound = df.withColumn("_parts", F.explode(F.array(parts)))
    whole = F.array_join(F.transform("_parts", lambda x: F.concat(F.lit(TURN), x.role, F.lit(TEXT), x.text, F.lit(END))), "")
    zero = F.lit(0).cast("long")
    span = "struct<start:bigint,length:bigint>"
    start = F.struct(zero.alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + len(TURN) + F.length(x.role) + len(TEXT)
        mine = F.struct(begin.cast("long").alias("start"), F.length(x.text).cast("long").alias("length"))
        spans = F.when(x.role == "assistant", F.array_append(a["spans"], mine)).otherwise(a["spans"])
        return F.struct((begin + F.length(x.text) + len(END)).cast("long").alias("at"), spans.alias("spans"))

    return bound.select(*df.columns, whole.alias("formatted"), F.aggregate("_parts", start, step, lambda a: a["spans"]).alias("loss"))


def turns_back(text: Column) -> Column:
    """The turns of a formatted text."""
    each = F.filter(F.split(text, r"<\|turn\|>", -1), lambda x: F.length(x) > 0)

    def read(x: Column) -> Column:
        halves = F.split(F.regexp_replace(x, r"<\|end\|>$", ""), r"<\|text\|>", 2)
        return F.struct(unescape(F.get(halves, F.lit(0))).alias("role"), unescape(F.get(halves, F.lit(1))).alias("text"))

    return F.transform(each, read)


def loss_text(text: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(text, s.start.cast("int") + 1, s.length.cast("int")))), "")

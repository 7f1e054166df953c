"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every rule bounds one ratio of a text (length, symbols, stop words, lines). All
measures come from one pass over the words of a row; nothing is shuffled and no
Python runs, so a table of any size is one map stage.

Defined cases: a null text is empty; an empty text fails on length; repeated
rows are judged one by one; an empty table gives an empty result; columns of
the input may have any names, those of the measures included, since the input
row travels as one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.llm.common import WORD, computed, let, words

WINDOW = 8  # three doublings of one word

# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to in a is that it for on with as was be by this from or an are at he "
    "der die und das den von zu mit ist im auf für des dem ein eine nicht sich "
    "de la le et les des du un une est que dans qui en pour sur au ce "
    "el los las y una por con para se su no es lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a missing bound is open. The measure is a key of ``ratios``."""

    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("n_words", low=20),
    Rule("repeat_share", high=0.30),
    Rule("symbols_per_word", high=0.15),
    Rule("exclamations_per_word", high=0.15),
    Rule("upper_share", high=0.45),
    Rule("mean_word_length", low=2.0, high=15.0),
    Rule("dup_line_share", high=0.40),
    Rule("stop_word_share", low=0.02),
)


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows of WINDOW words that occur at least twice, from the hashes of the words."""

    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(pairs: Column) -> Column:
            at = F.transform(
                pairs,
                lambda p, k: F.when(
                    (p.h == F.get(pairs, k - 1).h) | (p.h == F.get(pairs, k + 1).h), p.i
                ),
            )
            return F.array_sort(F.array_compact(at))

        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a.n + F.least(F.lit(WINDOW), p - a["last"])).alias("n"))
        found = let(ordered, lambda pairs: F.aggregate(twins(pairs), start, step, lambda a: a.n))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(found)

    def paired(h: Column, step: int) -> Column:
        """Hash of each element with the one ``step`` places on: spans of a length become spans of its double."""
        rest = lambda x: F.greatest(F.size(x) - step, F.lit(0))
        return let(h, lambda x: F.zip_with(F.slice(x, 1, rest(x)), F.slice(x, step + 1, rest(x)), lambda p, q: F.xxhash64(p, q)))

    def over(h: Column) -> Column:
        windows = paired(paired(paired(h, 1), 2), 4)
        return F.when(F.size(h) <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows, covered))

    return let(hashes, over)


def measures(text: Column) -> Column:
    """Struct of the counts of one text; ``text`` must not be null."""

    def counted(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS, *(s.capitalize() for s in STOP_WORDS)))).cast("long").alias("n_stop"),
            _repeat_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words"),
        )

    return let(words(text), counted)


def ratios(m: Column) -> dict[str, Column]:
    """The bounded quantities, from the struct of ``measures``; shares of nothing are 0."""
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return {
        "n_words": m.n_words,
        "repeat_share": share(m.n_repeat_words, m.n_words),
        "symbols_per_word": share(m.n_symbols, m.n_words),
        "exclamations_per_word": share(m.n_exclamations, m.n_words),
        "upper_share": share(m.n_upper, m.word_chars),
        "mean_word_length": share(m.word_chars, m.n_words),
        "dup_line_share": share(m.lines.dup, m.lines.n),
        "stop_word_share": share(m.n_stop, m.n_words),
    }


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True when every rule of the table holds."""
    of = ratios(m)
    kept = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            kept = kept & (of[rule.measure] >= F.lit(rule.low))
        if rule.high is not None:
            kept = kept & (of[rule.measure] <= F.lit(rule.high))
    return kept


def judged(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (the whole input row), ``m`` (measures) and ``kept``."""
    base = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    measured = computed(base, measures(F.col("body")), "m")
    return measured.select("row", "m", verdict(F.col("m"), rules).alias("kept"))


def keep_quality(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes every rule, with the columns of the input."""
    return judged(df, text, rules).filter("kept").select("row.*")

"""Literals that a pattern cannot do without: texts that lack them need no regular expression.

A pattern is read once, on the driver, into sets of strings of which one each must
occur. A pattern that is nothing but such strings needs no expression at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as k
from re import _parser as parser

MOST = 16  # strings of one set
CLASS = r"(?:\[[^\]]+\]|\\[dws])"


@dataclass(frozen=True)
class Needs:
    """``sets``: of each, one string must occur. ``exact``: the pattern is found exactly where its only set is. ``folded``: in lower case."""

    sets: tuple[frozenset[str], ...]
    exact: bool
    folded: bool
    pattern: str


Found = tuple["frozenset[str] | None", "list[frozenset[str]]"]


def _sequence(items: Iterable) -> Found:
    run, whole, sets = frozenset({""}), True, []

    def close() -> None:
        if all(run):
            sets.append(run)

    for op, arg in items:
        exact, inner = _item(op, arg)
        if exact is not None and len(run) * len(exact) <= MOST:
            run = frozenset(a + b for a in run for b in exact)
            continue
        close()
        whole = False
        run = exact if exact is not None else frozenset({""})
        sets += inner
    if whole:
        return run, []
    close()
    return None, sets


def _best(found: Found) -> frozenset[str] | None:
    """The set that is hardest to meet."""
    exact, sets = found
    choices = ([exact] if exact is not None and all(exact) else []) + sets
    return max(choices, key=lambda s: min(map(len, s)), default=None)


def _item(op, arg) -> Found:
    if op is k.LITERAL:
        return frozenset({chr(arg)}), []
    if op is k.IN and len(arg) <= 8 and all(o is k.LITERAL for o, _ in arg):
        return frozenset(chr(a) for _, a in arg), []
    if op is k.SUBPATTERN and not arg[1] and not arg[2]:
        return _sequence(arg[3])
    if op is k.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        if all(e is not None for e, _ in parts):
            union = frozenset().union(*[e for e, _ in parts])
            if len(union) <= MOST:
                return union, []
        best = [_best(p) for p in parts]
        if all(b is not None for b in best):
            union = frozenset().union(*best)
            if len(union) <= MOST:
                return None, [union]
        return None, []
    if op in (k.MAX_REPEAT, k.MIN_REPEAT, k.POSSESSIVE_REPEAT):
        low, high, inner = arg
        found = _sequence(inner)
        if found[0] is not None and (low, high) == (0, 1) and op is not k.POSSESSIVE_REPEAT:
            return found[0] | {""}, []
        if found[0] is not None and low == high and len(found[0]) ** low <= MOST:
            out = frozenset({""})
            for _ in range(low):
                out = frozenset(a + b for a in out for b in found[0])
            return out, []
        best = _best(found) if low else None
        return None, [best] if best is not None else []
    return None, []


def shortened(pattern: str) -> str:
    """An expression found in the same texts that looks at each place once.

    A run of one class is looked for at its start only, and a repetition at the
    end of an expression is satisfied by its first character.
    """
    run = re.fullmatch(rf"({CLASS})(?:\+|\{{(\d+),?\d*\}})", pattern)
    if run:
        return f"(?<!{run[1]}){run[1]}{{{run[2] or 1}}}"
    if "|" in pattern or "(" in pattern or pattern.endswith("\\+"):
        return pattern
    cut = re.sub(rf"({CLASS})\+$", r"\1", pattern)
    return re.sub(rf"^({CLASS})\+(?![+?])", r"\1", cut)


def needs_of(pattern: str) -> Needs:
    """What the pattern needs; nothing where it cannot be read."""
    try:
        tree = parser.parse(pattern)
    except re.error:
        return Needs((), False, False, pattern)
    folded = bool(tree.state.flags & re.IGNORECASE)
    exact, sets = _sequence(tree)
    if exact is not None and all(exact):
        sets = [exact]
    if folded:
        sets = [frozenset(s.lower() for s in one) for one in sets]
    return Needs(tuple(dict.fromkeys(sets)), exact is not None and all(exact) and not folded, folded, shortened(pattern))

"""Repair of conversation structure at the least cost, by a square-root checkpointed dynamic program.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``. Edits:
keep a row (0), give it the role that is due, user or assistant (1), delete it
(2; blank rows and duplicates must go), insert an empty row of the role that is
due anywhere (5). A row that stays though its text breaks off costs 5 more.

Costs to the end are computed backwards over four states: nothing yet, after a
system row, after a user, after an assistant. Only every square-root-th vector
is kept; walking forward, the vectors of one stretch at a time are computed again
from its checkpoint, and of the edits that lose nothing against the vector (the
tight ones) the ASCII-least is taken, which makes the least string of initials.

Long conversations are dealt over tasks: rows are sorted by range into blocks of
bounded size, a block folds to a 4 x 4 matrix of costs (least sums, which chain
as matrices do), the matrices of a conversation give the vectors at the ends of
its blocks, and the walk reads the blocks one after the other, in order. A task
holds one block of rows and, of a conversation, four numbers a block.

Defined cases: rows are taken by turn, nulls first, rows of one turn by role and
text; a null role or text is one space; a null conversation is one of its own; a
role with an empty initial fits no place; equal rows are duplicates of the first;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from functools import cache
from itertools import groupby
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arena.llm.common import stored

BLANK = " \t\n\x0b\x0c\r"  # fixed value: ASCII white space
BLOCK_ROWS = 4096  # of one conversation that a task holds
BLOCK_CHARS = 8_000_000  # of one conversation that a task holds, above its last row
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

FAR = 1 << 40  # a cost that no conversation reaches; sums of it stay in 64 bits
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = (USER, USER, ASSISTANT, USER)  # state after a row of the role that is due
# state after keeping a row whose role begins with s, u, a or anything else; -1 where it does not fit
KEEP = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
ROLES = {USER: "user", ASSISTANT: "assistant"}
GOES, BREAKS = 4, 8  # flags of a row's code, above two bits of its initial


def _filled(v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs when rows may be inserted first; two in turn lead back to the state they came from."""
    u, a = min(v[USER], v[ASSISTANT] + INSERT), min(v[ASSISTANT], v[USER] + INSERT)
    return min(v[START], u + INSERT), min(v[SYSTEM], u + INSERT), u, a


END = _filled((0, FAR, FAR, 0))


def _before(code: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row, from those after it."""
    if code & GOES:
        return _filled(tuple(x + DELETE for x in v))
    more, kind = TRUNCATED if code & BREAKS else 0, code & 3
    return _filled(tuple(
        min(v[s] + DELETE, v[DUE[s]] + REROLE + more, v[KEEP[s][kind]] + more if KEEP[s][kind] >= 0 else FAR) for s in range(4)
    ))


@cache
def _one(code: int) -> np.ndarray:
    units = [tuple(0 if s == t else FAR for s in range(4)) for t in range(4)]
    return np.array([_before(code, u) for u in units], np.int64).T


def transfer(codes: bytes) -> np.ndarray:
    """Least costs from each state before some rows to each state after them; 4 x 4, 64 bits."""
    stack = np.stack([_one(c) for c in codes])
    while len(stack) > 1:
        rest = stack[len(stack) & ~1 :]
        pairs = np.minimum((stack[:-1:2, :, :, None] + stack[1::2, None, :, :]).min(2), FAR)
        stack = np.concatenate([pairs, rest])
    return stack[0]


def tight_edits(codes: bytes, last: tuple[int, ...], state: int, final: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits of some rows from ``state`` on, and the state after them.

    ``last`` are the costs after the rows; ``final`` if the conversation ends there.
    """
    n = len(codes)
    step = isqrt(n) + 1
    marks, v = {n: last}, last
    for i in range(n - 1, -1, -1):
        v = _before(codes[i], v)
        if i % step == 0:
            marks[i] = v
    out: list[str] = []
    for begin in range(0, n, step):
        end = min(begin + step, n)
        vectors = [marks[end]]
        for i in range(end - 1, begin - 1, -1):
            vectors.append(_before(codes[i], vectors[-1]))
        vectors.reverse()
        for i in range(begin, end):
            now, after, code = vectors[i - begin], vectors[i - begin + 1], codes[i]
            more, kind = TRUNCATED if code & BREAKS else 0, code & 3
            while True:
                cost, due = now[state], DUE[state]
                if after[state] + DELETE == cost:
                    out.append("D")
                    break
                if now[due] + INSERT == cost:
                    out.append("I")
                    state = due
                    continue
                kept = KEEP[state][kind]
                if kept >= 0 and after[kept] + more == cost:
                    out.append("K")
                    state = kept
                else:
                    out.append("R")
                    state = due
                break
    while final and state in (SYSTEM, USER):
        out.append("I")
        state = DUE[state]
    return "".join(out), state


def repaired(audit: str, state: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Roles and texts after the edits of ``audit``, which begins in ``state``."""
    out, left = [], iter(rows)
    for edit in audit:
        if edit == "I":
            state = DUE[state]
            out.append((ROLES[state], ""))
            continue
        role, text = next(left)
        if edit == "R":
            state = DUE[state]
            out.append((ROLES[state], text))
        elif edit == "K":
            state = KEEP[state]["sua".find(role[:1])]
            out.append((role, text))
    return out


def flagged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """key, turn, role, text and the first fault of each row: blank, duplicate, truncated or null.

    Of equal rows of one turn the first is told only where they are read in order.
    """
    rows = df.select(
        F.col(conv).cast("string").alias("key"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    rows = rows.withColumn("fp", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    known = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    seen = rows.groupBy("key", "fp").agg(F.count(F.lit(1)).alias("n"), F.min(known).alias("first")).filter("n > 1")
    seen = seen.select(F.col("key").alias("_key"), F.col("fp").alias("_fp"), "first")
    joined = rows.join(seen, rows["key"].eqNullSafe(seen["_key"]) & (rows["fp"] == seen["_fp"]), "left")
    visible = F.btrim("text", F.lit(BLANK))
    fault = F.when(visible == "", "blank").when(known > F.col("first"), "duplicate")
    fault = fault.when(~F.right(visible, F.lit(1)).isin(".", "!", "?"), "truncated")
    return joined.select("key", "turn", "role", "text", fault.alias("fault"), F.col("first").isNotNull().alias("twice"))


_INITIALS = {"s": 0, "u": 1, "a": 2}
_LEGAL = {"su", "ua", "au"}

_BLOCK = pa.schema([
    ("key", pa.string()), ("piece", pa.int32()), ("seq", pa.int32()), ("codes", pa.binary()), ("costs", pa.list_(pa.int64())),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.list_(pa.int64())),
    ("turns", pa.list_(pa.int64())), ("illegal", pa.int64()),
])
BLOCK = (
    "key string, piece int, seq int, codes binary, costs array<bigint>, roles array<string>, texts array<string>, "
    "faults array<bigint>, turns array<bigint>, illegal bigint"
)
_KINDS = ("blank", "duplicate", "truncated")


def _packed(key: str | None, piece: int, seq: int, rows: list[tuple], before: tuple | None) -> tuple:
    """One block; ``before`` is the row of the conversation that came before in this task, which may be its first copy."""
    codes, faults, turns, distinct, illegal = bytearray(), [0, 0, 0], [], 0, 0
    for i, (turn, role, text, fault, twice) in enumerate(rows):
        last = rows[i - 1] if i else before
        if twice and last is not None and fault != "blank" and last[:3] == (turn, role, text):
            fault = "duplicate"
        if fault is not None:
            faults[_KINDS.index(fault)] += 1
        codes.append(_INITIALS.get(role[:1], 3) | (GOES if fault in ("blank", "duplicate") else BREAKS if fault else 0))
        illegal += i > 0 and last[1][:1] + role[:1] not in _LEGAL
        if turn is not None and (not turns or turn != turns[-1]):
            distinct += 1
            turns = [turns[0] if turns else turn, turn]
    code = bytes(codes)
    return (key, piece, seq, code, transfer(code).ravel().tolist(), [r[1] for r in rows], [r[2] for r in rows], faults, [*turns, distinct] if turns else [], illegal)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _blocks(block_rows: int):
    """Map over sorted rows (piece, key, turn, role, text, fault, twice): blocks of one conversation each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, weight = [], 0
        for (piece, key), rows in groupby(_rows_of(batches), key=lambda r: r[:2]):
            seq, lot, held, before = 0, [], 0, None
            for row in rows:
                lot.append(row[2:])
                held += len(row[4])
                if len(lot) >= block_rows or held >= BLOCK_CHARS:
                    yield _record([_packed(key, piece, seq, lot, before)], _BLOCK)
                    seq, before, lot, held = seq + 1, lot[-1], [], 0
            if lot:
                out.append(_packed(key, piece, seq, lot, before))
                weight += held
            if len(out) >= BLOCK_ROWS or weight >= BLOCK_CHARS:
                yield _record(out, _BLOCK)
                out, weight = [], 0
        if out:
            yield _record(out, _BLOCK)

    return run


_EXIT = pa.schema([("key", pa.string()), ("piece", pa.int32()), ("seq", pa.int32()), ("exits", pa.list_(pa.int64()))])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map over (key, piece, seq, costs), last blocks first: the costs after every block of conversations of several."""
    out = []
    for key, blocks in groupby(_rows_of(batches), key=lambda r: r[0]):
        v, exits = np.array(END, np.int64), []
        for block in blocks:
            exits.append(v)
            v = (np.array(block[3], np.int64).reshape(4, 4) + v).min(1)
        if len(exits) > 1:
            out.append((key, -1, 0, np.concatenate(exits[::-1]).tolist()))
        if len(out) >= 1000:
            yield _record(out, _EXIT)
            out = []
    if out:
        yield _record(out, _EXIT)


_DONE = pa.schema([
    ("key", pa.string()), ("block", pa.int64()), ("audit", pa.string()), ("cost", pa.int64()), ("digest", pa.string()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("gaps", pa.int64()),
    ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
])
DONE = (
    "key string, block bigint, audit string, cost bigint, digest string, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, gaps bigint, rows array<struct<role:string,text:string>>"
)


def _walk(digest: bool):
    """Map over exits and blocks in order: the edits of each block, and on the last one the figures of the conversation."""

    def ended(key, number, audit, cost, sha, faults, illegal, turns, said):
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        return (key, number, audit, cost, sha.hexdigest(), *faults, illegal, gaps, said)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, weight = [], 0
        for key, blocks in groupby(_rows_of(batches), key=lambda r: r[0]):
            exits, state, number, cost, sha, first = None, START, 0, 0, sha256(), True
            faults, illegal, turns, role = [0, 0, 0], 0, [], None
            for _, piece, _, codes, roles, texts, their, spans, odd, ends in blocks:
                if piece < 0:
                    exits = ends
                    continue
                final = exits is None or 4 * (number + 1) == len(exits)
                last = END if exits is None else tuple(exits[4 * number : 4 * number + 4])
                audit, after = tight_edits(codes, last, state, final)
                said = repaired(audit, state, list(zip(roles, texts, strict=True)))
                cost += sum({"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[e] for e in audit)
                kept = [e for e in audit if e != "I"]
                cost += sum(TRUNCATED for e, c in zip(kept, codes, strict=True) if e != "D" and c & BREAKS)
                for pair in said:
                    sha.update(("" if first else "\n").encode() + f"{pair[0]}:{pair[1]}".encode())
                    first = False
                faults = [a + b for a, b in zip(faults, their, strict=True)]
                illegal += odd + (role is not None and role[:1] + roles[0][:1] not in _LEGAL)
                if spans:
                    turns = [turns[0], spans[1], turns[2] + spans[2] - (turns[1] == spans[0])] if turns else spans
                state, role = after, roles[-1]
                shown = None if digest else [{"role": r, "text": t} for r, t in said]
                if final:
                    out.append(ended(key, number, audit, cost, sha, faults, illegal, turns, shown))
                else:
                    out.append((key, number, audit, *[None] * 7, shown))
                number += 1
                weight += sum(map(len, texts))
                if len(out) >= BLOCK_ROWS or weight >= BLOCK_CHARS:
                    yield _record(out, _DONE)
                    out, weight = [], 0
        if out:
            yield _record(out, _DONE)

    return run


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", digest: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """key (the conversation as text), block, audit, rows; a row a block of a conversation, in order of ``block``.

    ``rows`` are the repaired roles and texts (null with ``digest``). The last
    block has the figures of the conversation, the others null: cost, the counts
    of faults, illegal, gaps, and digest, the SHA-256 of all ``role:text`` lines.
    """
    rows = flagged(df, conv, turn, role, text)
    # rows that agree in these are one turn's; ranges end between them, so equal rows stay together
    dealt = rows.repartitionByRange(F.col("key"), F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 32))
    ordered = dealt.sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text")
    ordered = ordered.select(F.spark_partition_id().alias("piece"), "key", "turn", "role", "text", "fault", "twice")
    blocks = stored(ordered.mapInArrow(_blocks(block_rows), BLOCK), "turns-blocks")
    light = blocks.select("key", "piece", "seq", "costs").repartition("key")
    light = light.sortWithinPartitions("key", F.desc("piece"), F.desc("seq"))
    exits = light.mapInArrow(_exits, "key string, piece int, seq int, exits array<bigint>")
    both = blocks.drop("costs").unionByName(exits, allowMissingColumns=True)
    both = both.repartition("key").sortWithinPartitions("key", "piece", "seq")
    return both.mapInArrow(_walk(digest), DONE)

"""Periodic runs of words, by an enhanced suffix array and its branching tandem repeats.

The suffixes of a text are sorted by prefix doubling; the ranks of every
doubling are kept and give the longest common prefixes of neighbours. An LCP
interval of depth d holds all suffixes that share d words, so a square of
period d that cannot move right (a branching one) lies at i if i and i + d are
in one interval and part in it, that is, in two of its children. Hence only the
suffixes of the smaller children are asked, in both directions: is the inverse
suffix array at i + d, or at i - d, inside the interval? Each square found is
rotated left as far as its words go, which gives a maximal stretch; stretches
found with several periods are merged under the smallest. No tree is built: the
intervals are arrays of bounds.

All of it runs on lots of texts at once; words are numbered by text, so suffixes
of different texts never share a word. Memory of a lot is 4 bytes a word for
each doubling of its longest repeat, above some 200 bytes a word.

Defined cases: a null text has no words, and a text without words no run; equal
rows have equal runs, each by itself; of runs of one length the first start is
the longest; an empty table gives an empty result; columns that are not named in
``keep`` are not read, and ``keep`` may have any names but those of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arena.llm.word_windows import split

LEAST = 12  # words of the shortest run
LOT_WORDS = 150_000  # words of the texts that are sorted together


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _ranked(texts: list[list[bytes]]) -> np.ndarray:
    """Words of all texts as numbers; equal only for equal words of one text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    numbers = _Numbers()
    said = np.fromiter(map(numbers.__getitem__, (w for t in texts for w in t)), np.int64, int(sizes.sum()))
    return said + np.repeat(np.arange(len(texts), dtype=np.int64), sizes) * len(numbers)


def _heads(new: np.ndarray) -> np.ndarray:
    """Index of the first of each group, at all its members."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def suffix_order(said: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the ranks by 1, 2, 4, ... words; the last ranks are the inverse array.

    ``ends`` is the end of the text at every position. Only suffixes that still
    share a rank are sorted again.
    """
    n = len(said)
    order = np.argsort(said, kind="stable")
    new = np.ones(n, bool)
    new[1:] = said[order[1:]] != said[order[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = _heads(new)
    levels, reach = [rank], 1
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(slots):
        at = order[slots]
        follow = at + reach
        inside = follow < ends[at]
        second = np.where(inside, rank[np.minimum(follow, n - 1)], -1).astype(np.int64)
        key = rank[at].astype(np.int64) * (n + 1) + second + 1
        by_key = np.argsort(key, kind="stable")
        key, at = key[by_key], at[by_key]
        order[slots] = at
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[at] = slots[_heads(new)]
        levels.append(rank)
        slots = slots[~(new & np.append(new[1:], True))]
        reach *= 2
    return order, levels


def _shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """Words that agree after (``back``: before) the places ``a`` and ``b`` of one text."""
    n = len(levels[0])
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 2, -1, -1):  # no 2 ** (len - 1) words occur twice
        step = -(1 << k) if back else 0
        x, y = (a - out, b - out) if back else (a + out, b + out)
        x, y = x + step, y + step
        fits = (x >= 0) & (y < n)
        same = fits & (levels[k][np.where(fits, x, 0)] == levels[k][np.where(fits, y, 0)]) & (x != y)
        out[same] += 1 << k
    return out


def _smaller(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Next index after each of ``at`` with a smaller value; ``values`` ends with -1.

    Climbs a pyramid of block minima until a block holds a smaller value, then goes down to it.
    """
    pyramid = [values]
    while len(pyramid[-1]) > 1:
        row = pyramid[-1]
        row = np.append(row, row[-1:]) if len(row) % 2 else row
        pyramid.append(np.minimum(row[::2], row[1::2]))
    bound, here = values[at], at + 1
    level = np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    for k, row in enumerate(pyramid):  # up: blocks from ``here`` on, whose start is at an even place of the next level
        i = here[todo]
        hit = row[np.minimum(i, len(row) - 1)] < bound[todo]
        level[todo[hit]] = k
        todo, i = todo[~hit], i[~hit]
        odd = i % 2 == 0  # the sister block to the right was not looked at yet
        side = todo[odd]
        found = row[np.minimum(i[odd] + 1, len(row) - 1)] < bound[side]
        here[side[found]] += 1
        level[side[found]] = k
        gone = np.zeros(len(todo), bool)
        gone[np.flatnonzero(odd)[found]] = True
        todo, i = todo[~gone], i[~gone]
        here[todo] = i // 2 + 1
        if not len(todo):
            break
    for k in range(len(pyramid) - 1, 0, -1):  # down: into the first half with a smaller value
        down = np.flatnonzero(level >= k)
        left = here[down] * 2
        here[down] = left + (pyramid[k - 1][left] >= bound[down])
    return here


def lcp_intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left bounds, right bounds (exclusive) and split places of the intervals, sorted; one row a split place.

    ``lcp[k]`` is shared by the suffixes k - 1 and k of the array; 0 parts them.
    """
    at = np.flatnonzero(lcp > 0)
    right = _smaller(np.append(lcp, -1), at)
    turned = np.append(lcp[::-1], -1)
    left = len(lcp) - 1 - _smaller(turned, len(lcp) - 1 - at)
    by_bounds = np.lexsort((at, right, left))
    return left[by_bounds], right[by_bounds], at[by_bounds]


def _small_children(left: np.ndarray, right: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of an interval, place in the suffix array) of all suffixes outside of the largest child of their interval."""
    new = np.ones(len(cut), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    head = np.flatnonzero(new)
    # children: from the left bound or a split place to the next split place or the right bound
    begin = np.concatenate([left[head], cut])
    stop = np.concatenate([cut[head], np.where(np.append(new[1:], True), right, np.append(cut[1:], 0))])
    group = np.concatenate([np.arange(len(head)), np.cumsum(new) - 1])
    size = stop - begin
    order = np.lexsort((begin, -size, group))
    keep = np.ones(len(order), bool)
    keep[np.flatnonzero(np.diff(group[order], prepend=-1))] = False
    chosen = order[keep]
    size = size[chosen]
    place = np.repeat(begin[chosen] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return np.repeat(head[group[chosen]], size), place


def periodic_runs(texts: list[list[bytes]], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of at least ``least`` words, by text, start and period."""
    said = _ranked(texts)
    n = len(said)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not n:
        return (np.empty(0, np.int64),) * 4
    ends = np.repeat(np.cumsum(sizes), sizes)
    order, levels = suffix_order(said, ends)
    inverse = levels[-1]
    lcp = np.zeros(n, np.int64)
    near = np.flatnonzero(said[order[1:]] == said[order[:-1]]) + 1
    lcp[near] = _shared(levels, *(np.sort(np.stack([order[near - 1], order[near]]), 0)), back=False)
    left, right, cut = lcp_intervals(lcp)
    row, place = _small_children(left, right, cut)
    low, high, depth, i = left[row], right[row], lcp[cut[row]], order[place]
    squares = []
    for start, other in ((i, i + depth), (i - depth, i - depth)):
        fits = (other >= 0) & (other < n)
        there = inverse[np.where(fits, other, 0)]
        hit = fits & (there >= low) & (there < high)
        squares.append(np.stack([start[hit], depth[hit]]))
    start, period = np.unique(np.concatenate(squares, 1), axis=1)
    end = start + 2 * period
    inner = end < ends[start]
    branching = ~inner | (said[np.where(inner, end, 0)] != said[start])
    start, period, end = start[branching], period[branching], end[branching]
    start = start - _shared(levels, start, start + period, back=True)  # all rotations to the left
    order = np.lexsort((period, end, start))
    start, period, end = start[order], period[order], end[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    first &= end - start >= least
    start, period, end = start[first], period[first], end[first]
    order = np.lexsort((period, start))
    start, period, end = start[order], period[order], end[order]
    text = np.repeat(np.arange(len(texts)), sizes)[start] if len(start) else start
    return text, start - (np.cumsum(sizes) - sizes)[text], end - start, period


def _collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words outside of all runs, and the first period of each run, joined by one space."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    stay = np.cumsum(edge[:-1]) == 0
    return b" ".join([w for w, s in zip(words, stay.tolist(), strict=True) if s])


RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _lots(bodies: list[bytes | None], lot_words: int) -> Iterator[list[list[bytes]]]:
    lot, held = [], 0
    for body in bodies:
        lot.append(split(body))
        held += len(lot[-1])
        if held >= lot_words:
            yield lot
            lot, held = [], 0
    if lot:
        yield lot


def find_runs(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", least: int = LEAST, lot_words: int = LOT_WORDS) -> DataFrame:
    """``keep``, n_words, runs (by start, then period) and collapsed: the text without the repetitions of its runs.

    One map stage without a shuffle; a text is never split.
    """
    rows = df.select(*keep, F.col(text).cast("binary").alias("_body"))
    kept = rows.drop("_body").schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for lot in _lots(batch.column(batch.num_columns - 1).to_pylist(), lot_words):
                at, start, length, period = periodic_runs(lot, least)
                bounds = np.searchsorted(at, np.arange(len(lot) + 1))
                found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN_ARROW))
                collapsed = [
                    _collapsed(w, start[a:b], length[a:b], period[a:b]) if a < b else b" ".join(w)
                    for w, a, b in zip(lot, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                ]
                mine = batch.slice(done, len(lot))
                done += len(lot)
                yield pa.RecordBatch.from_arrays(
                    [mine.column(k) for k in range(mine.num_columns - 1)]
                    + [
                        pa.array([len(w) for w in lot], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=[f.name for f in kept] + ["n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(run, f"{fields}, n_words bigint, runs array<{RUN}>, collapsed string")

"""Hierarchical multi-length packing of documents into training windows.

A document is tokenized and closed by an end id. Its whole long windows stand
alone; what is left is routed to the smallest context tier that holds it. Then,
from the longest tier to the shortest: every long-tier rest opens a window, and
the gap is filled with the longest fitting rests of shorter tiers, at the end
with the head of one that is cut. Windows of shorter tiers are filled to the
last place, so they stand at their own size without padding. At last the windows
are dealt to step groups so that every group costs about the same.

A task packs its partition as it streams by, holding one pool of bounded size:
nothing is shuffled, no key decides where a document goes, and a lost task is
repeated with the same result. Ids of sequences and groups hold the partition.

Defined cases: a null text is empty, and an empty one is its end id alone;
repeated rows are packed once each; a null key is kept; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (256, 512, 1024, 2048)
END_ID = 1
POOL_TOKENS = 2_000_000  # a task packs whenever it holds this many
MIN_CUT = 16  # smaller gaps of a long window are padded, not filled with a cut
STEP_TOKENS = 131_072  # tokens of a step group
CACHE_WORDS = 1_200_000  # words of which a worker remembers the ids

_SEPARATOR = "\x01"
# letters of ASCII and Latin-1, then ASCII punctuation without the apostrophe, which can open a suffix
_WORD_AND_TAIL = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]+)")
_tokenizers: dict[str, WordIds] = {}


class WordIds:
    """Ids of texts, word by word: the vocabulary never joins over white space, so words are remembered.

    ASCII letters are lowered before the look-up, as the vocabulary does. Called
    on a text, control strings in it are words like others; ``whole`` sets them apart.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        (self.separator,) = self.tokenizer.encode(_SEPARATOR, add_special_tokens=False).ids
        self.known: dict[bytes, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder()
        self.controls = {t.content.encode(): np.array([i], "<u4").tobytes() for i, t in added.items()}
        longest = sorted(self.controls, key=len, reverse=True)
        self.control = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if longest else None

    def whole(self, text: bytes) -> bytes:
        """Ids of a document, in which control strings have their own ids, as the tokenizer reads them: in the raw text, also inside words."""
        if self.control is None or not self.control.search(text):
            return self(text)
        parts = self.control.split(text)
        return b"".join([self.controls[x] if k % 2 else self(x) for k, x in enumerate(parts)])

    def __call__(self, text: bytes) -> bytes:
        words = text.lower().split()
        try:
            return b"".join([self.known[w] for w in words])
        except KeyError:
            if len(self.known) > CACHE_WORDS:
                self.known = {}
            self.learn(sorted({w for w in words if w not in self.known}))
            return b"".join([self.known[w] for w in words])

    def learn(self, new: list[bytes]) -> None:
        """Punctuation behind letters never joins them, so such words are made of two that are met more often."""
        halves = {w: m.groups() for w in new if (m := _WORD_AND_TAIL.fullmatch(w))}
        rest = {x for w in new for x in halves.get(w, (w,)) if x not in self.known}
        self._encode(sorted(rest))
        for w, (head, tail) in halves.items():
            self.known[w] = self.known[head] + self.known[tail]

    def _encode(self, new: list[bytes]) -> None:
        odd = [w for w in new if _SEPARATOR.encode() in w]
        plain = [w for w in new if _SEPARATOR.encode() not in w] if odd else new
        for i in range(0, len(plain), 64):
            part = plain[i : i + 64]
            line = f" {_SEPARATOR} ".join(w.decode() for w in part)
            ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.separator)
            raw, begin = ids.tobytes(), 0
            for w, end in zip(part, (*cuts.tolist(), len(ids)), strict=True):
                self.known[w] = raw[4 * begin : 4 * end]
                begin = end + 1
        for w in odd:
            ids = self.tokenizer.encode(w.decode(), add_special_tokens=False).ids
            self.known[w] = np.array(ids, "<u4").tobytes()


def word_ids(path: str) -> WordIds:
    """One tokenizer and memory per worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class Packer:
    """Rests by tier, and the windows that are done. A piece is (document, start, length)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers, self.long = tiers, tiers[-1]
        self.rests: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # (length, document, start) sorted
        self.held = [0] * len(tiers)  # tokens of the rests of each tier
        self.windows: list[list[tuple[int, int, int]]] = []

    def add(self, doc: int, n: int) -> None:
        start = 0
        while n - start >= self.long:
            self.windows.append([(doc, start, self.long)])
            start += self.long
        if n > start:
            self._put(doc, start, n - start)

    def _put(self, doc: int, start: int, length: int) -> None:
        tier = next(i for i, size in enumerate(self.tiers) if length <= size)
        insort(self.rests[tier], (length, doc, start))
        self.held[tier] += length

    def _take(self, tier: int, at: int) -> tuple[int, int, int]:
        rest = self.rests[tier].pop(at)
        self.held[tier] -= rest[0]
        return rest

    def _fill(self, window: list, gap: int, below: int, least: int) -> int:
        """Puts rests of tiers under ``below`` into the window; returns the gap that is left."""
        while gap:
            for tier in range(below - 1, -1, -1):
                at = bisect_right(self.rests[tier], (gap, 1 << 62, 0))
                if at:
                    length, doc, start = self._take(tier, at - 1)
                    window.append((doc, start, length))
                    gap -= length
                    break
            else:
                break
        if gap >= least:
            for tier in range(below):
                if self.rests[tier]:  # all are longer than the gap: cut the shortest
                    length, doc, start = self._take(tier, 0)
                    window.append((doc, start, gap))
                    self._put(doc, start + gap, length - gap)
                    return 0
        return gap

    def pack(self, last: bool) -> None:
        """Packs tier by tier. Rests that cannot fill a window of their tier wait, and after the last call make smaller ones."""
        for tier in range(len(self.tiers) - 1, -1, -1):
            size = self.tiers[tier]
            while self.rests[tier] and sum(self.held[: tier + 1]) >= size:
                length, doc, start = self._take(tier, -1)
                window = [(doc, start, length)]
                least = MIN_CUT if size == self.long else 1
                gap = self._fill(window, size - length, tier, least)
                if gap >= least:
                    self._fill(window, gap, tier + 1, least)
                self.windows.append(window)
        if last:
            self._rest()

    def _rest(self) -> None:
        """What fits no window any more: powers of two, each exactly filled."""
        left = [(doc, start, length) for rests in self.rests for length, doc, start in rests]
        self.rests, self.held = [[] for _ in self.tiers], [0] * len(self.tiers)
        total = sum(x[2] for x in left)
        sizes = [self.long] * (total // self.long) + [1 << b for b in range(self.long.bit_length() - 2, -1, -1) if total % self.long >> b & 1]
        for size in sizes:
            window: list[tuple[int, int, int]] = []
            while size:
                doc, start, length = left.pop()
                take = min(size, length)
                window.append((doc, start, take))
                if take < length:
                    left.append((doc, start + take, length - take))
                size -= take
            self.windows.append(window)


def step_groups(windows: list[list[tuple[int, int, int]]], tokens: int = STEP_TOKENS) -> list[int]:
    """Group of each window. Windows go from dear to cheap, to and fro over the groups; attention costs the square of a piece."""
    total = sum(x[2] for w in windows for x in w)
    groups = max(1, round(total / tokens))
    order = sorted(range(len(windows)), key=lambda i: (-sum(x[2] * x[2] for x in windows[i]), i))
    out = [0] * len(windows)
    for rank, i in enumerate(order):
        turn, place = divmod(rank, groups)
        out[i] = place if turn % 2 == 0 else groups - 1 - place
    return out


def pack_documents(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, context, step_group, ids.

    ``ids`` are the token ids as little-endian unsigned 32-bit numbers; a
    sequence of under ``context`` ids is padded to the longest tier.
    """
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, base = word_ids(tokenizer), TaskContext.get().partitionId() << 33
        sequences = groups = held = 0
        packer, docs = Packer(tiers), {}

        def emit(last: bool) -> pa.RecordBatch | None:
            nonlocal sequences, groups, held, docs
            packer.pack(last)
            rows, mine = [], step_groups(packer.windows)
            for window, group in zip(packer.windows, mine, strict=True):
                size, offset = sum(x[2] for x in window), 0
                context = next(t for t in tiers if size <= t)
                for doc, start, length in window:
                    name, ids = docs[doc]
                    rows.append((name, start, length, len(ids) // 4, base + sequences, offset, context, base + groups + group, ids[4 * start : 4 * (start + length)]))
                    offset += length
                sequences += 1
            groups += max(mine, default=-1) + 1
            packer.windows = []
            waiting = {r[1] for rests in packer.rests for r in rests}
            docs, held = {d: docs[d] for d in waiting}, 0
            if not rows:
                return None
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        count = 0
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = ids_of.whole(body or b"") + np.array([END_ID], "<u4").tobytes()
                docs[count] = (name, ids)
                packer.add(count, len(ids) // 4)
                count, held = count + 1, held + len(ids) // 4
                if held >= POOL_TOKENS and (out := emit(False)) is not None:
                    yield out
        if (out := emit(True)) is not None:
            yield out

    from pyspark.sql.pandas.types import to_arrow_type

    names = [key, "start", "length", "doc_tokens", "sequence_id", "offset", "context", "step_group", "ids"]
    types = [to_arrow_type(kind), *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.binary()]
    schema = f"`{key}` {kind.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, context int, step_group long, ids binary"
    return df.select(F.col(key), F.col(text).cast("binary").alias("_body")).mapInArrow(run, schema)

"""Words of texts as 64-bit numbers, and hashes of runs of words, in numpy."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

CACHE_WORDS = 150_000  # words whose hash a worker remembers

_known: dict[bytes, int] = {}


def split(body: bytes | None) -> list[bytes]:
    """Words of a text: runs of bytes other than ASCII white space."""
    return body.split() if body else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One unsigned 64-bit hash a word."""
    global _known
    try:
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_known) > CACHE_WORDS:
            _known = {}
        for w in words:
            if w not in _known:
                _known[w] = xxh3_64_intdigest(w)
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits (the finaliser of splitmix64; fixed values)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(h: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``length`` words, by its start; polynomials of mixed words, built by doubling."""
    out, done, power = None, 0, 1
    block, size, factor = mixed(h ^ np.uint64(base)), 1, base
    mask = (1 << 64) - 1
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    while True:
        if length & size:
            part = block[done : done + n] * np.uint64(power)
            out = part if out is None else out + part
            done, power = done + size, power * factor & mask
        if size * 2 > length:
            return mixed(out)
        block = block[: len(block) - size] + block[size:] * np.uint64(factor)
        size, factor = size * 2, factor * factor & mask

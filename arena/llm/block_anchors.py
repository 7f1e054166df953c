"""Exact repeated passages by fixed-block anchors.

Every text is cut into blocks of BLOCK words that do not overlap; their hashes
are the index. Every rolling window of BLOCK words probes it. A passage of at
least 2 * BLOCK words that occurs twice holds a whole block of each occurrence,
which the other's rolling windows meet, so a hit marks every place where a
repeated passage can be. Hits are then extended: of the windows of LENGTH words
that hold a hit, equal ones meet by a 96-bit hash, the earliest stays, and runs
of the others are the maximal repeats, whose words go.

Hashes travel packed: a task sends, for each bucket of hash values, one row with
its distinct blocks and probes, seven to eight bytes a word. What a task repeats
itself is settled in the task and sent once, so a passage in a third of all
texts gives its bucket one entry a task and not one a text. Buckets and homes are
as many as the bytes of the texts ask for, each a partition of its own, so a task
holds the same at any size of the table; no fewer than the session's tasks.

Defined cases: a null or empty text has no words; texts under LENGTH words lose
nothing; rows of one id are one document: equal ones do not repeat each other,
and what goes from one row of an id at some place goes from the others there;
a null id comes first; an empty table gives an empty result; only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.llm.common import stored
from arena.llm.word_windows import mixed, run_hashes, split, word_hashes

LENGTH = 20  # words of a repeat
BLOCK = LENGTH // 2
CHUNK_WORDS = 300_000  # words of which a task packs the hashes at once
BUCKET_BYTES = 8 << 20  # of texts whose hashes share a bucket, about
HOME_BYTES = 32 << 20  # of texts that are opened and closed in one group, about
NULL_ID = -(2**63)


def _chunks(frames: Iterator[pd.DataFrame], column: str) -> Iterator[tuple[pd.DataFrame, list[list[bytes]]]]:
    """Rows with the words of their texts, lots of bounded size."""
    for frame in frames:
        lot, held, begin = [], 0, 0
        for i, body in enumerate(frame[column]):
            lot.append(split(body))
            held += len(lot[-1])
            if held >= CHUNK_WORDS:
                yield frame.iloc[begin : i + 1], lot
                lot, held, begin = [], 0, i + 1
        if lot:
            yield frame.iloc[begin:], lot


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned numbers, byte plane by byte plane, so that zeros compress away."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _steps(ids: np.ndarray) -> np.ndarray:
    """Differences, which are small where ids are in order."""
    return np.diff(ids.astype(np.int64), prepend=np.int64(0)).view(np.uint64)


def _unstep(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.view(np.int64))


PLACES = "bucket int, kind string, ids binary, starts binary, h binary, g binary"


def _rows(bucket: np.ndarray, kind: str, ids: np.ndarray, starts: np.ndarray, h: np.ndarray | None = None, width: int = 0, g: np.ndarray | None = None) -> pd.DataFrame:
    """One packed row a bucket; the order of the places is kept."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    out = []
    for part in np.split(order, cuts[1:]) if len(order) else []:
        out.append((
            int(bucket[part[0]]), kind, _planes(_steps(ids[part]), 8), _planes(starts[part], 4),
            None if h is None else _planes(h[part], width), None if g is None else _planes(g[part], 4),
        ))
    return pd.DataFrame(out, columns=["bucket", "kind", "ids", "starts", "h", "g"])


def _home(ids: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a document."""
    return (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _home_column(column: Column, buckets: int) -> Column:
    return F.pandas_udf(lambda ids: pd.Series(_home(ids.to_numpy(), buckets).astype("int32")), "int")(column)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _anchors_and_probes(buckets: int, homes: int):
    """Map: the distinct rolling windows of a lot, each marked if it is a block somewhere; its own repeats are hits."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, texts in _chunks(frames, "body"):
            hashes = [run_hashes(word_hashes(w), BLOCK) for w in texts]
            sizes = [len(h) for h in hashes]
            h = np.concatenate(hashes)
            ids = np.repeat(frame["id"].to_numpy(np.int64), sizes)
            starts = np.concatenate([np.arange(n) for n in sizes])
            order = np.argsort(h, kind="stable")
            new = _firsts(h[order])
            group = np.cumsum(new) - 1
            twice = np.bincount(group, minlength=1)[group] > 1
            block = np.bincount(group, weights=starts[order] % BLOCK == 0, minlength=1) > 0
            own = np.sort(order[twice])
            yield _rows(_home(ids[own], homes), "hit", ids[own], starts[own])
            # 0: probe, 1: block, 2: block among own repeats, which need no answer
            flag = block.astype(np.int64) + (block & twice[new])
            sent = order[new]
            ask = block | ~twice[new]
            sent, flag = sent[ask], flag[ask]
            by_place = np.argsort(sent)
            sent, flag = sent[by_place], flag[by_place]
            key = h[sent]
            yield _rows((key % np.uint64(buckets)).astype(np.int64), "ask", ids[sent], starts[sent] * 4 + flag, key // np.uint64(buckets), 5)

    return run


def _gathered(frame: pd.DataFrame, width: int) -> tuple[np.ndarray, ...]:
    ids = np.concatenate([_unstep(_numbers(x, 8)) for x in frame["ids"]])
    starts = np.concatenate([_numbers(x, 4) for x in frame["starts"]]).astype(np.int64)
    h = np.concatenate([_numbers(x, width) for x in frame["h"]])
    g = np.concatenate([_numbers(x, 4) for x in frame["g"]]) if frame["g"].notna().all() else np.zeros(len(h), np.uint64)
    return ids, starts, h, g


def _answer(frame: pd.DataFrame, homes: int, settle) -> pd.DataFrame:
    """Reduce: places that were settled in a task go on as they are; of the others ``settle`` picks."""
    settled, asked = frame[frame["kind"] == "hit"], frame[frame["kind"] == "ask"]
    out = [settled]
    if len(asked):
        ids, starts = settle(*_gathered(asked, 5 if asked["g"].isna().all() else 8))
        order = np.lexsort((starts, ids))
        out.append(_rows(_home(ids[order], homes), "hit", ids[order], starts[order]))
    return pd.concat(out)


def _probe(ids: np.ndarray, starts: np.ndarray, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that equal a block at another place."""
    flag, starts = starts % 4, starts // 4
    order = np.argsort(h, kind="stable")
    group = np.cumsum(_firsts(h[order])) - 1
    blocks = np.bincount(group, weights=flag[order] > 0, minlength=1)[group]
    hit = order[((flag[order] == 0) & (blocks >= 1)) | ((flag[order] == 1) & (blocks >= 2))]
    return ids[hit], starts[hit]


def _later(ids: np.ndarray, starts: np.ndarray, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose equals start earlier elsewhere."""
    order = np.lexsort((starts, ids, g, h))
    ids, starts, h, g = ids[order], starts[order], h[order], g[order]
    new = _firsts(h, g)
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    late = (ids != ids[first]) | (starts != starts[first])
    return ids[late], starts[late]


def _places(frame: pd.DataFrame) -> dict[int, np.ndarray]:
    """Starts by id, of packed rows."""
    if not len(frame):
        return {}
    ids = np.concatenate([_unstep(_numbers(x, 8)) for x in frame["ids"]])
    starts = np.concatenate([_numbers(x, 4) for x in frame["starts"]]).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    ids, starts = ids[order], starts[order]
    cuts = np.flatnonzero(_firsts(ids))
    return dict(zip(ids[cuts].tolist(), np.split(starts, cuts[1:]), strict=True))


def _spans(n: int, starts: np.ndarray, before: int, after: int) -> np.ndarray:
    """Marks of 0..n-1 that lie in start - before .. start + after - 1 of any start."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.clip(starts - before, 0, n), 1)
    np.add.at(edge, np.clip(starts + after, 0, n), -1)
    return np.cumsum(edge[:n]) > 0


OPEN = "id long, fp long, bucket int, n_words long, kept string, body binary, windows binary"


def _kept(words: list[bytes], gone: np.ndarray | None, digest: bool) -> str | None:
    left = words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    if digest:
        return sha256(b" ".join(left)).hexdigest()
    return None if gone is None else b" ".join(left).decode()


def _opened(docs: pd.DataFrame, hits: pd.DataFrame, digest: bool) -> pd.DataFrame:
    """Texts with the windows of LENGTH words that hold a hit; texts without are done."""
    at, out = _places(hits), []
    for i, fp, bucket, body in zip(docs["id"], docs["fp"], docs["bucket"], docs["body"], strict=True):
        words = split(body)
        n = len(words) - LENGTH + 1
        window = _spans(n, at[i], LENGTH - BLOCK, 1) if n > 0 and i in at else None
        if window is None or not window.any():
            out.append((i, fp, bucket, len(words), _kept(words, None, digest), None, None))
        else:
            out.append((i, fp, bucket, len(words), None, body, np.packbits(window).tobytes()))
    return pd.DataFrame(out, columns=["id", "fp", "bucket", "n_words", "kept", "body", "windows"])


def _windows(buckets: int, homes: int):
    """Map: the earliest place of each distinct open window of a lot; later places of the lot are repeats."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, texts in _chunks(frames, "body"):
            h, g, ids, starts = [], [], [], []
            for i, words, raw in zip(frame["id"], texts, frame["windows"], strict=True):
                at = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), count=len(words) - LENGTH + 1))
                numbers = word_hashes(words)
                h.append(run_hashes(numbers, LENGTH)[at])
                g.append(run_hashes(mixed(numbers), LENGTH, 0xD6E8FEB86659FD93)[at] & np.uint64(0xFFFFFFFF))
                ids.append(np.full(len(at), i, np.int64))
                starts.append(at)
            h, g, ids, starts = map(np.concatenate, (h, g, ids, starts))
            order = np.lexsort((starts, ids, g, h))
            h, g, ids, starts = h[order], g[order], ids[order], starts[order]
            new = _firsts(h, g)
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            late = np.flatnonzero((ids != ids[first]) | (starts != starts[first]))
            late = late[np.lexsort((starts[late], ids[late]))]
            yield _rows(_home(ids[late], homes), "hit", ids[late], starts[late])
            sent = np.flatnonzero(new)
            sent = sent[np.lexsort((starts[sent], ids[sent]))]
            yield _rows((h[sent] % np.uint64(buckets)).astype(np.int64), "ask", ids[sent], starts[sent], h[sent], 8, g[sent])

    return run


def _closed(docs: pd.DataFrame, late: pd.DataFrame, digest: bool) -> pd.DataFrame:
    """Texts without the words that late windows cover."""
    at, out = _places(late), []
    for i, fp, body in zip(docs["id"], docs["fp"], docs["body"], strict=True):
        words = split(body)
        gone = _spans(len(words), at[i][at[i] <= len(words) - LENGTH], 0, LENGTH) if i in at else np.zeros(len(words), bool)
        n = int(gone.sum())
        out.append((i, fp, len(words), n, _kept(words, gone if n else None, digest)))
    return pd.DataFrame(out, columns=["id", "fp", "n_words", "n_removed", "kept"])


def _shape(docs: DataFrame) -> tuple[int, int]:
    """(buckets, homes) that keep a group of either at the same size whatever the size of the table; one count of bytes."""
    size = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * tasks, -(-size // BUCKET_BYTES)), max(tasks, -(-size // HOME_BYTES))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """id, fp, n_words, n_removed and kept, one row per input row; see ``keyed`` for id and fp.

    ``kept`` is the text that is left, its words joined by one space, or null
    where nothing was removed; with ``digest``, the hex SHA-256 of the words left.
    """
    docs = keyed(df, key, text).select("id", "fp", F.col(text).cast("binary").alias("body"))
    buckets, homes = _shape(docs)  # of hash values; answers go to the homes of the documents
    asked = docs.mapInPandas(_anchors_and_probes(buckets, homes), PLACES)
    by_bucket = lambda rows, parts: rows.repartition(parts, "bucket").groupBy("bucket")
    hits = stored(by_bucket(asked, buckets).applyInPandas(lambda f: _answer(f, homes, _probe), PLACES), "anchors-hits")
    home = docs.withColumn("bucket", _home_column(F.col("id"), homes))
    opened = by_bucket(home, homes).cogroup(by_bucket(hits, homes)).applyInPandas(lambda d, h: _opened(d, h, digest), OPEN)
    opened = stored(opened, "anchors-open")
    todo = opened.filter("body is not null")
    late = todo.select("id", "body", "windows").mapInPandas(_windows(buckets, homes), PLACES)
    late = stored(by_bucket(late, buckets).applyInPandas(lambda f: _answer(f, homes, _later), PLACES), "anchors-late")
    closed = by_bucket(todo.select("id", "fp", "bucket", "body"), homes).cogroup(by_bucket(late, homes)).applyInPandas(
        lambda d, h: _closed(d, h, digest), "id long, fp long, n_words long, n_removed long, kept string"
    )
    done = opened.filter("body is null").select("id", "fp", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept")
    return done.unionByName(closed)


def keyed(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds id (null: the smallest number) and fp (hash of the text), which find a row's result."""
    return df.withColumns({"id": F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)), "fp": F.xxhash64(text)})

"""Near-duplicate documents by ProbMinHash of weighted five-word shingles.

A shingle weighs as many as it has different words, in every text alike, so runs
of one word count little and prose counts in full. Two texts are linked by the
probability Jaccard similarity of these weights; as a shingle's weight depends on
the shingle alone, that is the weight they share over the weight of both, however
often a text repeats a shingle.

Equal texts are one class, kept by its smallest id. A class is sketched by
Poisson processes: a shingle of weight w arrives at random times of rate w, every
arrival falls into one of REGISTERS registers, and each register keeps its first
shingle. Arrivals after the last register's time change nothing, so a shingle
stops early. Two sketches agree in a register with just the similarity above.
Bands of four registers bring candidates together; candidates whose sketches
agree well enough are verified on their whole texts, by the same similarity.

Members of a small bucket are all compared. In a large one each member is
compared with its hubs, the members that share most buckets, which links most
copies at little cost. What the links leave in several parts is then compared
whole: in each large bucket the members outside of its main part meet all others,
in tiles of bounded size, so no bucket is expanded into its pairs, and no pair of
two parts is left out. A tile sends one edge for each two parts it joins.

Defined cases: a null text is empty; texts without words are alone, whatever
they are; texts of one to four words have one shingle; rows of one id are one
document with several texts; rows of a null id are one document, which comes
first, and the class it leads is null; an empty table gives an empty result; only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arena.llm.common import stored
from arena.llm.word_windows import mixed, run_hashes, split, word_hashes
from arena.operators.graph import connected_components

SHINGLE = 5
NULL_ID = -(2**63)
SIMILARITY = 0.8
BANDS, ROWS = 24, 4  # a pair at 0.8 shares no band with a chance of 3e-6
REGISTERS = BANDS * ROWS
AGREE = 56  # registers; a pair at 0.8 agrees in fewer with a chance under 1e-6
SMALL = 64  # a bucket up to this size is compared whole
HUBS = 3  # members of a large bucket with which all others are compared first
TILE = 4_000  # members of a block, and
TILE_BYTES = 8_000_000  # its texts; a tile compares two blocks
GROUP_SHINGLES = 400_000  # sketched at once
SHORT = 64  # shingles of a short text

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_PAD = np.arange(1, SHINGLE, dtype=np.uint64)


Shingles = tuple[np.ndarray, np.ndarray]  # hashes, sorted and distinct, and their weights


def _shingles(body: bytes | None) -> Shingles:
    """Distinct shingles of a text with the number of their different words."""
    h = word_hashes(split(body))
    if 0 < len(h) < SHINGLE:
        h = np.concatenate([h, _PAD[: SHINGLE - len(h)]])
    keys, first = np.unique(run_hashes(h, SHINGLE), return_index=True)
    weights = np.ones(len(keys), np.int64)
    for j in range(1, SHINGLE):  # word j counts if none before it in the shingle is the same
        new = np.ones(len(keys), bool)
        for i in range(j):
            new &= h[first + j] != h[first + i]
        weights += new
    return keys, weights


def sketch(texts: list[Shingles]) -> np.ndarray:
    """Registers of each set of weighted shingles (none empty)."""
    doc = np.repeat(np.arange(len(texts)), [len(keys) for keys, _ in texts])
    seed = np.concatenate([keys for keys, _ in texts])
    pace = 1 / np.concatenate([weights for _, weights in texts])  # mean time between arrivals
    item = seed
    when = np.full(len(texts) * REGISTERS, np.inf)
    what = np.zeros(len(when), np.uint64)
    time = np.zeros(len(seed))
    while len(seed):
        seed = seed + _GOLDEN
        draw = mixed(seed)
        time = time - np.log(((draw >> np.uint64(11)).astype("f8") + 0.5) * 2.0**-53) * pace
        register = (mixed(draw + _GOLDEN) % np.uint64(REGISTERS)).astype(np.int64)
        at = doc * REGISTERS + register
        early = time < when[at]
        np.minimum.at(when, at[early], time[early])
        won = early.copy()
        won[early] = time[early] == when[at[early]]
        what[at[won]] = item[won]
        alive = time < when.reshape(-1, REGISTERS).max(axis=1)[doc]
        doc, seed, item, time, pace = doc[alive], seed[alive], item[alive], time[alive], pace[alive]
    return what.reshape(-1, REGISTERS)


def _groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Texts to sketch together: all short ones, whose processes take many rounds, and bounded lots of the others."""
    yield np.flatnonzero((sizes > 0) & (sizes <= SHORT))
    long = np.flatnonzero(sizes > SHORT)
    lots = np.cumsum(sizes[long]) // GROUP_SHINGLES
    for lot in np.unique(lots):
        yield long[lots == lot]


def sketched(docs: DataFrame) -> DataFrame:
    """id, same (digest of the text), bands and sketch of (id, body); texts without words have null bands."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = mixed(np.arange(1, ROWS + 1, dtype=np.uint64))
        for frame in frames:
            shingles = [_shingles(b) for b in frame["body"]]
            bands, tiny = [None] * len(frame), [None] * len(frame)
            for lot in _groups(np.array([len(keys) for keys, _ in shingles])):
                if not len(lot):
                    continue
                registers = sketch([shingles[i] for i in lot])
                keys = mixed((registers.reshape(len(lot), BANDS, ROWS) * factors).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                small = (registers >> np.uint64(56)).astype(np.uint8)
                for k, i in enumerate(lot):
                    bands[i], tiny[i] = keys[k].view(np.int64), small[k].tobytes()
            yield pd.DataFrame({"id": frame["id"], "same": frame["same"], "bands": bands, "sketch": tiny})

    return docs.mapInPandas(run, "id long, same binary, bands array<long>, sketch binary")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sketches agree well enough and whose whole texts have at least that similarity.

    ``texts``: id, sketch, body. Sketch and text come by one join a side, and only agreeing pairs are cut into shingles.
    """

    @F.pandas_udf("boolean")
    def near(sa: pd.Series, sb: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        seen: dict[bytes, Shingles] = {}

        def of(body: bytes) -> Shingles:
            if body not in seen:
                if len(seen) > 200:
                    seen.clear()
                seen[body] = _shingles(body)
            return seen[body]

        out = []
        for p, q, x, y in zip(sa, sb, a, b, strict=True):
            if (np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8)).sum() < AGREE:
                out.append(False)
                continue
            (p, weights), (q, others) = of(x), of(y)
            m, n = int(weights.sum()), int(others.sum())
            if min(m, n) < similarity * max(m, n):
                out.append(False)
                continue
            _, at, _ = np.intersect1d(p, q, assume_unique=True, return_indices=True)
            common = int(weights[at].sum())
            out.append(common >= similarity * (m + n - common) - 1e-9)
        return pd.Series(out, dtype="bool")

    ours = texts.select(F.col("id").alias("a"), F.col("sketch").alias("sa"), F.col("body").alias("ta"))
    theirs = texts.select(F.col("id").alias("b"), F.col("sketch").alias("sb"), F.col("body").alias("tb"))
    return pairs.join(ours, "a").join(theirs, "b").filter(near("sa", "sb", "ta", "tb")).select("a", "b")


def _candidates(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs to compare of (key, band, id, hub), and the members of large buckets."""
    turn = F.pmod(F.xxhash64("id"), F.lit(HUBS))
    tops = [F.max(F.when(turn == i, F.struct("hub", "id"))).alias(f"top{i}") for i in range(HUBS)]
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), *tops)
    hubs = F.array_compact(F.array(*[F.col(f"top{i}") for i in range(HUBS)]))
    buckets = buckets.filter(F.col("low") != F.col("high")).select("key", "n", F.when(F.col("n") > SMALL, hubs).alias("hubs"))
    here = stored(members.join(buckets, "key"), "minhash-members")
    small = here.filter(F.col("n") <= SMALL).select("key", "id")
    each = small.join(small.select("key", F.col("id").alias("b")), "key").filter(F.col("id") < F.col("b")).select(F.col("id").alias("a"), "b")
    large = here.filter(F.col("n") > SMALL)
    star = large.select("id", F.explode("hubs").alias("h")).filter(F.col("id") != F.col("h.id"))
    star = star.select(F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b"))
    return each.unionByName(star).distinct(), large.select("key", "band", "id")


def _join_tile(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Edges that join the parts of one tile (i, j) of a bucket: every pair of two parts that may be linked is compared.

    A pair that shares an earlier band is left to the bucket of that band.
    """
    same, band = frame["i"].iloc[0] == frame["j"].iloc[0], int(frame["band"].iloc[0])
    side, part = frame["side"].to_numpy(), frame["part"].to_numpy()
    src, dst = [], []
    if not same and (side == side[0]).all():
        return pd.DataFrame({"src": src, "dst": dst}, dtype="int64")
    small = np.stack([np.frombuffer(x, np.uint8) for x in frame["sketch"]])
    bands = np.stack(frame["bands"].to_list())[:, :band]
    texts = [_shingles(b) for b in frame["body"]]
    lengths = np.array([len(keys) for keys, _ in texts])
    sizes = np.array([int(weights.sum()) for _, weights in texts])
    starts = np.cumsum(lengths) - lengths
    number = np.unique(np.concatenate([keys for keys, _ in texts]), return_inverse=True)[1].astype(np.int32)
    weight = np.concatenate([weights for _, weights in texts])
    mark = np.zeros(int(number.max()) + 1, np.int64)
    root = np.unique(part, return_inverse=True)[1]
    value = np.unique(part)
    for x in range(len(frame)) if same else np.flatnonzero(side == 0):
        others = root != root[x]
        others &= np.arange(len(frame)) > x if same else side == 1
        at = np.flatnonzero(others & (np.minimum(sizes, sizes[x]) >= similarity * np.maximum(sizes, sizes[x])))
        at = at[(small[at] == small[x]).sum(axis=1) >= AGREE]
        at = at[~(bands[at] == bands[x]).any(axis=1)]
        if not len(at):
            continue
        own = slice(starts[x], starts[x] + lengths[x])
        mark[number[own]] = weight[own]
        common = np.array([mark[number[starts[y] : starts[y] + lengths[y]]].sum() for y in at])
        mark[number[own]] = 0
        for y in at[common >= similarity * (sizes[x] + sizes[at] - common) - 1e-9]:
            if root[y] != root[x]:
                src.append(value[root[x]])
                dst.append(value[root[y]])
                root[root == root[y]] = root[x]
    return pd.DataFrame({"src": src, "dst": dst}, dtype="int64")


def _joined_parts(large: DataFrame, parts: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """src, dst: parts that a link inside a large bucket joins.

    ``large``: key, band, id. ``parts``: id, part. ``texts``: id, bands, sketch, body.
    """
    placed = large.join(parts, "id")
    counted = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    main = counted.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
    sized = texts.select("id", F.length("body").alias("size"))
    rest = placed.join(main.filter("parts > 1").select("key", "main"), "key").join(sized, "id")
    rest = stored(rest.withColumn("free", F.col("part") != F.col("main")), "minhash-rest")

    # blocks of a bucket by hash, those of the main part last; a tile is a pair of blocks, never of two of the main part
    def blocks(of: Column) -> Column:
        bytes_of = F.sum(F.when(of, F.col("size").cast("long")).otherwise(0))
        return F.greatest(F.ceil(F.count_if(of) / TILE), F.ceil(bytes_of / TILE_BYTES)).cast("int")

    counts = rest.groupBy("key").agg(blocks(F.col("free")).alias("frees"), blocks(~F.col("free")).alias("mains"))
    place = F.xxhash64("id")
    block = F.when(F.col("free"), F.pmod(place, F.col("frees"))).otherwise(F.col("frees") + F.pmod(place, F.col("mains")))
    blocked = rest.join(counts, "key").withColumn("block", block.cast("int"))
    last = F.when(F.col("free"), F.col("frees") + F.col("mains")).otherwise(F.col("frees")) - 1
    tiles = blocked.select("*", F.explode(F.sequence(F.lit(0), last)).alias("other")).select(
        "key", "band", "id", "part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    full = tiles.join(texts, "id")
    return full.groupBy("key", "i", "j").applyInPandas(lambda f: _join_tile(f, similarity), "src long, dst long")


def near_classes(df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``key``, class_id (smallest id of the component) and kept (the row is that document), one row per input row."""
    docs = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(key).alias("own"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    ).withColumn("same", F.unhex(F.md5("body")))
    rows = stored(sketched(docs.select("id", "same", "body")), "minhash-sketches")
    wordy = rows.filter("bands is not null")
    classes = stored(wordy.groupBy("same").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "minhash-classes")

    banded = classes.select("id", F.posexplode("bands").alias("band", "value")).select("id", "band", F.xxhash64("band", "value").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(banded.join(shared, "key"), "minhash-buckets")
    hubs = members.groupBy("id").agg(F.sum("n").alias("hub"))
    ids = hubs.select("id")
    found = classes.join(ids, "id", "left_semi")
    sketches = stored(found.groupBy("id").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "minhash-found")
    bodies = docs.select("id", "same", "body").join(found.select("id", "same"), ["id", "same"], "left_semi")
    texts = bodies.groupBy("id").agg(F.min("body").alias("body")).join(sketches, "id")
    texts = stored(texts, "minhash-texts")

    pairs, large = _candidates(members.select("key", "band", "id").join(hubs, "id"))
    links = stored(_verified(pairs, texts, similarity), "minhash-links")
    parts = connected_components(ids, links.select(F.col("a").alias("src"), F.col("b").alias("dst"))).withColumnRenamed("component", "part")
    parts = stored(parts, "minhash-parts")
    edges = stored(_joined_parts(large, parts, texts, similarity), "minhash-edges")
    if not edges.isEmpty():
        ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        wider = connected_components(ends, edges).withColumnRenamed("id", "part")
        parts = parts.join(wider, "part", "left").select("id", F.coalesce("component", "part").alias("part"))
    linked = parts.select(F.col("id").alias("rep"), F.col("part").alias("component"))
    of_class = classes.select("same", F.col("id").alias("rep")).join(linked, "rep", "left")
    joined = rows.select("id", "same").join(of_class, "same", "left")
    back = joined.select(F.coalesce("component", "rep", "id").alias("class_id"), "id")
    named = lambda col: F.when(F.col(col) != NULL_ID, F.col(col))
    return back.select(
        named("id").cast(df.schema[key].dataType).alias(key), named("class_id").alias("class_id"), (F.col("id") == F.col("class_id")).alias("kept")
    )

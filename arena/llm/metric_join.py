"""Exact near-duplicate join of vectors: pivots, triangle inequality, independent cells.

Equal unit vectors of a label are one class. Pivots are a sample of the classes
that grows with the label, thinned to a distance of at least r, so a dense spot
keeps one pivot and the cells that reach a vector do not multiply with the data;
every class belongs to the cell of its nearest pivot. If x (cell p) and
y (cell q) are within r, the triangle inequality gives d(x, q) <= d(x, p) + 2r,
and x must lie within r of the plane halfway between p and q, and within r of
the ball that cell q fills. Only then is x copied to q as a guest, and of the
two cells the one with the smaller number joins the pair. Cells are joined
independently, in tiles of bounded size, so a dense cell is many small tasks;
a tile sends counts of links and one edge per vector and local component, never
the pairs.

Defined cases: null, zero, or non-finite vectors, and vectors without a label
link with nothing and are their own component; vectors of different lengths never
link, each length of a label is joined on its own; repeated ids are joined as one vector each by their content, and
every row gets its result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arena.llm.common import stored
from arena.operators.graph import connected_components

TILE = 1_000  # classes of a block; a tile compares two blocks
PIVOTS = 2_000  # at most, of a label and length; one for half a tile of classes before thinning
PIVOT_ROWS = 12_000  # of all groups together, shared by size; what the driver holds and sends to tasks
PIVOTED = 500  # so many groups of more than a tile, the largest ones, get pivots; any further one is a single cell of tiles
PRODUCTS = 2_000_000  # of vectors and pivots held at once in a task
FRAME = 10_000  # guests sent on at once
HASHES = 2**31  # hashes of vectors run below it
SLACK = 1e-12  # of products of unit vectors, against rounding
ROUND = 1e-6  # of distances: the root of a product's rounding
GUEST, HOME = 1, 0


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(v, "<f8") for v in values])


def unit_vectors(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """vid, label, unit (binary of doubles; null if the vector links with nothing)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            units = []
            for v, known in zip(frame["v"], frame["label"].notna(), strict=True):
                unit = None
                if known and v is not None and len(v):
                    x = np.array([np.nan if c is None else c for c in v], "f8") if isinstance(v, list) else np.asarray(v, "f8")
                    top = np.abs(x).max()
                    if np.isfinite(top) and top > 0:
                        x = x / top  # the square of a huge or tiny component stays finite
                        unit = (x / np.sqrt(x @ x)).astype("<f8").tobytes()
                units.append(unit)
            yield pd.DataFrame({"vid": frame["vid"], "label": frame["label"], "unit": units})

    read = df.select(F.col(vec_id).cast("long").alias("vid"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    return read.mapInPandas(run, "vid long, label string, unit binary")


def _thinned(points: np.ndarray, radius: float) -> np.ndarray:
    """Points in order, without those nearer than ``radius`` to one that was kept."""
    kept = points[:1]
    for point in points[1:]:
        if np.linalg.norm(kept - point, axis=1).min() >= radius:
            kept = np.vstack([kept, point])
    return kept


def _pivots(classes: DataFrame, radius: float) -> dict[tuple[str, int], np.ndarray]:
    """Classes in hash order of each large group, as many as its size asks for: at most PIVOT_ROWS + PIVOTED rows come to the driver."""
    groups = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE)
    large = groups.orderBy(F.desc("n"), "label", "dim").limit(PIVOTED).collect()
    if not large:
        return {}
    total = sum(r["n"] for r in large)
    asked = []
    for r in large:
        quota = min(PIVOTS, -(-2 * r["n"] // TILE), -(-PIVOT_ROWS * r["n"] // total))
        asked.append((r["label"], r["dim"], quota, int(HASHES * min(1, (2 * quota + 100) / r["n"]))))
    quotas = classes.sparkSession.createDataFrame(asked, "label string, dim int, quota long, below long")
    # the hash leaves about twice the quota of a group before anything is shuffled
    sample = classes.join(F.broadcast(quotas), ["label", "dim"]).filter(F.pmod(F.xxhash64("unit"), F.lit(HASHES)) < F.col("below"))
    first = Window.partitionBy("label", "dim").orderBy(F.xxhash64("unit"), "cid")
    ranked = sample.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= F.col("quota"))
    chosen = ranked.orderBy("label", "dim", "n").select("label", "dim", "unit").toPandas()
    return {k: _thinned(_matrix(g["unit"]), radius) for k, g in chosen.groupby(["label", "dim"])}


def _pieces(frame: pd.DataFrame, pivots: np.ndarray) -> Iterator[pd.DataFrame]:
    step = max(1, PRODUCTS // len(pivots))
    for i in range(0, len(frame), step):
        yield frame.iloc[i : i + step]


def _assign(classes: DataFrame, pivots: dict) -> DataFrame:
    """cid, label, dim, unit, cell, near (distance to the own pivot)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (name, dim), g in frame.groupby(["label", "dim"]):
                if (name, dim) not in pivots:
                    yield g.assign(cell=np.int32(0), near=0.0)
                    continue
                for piece in _pieces(g, pivots[name, dim]):
                    cos = _matrix(piece["unit"]) @ pivots[name, dim].T
                    cell = cos.argmax(axis=1)
                    near = np.sqrt(np.maximum(2 - 2 * cos[np.arange(len(piece)), cell], 0))
                    yield piece.assign(cell=cell.astype("int32"), near=near)

    return classes.mapInPandas(run, "cid long, copies long, label string, dim int, unit binary, cell int, near double")


def _balls(homes: DataFrame, pivots: dict) -> dict[tuple[str, int, int], float]:
    """Largest distance to the own pivot by (label, dim, cell), of groups with pivots: at most PIVOT_ROWS + PIVOTED rows come to the driver."""
    if not pivots:
        return {}
    known = homes.sparkSession.createDataFrame([(name, int(dim)) for name, dim in pivots], "label string, dim int")
    cells = homes.join(F.broadcast(known), ["label", "dim"]).groupBy("label", "dim", "cell").agg(F.max("near").alias("ball"))
    return {(r["label"], r["dim"], r["cell"]): r["ball"] for r in cells.collect()}


def _copied(classes: DataFrame, pivots: dict, balls: dict, radius: float) -> DataFrame:
    """Every class at home, and as a guest in each cell of a smaller number that may hold partners."""

    def bounds(name: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
        p = pivots[name, dim]
        apart = np.stack([np.linalg.norm(p - x, axis=1) for x in p])  # of the difference: exact for near pivots too
        return apart, np.array([balls.get((name, dim, c), -np.inf) for c in range(len(p))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        for frame in frames:
            frame = frame.assign(role=np.int32(HOME), home=frame["cell"])
            yield frame
            for (name, dim), g in frame.groupby(["label", "dim"]):
                if (name, dim) not in pivots:
                    continue
                p = pivots[name, dim]
                if (name, dim) not in known:
                    known[name, dim] = bounds(name, dim)
                apart, ball = known[name, dim]
                for piece in _pieces(g, p):
                    cos = _matrix(piece["unit"]) @ p.T
                    dist = np.sqrt(np.maximum(2 - 2 * cos, 0))
                    own, cell = piece["near"].to_numpy()[:, None], piece["cell"].to_numpy()
                    # the distance to the plane times 2 * apart, so that pivots may coincide
                    may = 2 * (cos[np.arange(len(piece)), cell][:, None] - cos) <= 2 * (radius + ROUND) * apart[cell] + SLACK
                    may &= (cell[:, None] > np.arange(len(p))) & (dist <= own + 2 * radius + ROUND) & (dist <= ball + radius + ROUND)
                    row, q = np.nonzero(may)
                    for i in range(0, len(row), FRAME):
                        yield piece.iloc[row[i : i + FRAME]].assign(cell=q[i : i + FRAME].astype("int32"), role=np.int32(GUEST))

    return classes.mapInPandas(run, "cid long, copies long, label string, dim int, unit binary, cell int, near double, role int, home int")


def _local_components(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every vertex of the links to the smallest id of its local component."""
    best = ids.copy()
    while True:
        low = np.minimum(best[a], best[b])
        new = best.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == best).all():
            break
        best = new
    moved = best != ids
    return ids[moved], best[moved]


def _join_tile(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Counts of linked rows per class, and edges, of one tile (i, j) of a cell."""
    left, right = frame[frame["side"] == 0], frame[frame["side"] == 1]
    same = frame["i"].iloc[0] == frame["j"].iloc[0]
    if not len(left) or not (same or len(right)):
        return pd.DataFrame({"cid": [], "other": [], "n": []}, dtype="int64")
    right = left if same else right
    x, y = _matrix(left["unit"]), _matrix(right["unit"])
    ids = np.concatenate([left["cid"].to_numpy(), right["cid"].to_numpy()])
    links = x @ y.T >= threshold
    if same:
        np.fill_diagonal(links, False)
    n = len(left)
    a, b = np.nonzero(links)
    counts = [pd.DataFrame({"cid": left["cid"], "other": -1, "n": links @ right["copies"].to_numpy()})]
    if not same:
        counts.append(pd.DataFrame({"cid": right["cid"], "other": -1, "n": left["copies"].to_numpy() @ links}))
    src, dst = _local_components(a, b + (0 if same else n), ids)
    counts.append(pd.DataFrame({"cid": src, "other": dst, "n": 0}))
    out = pd.concat(counts)
    return out[(out["n"] > 0) | (out["other"] >= 0)].astype("int64")


def join_vectors(df: DataFrame, threshold: float, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: links are pairs of one label with a cosine of at least ``threshold``."""
    units = stored(unit_vectors(df, vec_id, vector, label), "metric-units")
    linkable = units.filter("unit is not null")
    key = ["label", "unit"]
    classes = linkable.groupBy(*key).agg(F.coalesce(F.min("vid"), F.lit(-(2**63))).alias("cid"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.select("cid", "copies", "label", (F.length("unit") / 8).cast("int").alias("dim"), "unit"), "metric-classes")
    radius = float(np.sqrt(2 - 2 * threshold))
    pivots = _pivots(classes, radius)
    homes = stored(_assign(classes, pivots), "metric-cells")
    balls = _balls(homes, pivots)
    copied = _copied(homes, pivots, balls, radius)

    # blocks of a cell by hash, guests after those at home; a tile is a pair of blocks, never of two guests
    copied = stored(copied, "metric-copies")
    cell = ["label", "dim", "cell"]
    count = lambda role: F.ceil(F.count_if(F.col("role") == role) / TILE).cast("int")
    sizes = copied.groupBy(*cell).agg(count(HOME).alias("homes"), count(GUEST).alias("guests"))
    at_home, place = F.col("role") == HOME, F.xxhash64("cid")
    block = F.when(at_home, F.pmod(place, F.col("homes"))).otherwise(F.col("homes") + F.pmod(place, F.greatest("guests", F.lit(1))))
    blocked = copied.join(sizes, cell).withColumn("block", block.cast("int"))
    last = F.when(at_home, F.col("homes") + F.col("guests")).otherwise(F.col("homes")) - 1
    tiles = blocked.select("*", F.explode(F.sequence(F.lit(0), last)).alias("other")).select(
        *cell, "cid", "copies", "unit", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    found = tiles.groupBy(*cell, "i", "j").applyInPandas(lambda f: _join_tile(f, threshold), "cid long, other long, n long")
    found = stored(found, "metric-found")

    links = found.filter("other < 0").groupBy("cid").agg(F.sum("n").alias("n"))
    edges = found.filter("other >= 0").select(F.col("cid").alias("src"), F.col("other").alias("dst"))
    parts = connected_components(links.select(F.col("cid").alias("id")), edges)
    of_class = (
        classes.select("cid", "copies", *key)
        .join(links, "cid", "left").join(parts.select(F.col("id").alias("cid"), "component"), "cid", "left")
        .select(*key, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", F.col("cid")).alias("part"))
    )
    known = linkable.join(of_class, key)
    alone = units.filter("unit is null").select("vid", F.lit(0).cast("long").alias("n"), F.col("vid").alias("part"))
    return known.select("vid", "n", "part").unionByName(alone).select(
        F.col("vid").alias(vec_id), F.col("n").alias("n_links"), F.col("part").alias("component_id"), F.col("vid").eqNullSafe(F.col("part")).alias("kept")
    )

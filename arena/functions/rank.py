"""Ranking and first/last-per-key without putting one hot key into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_SPLITS = 1024  # upper bound of the split array carried in the plan; heavy values are cut again by the tie


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key; NULLs rank lowest.

    An aggregate, so hot keys are combined on the map side before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def quantile_splits(df: DataFrame, *columns: str) -> list[float] | list[list[float]]:
    """Split points of a numeric column, or of several: one pass, bounded arrays to the driver."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(2, min(parts, MAX_SPLITS))
    points = [i / n for i in range(1, n)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), points, 4 * n) for c in columns]).first()
    out = [sorted(set(row or ())) for row in found]
    return out[0] if len(columns) == 1 else out


def with_range(df: DataFrame, value: Column, splits: Sequence[float | str], name: str) -> DataFrame:
    """Adds the number of splits below the value, found in two steps: a block of splits, then inside it.

    Plain comparisons, about twice the square root of the number of splits. The
    splits are numbers, or strings in order for a string column.
    """
    if not splits:
        return df.withColumn(name, F.lit(0))
    texts = isinstance(splits[0], str)
    lit = F.lit if texts else lambda b: F.lit(float(b))
    width = math.ceil(math.sqrt(len(splits)))
    blocks = [list(splits[i : i + width]) for i in range(0, len(splits), width)]
    above = lambda bound: F.when(value > bound, 1).otherwise(0)
    blocked = df.withColumn("_block", sum((above(lit(b[-1])) for b in blocks[:-1]), F.lit(0)))
    steps = []
    for i in range(width):
        # nothing is above the places that the last block lacks
        column = F.array(*[lit(b[i]) if i < len(b) else F.lit(None if texts else math.inf) for b in blocks])
        steps.append(above(F.get(column, F.col("_block"))))
    return blocked.withColumn(name, F.col("_block") * width + sum(steps, F.lit(0))).drop("_block")


PAGE_RANGES = 1024  # ranges that one round of paging cuts the keys into
PAGE_ROWS = 100_000  # rows of a range that are sorted as they are


def page_bounds(df: DataFrame, order: str, offset: int, limit: int) -> tuple[str | None, str | None, int]:
    """(lower, upper, rows before) of the smallest key range found that holds the rows offset..offset + limit.

    Keys are compared as text. Each round takes a bounded sample of the keys by
    hash as bounds, counts the rows between them, and goes on inside the ranges
    that the page touches, until few rows are left or one key holds them all.
    """
    low: str | None = None
    high: str | None = None
    before = 0
    while True:
        inside = df.select(F.col(order).alias("_k"))
        if low is not None:
            inside = inside.filter(F.col("_k") > F.lit(low))
        if high is not None:
            inside = inside.filter(F.col("_k") <= F.lit(high))
        keys = inside.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
        sample = keys.select("_k").filter(F.col("_k").isNotNull()).orderBy(F.xxhash64("_k"), "_k").limit(PAGE_RANGES)
        bounds = sorted(r["_k"] for r in sample.collect())
        counts = {r["_r"]: r["n"] for r in with_range(keys, F.col("_k"), bounds, "_r").groupBy("_r").agg(F.sum("_n").alias("n")).collect()}
        start, touched = before, []
        for i in range(len(bounds) + 1):
            n = counts.get(i, 0)
            if n and start < offset + limit and start + n > offset:
                touched.append((i, start, n))
            start += n
        if not touched:
            return low, high, before
        first, last = touched[0][0], touched[-1][0]
        narrow = (bounds[first - 1] if first else low, bounds[last] if last < len(bounds) else high)
        done = narrow == (low, high)
        low, high, before = *narrow, touched[0][1]
        if done or sum(n for _, _, n in touched) <= max(PAGE_ROWS, 2 * limit):
            return low, high, before


def split_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    splits: Sequence[float],
    desc: bool = False,
    tie: Sequence[str] = (),
    name: str = "rn",
    total: str | None = None,
    tie_splits: Sequence[float] = (),
) -> DataFrame:
    """Exact row number within ``keys`` where one key may hold most of the rows.

    Rows are cut into value ranges of ``order`` (``splits``), numbered inside
    (key, range), then shifted by the row count of the ranges before. A value
    that is itself a split, as every heavy one is, has a range of its own, which
    ``tie_splits`` cut further by the first (numeric) tie column. No task sees
    more than one range of a key. NULL keys are a key like any other. ``total``
    also adds the group size.
    """
    keys = list(keys)
    value = F.col(order).cast("double")
    base = with_range(df, value, splits, "_range")
    at_split = F.coalesce(F.get(F.array(*[F.lit(float(x)) for x in splits]), F.col("_range")) == value, F.lit(False)) if splits else F.lit(False)
    # the values below split i, then the split itself
    base = base.withColumn("_at", at_split).withColumn("_range", F.col("_range") * 2 + F.col("_at").cast("int"))
    if desc:
        base = base.withColumn("_range", -F.col("_range"))
    if tie and tie_splits:
        base = with_range(base, F.col(tie[0]).cast("double"), tie_splits, "_tie").withColumn("_tie", F.when(F.col("_at"), F.col("_tie")).otherwise(0))
    else:
        base = base.withColumn("_tie", F.lit(0))
    base = base.drop("_at")

    ranges = base.groupBy(*keys, "_range", "_tie").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_range", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col("_range").alias("_r"),
        F.col("_tie").alias("_t"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(group).alias("_total"),
    )

    direction = F.col(order).desc() if desc else F.col(order).asc()
    local = Window.partitionBy(*keys, "_range", "_tie").orderBy(direction, *[F.col(t).asc() for t in tie])
    numbered = base.withColumn("_local", F.row_number().over(local))
    same = (F.col("_range") == F.col("_r")) & (F.col("_tie") == F.col("_t"))
    for i, k in enumerate(keys):
        same = same & numbered[k].eqNullSafe(F.col(f"_key{i}"))
    ranked = numbered.join(offsets, same).drop("_r", "_t", *[f"_key{i}" for i in range(len(keys))])
    out = ranked.withColumn(name, F.col("_local") + F.col("_offset"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_range", "_tie", "_local", "_offset", "_total")

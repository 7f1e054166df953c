"""Mixing sources to target weights with a splitting tree.

Every source is a stream of words: its rows in hash order, read as many times as
its target asks. All passes over all streams are cut into blocks of one size,
which follows the words to draw. A last pass that is not whole takes a permuted
choice of its blocks and a part of one more, so the words a source gives are
exact. The tree splits the numbers of blocks of all sources among output shards:
at each node the left half takes a multivariate-hypergeometric draw, so shards
hold the same number of blocks but for one, and a fair mix, without looking at a
single block. Then each source deals its blocks in permuted order: a shard's
range of that order is disjoint from every other shard's. ``order`` shuffles
inside a shard.

Rows are handled in (source, bucket) groups of a few hundred rows, so a source
with a third of all rows is spread like any other; the places of buckets in their
stream are summed in two levels. All draws come from hashes of the seed: reruns
agree.

Defined cases: a null text has size 0, gives no words and takes none; null
sources form one source, after all others; a source without words has target 0;
repeated rows are separate rows, told apart by their place in the bucket; an
empty table gives empty results; only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arena.llm.common import WORD, let, stored

SHARD_WORDS = 1 << 20  # words of a shard, more only beyond the most shards
LEVELS = (2, 14)  # of the tree, least and most: 4 to 16384 shards
SHARD_BLOCKS = 64  # blocks of a shard
ROWS_PER_BUCKET = 250
BUCKETS_PER_GROUP = 4_096  # whose words are summed in one step
SPREAD = 5  # level from which the nodes of the tree are spread over tasks
SEED = 20_240
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)  # fixed values: above any number of blocks


@dataclass(frozen=True)
class Mix:
    """``rows`` (row columns, src, size, words before it in its stream) , ``sources`` (plan) and ``draws``."""

    rows: DataFrame
    sources: DataFrame
    draws: DataFrame


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds ``weight``: the given weights in turn, by code point order of ``src``, null last.

    One row per source is numbered in one task; a source list is configuration, not data.
    """
    place = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    chosen = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    return sources.withColumn("weight", chosen)


def with_targets(sources: DataFrame, cap: float) -> DataFrame:
    """Adds ``target``: shares of all words by weight, none above ``cap`` times its source, the excess reshared.

    Each round closes the sources whose share is over the cap; what is left is
    shared anew among the rest. The rounds end when no source is over.
    """
    size, ceiling = F.col("source_size").cast("double"), F.col("source_size") * F.lit(float(cap))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, closed = 0.0, -1
    while True:
        over = ceiling < F.col("weight") * level if closed >= 0 else F.lit(False)
        state = sources.agg(
            F.count_if(over).alias("n"),
            F.coalesce(F.sum(F.when(over, ceiling)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~over & (size > 0), F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if state["n"] == closed or state["open"] == 0:
            break
        closed, level = state["n"], (total - state["held"]) / state["open"]
    return sources.withColumn("target", F.when(size > 0, F.least(ceiling, F.col("weight") * level)).otherwise(F.lit(0.0)))


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11).cast("double") + 0.5) / float(2**53)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Number of marked blocks among ``drawn`` of ``total``, by inversion at ``u``.

    The probabilities follow from each other by ratios, from a start that lies 12
    standard deviations below the mode to one as far above: what is outside
    weighs under 1e-30.
    """

    def at(p: Column) -> Column:
        n, k, d = p["n"], p["k"], p["d"]
        low = F.greatest(F.lit(0.0), d - (n - k))
        high = F.least(d, k)
        mode = F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")
        spread = F.ceil(12 * F.sqrt(F.greatest(d * (k / n) * (1 - k / n), F.lit(0.0))) + 12).cast("double")
        first = F.greatest(low, mode - spread).cast("long")
        last = F.least(high, mode + spread).cast("long")

        def ratio(x: Column) -> Column:  # of the probability of x to that of x - 1
            return ((k - x + 1) * (d - x + 1)) / (x * (n - k - d + x))

        start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"))

        def add(a: Column, x: Column) -> Column:
            w = a["w"] * ratio(x.cast("double"))
            return F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))

        def span(lo: Column, hi: Column) -> Column:
            steps = F.when(hi > lo, F.sequence(lo + 1, hi)).otherwise(F.array().cast("array<bigint>"))
            goal = u * F.aggregate(steps, start, add, lambda a: a["sum"])
            found = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), lo.alias("x"))
            return let(goal, lambda g: F.aggregate(steps, found, lambda a, x: F.struct(
                (a["w"] * ratio(x.cast("double"))).alias("w"),
                F.when(a["sum"] < g, a["sum"] + a["w"] * ratio(x.cast("double"))).otherwise(a["sum"]).alias("sum"),
                F.when(a["sum"] < g, x).otherwise(a["x"]).alias("x")), lambda a: a["x"]))

        return let(F.struct(first.alias("lo"), last.alias("hi")), lambda s: span(s["lo"], s["hi"]))

    bound = F.struct(total.cast("double").alias("n"), marked.cast("double").alias("k"), drawn.cast("double").alias("d"))
    some = (total > 0) & (marked > 0) & (drawn > 0)
    return F.when(some, let(bound, at)).otherwise(F.lit(0).cast("long"))


def split_tree(quotas: DataFrame, levels: int) -> DataFrame:
    """(sid, quota) -> (sid, shard, first, quota): block quotas of 2^levels shards, ``first`` in the source's order.

    One node is one row that lists the quotas of the sources, so a level is a
    map stage. The left child takes half of the node's blocks; its share of each
    source is drawn in turn, given what the sources before took.
    """
    lists = F.array_sort(F.collect_list(F.struct("sid", "quota")))
    nodes = quotas.agg(lists.alias("q")).select(F.lit(0).cast("long").alias("shard"), "q")
    for level in range(levels):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x.quota)
        start = F.struct(
            total.alias("n"), F.floor(total / 2).cast("long").alias("d"),
            F.array().cast("array<struct<sid:bigint,quota:bigint>>").alias("left"),
        )

        depth = F.lit(level)

        def take(a: Column, x: Column) -> Column:
            drawn = hypergeometric(a["n"], x.quota, a["d"], _uniform(depth, F.col("shard"), x.sid))  # noqa: B023
            return let(drawn, lambda h: F.struct(
                (a["n"] - x.quota).alias("n"), (a["d"] - h).alias("d"),
                F.array_append(a["left"], F.struct(x.sid.alias("sid"), h.alias("quota"))).alias("left")))

        left = F.aggregate("q", start, take, lambda a: a["left"])
        drawn = nodes.select("shard", "q", F.explode(F.array(left)).alias("left"))
        right = F.zip_with("q", "left", lambda a, b: F.struct(a.sid.alias("sid"), (a.quota - b.quota).alias("quota")))
        if level == SPREAD:
            drawn = drawn.repartition("shard")
        nodes = drawn.select(F.explode(F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.col("left").alias("q")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"), right.alias("q")))).alias("c")).select("c.shard", "c.q")
    leaves = nodes.select("shard", F.inline("q")).select("sid", "shard", "quota")
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.select("sid", "shard", F.coalesce(F.sum("quota").over(before), F.lit(0)).alias("first"), "quota")


def tree_levels(words: int, shard_words: int = SHARD_WORDS) -> int:
    """Levels of the tree for the words to draw."""
    return min(max((max(words, 1) - 1) // shard_words, 1).bit_length(), LEVELS[1]) if words > shard_words << LEVELS[0] else LEVELS[0]


def _bucket_starts(totals: DataFrame) -> DataFrame:
    """src, bucket, begin: where each bucket begins in its source's stream; groups of buckets first, then inside a group."""
    grouped = totals.withColumn("group", F.floor(F.col("bucket") / BUCKETS_PER_GROUP))
    before = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("src", "group").agg(F.sum("words").alias("words"))
    groups = groups.select(F.col("src").alias("_src"), F.col("group").alias("_group"), F.coalesce(F.sum("words").over(before(["src"], "group")), F.lit(0)).alias("_far"))
    inside = grouped.select("src", "group", "bucket", F.coalesce(F.sum("words").over(before(["src", "group"], "bucket")), F.lit(0)).alias("_near"))
    joined = inside.join(groups, inside["src"].eqNullSafe(groups["_src"]) & (F.col("group") == F.col("_group")))
    return joined.select("src", "bucket", (F.col("_far") + F.col("_near")).alias("begin"))


def mix(df: DataFrame, weights: tuple[float, ...], source: str = "source", text: str = "text", keep: tuple[str, ...] = ("doc_id",),
        cap: float = 3.0, shard_words: int = SHARD_WORDS) -> Mix:
    """Plans the mix of all words of ``df``; see the module for what the parts mean.

    ``draws``: row (the ``keep`` columns), sid and begin (together the row's key), pass, shard, start and length (words of the
    row), order: one draw per row, pass and block.
    """
    sized = df.select(
        F.struct(*keep).alias("row"), F.col(source).alias("src"), n_words(F.col(text)).alias("size"),
        F.xxhash64(F.lit(SEED), *keep, source).alias("mark"),
    )
    sized = stored(sized, "mix-sizes")
    count, words = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(1, -(-count // ROWS_PER_BUCKET))
    placed = sized.withColumn("bucket", F.pmod(F.col("mark"), F.lit(buckets)))
    levels = tree_levels(words, shard_words)
    block = F.lit(max(1, -(-words // (SHARD_BLOCKS << levels)))).cast("long")

    totals = placed.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    sources = totals.groupBy("src").agg(F.sum("words").alias("source_size"))
    sources = stored(cyclic_weights(sources, weights), "mix-sources")
    size, frac = F.col("source_size"), F.col("target_words") - F.col("passes") * F.col("source_size")
    sources = (
        with_targets(sources, cap)
        .withColumn("sid", F.xxhash64(F.coalesce("src", F.lit("")), F.col("src").isNull()))
        .withColumn("target_words", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("passes", F.when(size > 0, F.floor(F.col("target_words") / size)).otherwise(0).cast("long"))
        .withColumn("block", block)
        .withColumn("full_blocks", F.floor(size / block).cast("long"))
        .withColumn("pass_blocks", F.ceil(size / block).cast("long"))
        .withColumn("part", F.floor(frac / block).cast("long"))
        .withColumn("rest", F.pmod(frac, block))
        .withColumn("quota", F.col("passes") * F.col("pass_blocks") + F.col("part") + F.when(F.col("rest") > 0, 1).otherwise(0))
    )
    sources = stored(sources, "mix-plan")
    leaves = split_tree(sources.select("sid", "quota"), levels).filter("quota > 0")
    deal = leaves.select(F.col("sid").alias("_sid"), "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("_place"))
    deal = stored(deal, "mix-deal")  # SHARD_BLOCKS rows a shard and some

    begins = _bucket_starts(totals)
    plan = begins.join(sources, begins["src"].eqNullSafe(sources["src"])).drop(sources["src"]).drop(begins["src"])
    inside = Window.partitionBy("sid", "bucket").orderBy("mark", "row", "size").rowsBetween(Window.unboundedPreceding, -1)
    keyed = placed.withColumn("sid", F.xxhash64(F.coalesce("src", F.lit("")), F.col("src").isNull()))
    run = keyed.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = run.join(plan, ["sid", "bucket"]).withColumn("begin", F.col("begin") + F.col("inner"))
    rows = stored(rows.drop("src", "bucket", "inner"), "mix-rows")

    end, b, turn = F.col("begin") + F.col("size"), F.col("b"), F.col("pass")
    last = F.when((F.col("part") > 0) | (F.col("rest") > 0), F.col("passes")).otherwise(F.col("passes") - 1)
    pieces = rows.filter("size > 0 and quota > 0").select(
        "row", "sid", "mark", "begin", "size", "passes", "block", "full_blocks", "pass_blocks", "part", "rest",
        F.explode(F.sequence(F.floor(F.col("begin") / block).cast("long"), F.floor((end - 1) / block).cast("long"))).alias("b"), last.alias("last"),
    )
    pieces = pieces.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("pass"))
    # full blocks in permuted order, another one each pass; the short one at the end of the stream stays last
    place = F.when(b < F.col("full_blocks"), permuted(b, F.col("full_blocks"), F.col("sid"), turn)).otherwise(b)
    pieces = pieces.withColumn("place", place)
    whole = (turn < F.col("passes")) | (F.col("place") < F.col("part"))
    reach = F.when(whole, block).when(F.col("place") == F.col("part"), F.col("rest")).otherwise(0)
    low, high = F.greatest(b * block, F.col("begin")), F.least(b * block + reach, end)
    taken = pieces.filter(high > low).withColumn("_place", turn * F.col("pass_blocks") + F.col("place"))
    dealt = taken.join(deal, (F.col("sid") == F.col("_sid")) & (taken["_place"] == deal["_place"]))
    draws = dealt.select(
        "row", "sid", "begin", "pass", "shard", (low - F.col("begin")).alias("start"), (high - low).alias("length"),
        F.xxhash64(F.lit(SEED + 1), "sid", "pass", "b", "mark").alias("order"),
    )
    return Mix(rows, sources, draws)


def permuted(b: Column, n: Column, *key: Column) -> Column:
    """A bijection of 0..n-1: the multiplier is a prime above any n, so it has no factor in common with n."""
    draw = F.pmod(F.xxhash64(F.lit(SEED + 2), *key), F.lit(1 << 30))
    prime = F.element_at(F.array(*[F.lit(p).cast("long") for p in PRIMES]), (draw % len(PRIMES) + 1).cast("int"))
    return F.pmod(F.pmod(b * prime, n) + draw, n)

"""Frequent lines by levelled sorted runs of line hashes.

The state is a set of runs, tables of (hash, documents) sorted by hash. A batch of
documents is reduced to such a table, is merge-anti-joined with the runs of the
lines that are known to be frequent, and what is left becomes a run of level 0.
When a level holds ``fanout`` runs they are merged into one of the next level;
lines that reach the bound there are settled: they leave the counting runs and
later batches no longer carry them. A line is frequent if it is settled or the
sum of its counts over the runs of all levels reaches the bound.

A line's hash has 128 bits. A hash that makes up a 4096th of the lines of a
batch is heavy; a batch has 4096 of them at most, so they may be sent to all
tasks, and no other hash can gather more than that share in one task.

Defined cases: a null or empty text has one empty line; empty lines (by their
key) stay whatever their number; rows of one id are one document, a null id is
an id like any other; repeated rows get equal results; an empty table gives an
empty result; columns of any name are carried in ``row``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arena.llm.common import computed, scalar, stored

LEAST = 10  # documents of a frequent line
BATCHES = 4  # in which a whole table is added
FANOUT = 2  # runs of a level that are merged into one of the next
HEAVY = 4096  # part of a batch's lines that makes a hash heavy
BLANK = " \t\n\x0b\x0c\r"  # fixed value: ASCII white space
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HASH = ["h", "g"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, ASCII letters lowered."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def hashes_of(text: Column) -> Column:
    """(place, h, g) of every line of a text whose key is not empty."""
    keys = F.transform(lines_of(text), line_key)
    hashed = F.transform(keys, lambda k, i: F.struct(
        i.alias("place"), F.when(k != "", F.xxhash64(k)).alias("h"), F.xxhash64(F.lit(1), k).alias("g")
    ))
    return F.filter(hashed, lambda x: x.h.isNotNull())


class LineRuns:
    """Counts of documents by line hash; grows by batches, whose documents must differ."""

    def __init__(self, spark: SparkSession, least: int = LEAST, fanout: int = FANOUT):
        self.least, self.fanout = least, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []
        self.heavy: list[DataFrame] = []
        self._none = spark.createDataFrame([], "h long, g long")

    def _run(self, counts: DataFrame, name: str) -> DataFrame:
        return stored(counts.sortWithinPartitions(*HASH), name)

    def _all(self, runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs) if runs else self._none

    def add(self, lines: DataFrame) -> None:
        """A batch of (id, h, g), a row a line."""
        each = lines.groupBy("id", *HASH).agg(F.count(F.lit(1)).alias("m"))
        each = each.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"))
        mine = self._run(each, "lines-batch")
        total = scalar(mine.agg(F.coalesce(F.sum("m"), F.lit(0))))
        self.heavy.append(mine.filter(F.col("m") * HEAVY >= total).select(*HASH))
        fresh = mine.select(*HASH, "n")
        if self.settled:
            fresh = self._run(fresh.join(self._all(self.settled), HASH, "left_anti"), "lines-run")
        self._put(0, fresh)

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level)

    def _compact(self, level: int) -> None:
        """One run of the next level from all of this one; lines that reached the bound are settled."""
        merged = self._all(self.levels[level]).groupBy(*HASH).agg(F.sum("n").alias("n"))
        whole = self._run(merged, "lines-merged")
        self.levels[level] = []
        self.settled.append(whole.filter(F.col("n") >= self.least).select(*HASH))
        self._put(level + 1, whole.filter(F.col("n") < self.least))

    def frequent(self) -> DataFrame:
        """(h, g) of the lines found in ``least`` documents or more, each once."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return self._none
        counted = self._all(runs).groupBy(*HASH).agg(F.sum("n").alias("n")).filter(F.col("n") >= self.least)
        # a line may be settled in one level while it is still counted in another
        return counted.select(*HASH).unionByName(self._all(self.settled)).distinct()

    def heaviest(self) -> DataFrame:
        """(h, g) of the heavy lines of all batches, at most HEAVY a batch."""
        return self._all(self.heavy).distinct()


def drop_frequent_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """row, n_lines, n_dropped and kept, the text without its frequent lines; one row per input row."""
    spark = df.sparkSession
    rows = df.select(F.struct("*").alias("row"), F.col(key).alias("id"), F.col(text).alias("body"))
    rows = rows.withColumn("fp", F.xxhash64("body"))
    found = rows.select("id", "fp", F.explode(hashes_of(F.col("body"))).alias("line")).select("id", "fp", "line.*")
    found = stored(found, "lines-found")
    runs = LineRuns(spark, least, fanout)
    for batch in range(batches):
        runs.add(found.filter(F.pmod(F.xxhash64("id"), F.lit(batches)) == batch))
    frequent = stored(runs.frequent(), "lines-frequent")
    heaviest = F.broadcast(stored(runs.heaviest().join(frequent, HASH, "left_semi"), "lines-heavy"))
    # heavy lines are told in place, the others meet the runs; no hash brings more than its share to a task
    near = found.join(heaviest, HASH, "left_semi")
    far = found.join(heaviest, HASH, "left_anti").join(frequent, HASH, "left_semi")
    gone = near.unionByName(far).groupBy("id", "fp").agg(F.array_sort(F.collect_set("place")).alias("gone"))
    gone = gone.withColumnsRenamed({"id": "_id", "fp": "_fp"})
    joined = rows.join(gone, rows["id"].eqNullSafe(gone["_id"]) & rows["fp"].eqNullSafe(gone["_fp"]), "left")
    each = computed(joined.select("row", "body", "gone"), lines_of(F.col("body")), "lines")
    last = F.array(F.size("lines"))
    spans = F.zip_with(
        F.concat(F.array(F.lit(-1)), F.col("gone")), F.concat(F.col("gone"), last), lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1)
    )
    kept = F.when(F.col("gone").isNull(), F.coalesce("body", F.lit(""))).otherwise(F.array_join(F.flatten(spans), "\n"))
    return each.select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"),
    )

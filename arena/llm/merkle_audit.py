"""Fixity audit of replicated archives with Merkle trees over ordered offset ranges.

Every record of an archive has a manifest offset, a length and a digest. A leaf
of the tree is a range of offsets and hashes its records in order; a node hashes
FANOUT neighbouring children with their places. Two replicas compare roots
first, then only the children of nodes that differ, down to the ranges that
differ, and only the records of those ranges are compared one by one.

A level is one aggregate with at most FANOUT rows a group. Records repeated
within a replica are counted before they are gathered, so a leaf never holds more
entries than its range has bytes. Bodies are hashed in the scan and never move.

Defined cases: null bodies are empty; a null archive is an archive of its own,
reported as ''; records of one offset are compared one by one, the left-overs of
both replicas being paired by digest and length; a
record that one replica lacks is ``missing`` (in the copy) or ``extra`` (only in
the copy); one that is there more often than in the other is ``repeated``; empty
replicas agree with each other.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arena.llm.common import stored

FANOUT = 16
RANGE = 65_536  # bytes of a leaf


def warc_body(url: Column, payload: Column) -> Column:
    """Bytes of a response record."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "))
    return F.concat(head, F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n")).cast("binary")


def with_offsets(df: DataFrame, archive: str, order: str, length: str) -> DataFrame:
    """Adds ``offset``: the bytes of the records before, in the order of the archive. Rows are index entries, without bodies."""
    ahead = Window.partitionBy(archive).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(length).over(ahead), F.lit(0)).cast("long"))


def _entries(records: DataFrame) -> DataFrame:
    """Distinct records with their number. A name of an archive is marked, so that a null archive is not the one named ''."""
    return records.groupBy(F.coalesce(F.concat(F.lit("="), "archive"), F.lit("-")).alias("archive"), "offset", "length", "digest").agg(F.count(F.lit(1)).alias("n"))


def _tree(entries: DataFrame, levels: int) -> DataFrame:
    """level, archive, node, hash; level 0 are the leaves."""
    line = F.concat_ws(":", "offset", "length", "digest", "n")
    leaf = entries.groupBy("archive", F.floor(F.col("offset") / RANGE).cast("long").alias("node")).agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "digest", line.alias("line")))).alias("r")
    )
    level = stored(leaf.select(F.lit(0).alias("level"), "archive", "node", F.sha2(F.array_join("r.line", "\n"), 256).alias("hash")), "merkle-level")
    tree = level
    for k in range(1, levels + 1):
        up = level.groupBy("archive", F.floor(F.col("node") / FANOUT).cast("long").alias("up")).agg(
            F.array_sort(F.collect_list(F.struct("node", F.concat_ws(":", "node", "hash").alias("line")))).alias("r")
        )
        level = stored(up.select(F.lit(k).alias("level"), "archive", F.col("up").alias("node"), F.sha2(F.array_join("r.line", "\n"), 256).alias("hash")), "merkle-level")
        tree = tree.unionByName(level)
    return tree


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """archive, node where the hashes of two node sets differ or one has no node."""
    left = a.select("archive", "node", F.col("hash").alias("ours"))
    right = b.select("archive", "node", F.col("hash").alias("theirs"))
    return left.join(right, ["archive", "node"], "full").filter(~F.col("ours").eqNullSafe(F.col("theirs"))).select("archive", "node")


def audit(primary: DataFrame, copy: DataFrame) -> DataFrame:
    """Records that differ between two replicas, given as (archive, offset, length, digest).

    archive, offset, length and copy_length (null where a replica has no such
    record), problem, and the leaf the record was found under.
    """
    ours, theirs = stored(_entries(primary), "merkle-primary"), stored(_entries(copy), "merkle-copy")
    last = ours.select("offset").unionByName(theirs.select("offset")).agg(F.coalesce(F.max("offset"), F.lit(0))).first()[0] // RANGE
    levels = 0
    while FANOUT**levels <= last:
        levels += 1
    a, b = _tree(ours, levels), _tree(theirs, levels)
    suspects = None
    for k in range(levels, -1, -1):
        here_a, here_b = a.filter(F.col("level") == k), b.filter(F.col("level") == k)
        if suspects is not None:
            children = suspects.select("archive", F.explode(F.sequence(F.col("node") * FANOUT, F.col("node") * FANOUT + FANOUT - 1)).alias("node"))
            here_a = here_a.join(children, ["archive", "node"], "left_semi")
            here_b = here_b.join(children, ["archive", "node"], "left_semi")
        suspects = stored(_differing(here_a, here_b), "merkle-suspects")
    bad = suspects.select("archive", F.col("node").alias("leaf"))

    def within(entries: DataFrame) -> DataFrame:
        placed = entries.withColumn("leaf", F.floor(F.col("offset") / RANGE).cast("long"))
        return placed.join(bad, ["archive", "leaf"], "left_semi")

    # equal records meet first; what is left of an offset is paired in order
    record = ["archive", "leaf", "offset", "length", "digest"]
    mine, other = within(ours).withColumnRenamed("n", "p_n"), within(theirs).withColumnRenamed("n", "c_n")
    met = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in record]
    either = [F.when(F.col("p_n").isNotNull(), F.col(f"p.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in record]
    both = mine.alias("p").join(other.alias("c"), reduce(and_, met), "full").select(*either, "p_n", "c_n")
    both = stored(both.filter(~F.col("p_n").eqNullSafe(F.col("c_n"))), "merkle-records")
    repeated = both.filter("p_n is not null and c_n is not null").select(
        "archive", "offset", "length", F.col("length").alias("copy_length"), F.lit("repeated").alias("problem"), "leaf"
    )
    turn = Window.partitionBy("archive", "leaf", "offset").orderBy("digest", "length")

    def left(rows: DataFrame, side: str) -> DataFrame:
        return rows.select("archive", "leaf", "offset", F.row_number().over(turn).alias("turn"), F.struct("length").alias(side))

    pairs = left(both.filter("c_n is null"), "p").join(left(both.filter("p_n is null"), "c"), ["archive", "leaf", "offset", "turn"], "full")
    problem = F.when(F.col("c").isNull(), "missing").when(F.col("p").isNull(), "extra").otherwise("changed")
    found = pairs.select(
        "archive", "offset", F.col("p.length").alias("length"), F.col("c.length").alias("copy_length"), problem.alias("problem"), "leaf"
    )
    return found.unionByName(repeated).withColumn("archive", F.substring("archive", 2, 2**31 - 1))

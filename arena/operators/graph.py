"""Parent chains and components with logarithmic rounds; lineage is cut by reliable checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arena.session import checkpointed


def _double(nodes: DataFrame) -> DataFrame:
    """Pointer doubling on (id, ptr, done): after k rounds a pointer is 2^k steps ahead.

    Stops when nothing is open, or when a round neither closed a node nor moved
    pointers onto fewer targets: the open rest then leads into cycles, and its
    pointers are exactly the nodes on them.
    """
    previous = None
    while True:
        left = nodes.filter(~F.col("done"))
        state = left.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ptr").alias("targets")).first()
        if state["n"] == 0 or state == previous:
            return nodes
        previous = state
        ahead = nodes.select(F.col("id").alias("_id"), F.col("ptr").alias("_ptr"), F.col("done").alias("_done"))
        stepped = left.join(ahead, F.col("ptr") == F.col("_id")).select("id", F.col("_ptr").alias("ptr"), F.col("_done").alias("done"))
        nodes = checkpointed(nodes.filter("done").unionByName(stepped))


def chain_roots(parents: DataFrame) -> DataFrame:
    """id, parent -> id, root. A parent that is not an id ends the chain; cycles end at their entry."""
    ids = parents.select(F.col("id").alias("_pid"))
    linked = parents.join(ids, F.col("parent") == F.col("_pid"), "left").select("id", F.col("_pid").alias("parent"))
    linked = checkpointed(linked)
    start = linked.select("id", F.coalesce("parent", F.col("id")).alias("ptr"), F.col("parent").isNull().alias("done"))
    nodes = _double(start)
    stuck = nodes.filter(~F.col("done"))
    if stuck.isEmpty():
        return nodes.select("id", F.col("ptr").alias("root"))
    on_cycle = stuck.select(F.col("ptr").alias("_cycle")).distinct()
    cut = linked.join(on_cycle, F.col("id") == F.col("_cycle"), "left").select(
        "id", F.when(F.col("_cycle").isNull(), F.col("parent")).alias("parent")
    )
    again = cut.select("id", F.coalesce("parent", F.col("id")).alias("ptr"), F.col("parent").isNull().alias("done"))
    return _double(again).select("id", F.col("ptr").alias("root"))


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """id, component (smallest id). Alternating large-star and small-star steps.

    Each step is one ``min`` aggregate joined back to the edges; neighbourhoods
    are never collected, so a hub with a third of the edges is fine.
    """
    both = edges.select("src", "dst").filter(F.col("src") != F.col("dst"))
    links = checkpointed(both.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    previous = None
    while True:
        # large star: every larger neighbour of u hangs on the least of u and its neighbours
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = around.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours hang on the least of them
        large = large.filter(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        links = checkpointed(small.filter(F.col("u") != F.col("v")).distinct())
        state = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if previous == state:
            break
        previous = state
    labels = links.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_c"))
    return vertices.join(labels, F.col("id") == F.col("_u"), "left").select("id", F.coalesce("_c", F.col("id")).alias("component"))


def evolve_edges(cards: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """Forward and reverse edges of the parent column, rebuilt whole so set order never matters."""
    linked = cards.filter(F.col(parent_col).isNotNull())
    forward = linked.select(F.col(id_col).alias("card_id"), F.col(parent_col).alias("related_id"), F.lit("evolves_from").alias("relation"))
    reverse = linked.select(F.col(parent_col).alias("card_id"), F.col(id_col).alias("related_id"), F.lit("evolves_to").alias("relation"))
    return forward.unionByName(reverse).distinct()

"""Skew-safe ranking, sampling and graph steps against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from arena.functions import rank as rk
from arena.operators import graph as g
from arena.operators import quality as q


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with two thirds of the rows, ties in the order column."""
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"k{i % 7}", float(rng.randrange(200)), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k string, v double, id long").repartition(6)


@pytest.mark.parametrize("desc", [True, False])
def test_split_rank_equals_sorting(skewed, desc):
    rows, df = skewed
    out = rk.split_rank(df, ["k"], "v", splits=rk.quantile_splits(df, "v"), desc=desc, tie=["id"], total="n")
    want = {}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1] if desc else r[1], r[2]))
        want.update({r[2]: (i + 1, len(group)) for i, r in enumerate(group)})
    assert {r["id"]: (r["rn"], r["n"]) for r in out.collect()} == want


def test_split_rank_keeps_hot_keys_apart(skewed):
    _, df = skewed
    splits = rk.quantile_splits(df, "v")
    ranged = rk.with_range(df.filter("k = 'hot'"), F.col("v"), splits, "r")
    largest = ranged.groupBy("r").count().agg(F.max("count")).first()[0]
    assert largest < 2000 / 4


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 17])
def test_range_of_counts_the_splits_below(spark, n):
    splits = [float(10 * i) for i in range(n)]
    df = spark.createDataFrame([(float(v),) for v in range(-5, 200, 5)], "v double")
    for row in rk.with_range(df, F.col("v"), splits, "r").collect():
        assert row["r"] == sum(s < row["v"] for s in splits)


def test_split_rank_without_keys_is_global(skewed):
    rows, df = skewed
    out = rk.split_rank(df, [], "v", splits=rk.quantile_splits(df, "v"), tie=["id"])
    order = [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))]
    assert [r["id"] for r in out.orderBy("rn").collect()] == order


def test_split_rank_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 2.0, 1), (None, 1.0, 2), ("a", None, 3), ("a", 5.0, 4)], "k string, v double, id long")
    out = rk.split_rank(df, ["k"], "v", splits=[1.0, 2.0, 5.0], tie=["id"], total="n").collect()
    assert sorted((r["id"], r["rn"], r["n"]) for r in out) == [(1, 2, 2), (2, 1, 2), (3, 1, 2), (4, 2, 2)]


@pytest.mark.parametrize("desc", [True, False])
def test_split_rank_cuts_ties(spark, desc):
    """A thousand equal values fall into several ranges and are still numbered by the tie."""
    df = spark.createDataFrame([(7.0, i) for i in range(1000)] + [(float(i), 2000 + i) for i in range(20)], "v double, id long").repartition(4)
    ties = rk.quantile_splits(df, "id")
    out = rk.split_rank(df, [], "v", splits=rk.quantile_splits(df, "v"), desc=desc, tie=["id"], tie_splits=ties)
    rows = sorted(out.collect(), key=lambda r: r["rn"])
    assert [r["rn"] for r in rows] == list(range(1, 1021))
    assert [r["id"] for r in rows] == [r["id"] for r in sorted(rows, key=lambda r: (-r["v"] if desc else r["v"], r["id"]))]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_range" in plan and "_tie" in plan


def test_latest_and_earliest(skewed):
    rows, df = skewed
    last = {r["k"]: r["id"] for r in rk.latest_per_key(df, ["k"], [F.col("v"), F.col("id")]).collect()}
    first = {r["k"]: r["id"] for r in rk.earliest_per_key(df, ["k"], [F.col("v"), F.col("id")]).collect()}
    for key in last:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        assert (first[key], last[key]) == (group[0][2], group[-1][2])


def test_stride_sample_positions(spark):
    df = spark.createDataFrame([("a", i) for i in range(103)] + [("b", i) for i in range(7)], "s string, id long")
    out = q.stride_sample(df, ["s"], "id", rk.quantile_splits(df, "id"))
    got = sorted((r["s"], r["id"]) for r in out.collect())
    want = [("a", int(i * 103 / 6)) for i in range(6)] + [("b", 0)]
    assert got == want


def roots(parents):
    out = {}
    for start in parents:
        node, seen = start, set()
        while parents.get(node) in parents and node not in seen:
            seen.add(node)
            node = parents[node]
        out[start] = node
    return out


@pytest.mark.parametrize("seed", range(3))
def test_chain_roots_with_cycles(spark, seed):
    rng = random.Random(seed)
    parents = {i: rng.choice([None, *range(60)]) for i in range(60)}
    parents[61] = 999  # a parent that does not exist
    df = spark.createDataFrame(list(parents.items()), "id long, parent long")
    assert {r["id"]: r["root"] for r in g.chain_roots(df).collect()} == roots(parents)


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i - 1 if i else None) for i in range(300)], "id long, parent long")
    assert {r["root"] for r in g.chain_roots(df).collect()} == {0}


def components(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(80))
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(50)] + [(7, n) for n in range(20, 40)] + [(60 + i, 61 + i) for i in range(15)]
    out = g.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "id long"), spark.createDataFrame(edges, "src long, dst long")
    )
    assert {r["id"]: r["component"] for r in out.collect()} == components(nodes, edges)


def test_components_without_edges(spark):
    out = g.connected_components(spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([], "src long, dst long"))
    assert {(r["id"], r["component"]) for r in out.collect()} == {(1, 1), (2, 2)}


def test_seeded_sample_ignores_partitioning(spark):
    df = spark.range(1000)
    one = {r["id"] for r in q.seeded_sample(df.repartition(3), "id", 20, 7).collect()}
    two = {r["id"] for r in q.seeded_sample(df.repartition(11), "id", 20, 7).collect()}
    assert one == two and len(one) == 20

"""Plan shapes that must hold at any size, and metrics under a hot competition against brute force."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

import __spark_entry__ as entry
from arena.plans import metrics as m
from arena.sources.tables import Star

SF = "/root/testdata/sf0.001"
KEYS = [
    "weighted_usage", "weighted_win_score", "topcut_conversion", "win_rate_records", "stat_fact_view", "legal_pool", "basket_legality_report",
    "resolve_items", "name_chain_match", "multi_variant_resolve", "parent_resolution", "tag_coverage", "effective_text", "variant_share_reconcile",
    "snapshot_as_of", "topcut_from_columns", "record_misses", "page_change_monitor",
]


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_join_and_no_row_python(spark, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan


def scans(df):
    """The parquet scans of a plan, one line each."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan parquet" in x]


def test_filters_and_columns_reach_the_scan(spark):
    (scan,) = scans(entry.queries()["search_catalogue"](spark, SF))
    assert "p_retailprice" not in scan.split("ReadSchema")[1]
    pushed = scan.split("PushedFilters: [")[1].split("]")[0]
    assert "p_type" in pushed or "p_size" in pushed or "p_brand" in pushed


@pytest.mark.parametrize("key", ["eligible_competitions", "metric_meta_echo"])
def test_metrics_read_the_months_of_the_window(spark, key):
    """Every scan of the orders carries both bounds of the window."""
    orders = [x for x in scans(entry.queries()[key](spark, SF)) if "/orders.parquet" in x]
    assert orders
    for scan in orders:
        pushed = scan.split("PushedFilters: [")[1].split("]")[0]
        assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def brute(tours, apps, items, as_of, k_b=10.0):
    weight = {}
    for tid, coef, day, n, cut in tours:
        static = coef if n is None else coef * math.log10(n)
        weight[tid] = (static * 0.5 ** ((as_of - day).days / 90), cut, n)
    w_d = {(d, t): (p if p and p > 0 else 1 / r) for d, t, r, p in apps}
    total = defaultdict(float)
    for (d, t), w in w_d.items():
        total[t] += w
    usage, u_w, t_w = defaultdict(float), defaultdict(float), defaultdict(float)
    for d, t, r, _ in apps:
        w, cut, n = weight[t]
        for group in items[d]:
            part = w * w_d[d, t] / total[t]
            usage[group] += part
            if cut is not None and n is not None:
                u_w[group] += part
                t_w[group] += part if r <= cut else 0
    all_w = sum(w for w, _, _ in weight.values())
    known = [(w, c, n) for w, c, n in weight.values() if c is not None and n is not None]
    q0 = sum(w * c / n for w, c, n in known) / sum(w for w, _, _ in known)
    return {g: (v / all_w, v / all_w * (t_w[g] + k_b * q0) / (u_w[g] + k_b)) for g, v in usage.items()}


@pytest.mark.parametrize("seed", range(2))
def test_metrics_with_a_hot_competition(spark, seed):
    rng = random.Random(seed)
    as_of = date(2026, 8, 1)
    tours = [
        (f"t{i}", rng.choice([1.0, 2.0]), as_of - timedelta(days=rng.randrange(80)), rng.choice([None, 64, 500]), rng.choice([None, 4, 8])) for i in range(12)
    ] + [("hot", 1.0, as_of, 100, 8)]
    apps, items = [], {}
    for d in range(400):
        tid = "hot" if d % 2 else f"t{d % 12}"
        apps.append((d, tid, d // 2 + 1, rng.choice([None, 0.0, float(rng.randrange(1, 50))])))
        items[d] = {"everywhere", f"g{rng.randrange(6)}"}
    frame = spark.createDataFrame
    star = Star(
        frame([(t, t, "mik_moe", "city", c, None, day, n, cut, False, False) for t, c, day, n, cut in tours],
              "tournament_id string, name string, source string, tier string, tier_coef double, division string, date date, participant_count int, "
              "topcut_slots int, is_qual boolean, is_team boolean"),
        frame([(d, "full") for d in items], "deck_id int, mapping_status string"),
        frame([(d, t, r, p, None, None, None, "mik_moe") for d, t, r, p in apps],
              "deck_id int, tournament_id string, rank int, points double, record_wins int, record_losses int, record_ties int, source string"),
        frame([(d, g, g, 1, "pokemon", g) for d, gs in items.items() for g in sorted(gs)],
              "deck_id int, card_id string, raw_name string, count int, stat_scope string, group_key string"),
    )
    params = m.metric_params(as_of="2026-08-01", date_from="2026-01-01")
    want = brute(tours, apps, items, as_of)
    usage = {r["group_key"]: r["value"] for r in m.weighted_usage(star, params).collect()}
    score = {r["group_key"]: r["value"] for r in m.weighted_win_score(star, params, "b").collect()}
    assert usage.keys() == score.keys() == want.keys()
    for g, (u, s) in want.items():
        assert usage[g] == pytest.approx(u, abs=1e-9) and score[g] == pytest.approx(s, abs=1e-9)

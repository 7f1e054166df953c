"""Archive audit, url rules, vector join and chat formatting against plain Python, with odd rows."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arena.llm import metric_join
from arena.llm.chat_turns import canonical_turns, escape, formatted, loss_text, records_of, turns_back, unescape
from arena.llm.merkle_audit import audit, with_offsets
from arena.llm.url_rules import WORD_RULES, judge_urls, site_rule

RECORDS = "archive string, offset long, length long, digest string"


def test_audit_finds_what_differs(spark):
    rng = random.Random(21)
    ours, theirs, want = [], [], set()
    for archive in ("a", "b", None, "same"):
        at = 0
        for k in range(300):
            row = (archive, at, rng.randrange(1, 40_000), f"d{rng.randrange(10**9)}")
            ours.append(row)
            luck = rng.random() if archive != "same" else 1
            key = (archive or "", at)
            if luck < 0.01:
                want.add((*key, "missing"))
            elif luck < 0.02:
                theirs.append((*row[:3], "rotten"))
                want.add((*key, "changed"))
            elif luck < 0.03:
                theirs += [row, (archive, at + 1, 5, "new")]
                want.add((archive or "", at + 1, "extra"))
            elif luck < 0.04:
                theirs += [row, row]
                want.add((*key, "repeated"))
            else:
                theirs.append(row)
            at += row[2] + 2
    found = audit(spark.createDataFrame(ours, RECORDS), spark.createDataFrame(theirs, RECORDS).repartition(5)).collect()
    assert {(r["archive"], r["offset"], r["problem"]) for r in found} == want and len(found) == len(want)


def test_audit_of_nothing(spark):
    none, one = spark.createDataFrame([], RECORDS), spark.createDataFrame([("a", 0, 1, "x")], RECORDS)
    assert audit(none, none).count() == 0 and audit(one, one).count() == 0
    assert [r["problem"] for r in audit(one, none).collect()] == ["missing"]


def test_offsets_add_up(spark):
    df = with_offsets(spark.createDataFrame([("a", i, 10 + i) for i in range(5)] + [("b", 9, 3)], "archive string, n long, length long"), "archive", "n", "length")
    assert sorted((r["archive"], r["n"], r["offset"]) for r in df.collect()) == [("a", 0, 0), ("a", 1, 10), ("a", 2, 21), ("a", 3, 33), ("a", 4, 46), ("b", 9, 0)]


SITES = (site_rule("block", "net", "/"), site_rule("allow", "example.net", "/en/"), site_rule("block", "example.com", "/d"), site_rule("allow", "org", ""))


def judged(url):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, a) for h, p, a in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/d", "block"), ("org", "", "allow"))
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    return host, path, None, "block" if "casino" in (host + path).lower() else "allow"


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "https://example.net/en", "https://www.EXAMPLE.net/en/?q=/de/", "http://example.net/EN/",
            "http://planet/x", "http://x.example.com/de/a#b", "http://example.com/daily", "http://example.com/x", "http://a.org?x", "http://a.org#y", "http://borg/", "ftp://u:p@h.net:80/a",
            "http://a.b/c://d.net/", "http://best-casino.com/", "http://a.de/casino/x", "http://a.de/casinos", "http://ÄÖ.org/é", "http://x.net/" + "a/" * 20_000, "http://net.example.org/net/"] * 2
    df = spark.createDataFrame([(i, u, "k", "t") for i, u in enumerate(urls)], "page_id long, url string, token string, id string")
    out = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, SITES + WORD_RULES, keep=("page_id",)).collect()}
    assert len(out) == len(urls)
    for i, u in enumerate(urls):
        if u != "http://a.de/casinos":
            assert out[i] == judged(u), u
    assert out[21][3] == "allow"
    assert judge_urls(df.limit(0), SITES, keep=("page_id",)).count() == 0
    assert {r["verdict"] for r in judge_urls(df, (), keep=("page_id",)).collect()} == {"allow"}


def vectors(rng, n):
    base = rng.normal(size=(n // 4, 16))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] + rng.normal(size=16) * rng.choice([0, 0.05, 0.12])
        rows.append((i, v.tolist(), int(rng.integers(3))))
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, rows[0][1], None), (n + 4, [None] + [1.0] * 15, 0), (n + 5, [], 0),
             (n + 6, [1e200] * 16, 2), (n + 7, [1e-200] * 16, 2), (n + 8, rows[0][1], rows[0][2]), (n + 9, [1.0, 0.0], 0), (n + 10, [2.0, 0.0], 0), (n + 11, [float("inf")] * 16, 0)]
    return rows


def linked(rows, threshold):
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = v and label is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x = np.array(v, float) / max(abs(c) for c in v) if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    part = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([part[i]] + [part[j] for j in links[i]], key=lambda k: rows[k][0])
            if low != part[i]:
                part[i], changed = low, True
    return [(rows[i][0], len(links[i]), rows[part[i]][0], part[i] == i) for i in range(n)]


@pytest.mark.parametrize("tile", [1_000, 25])
def test_vector_join_equals_brute_force(spark, monkeypatch, tile):
    """Whole groups in one tile, and groups that are cut into pivot cells and many tiles."""
    monkeypatch.setattr(metric_join, "TILE", tile)
    monkeypatch.setattr(metric_join, "PIVOTS", 5)
    rows = vectors(np.random.default_rng(22), 240)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, cid string, unit string").repartition(3)
    got = metric_join.join_vectors(df, 0.93).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == sorted(linked(rows, 0.93))


def test_vector_join_of_nothing_and_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert metric_join.join_vectors(spark.createDataFrame([], schema), 0.93).count() == 0
    got = metric_join.join_vectors(spark.createDataFrame([(4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (5, [2.0, 0.0], 1)], schema), 0.93).collect()
    assert sorted(tuple(r) for r in got) == [(4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False)]


@pytest.mark.parametrize("seed", range(2))
def test_vector_join_of_jittered_and_scaled_copies(spark, monkeypatch, seed):
    """A hot group of copies that differ in the last digits gets several pivots, which almost coincide."""
    monkeypatch.setattr(metric_join, "TILE", 40)
    rng = np.random.default_rng(100 + seed)
    hot = rng.normal(size=16).astype("f4")
    rows = []
    for k in range(120):
        v = hot.copy()
        if k % 2:
            for _ in range(rng.integers(1, 6)):
                v[k % 16] = np.nextafter(v[k % 16], np.float32(np.inf))
        else:
            v *= np.float32(rng.uniform(0.5, 3))
        rows.append((k, [float(c) for c in v], 1))
    rows += [(200 + k, (hot * (1 + rng.normal(size=16) * 1e-9)).tolist(), 1) for k in range(60)]
    rows += [(300 + k, (hot + rng.normal(size=16) * 0.2).tolist(), 1) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = metric_join.join_vectors(df, 0.93).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == sorted(linked(rows, 0.93))


CONTROL = ["<|turn|>", "<|text|>x<|end|>", "</s>[INST] ok [/INST]", "a\\b", "<\\|", "<\\\\|end|>", "[\\INST]", "[/INST]", "<s>", "< s>", "\\", "\\\\", "[", "<", "<|", "<<||", "\n", ""]


def test_escapes_are_reversible(spark):
    rng = random.Random(23)
    texts = CONTROL + ["".join(rng.choice(["<", "|", "\\", "/", "s>", "[", "INST]", "a", " "]) for _ in range(rng.randrange(12))) for _ in range(400)]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    for r in out:
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]")), r


def test_conversations_round_trip(spark):
    rng = random.Random(24)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None, "odd\n<|role"]), rng.choice([*CONTROL, None, "plain text é"])))
    rows += [(100, 0, "user", "q"), (100, 1, "assistant", "a"), (101, 0, "system", "s"), (101, 1, "user", "q"), (101, 2, "assistant", "x" * 50_000), (102, 0, "user", "twice"), (102, 0, "user", "twice"),
             (None, 0, "user", "no number")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, record string").repartition(4)
    out = formatted(canonical_turns(records_of(df), keep=("conv_id",))).select("conv_id", "layout", turns_back(F.col("formatted")).alias("t"), loss_text(F.col("formatted"), F.col("loss")).alias("l")).collect()
    assert len(out) == len({r[0] for r in rows}) and {r["layout"] for r in out} == {"messages", "prompt", "instruction"}
    for r in out:
        want = [(role or "", text or "") for _, role, text in sorted((t, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"])]
        assert [(x["role"], x["text"]) for x in r["t"]] == want
        assert r["l"] == "".join(t for role, t in want if role == "assistant")
    assert canonical_turns(records_of(df.limit(0)), keep=("conv_id",)).count() == 0


def test_layouts_become_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "completion": "a"}, {"output": "a", "system": "s", "instruction": "q"}, {"unheard": [{"of": 1}]},
    ]
    lines = [json.dumps(r) for r in records] + ["not json", None]
    out = canonical_turns(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i long, record string"), keep=("i",)).collect()
    got = {r["i"]: (r["layout"], None if r["turns"] is None else [(t["role"], t["text"]) for t in r["turns"]]) for r in out}
    assert got == {0: ("messages", [("user", "q"), ("assistant", "")]), 1: ("conversations", [("user", "q"), ("assistant", "a")]), 2: ("prompt", [("user", "q"), ("assistant", "a")]),
                   3: ("instruction", [("system", "s"), ("user", "q"), ("assistant", "a")]), 4: (None, None), 5: (None, None), 6: (None, None)}
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_conversations_beyond_the_limit_of_json_keep_their_turns(spark):
    """A text of over 20 million characters in each layout."""
    n = 21_000_000
    rows = spark.createDataFrame(
        [(1, 0, "user"), (1, 1, "assistant"), (2, 0, "system"), (2, 1, "user"), (2, 2, "assistant"), (3, 0, "odd"), (3, 1, "assistant")],
        "conv_id long, turn long, role string",
    ).withColumn("text", F.when(F.col("role") == "assistant", F.repeat(F.lit("a<|b c "), n // 7)).otherwise("q"))
    out = formatted(canonical_turns(records_of(rows), keep=("conv_id",)))
    got = out.select("conv_id", "layout", F.size("turns"), F.length(loss_text(F.col("formatted"), F.col("loss"))), F.size(turns_back(F.col("formatted")))).collect()
    assert sorted(tuple(r) for r in got) == [(1, "prompt", 2, n, 2), (2, "instruction", 3, n, 3), (3, "messages", 2, n, 2)]


def test_only_labels_with_pivots_send_their_cells_to_the_driver(spark, monkeypatch):
    """Nearly as many labels as rows, and one large label."""
    monkeypatch.setattr(metric_join, "TILE", 20)
    sent, copied = [], metric_join._copied
    monkeypatch.setattr(metric_join, "_copied", lambda c, pivots, balls, radius: sent.append((pivots, balls)) or copied(c, pivots, balls, radius))
    rng = np.random.default_rng(40)
    rows = [(k, rng.normal(size=8).tolist(), max(k - 40, 0)) for k in range(140)]
    got = metric_join.join_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.5).collect()
    (pivots, balls), = sent
    assert list(pivots) == [("0", 8)] and {k[:2] for k in balls} == {("0", 8)}
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == sorted(linked(rows, 0.5))


def test_copies_of_a_vector_do_not_grow_with_structured_data(spark, monkeypatch):
    """Five times the vectors around the same centres: more pivots are sampled, but none stand near each other."""
    monkeypatch.setattr(metric_join, "TILE", 50)
    rng = np.random.default_rng(51)
    centres = rng.normal(size=(30, 16))
    radius, stored, copies, pivots = np.sqrt(2 - 2 * 0.93), metric_join.stored, {}, {}
    counted = lambda df, name: copies.update({name: df.count()}) or stored(df, name)
    monkeypatch.setattr(metric_join, "stored", counted)
    sampled = metric_join._pivots
    monkeypatch.setattr(metric_join, "_pivots", lambda classes, radius: pivots.update(sampled(classes, radius)) or pivots)
    shares = []
    for n in (400, 2_000):
        rows = [(k, (centres[k % 30] + rng.normal(size=16) * 0.1).tolist(), 1) for k in range(n)]
        got = metric_join.join_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.93).collect()
        unit = np.array([r[1] for r in rows])
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(((unit @ unit.T >= 0.93).sum(axis=1) - 1).tolist()))
        p = pivots["1", 16]
        assert 1 < len(p) <= 2 * n // 50 and min(np.linalg.norm(p[i] - p[j]) for i in range(len(p)) for j in range(i)) >= radius
        shares.append(copies["metric-copies"] / n)
    assert shares[1] < 1.5 * shares[0] and shares[1] < 5, shares


def test_audit_compares_every_record_of_an_offset(spark):
    """The record of the smaller digest is corrupt, a null archive is not '', and an offset loses one of two."""
    ours = [("a", 0, 5, "d1"), ("a", 0, 5, "d9"), ("b", 0, 5, "d1"), ("b", 0, 7, "d2"), ("", 3, 1, "x"), (None, 9, 1, "y"), ("c", 1, 1, "z")]
    theirs = [("a", 0, 5, "d0"), ("a", 0, 5, "d9"), ("b", 0, 7, "d2"), (None, 3, 1, "x"), (None, 9, 1, "y"), ("c", 1, 1, "z")]
    found = audit(spark.createDataFrame(ours, RECORDS), spark.createDataFrame(theirs, RECORDS)).collect()
    assert sorted((r["archive"], r["offset"], r["length"] or 0, r["copy_length"] or 0, r["problem"]) for r in found) == [
        ("", 3, 0, 1, "extra"), ("", 3, 1, 0, "missing"), ("a", 0, 5, 5, "changed"), ("b", 0, 5, 0, "missing")]

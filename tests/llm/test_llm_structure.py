"""Periodic runs, conversation repair and frequent lines against plain Python, with odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest

from arena.llm import line_runs, periodic_runs, turn_repair
from arena.llm.queries import op11_periodic_runs, op12_turn_repair, op13_line_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, runs string, n_words string, collapsed string, kept string, row string, body string"


def sha(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def docs_frame(spark, rows):
    """Rows of (doc_id, text) with columns named as the operators name theirs."""
    return spark.createDataFrame([(i, t, "r", "n", "c", "k", "w", "b") for i, t in rows], DOCS)


# ---- periodic runs


def runs_of(words, least=12):
    """{(start, length): smallest period} of all runs, by definition."""
    out, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                out.setdefault((start, i + q - start), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(rng, n, letters):
    words = [f"w{rng.randrange(letters)}" for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randrange(2, 7)
        words[a:] = [words[a + i % p] for i in range(n - a)]
    return words


def test_runs_equal_definition():
    rng = random.Random(5)
    for _ in range(400):
        texts = [periodic(rng, rng.randrange(90), rng.randrange(1, 6)) for _ in range(rng.randrange(1, 6))]
        least = rng.choice([2, 5, 12])
        got = [[] for _ in texts]
        for at, s, n, q in zip(*periodic_runs.periodic_runs([[w.encode() for w in t] for t in texts], least), strict=True):
            got[at].append((int(s), int(n), int(q)))
        assert got == [runs_of(t, least) for t in texts]


def test_runs_of_long_texts():
    ones = [b"a"] * 100_000
    wide = [b"%d" % (i % 7_000) for i in range(60_000)]
    nested = ([b"x", b"y"] * 30 + [b"z"]) * 400
    at, start, length, period = periodic_runs.periodic_runs([ones, [], wide, nested])
    found = set(zip(at.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True))
    assert {(0, 0, 100_000, 1), (2, 0, 60_000, 7_000), (3, 0, 61 * 400, 61), (3, 0, 60, 2)} <= found
    assert len(found) == 2 + 1 + 400


def test_runs_of_a_table(spark):
    rng = random.Random(8)
    rows = [(None, "one two " * 9), (1, None), (2, ""), (3, " \n\t"), (4, "alone"), (5, "é ü " * 20), (6, " ".join(periodic(rng, 9_000, 3)))]
    rows += [(7, "tie " * 13)] * 3 + [(10 + i, "\n".join(periodic(rng, rng.randrange(200), 4))) for i in range(40)]
    df = docs_frame(spark, rows).repartition(5)
    got = periodic_runs.find_runs(df.select("doc_id", "text"), lot_words=500).collect()
    want = []
    for i, t in rows:
        words = WORD.findall(t or "")
        want.append((i, len(words), runs_of(words), collapsed(words, runs_of(words))))
    same = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]
    assert sorted(same, key=repr) == sorted(want, key=repr)
    assert periodic_runs.find_runs(df.limit(0)).count() == 0
    assert periodic_runs.find_runs(df, keep=("doc_id", "row", "kept")).columns == ["doc_id", "row", "kept", "n_words", "runs", "collapsed"]


def write(spark, tmp_path, name, df):
    df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_runs_query_on_planted_periods(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 150)))) for i in range(150)] + [(1_000_003, None), (-5, ""), (None, "a " * 30)]
    sf = write(spark, tmp_path, "documents", docs_frame(spark, rows).select("doc_id", "text"))
    got = {r["doc_id"]: r for r in op11_periodic_runs(spark, sf).collect()}
    assert len(got) == len(rows)
    made = 0
    for i, t in rows:
        words, h = WORD.findall(t or ""), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
            made += 1
        runs, r = runs_of(words), got[i]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r["collapsed_sha256"] == sha(collapsed(words, runs))
    assert made >= 8


# ---- conversation repair


def faults_of(rows):
    """Fault of each (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines) by a full search over strings."""
    faults, memo = faults_of(rows), {}
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def best(i, last, inserted):
        if (i, last, inserted) in memo:
            return memo[i, last, inserted]
        options = []
        if i == len(rows):
            if last in ("", "a"):
                options.append((0, "", ()))
        else:
            _, role, text = rows[i]
            more = 5 if faults[i] == "truncated" else 0
            cost, audit, lines = best(i + 1, last, 0)
            options.append((cost + 2, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                cost, audit, lines = best(i + 1, due[last], 0)
                options.append((cost + 1 + more, "R" + audit, (f"{names[due[last]]}:{text}", *lines)))
                fits = {"s": last == "", "u": last != "u", "a": last == "u"}
                if role and fits.get(role[0], False):
                    cost, audit, lines = best(i + 1, role[0], 0)
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
        if inserted < 3:
            cost, audit, lines = best(i, due[last], inserted + 1)
            options.append((cost + 5, "I" + audit, (f"{names[due[last]]}:", *lines)))
        memo[i, last, inserted] = min(options, default=(10**9, "", ()))
        return memo[i, last, inserted]

    return best(0, "", 0)


def figures(rows):
    """What the query returns for the rows of one conversation, in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", sha("")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = Counter(faults_of(rows))
    pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(rows)
    return gaps, count["blank"], count["duplicate"], count["truncated"], pairs, cost, audit, sha("\n".join(lines))


def talk(rng, n):
    rows = []
    for i in range(n):
        turn = rng.choice([i, i, i, i * 2, None, 3])
        role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", "s", None])
        rows.append((turn, role, rng.choice(["Yes.", "No!", "and so", " ", "", None, f"t{i}.", f"Was it {i}? ", "é"])))
    return rows


def in_order(rows):
    filled = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))


TALK = "conv_id long, turn long, role string, text string, key string, piece int, fault string, block int"


def talk_frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "f", 2) for r in rows], TALK)


@pytest.mark.parametrize("block_rows", [1, 3, 4096])
def test_repair_equals_full_search(spark, block_rows):
    rng = random.Random(block_rows)
    talks = {c: talk(rng, rng.randrange(1, 14)) for c in [None, *range(-2, 40)]}
    rows = [(c, *r) for c, x in talks.items() for r in x]
    got = turn_repair.repair(talk_frame(spark, rows).repartition(6), block_rows=block_rows).collect()
    for c, x in talks.items():
        want = figures(in_order(x))
        mine = sorted((r for r in got if r["key"] == (None if c is None else str(c))), key=lambda r: r["block"])
        last = mine[-1]
        assert (last["gaps"], last["blank"], last["duplicate"], last["truncated"], last["illegal"], last["cost"]) == want[:6]
        assert "".join(r["audit"] for r in mine) == want[6]
        assert last["digest"] == want[7] == sha("\n".join(f"{t.role}:{t.text}" for r in mine for t in r["rows"]))
        assert all(r["cost"] is None for r in mine[:-1])


def test_repair_of_a_hot_conversation(spark):
    """A third of all rows in one conversation: many blocks over several tasks, the same result."""
    rng = random.Random(21)
    hot = [(i, rng.choice(["user", "assistant"]), rng.choice([f"line {i}.", f"line {i % 50}.", "cut off"])) for i in range(600)]
    rows = [(7, *r) for r in hot] + [(100 + i, i % 3, "user", "Hm.") for i in range(1200)]
    got = turn_repair.repair(talk_frame(spark, rows).repartition(9), block_rows=16, digest=True).filter("key = '7'").orderBy("block").collect()
    want = figures(in_order(hot))
    assert len(got) > 30 and "".join(r["audit"] for r in got) == want[6]
    assert (got[-1]["cost"], got[-1]["digest"]) == (want[5], want[7]) and got[0]["rows"] is None
    assert turn_repair.repair(talk_frame(spark, [])).count() == 0


def test_transfer_chains_like_single_steps():
    rng = random.Random(2)
    for _ in range(50):
        codes = bytes(rng.randrange(16) for _ in range(rng.randrange(1, 40)))
        v = turn_repair.END
        for c in reversed(codes):
            v = turn_repair._before(c, v)
        assert tuple((turn_repair.transfer(codes) + turn_repair.END).min(1)) == v


def test_repair_query_after_damage(spark, tmp_path):
    rng = random.Random(4)
    rows = [(c, t, role, text) for c in range(60) for t, role, text in talk(rng, rng.randrange(1, 9))]
    rows += [(900 + c, None, None, None) for c in range(40)] + [(None, 1, "user", "Hi.")]
    sf = write(spark, tmp_path, "conversations", talk_frame(spark, rows).select("conv_id", "turn", "role", "text"))
    got = {r["conv_id"]: r for r in op12_turn_repair(spark, sf).collect()}
    left = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        luck = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if luck == 0:
            continue
        text = "" if luck == 1 else re.sub("[.!?]", "", text) if luck == 2 else text
        left[c] += [(t, "user" if luck == 4 else role, text)] * (2 if luck == 3 else 1)
    assert set(got) == set(left) and any(not x for x in left.values())
    for c, x in left.items():
        r = got[c]
        mine = (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
        assert mine == figures(in_order(x)), c


# ---- frequent lines


def line_key(line):
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)


def without_frequent(rows, least=10):
    at = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            at.setdefault(line_key(line), set()).add(i)
    gone = {k for k, ids in at.items() if k and len(ids) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if line_key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def lined(rng, n):
    common = [f"Common line {k}" for k in range(12)] + ["", "  ", "ÄÖ Ü", "\x0bHead\x0c"]
    weights = [2 ** -(k / 2) for k in range(len(common))]
    rows = []
    for i in range(n):
        lines = rng.choices(common, weights, k=rng.randrange(0, 7)) + [f"own {i} {k}" for k in range(rng.randrange(3))]
        lines = [rng.choice([x, x.upper(), f" {x}\t", f"{x}\r"]) for x in lines]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (4, 2), (7, 3), (5, 99)])
def test_lines_equal_definition(spark, batches, fanout):
    rng = random.Random(batches)
    rows = lined(rng, 120) + [(None, "null id\nCommon line 3"), (None, "null id"), (500, None), (501, ""), (502, "\n\n")]
    rows += [(600, "again\nagain")] * 30 + [(601, "often\n" * 200), (602, "\n".join(f"line {k}" for k in range(3_000)))]
    df = docs_frame(spark, rows).repartition(6)
    got = line_runs.drop_frequent_lines(df, batches=batches, fanout=fanout)
    assert got.columns == ["row", "n_lines", "n_dropped", "kept"]
    same = [(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got.collect()]
    want = without_frequent(rows)
    assert sorted(same, key=repr) == sorted(want, key=repr) and any(x[2] for x in want)


def test_line_runs_level_and_settle(spark):
    """Batches of one line each document: levels stay under the fanout, settled lines are carried no more."""
    runs = line_runs.LineRuns(spark, least=4, fanout=2)
    for batch in range(6):
        runs.add(spark.createDataFrame([(batch * 10 + i, h, -h) for i in range(2) for h in (1, 2 + batch)], "id long, h long, g long"))
    assert [len(x) for x in runs.levels] == [0, 1, 1]
    assert sorted(map(tuple, runs.frequent().collect())) == [(1, -1)]
    open_rows = [r for level in runs.levels for run in level for r in run.collect()]
    assert all(r["h"] != 1 for r in open_rows) and {r["n"] for r in open_rows} == {2}


def test_lines_of_empty_tables_and_the_query(spark, tmp_path):
    assert line_runs.drop_frequent_lines(docs_frame(spark, [])).count() == 0
    assert line_runs.drop_frequent_lines(docs_frame(spark, [(1, None), (2, "")])).filter("n_lines = 1 and n_dropped = 0 and kept = ''").count() == 2
    rows = lined(random.Random(1), 60)
    sf = write(spark, tmp_path, "documents", docs_frame(spark, rows).select("doc_id", "text"))
    got = sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in op13_line_runs(spark, sf).collect())
    assert got == sorted((i, n, d, sha(k)) for i, n, d, k in without_frequent(rows))

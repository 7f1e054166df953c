"""Quality rules, repeated passages and near-duplicates against plain Python, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from arena.llm import block_anchors, prob_minhash
from arena.llm.word_windows import mixed
from arena.llm.quality_rules import STOP_WORDS, judged, keep_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, body string, m string, row string, kept string"


def frame(spark, rows):
    """Rows of (doc_id, text) with more columns, some named as the operators name theirs."""
    full = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), -1, "b", "m", "r", "k") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    long = prose(rng, 20_000, 3_000)
    twin = prose(rng, 120)
    return [(None, "a text without a number " * 2), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "é ü ß x"), (6, long),
            (7, twin), (7, twin), (8, twin), (9, "tie " * 50), (10, "tie " * 50)]


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for x in at.values() if len(x) > 1 for i in x for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_rules_count_as_plain_python(spark, odd_rows):
    rng = random.Random(1)
    rows = odd_rows + [(20, "x\ny\nx\n \n \nx"), (21, prose(rng, 60, 3)), (22, "a | b # c <d> " * 9), (23, prose(rng, 8) + " " + prose(rng, 5))]
    rows += [(30 + i, prose(rng, 40, 4 + i)) for i in range(8)]
    got = judged(frame(spark, rows)).select("row.doc_id", "row.text", "m.n_words", "m.word_chars", "m.n_symbols", "m.lines.dup", "m.n_repeat_words").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:] == counts(r["text"]), r["doc_id"]


def test_rules_keep_prose_and_drop_junk(spark):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(300)] + STOP_WORDS * 2
    good = [" ".join(rng.choice(vocabulary) for _ in range(80)).capitalize() + ".\nEnd of it." for _ in range(20)]
    junk = ["A!! B!! THE!! " * 20, "cell | " * 40, "heat " * 60, "short text", "", None, "qq zz " + " ".join(f"x{i}" for i in range(50))]
    df = frame(spark, list(enumerate(good + junk)))
    kept = keep_quality(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(good)))
    assert keep_quality(df.limit(0)).count() == 0


def cut(rows):
    """(n_words, kept words, n_removed) of each row, by definition."""
    first = {}
    texts = [(i if i is not None else -(2**63), (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, w in texts:
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] != (i, s):
                gone.update(range(s, s + 20))
        out.append((len(w), [x for k, x in enumerate(w) if k not in gone], len(gone)))
    return out


def repeats(rng, n):
    passages = [prose(rng, k) for k in (20, 21, 29, 55, 90)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else prose(rng, rng.randrange(0, 40)))
        rows.append((i * 7 % 101, " \n".join(parts)))
    return rows


def test_repeats_equal_brute_force(spark, odd_rows):
    rows = odd_rows + [(i + 1_000, t) for i, t in repeats(random.Random(4), 90)]
    want = sorted((i is not None, i or 0, n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()) for (i, _), (n, kept, gone) in zip(rows, cut(rows), strict=True))
    got = block_anchors.remove_repeats(frame(spark, rows).repartition(7), digest=True).collect()
    same = sorted((r["id"] != block_anchors.NULL_ID, r["id"] if r["id"] != block_anchors.NULL_ID else 0, r["n_words"], r["n_removed"], r["kept"]) for r in got)
    assert same == want


def test_repeats_inside_one_text_and_texts_that_stay(spark):
    rng = random.Random(6)
    passage = prose(rng, 30)
    rows = [(1, passage + " " + prose(rng, 5) + " " + passage), (2, prose(rng, 50)), (3, passage[: len(passage) // 2])]
    got = {r["id"]: r for r in block_anchors.remove_repeats(frame(spark, rows)).collect()}
    assert got[1]["n_removed"] == 30 and got[1]["kept"].startswith(passage)
    assert got[2]["n_removed"] == 0 and got[2]["kept"] is None and got[3]["kept"] is None
    assert block_anchors.remove_repeats(frame(spark, rows).limit(0)).count() == 0


def test_repeats_do_not_depend_on_the_number_of_groups(spark, monkeypatch):
    rows = repeats(random.Random(5), 60)
    df = frame(spark, rows)
    bodies = block_anchors.keyed(df).selectExpr("cast(text as binary) as body")
    few, size = block_anchors._shape(bodies), sum(len(t) for _, t in rows)
    read = lambda: sorted((r["id"], r["n_words"], r["n_removed"], r["kept"]) for r in block_anchors.remove_repeats(df, digest=True).collect())
    want = read()
    monkeypatch.setattr(block_anchors, "BUCKET_BYTES", size // 30)
    monkeypatch.setattr(block_anchors, "HOME_BYTES", size // 20)
    many = block_anchors._shape(bodies)
    assert many[0] >= 30 > few[0] and many[1] >= 20 > few[1]
    assert read() == want
    assert block_anchors._shape(bodies.limit(0)) == few  # no text at all: as many as the session's tasks


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def weight(some):
    """Of shingles: the number of different words of each."""
    return sum(len(set(s)) for s in some)


def components(rows):
    """Class of each row by weighted similarity of at least 0.8, all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            near = sets[a] and weight(sets[a] & sets[b]) >= 0.8 * weight(sets[a] | sets[b]) - 1e-9
            if near or (rows[a][0] == rows[b][0] and rows[a][0] is not None):
                x, y = find(a), find(b)
                parent[max(x, y, key=lambda k: rows[k][0])] = min(x, y, key=lambda k: rows[k][0])
    return [rows[find(i)][0] for i in range(len(rows))]


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def near_rows(rng):
    rows, i = [], 100
    for size, copies in ((150, 12), (60, 6), (400, 5), (9, 3), (30, 2)):
        base = prose(rng, size)
        for k in range(copies):
            rows.append((i, base if k % 3 == 0 else edited(rng, base, rng.randrange(1, max(2, size // 40)))))
            i += 1
    return rows + [(i + k, prose(rng, rng.randrange(1, 80))) for k in range(60)]


@pytest.mark.parametrize("small", [48, 2])
def test_near_classes_equal_brute_force(spark, odd_rows, monkeypatch, small):
    """Also where every bucket counts as large, so that hubs and splits find the groups."""
    monkeypatch.setattr(prob_minhash, "SMALL", small)
    rows = [r for r in odd_rows if r[0] is not None] + near_rows(random.Random(8))
    got = prob_minhash.near_classes(frame(spark, rows)).collect()
    want = sorted(zip([i for i, _ in rows], components(rows), strict=True))
    found = sorted((r["doc_id"], r["class_id"]) for r in got)
    assert found == want
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_near_classes_of_nothing_and_of_null_ids(spark):
    df = frame(spark, [(None, "a b c d e f"), (None, None), (3, "a b c d e f")])
    got = sorted(((r["doc_id"] is None, r["class_id"]) for r in prob_minhash.near_classes(df).collect()), key=str)
    assert got == [(False, None), (True, None), (True, None)]
    assert prob_minhash.near_classes(df.limit(0)).count() == 0


def test_shingles_weigh_their_different_words():
    keys, weights = prob_minhash._shingles(b"a a a a a b c d e a a a a a")
    assert len(keys) == len(weights) == 9 and sorted(weights.tolist()) == [1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert prob_minhash._shingles(b"one two")[0].size == 1 and prob_minhash._shingles(b"")[0].size == 0


def test_sketches_estimate_weighted_similarity():
    """Agreement of registers against the probability Jaccard similarity, over many pairs, by its full formula."""
    rng = random.Random(9)
    errors, plain = [], []
    for _ in range(60):
        x = {rng.randrange(90) for _ in range(80)}
        y = set(rng.sample(sorted(x), rng.randrange(10, len(x)))) | {rng.randrange(90, 130) for _ in range(20)}
        w = {k: 1 + k % 5 for k in x | y}
        sets = [(mixed(np.array(sorted(v), np.uint64) + np.uint64(1)), np.array([w[k] for k in sorted(v)])) for v in (x, y)]
        a, b = prob_minhash.sketch(sets)
        both, either = x & y, x | y
        j = sum(1 / sum(max((t in x) * w[t] / w[s], (t in y) * w[t] / w[s]) for t in either) for s in both)
        assert j == pytest.approx(sum(w[k] for k in both) / sum(w[k] for k in either))
        errors.append((a == b).mean() - j)
        plain.append(len(both) / len(either) - j)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08 and max(map(abs, plain)) > 0.03


def test_recall_by_similarity():
    """Share of pairs that meet in a band and pass the sketch, by exact similarity: all from 0.8 on, few far below."""
    rng = random.Random(10)
    met = {0.5: [], 0.7: [], 0.8: [], 0.9: []}
    for _ in range(500):
        base = prose(rng, 200, 10**6)
        pair = [base.encode(), edited(rng, base, rng.choice([1, 2, 3, 4, 5, 6, 8, 10, 14, 18])).encode()]
        sets = [prob_minhash._shingles(t) for t in pair]
        both = weight(shingles(base) & shingles(pair[1].decode())) / weight(shingles(base) | shingles(pair[1].decode()))
        a, b = prob_minhash.sketch(sets)
        bands = (a == b).reshape(prob_minhash.BANDS, prob_minhash.ROWS).all(axis=1)
        small = ((a >> np.uint64(56)) == (b >> np.uint64(56))).sum() >= prob_minhash.AGREE
        level = max((x for x in met if x <= both), default=None)
        if level is not None:
            met[level].append(bool(bands.any() and small))
    recall = {x: np.mean(v) for x, v in met.items() if v}
    print("recall by similarity", {x: (round(float(np.mean(v)), 3), len(v)) for x, v in met.items() if v})
    assert recall[0.8] >= 0.99 and recall[0.9] == 1 and min(len(v) for v in met.values()) > 30


def test_texts_that_differ_only_in_repeats_are_near(spark):
    """Pairs of similarity 0.94 to 0.97 whose counts of shingles differ by hundreds."""
    rng = random.Random(35)
    rows = []
    for k in range(12):
        for j, (body, line, times) in enumerate(((54, 10, 500), (104, 10, 500), (54, 20, 100))):
            start, again = prose(rng, body, 10**6), prose(rng, line, 10**6)
            i = 10 * (3 * k + j)
            rows += [(i, f"{start} {again} {again}"), (i + 1, start + f" {again}" * times)]
    got = sorted((r["doc_id"], r["class_id"]) for r in prob_minhash.near_classes(frame(spark, rows)).collect())
    assert got == sorted(zip([i for i, _ in rows], components(rows), strict=True)) == [(i, i // 10 * 10) for i, _ in rows]


@pytest.mark.parametrize("tile", [4_000, 30])
def test_large_buckets_of_many_groups_lose_no_pair(spark, monkeypatch, tile):
    """Pairs inside one large group of texts that share most of their words: hubs link few of them."""
    monkeypatch.setattr(prob_minhash, "SMALL", 2)
    monkeypatch.setattr(prob_minhash, "TILE", tile, raising=False)
    rng = random.Random(36)
    common = prose(rng, 190, 10**6)
    rows = []
    for k in range(150):
        tail = prose(rng, 6, 10**6)
        rows += [(1000 + 2 * k + j, f"{prose(rng, 23, 10**6)} {common} {tail}") for j in range(2)]
    got = sorted((r["doc_id"], r["class_id"]) for r in prob_minhash.near_classes(frame(spark, rows)).collect())
    want = sorted(zip([i for i, _ in rows], components(rows), strict=True))
    assert len({c for _, c in want}) == 150
    assert got == want

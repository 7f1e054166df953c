"""Quality scores on held-back texts, and the corpus pipeline against plain Python, stage by stage."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from test_llm_texts import components, cut, edited, prose
from tokenizers import Tokenizer

import corpus_pipeline
from arena.llm.pu_quality import class_prior, features, fit_scorer, score_texts, train
from arena.llm.quality_rules import STOP_WORDS
from arena.llm.queries import op9_pu_quality


def sentence(rng, n):
    return " ".join(rng.choice([f"word{rng.randrange(400)}", rng.choice(STOP_WORDS)]) for _ in range(n)) + "."


def junk(rng):
    return rng.choice([
        lambda: " ".join(f"{sentence(rng, 1).upper()}!!" for _ in range(40)), lambda: "cell | " * rng.randrange(20, 60),
        lambda: " ".join(f"w{rng.randrange(99)}$$$" for _ in range(50)), lambda: f"again{rng.randrange(9)} " * rng.randrange(40, 80),
    ])()


def test_positive_unlabelled_scores(spark):
    rng = random.Random(31)
    good = [(i, "\n".join(sentence(rng, rng.randrange(5, 20)) for _ in range(rng.randrange(2, 9)))) for i in range(600)]
    bad = [(1_000 + i, junk(rng)) for i in range(150)]
    odd = [(2_000, None), (2_001, ""), (2_002, " \n "), (None, "no number"), (3, good[3][1]), (2_003, "w " * 50_000)]
    df = spark.createDataFrame([(*r, "x") for r in good + bad + odd], "doc_id long, text string, x string").repartition(4)
    trusted = df.filter("doc_id < 200").select("doc_id")
    scorer = fit_scorer(df, trusted, df.filter("doc_id < 2000 and doc_id % 5 > 0").select("doc_id"))
    out = score_texts(df, scorer).collect()
    assert len(out) == len(good + bad + odd) and all(0 <= r["score"] <= 1 for r in out)
    fresh = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 2_000 and r["doc_id"] % 5 == 0 and r["doc_id"] >= 200]
    right = [(r["score"] >= 0.3) == (r["doc_id"] < 1_000) for r in fresh]
    assert np.mean(right) > 0.97
    assert 0.65 < scorer.prior < 0.9


def test_scores_without_positives_and_without_rows(spark):
    df = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    assert fit_scorer(df, df.limit(0).select("doc_id"), df.select("doc_id")) is None
    assert [r["score"] for r in score_texts(df, None).collect()] == [0.5]
    assert score_texts(df.limit(0), None).count() == 0


def test_prior_of_a_mixture():
    rng = np.random.default_rng(32)
    p = rng.normal(2, 1, 4_000)
    u = np.where(rng.random(8_000) < 0.7, rng.normal(2, 1, 8_000), rng.normal(-2, 1, 8_000))
    assert class_prior(p, u) == pytest.approx(0.7, abs=0.06)
    scorer = train(rng.normal(1, 1, (400, 3)), np.concatenate([rng.normal(1, 1, (500, 3)), rng.normal(-2, 1, (300, 3))]))
    assert scorer(np.full((1, 3), 1.5))[0] > 0.9 > 0.1 > scorer(np.full((1, 3), -3.0))[0]


def test_features_are_shares():
    one = "Some text here, and more of it.\nA line.\n".encode()
    assert np.isfinite(features(b"")).all() and features(b"").shape == features(one).shape
    assert np.abs(features(one * 50)[:5] - features(one)[:5]).max() < 1e-9


def test_held_out_labels_are_never_read(spark, tmp_path):
    """Turning every held-out label over leaves the scores as they were."""
    import zlib

    rng = random.Random(33)
    texts = [(i, junk(rng) if i % 6 == 0 else sentence(rng, 60)) for i in range(240)]
    scores = []
    for turn in (0, 1):
        folder = tmp_path / str(turn)
        spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(folder / "documents.parquet"))
        labels = [(i, (0 if i % 6 == 0 else 1) ^ (turn if zlib.crc32(str(i).encode()) % 5 == 0 else 0), 0) for i, _ in texts]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        out = op9_pu_quality(spark, str(folder)).collect()
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
        scores.append(sorted((r["doc_id"], r["score"], r["predicted"]) for r in out))
    assert scores[0] == scores[1]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(rng):
    rows, i = [], 0

    def add(text, source):
        nonlocal i
        rows.append((i, text, "en", source, None if text is None else len(text)))
        i += 1

    passage = sentence(rng, 60)
    for k in range(60):
        base = "\n".join(sentence(rng, rng.randrange(20, 60)) for _ in range(3))
        add(base, f"src{k % 4}")
        if k % 6 == 0:
            add(base, "src0")
        if k % 7 == 0:
            add(edited(rng, base, 2), "src1")
        if k % 5 == 0:
            add(sentence(rng, 70) + " " + passage + " " + sentence(rng, 70), None)
    for _ in range(12):
        add(junk(rng), "src2")
    add(None, "src3")
    add("", "src3")
    add(prose(rng, 30), "src3")
    return rows


def test_stages_equal_plain_python(spark):
    rows = corpus(random.Random(34))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "repeated_passages", "source_mix", "packing"]

    kept = stages["quality_rules"](spark, docs, "")
    assert kept.columns == docs.columns
    good = sorted(tuple(r) for r in kept.collect())
    assert {r[0] for r in good} == {r[0] for r in rows if r[1] and "word" in r[1] and "!!" not in r[1]}

    unique = stages["near_duplicates"](spark, kept, "")
    pairs = [(r[0], r[1]) for r in good]
    want = {i for (i, _), c in zip(pairs, components(pairs), strict=True) if i == c}
    left = sorted(tuple(r) for r in unique.collect())
    assert unique.columns == docs.columns and left == [r for r in good if r[0] in want] and len(left) < len(good)

    trimmed = stages["repeated_passages"](spark, unique, "")
    after = sorted(tuple(r) for r in trimmed.collect())
    expected = []
    for r, (_, words, gone) in zip(left, cut([(r[0], r[1]) for r in left]), strict=True):
        text = b" ".join(words).decode() if gone else r[1]
        expected.append((r[0], text, *r[2:4], len(text)))
    assert trimmed.columns == docs.columns and after == sorted(expected) and after != left

    mixed = stages["source_mix"](spark, trimmed, "")
    drawn = [tuple(r) for r in mixed.collect()]
    texts = {r[0]: r for r in after}
    taken = {}
    for i, text, lang, source, n in drawn:
        assert (lang, source) == texts[i][2:4] and n == len(text) and text
        assert text == texts[i][1] or set(text.split()) <= set(texts[i][1].split())
        taken[i] = taken.get(i, 0) + len(text.split())
    assert mixed.columns == docs.columns and all(n <= 3 * len(texts[i][1].split()) for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(sum(len(r[1].split()) for r in after), abs=3)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = stages["packing"](spark, mixed, "").collect()
    assert sum(p["length"] for p in pieces) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t, *_ in drawn)


def test_stages_take_odd_rows(spark):
    """Repeated rows, null numbers, clashing columns and empty tables."""
    rng = random.Random(35)
    text = sentence(rng, 80)
    schema = SCHEMA + ", id long, fp long, row string, _id string, _n long, kept string, draws string"
    rows = [(5, text, "en", "a", 1, 1, 1, "r", "i", 2, "k", "d")] * 2 + [(None, sentence(rng, 90), "en", None, 1, 1, 1, "r", "i", 2, "k", "d"), (6, sentence(rng, 40), None, "b", None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), schema)
        if name == "near_duplicates":
            assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["5", "6", "None"]
    assert {r["doc_id"] for r in docs.collect()} <= {5, 6, None}
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_run_chains_the_stages(spark, tmp_path):
    spark.createDataFrame(corpus(random.Random(36)), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 20 and {"doc_id", "start", "length", "sequence_id", "offset", "ids"} <= set(out.columns)

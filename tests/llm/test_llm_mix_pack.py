"""Mixing and packing: exact totals, exact round trips, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arena.llm.queries import op2_tier_packing, op5_split_tree_mix
from arena.llm.split_mix import LEVELS, SHARD_BLOCKS, SHARD_WORDS, hypergeometric, mix, permuted, split_tree, tree_levels
from arena.llm.tier_packing import TIERS, Packer, WordIds, pack_documents, step_groups, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, source string, text string, size string, src string, row string, begin string, ids string, start string"


def docs(spark, rows):
    return spark.createDataFrame([(i, s, t, "x", "y", "z", "w", "v", "u") for i, s, t in rows], SCHEMA)


def targets(sizes, weights, cap=3.0):
    """Water filling by plain Python over sources in code point order, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, closed = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[n] for n in closed)
        free = sum(w[n] for n in names if n not in closed and sizes[n])
        share = {n: cap * sizes[n] if n in closed else (rest * w[n] / free if sizes[n] else 0) for n in names}
        over = {n for n in names if n not in closed and share[n] > cap * sizes[n]}
        if not over:
            return share
        closed |= over


@pytest.fixture(scope="module")
def mixed_rows():
    rng = random.Random(11)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "a", "B", "c", "é", None, "tiny"])
        n = 1 if source == "tiny" else rng.choice([0, 1, 5, 30, 200])
        rows.append((i, source, None if rng.random() < 0.05 else " ".join(["w"] * n)))
    return rows + [(900, "a", "long " * 20_000), (5, "c", "same text"), (5, "c", "same text"), (None, "c", "no number"), (901, "empty", "")]


def test_mix_meets_the_targets(spark, mixed_rows):
    plan = mix(docs(spark, mixed_rows), weights=(5, 2, 1))
    draws = plan.draws.select("row.doc_id", "sid", "begin", "pass", "shard", "start", "length").collect()
    rows = {(r["sid"], r["begin"], r["doc_id"]): r for r in plan.rows.filter("size > 0").select("row.doc_id", "sid", "begin", "size", "target", "source_size").collect()}
    sizes = {}
    for _, s, t in mixed_rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes, (5, 2, 1))
    by_size = {sizes[s]: want[s] for s in sizes}
    taken, seen = {}, {}
    for d in draws:
        key = (d["sid"], d["begin"], d["doc_id"])
        taken[key] = taken.get(key, 0) + d["length"]
        seen.setdefault((*key, d["pass"]), []).append((d["start"], d["length"]))
    for parts in seen.values():  # a pass takes no word twice
        parts.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
    per_source = {}
    for key, r in rows.items():
        assert taken.get(key, 0) <= 3 * r["size"]
        assert r["target"] == pytest.approx(by_size[r["source_size"]])
        per_source.setdefault(key[0], [r["target"], 0])[1] += taken.get(key, 0)
    for target, words in per_source.values():
        assert abs(target - words) <= 0.51
    assert sum(w for _, w in per_source.values()) == pytest.approx(sum(sizes.values()), abs=5)


def test_mix_agrees_with_itself_and_takes_nothing_of_nothing(spark, mixed_rows):
    df = docs(spark, mixed_rows)
    taken = [sorted(map(str, mix(d, weights=(5, 2, 1)).draws.select("row", "pass", "shard", "start", "length", "order").collect())) for d in (df, df.repartition(5))]
    assert taken[0] == taken[1]
    assert mix(df.limit(0), weights=(1,)).draws.count() == 0
    assert mix(df.filter("text is null or text = ''"), weights=(1,)).draws.count() == 0


def test_tree_deals_every_block_once(spark):
    quotas = spark.createDataFrame([(i, q) for i, q in enumerate((0, 1, 700, 1024, 333))], "sid long, quota long")
    leaves = split_tree(quotas, 3).collect()
    shards = {}
    for sid, quota in enumerate((0, 1, 700, 1024, 333)):
        mine = sorted((r for r in leaves if r["sid"] == sid), key=lambda r: r["shard"])
        assert [r["first"] for r in mine] == [sum(r["quota"] for r in mine[:k]) for k in range(8)]
        assert sum(r["quota"] for r in mine) == quota
        for r in mine:
            shards[r["shard"]] = shards.get(r["shard"], 0) + r["quota"]
    assert max(shards.values()) - min(shards.values()) <= 1


def test_draws_are_hypergeometric(spark):
    n, k, d = 60, 25, 20
    u = (F.col("id") + 0.5) / 4000
    got = spark.range(4000).select(hypergeometric(F.lit(n), F.lit(k), F.lit(d), u).alias("x")).groupBy("x").count().collect()
    from math import comb

    for r in got:
        assert r["count"] / 4000 == pytest.approx(comb(k, r["x"]) * comb(n - k, d - r["x"]) / comb(n, d), abs=0.002)
    edge = [(0, 0, 0, 0), (5, 5, 3, 3), (5, 0, 3, 0), (4, 2, 4, 2), (1024 * 20, 1024, 10_240, None)]
    for total, marked, drawn, want in edge:
        x = spark.range(1).select(hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), F.lit(0.5))).first()[0]
        assert want is None and abs(x - 512) < 60 or x == want


def test_places_of_blocks_are_distinct(spark):
    sizes = spark.createDataFrame([(n,) for n in (1, 2, 7, 500, 1023, 40_000)], "n long")
    each = sizes.select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("b"))
    out = each.select("n", permuted(F.col("b"), F.col("n"), F.col("n")).alias("p")).groupBy("n").agg(F.count_distinct("p").alias("d"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    assert all(r["d"] == r["n"] and r["lo"] == 0 and r["hi"] == r["n"] - 1 for r in out.collect())


def test_words_give_the_ids_of_the_tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    texts = ["Hello, WORLD's best 12x", "É\u0301ü ßtraße\u00a0nbsp\u2003em", "a\x01b \x01 c", "İstanbul ΟΔΟΣ", "don't we'll I'm", "tab\tnl\nvt\x0bff\x0c", "<|endoftext|> x", "日本語 text", "", " ", "emoji 👩‍👩‍👧 x"]
    ids = WordIds(PATH)
    for text in texts * 2:
        assert np.frombuffer(ids(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_memory_of_words_is_bounded(monkeypatch):
    from arena.llm import tier_packing

    monkeypatch.setattr(tier_packing, "CACHE_WORDS", 20)
    ids, plain = WordIds(PATH), word_ids(PATH)
    for k in range(30):
        text = " ".join(f"word{(k * 7 + j) % 90}" for j in range(12)).encode()
        assert ids(text) == plain(text)
        assert len(ids.known) <= 20 + 12


def test_packing_round_trip(spark):
    rng = random.Random(12)
    rows = [(i, "s", " ".join(f"thing{rng.randrange(500)}" for _ in range(rng.choice([0, 3, 40, 300, 2500])))) for i in range(150)]
    rows += [(500, "s", None), (None, "s", "no number"), (7, "s", rows[7][2]), (501, "s", "x " * 30_000)]
    pieces = pack_documents(docs(spark, rows).repartition(3), PATH).collect()
    t = Tokenizer.from_file(PATH)
    want = sorted((str(i), t.encode(x or "", add_special_tokens=False).ids + [1]) for i, _, x in rows)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        by_doc.setdefault(str(p["doc_id"]), []).append(p)
    for key, parts in by_doc.items():
        got = [ids for k, ids in want if k == key]
        assert sum(p["length"] for p in parts) == sum(map(len, got)) and all(p["doc_tokens"] == len(got[0]) for p in parts)
        whole = got[0]
        starts = sorted((p["start"], p["length"]) for p in parts)
        for p in parts:
            assert np.frombuffer(p["ids"], "<u4").tolist() == whole[p["start"] : p["start"] + p["length"]]
        if len(got) == 1:
            assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]
    padding = tokens = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        size = sum(p["length"] for p in parts)
        assert [p["offset"] for p in parts] == [sum(p["length"] for p in parts[:k]) for k in range(len(parts))]
        assert size <= TIERS[-1] and all(p["context"] == next(c for c in TIERS if size <= c) for p in parts)
        padding += 0 if size & (size - 1) == 0 else TIERS[-1] - size
        tokens += size
    assert padding < 0.01 * tokens
    assert pack_documents(docs(spark, rows).limit(0), PATH).count() == 0


def test_gaps_of_long_windows_take_short_rests():
    packer = Packer()
    for doc, n in enumerate((1500, 400, 200, 140, 5000, 100)):
        packer.add(doc, n)
    packer.pack(False)
    assert [(0, 0, 1500), (1, 0, 400), (3, 0, 140)] in packer.windows  # 8 left are padded
    packer.pack(True)
    assert sum(x[2] for w in packer.windows for x in w) == 7340


def test_step_groups_are_balanced():
    rng = random.Random(13)
    windows = [[(i, 0, n) for n in [rng.randrange(1, 512)] * rng.randrange(1, 5)] for i in range(400)]
    cost = lambda w: sum(x[2] ** 2 for x in w)
    groups = step_groups(windows, tokens=20_000)
    sums = {}
    for w, g in zip(windows, groups, strict=True):
        sums[g] = sums.get(g, 0) + cost(w)
    assert max(sums.values()) < 1.2 * min(sums.values())
    assert zlib.crc32(bytes(groups[:100])) == zlib.crc32(bytes(step_groups(windows, tokens=20_000)[:100]))


def test_control_strings_have_the_ids_of_the_untouched_tokenizer(spark):
    t = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|> hi", "a<|startoftext|>b", "x <|endoftext|>", "<|EndOfText|> y", "<|endoftext|><|endoftext|>", "Word's<|endoftext|>'s !", "<|startoftext|>\n\tÉ <|endoftext|> tail.", "<|endoftext", "plain"]
    pieces = pack_documents(docs(spark, [(i, "s", x) for i, x in enumerate(texts)]).repartition(1), PATH).collect()
    got = {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        got.setdefault(p["doc_id"], []).extend(np.frombuffer(p["ids"], "<u4").tolist())
    assert got == {i: t.encode(x, add_special_tokens=False).ids + [1] for i, x in enumerate(texts)}


def padding_of(pieces):
    """(tokens, places of padding) of packed pieces."""
    sizes = {}
    for p in pieces:
        sizes[p["sequence_id"]] = sizes.get(p["sequence_id"], 0) + p["length"]
    return sum(sizes.values()), sum(TIERS[-1] - n for n in sizes.values() if n & (n - 1))


@pytest.mark.parametrize(("count", "text"), [(400, ""), (9, None), (1_000, "two words"), (3_000, "x")])
def test_many_tiny_documents_are_not_padded(spark, count, text):
    pieces = pack_documents(docs(spark, [(i, "s", text) for i in range(count)]).repartition(4), PATH).collect()
    tokens, padding = padding_of(pieces)
    assert len({p["doc_id"] for p in pieces}) == count and padding <= 0.01 * tokens


def test_packer_counts_what_it_holds():
    rng = random.Random(14)
    packer = Packer()
    for doc in range(3_000):
        packer.add(doc, rng.choice([1, 2, 3, 60, 300, 700, 1_500, 2_047, 2_048, 5_000]))
        if doc % 250 == 0:
            packer.pack(False)
            assert packer.held == [sum(r[0] for r in rests) for rests in packer.rests]
    packer.pack(True)
    sizes = [sum(x[2] for x in w) for w in packer.windows]
    assert packer.held == [0] * 4 and sum(TIERS[-1] - n for n in sizes if n & (n - 1)) < 0.01 * sum(sizes)


def test_packing_query_equals_the_untouched_tokenizer(spark, tmp_path):
    rng = random.Random(15)
    rows = [(i, "s", " ".join(f"Thing{rng.randrange(900)}," for _ in range(rng.choice([0, 1, 9, 200, 900])))) for i in range(80)] + [(500, "s", None), (501, "s", "<|endoftext|>")]
    docs(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    t = Tokenizer.from_file(PATH)
    whole = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for i, _, x in rows}
    pieces = op2_tier_packing(spark, str(tmp_path)).collect()
    at, offsets = {}, {}
    for p in pieces:
        ids = whole[p["doc_id"]]
        assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
        at.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        offsets.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(at) == set(whole)
    for parts, end in [(at[i], len(ids)) for i, ids in whole.items()] + [(x, None) for x in offsets.values()]:
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) == end if end is not None else sum(n for _, n in parts) <= TIERS[-1]
    tokens, padding = padding_of(pieces)
    assert padding < 0.01 * tokens


def test_levels_follow_the_words():
    assert [tree_levels(n) for n in (0, 1, SHARD_WORDS * 4, SHARD_WORDS * 5, SHARD_WORDS * 64, 10**15)] == [LEVELS[0], LEVELS[0], 2, 3, 6, LEVELS[1]]


def test_the_tree_decides_all_words(spark, mixed_rows):
    """Every drawn word lies in a block, every block in the shard the tree gave it, and shards hold the same number of blocks."""
    plan = mix(docs(spark, mixed_rows), weights=(5, 2, 1), shard_words=2_000)
    draws = [r.asDict() for r in plan.draws.collect()]
    sources = {r["sid"]: r for r in plan.sources.collect()}
    blocks, words, owner = {}, {}, {}
    for d in draws:
        s = sources[d["sid"]]
        at = d["begin"] + d["start"]
        block = (d["sid"], d["pass"], at // s["block"])
        assert (at + d["length"] - 1) // s["block"] == block[2]
        assert owner.setdefault(block, d["shard"]) == d["shard"]
        blocks[block] = blocks.get(block, 0) + d["length"]
        words[d["shard"]] = words.get(d["shard"], 0) + d["length"]
    per_shard = {}
    for block, shard in owner.items():
        per_shard[shard] = per_shard.get(shard, 0) + 1
    size = next(iter(sources.values()))["block"]
    assert len(per_shard) == 1 << tree_levels(sum(words.values()), 2_000) and max(per_shard.values()) - min(per_shard.values()) <= 1
    assert max(blocks.values()) <= size and size == -(-sum(len((t or "").split()) for _, _, t in mixed_rows) // (SHARD_BLOCKS * len(per_shard)))
    # shards differ by a block at most, but for the short blocks at the ends of the streams
    short = sum(size - n for n in blocks.values())
    assert max(words.values()) - min(words.values()) <= size + short
    for sid, s in sources.items():
        assert sum(n for (x, _, _), n in blocks.items() if x == sid) == s["target_words"]
        if s["quota"] > 4_000:  # the share of a source in each shard is that of the whole, about
            shares = [sum(1 for b, o in owner.items() if b[0] == sid and o == shard) / per_shard[shard] for shard in per_shard]
            assert max(shares) - min(shares) < 0.6


def test_mixing_query_against_plain_python(spark, mixed_rows, tmp_path):
    mixed_rows = [(k, s, t) for k, (_, s, t) in enumerate(mixed_rows)]  # one source an id
    docs(spark, mixed_rows).select("doc_id", "source", "text").write.parquet(f"{tmp_path}/documents.parquet")
    out = op5_split_tree_mix(spark, str(tmp_path)).collect()
    sizes, of = {}, {}
    for i, s, t in mixed_rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
        of[i] = s
    want, taken = targets(sizes, (5, 2, 1)), {}
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _, _ in mixed_rows)
    for r in out:
        s = of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and r["taken"] <= 3 * r["size"]
        assert sum(int(x.split(":")[1]) for x in r["shards"].split()) == r["taken"]
        taken[s] = taken.get(s, 0) + r["taken"]
    assert all(abs(want[s] - taken[s]) <= 0.51 for s in sizes)
    assert {x.split(":")[0] for r in out for x in r["shards"].split()} == {"0", "1", "2", "3"}

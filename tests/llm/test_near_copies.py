"""The near-dedup stage of the pipeline: one text of each group of five-word Jaccard similarity 0.8 stays."""

import random

import numpy as np

import corpus_pipeline
from kindred.llm import jaccard


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(zip(*(words[i:] for i in range(5)))) if len(words) >= 5 else frozenset([tuple(words)])


def similar(a, b):
    return 9 * len(a & b) >= 4 * (len(a) + len(b))


def expected(rows):
    """The smallest id of each group, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in sorted(rows)]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if similar(a, b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {top(i) for i in root}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return out


def corpus():
    rng = random.Random(11)
    word = lambda: f"v{rng.randrange(5000)}"
    hot, line, texts = [word() for _ in range(200)], [word() for _ in range(12)], []
    texts += [edited(rng, hot, rng.randrange(9)) for _ in range(120)]
    for _ in range(80):
        own = [word() for _ in range(rng.randrange(3, 150))] + line
        texts += [own, edited(rng, own, rng.randrange(1, 5))]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(1000, None), (1001, ""), (1002, "x y"), (1003, "X  y"), (1004, "x z")]


def test_near_copies_go(spark):
    """Two of 200 words changed: a similarity above 0.9, yet fingerprints of three words lie further apart than two bits."""
    rng = random.Random(1)
    rows = []
    for i in range(20):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows += [(i, " ".join(words)), (100 + i, " ".join(edited(rng, words, 2)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == set(range(20))


def test_groups_by_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int").repartition(3)
    want = expected(rows)
    assert 50 < len(want) < len(rows) - 50
    for rounds, counters, keys in ((1, 1 << 17, 10**6), (0, 1, 0), (2, 64, 10**6)):
        monkeypatch.setattr(jaccard, "ROUNDS", rounds)
        monkeypatch.setattr(jaccard, "COUNTERS", counters)
        monkeypatch.setattr(jaccard, "BROADCAST", keys)
        kept = corpus_pipeline.near_dedup(spark, docs, "")
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == want


def test_documents_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()} == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_similar_sets_share_a_prefix():
    rng = np.random.default_rng(2)
    counters = rng.integers(0, 9, 256)
    for _ in range(500):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 90)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.12], rng.integers(0, 400, rng.integers(0, 6))]))
        if similar(set(a.tolist()), set(b.tolist())):
            assert np.intersect1d(jaccard.prefix(a, counters), jaccard.prefix(b, counters)).size


def test_bitmaps_differ_in_fewer_bits_than_sets():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, rng.integers(1, 400)))
        b = np.concatenate([a[rng.random(len(a)) > 0.1], np.unique(rng.integers(-(2**63), 2**63 - 1, rng.integers(0, 20)))])
        assert np.bitwise_count((jaccard.bitmap(a, 64) ^ jaccard.bitmap(b, 64)).view(np.uint64)).sum() <= len(np.setxor1d(a, b))
        x, y = sorted((jaccard.bitmap(a), jaccard.bitmap(b)), key=len)
        while len(y) > len(x):
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= len(np.setxor1d(a, b))

import itertools
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from kindred.llm import ann, langid

A, B = ["bra", "kel", "dor", "mun"], ["fiy", "zaq", "lox", "wec"]


def text(rng, parts, n):
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    model = langid.CRF(["a", "b", "c"])
    model.move = rng.normal(size=(3, 3))
    lengths = np.array([1, 4, 3])
    emit = rng.normal(size=(4, 3, 3))
    got = model.marginals(emit, lengths)
    for j, n in enumerate(lengths):
        want, total = np.zeros((n, 3)), 0.0
        for path in itertools.product(range(3), repeat=int(n)):
            s = math.exp(sum(emit[t, j, k] for t, k in enumerate(path)) + sum(model.move[x, y] for x, y in zip(path, path[1:])))
            total += s
            for t, k in enumerate(path):
                want[t, k] += s
        assert np.allclose(got[:n, j], want / total)
    node, pair = model._expect(emit, lengths)
    assert np.allclose(node, got) and np.isclose(pair.sum(), 5)
    alone = sum(model._expect(emit[:n, j : j + 1], lengths[j : j + 1])[1] for j, n in enumerate(lengths))
    assert np.allclose(pair, alone)


def test_languages_and_switches(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, A if i % 2 else B, 40), "aa" if i % 2 else "bb") for i in range(200)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 !? 34", "aa"), (903, text(rng, A, 5000), None), (None, rows[1][1], "aa"), (904, rows[1][1], "aa"), (904, rows[1][1], "aa")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int").repartition(3)
    got = langid.label_texts(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 900:
            assert r.lang_pred == ("aa" if r.doc_id % 2 else "bb")
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[903].lang_pred == "aa"
    model = langid.train(langid.learning_sample(docs, "doc_id", "text", "lang"))
    mixed = langid.words_of(text(rng, A, 15)) + langid.words_of(text(rng, B, 15))
    found = langid.Labeller(model).word_marginals([mixed])[0].argmax(axis=1)
    assert (found == [0] * 15 + [1] * 15).mean() > 0.9


def test_every_language_is_learned(spark, monkeypatch):
    """More languages than texts in the sample: each has one, and rows of features are shared."""
    monkeypatch.setattr(langid, "TRAIN_TOTAL", 6)
    monkeypatch.setattr(langid, "WEIGHTS", 1 << 14)
    rng = random.Random(3)
    parts = {f"l{i}": [f"{a}{b}{i}" for a in "bdgk" for b in "aeou"] for i in range(9)}
    parts = {k: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in v] for k, v in parts.items()}
    rows = [(i, text(rng, parts[f"l{i % 9}"], 60), f"l{i % 9}") for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(langid.learning_sample(docs, "doc_id", "text", "lang")["lang"]) == set(parts)
    found = {r.doc_id: r.lang_pred for r in langid.label_texts(docs).collect()}
    assert sum(found[i] == f"l{i % 9}" for i in found) > 0.9 * len(found)


def test_very_long_text(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, A if i % 2 else B, 40), "aa" if i % 2 else "bb") for i in range(60)] + [(99, text(rng, A, 300_000), None)]
    got = {r.doc_id: r.lang_pred for r in langid.label_texts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[99] == "aa"


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.label_texts(docs).first().lang_pred == "und"
    assert langid.label_texts(docs.filter("false")).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.label_texts(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert found.filter("lang = lang_pred").count() >= 0.95 * found.count()


def slow_nearest(rows, k=10):
    usable = {}
    for i, v in rows:
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v) and len(v) == 8:
            usable.setdefault(i, []).append(np.array(v, dtype=float))
    out = []
    for q in usable:
        if q % 10 == 0:
            query = min(usable[q], key=lambda v: v.tolist())
            found = sorted((min(float(np.sqrt(((v - query) ** 2).sum())) for v in vs), i) for i, vs in usable.items() if i != q)
            out += [(q, r + 1, i, round(d, 9)) for r, (d, i) in enumerate(found[:k])]
    return sorted(out)


def test_nearest_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 460)]  # one vector many times: ties
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [None] * 8), (1004, [1.0, 2.0]), (None, rows[0][1]), (20, rows[3][1]), (1005, []), (1006, [float("inf")] * 8)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = ann.nearest(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == slow_nearest(rows)


def test_small_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], schema), F.col("vec_id") % 10 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], schema)
    assert [tuple(r)[:3] for r in ann.nearest(two, F.col("vec_id") % 10 == 0).collect()] == [(0, 1, 1)]


def test_bounds_hold(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("embedding").collect()
    m = np.array([r[0] for r in rows], dtype=float)
    centre, turn = m.mean(axis=0), ann.rotation(m.shape[1])
    codes = ann.Codes.of(m, centre, turn)
    low, high = codes.bounds((m[:40] - centre) @ turn)
    true = ((m[None] - m[:40, None]) ** 2).sum(axis=2)
    assert ((low <= true + 1e-6) & (true <= high + 1e-6)).mean() > 0.999

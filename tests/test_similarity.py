import random

import pytest
from pyspark.sql import functions as F

from kindred.functions import similarity as S


def slow_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_lcs_against_the_table():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randrange(15))) for _ in range(2))
        assert S.one(S.lcs_lengths, a, b) == slow_lcs(a, b)


def test_partial_against_all_windows():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(2))
        def best(p, q):
            n = len(p)
            windows = [q[:k] for k in range(1, n)] + [q[k : k + n] for k in range(len(q) - n + 1)] + [q[-k:] for k in range(1, n)]
            return max(S.one(S.ratios, p, w) for w in windows if w)
        want = max(best(a, b), best(b, a)) if len(a) == len(b) else best(*sorted((a, b), key=len))
        assert S.one(S.partials, a, b) == pytest.approx(want)


def test_jaro_winkler_equals_duckdb(duck):
    rng = random.Random(4)
    assert S.one(S.jaro_winklers, "MARTHA", "MARHTA") == pytest.approx(0.961111, abs=1e-6)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 12))) for _ in range(2))
        assert S.one(S.jaro_winklers, a, b) == pytest.approx(duck.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0], abs=1e-9)


def test_token_scores():
    assert S.one(S.token_sorts, "b a", "a b") == 1.0
    assert S.one(S.token_sets, "a b", "a b c") == 1.0
    assert S.one(S.token_sets, "", "a") == 0.0
    assert 0 < S.one(S.weighteds, "acme corp", "acme corporation") <= 1


def test_empty_sides(spark):
    rows = spark.createDataFrame([("", ""), ("ka", ""), ("acme", "acmecorp"), ("acme", "acne")], "a string, b string")
    found = rows.select(S.scorer("jw")("a", "b").alias("jw"), S.common_prefix(F.col("a"), F.col("b")).alias("p"), S.token_overlap(F.col("a"), F.col("b")).alias("o")).collect()
    assert [r.jw for r in found[:2]] == [1.0, 0.0]
    assert [r.p for r in found] == [0.0, 0.0, 1.0, 0.5]
    assert [r.o for r in found[:2]] == [1.0, 0.0]


def test_many_pairs_score_as_each_alone():
    """Strings of all lengths, also beyond a word's bits, side by side."""
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdeé漢😀 ") for _ in range(rng.choice([0, 1, 3, 9, 40, 63, 64, 65, 130]))).strip() for _ in range(120)]
    a, b = [rng.choice(texts) for _ in range(400)], [rng.choice(texts) for _ in range(400)]
    for i, got in enumerate(S.lcs_lengths(a, b)):
        assert got == slow_lcs(a[i], b[i])
    for score in S.SCORERS.values():
        assert score(a, b).tolist() == [S.one(score, x, y) for x, y in zip(a, b)]

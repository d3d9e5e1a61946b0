import collections
import math
import random

from kindred.llm import quality as Q

BLANK = " \t\n\r\x0b\x0c"


def slow(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines, earlier, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_counts_by_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "é\x1fb c", "x\n\nx\n x"]
    texts += ["".join(rng.choice(["a", "b", "é", "😀", "#", "|", " ", "  ", "\n", "\t", "\x0b", "\x1c"]) for _ in range(rng.randrange(80))) for _ in range(400)]
    for t in texts:
        words, chars, symbols, dup, repeats = Q.counts(t)[:5]
        assert (words, chars, symbols, dup, repeats) == (slow(t) if words else (0, 0, slow(t)[2], 0, 0)), t


def test_binomial_tail_is_exact():
    for n, k, p in [(10, 0, 0.1), (50, 3, 0.04), (500, 2, 0.01), (5, 5, 0.5)]:
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(Q.binomial_tail(k, n, p) - want) < 1e-9


def test_rungs_are_risk_controlled():
    import numpy as np

    risk, good, bad = np.array([0, 10, 20, 30, 40]), np.array([5000, 0, 0, 0, 0]), np.array([0, 0, 0, 100, 200])
    assert Q.choose_rung(risk, good, bad, 0.04, 0.0125) == 30  # the mildest that still catches all bad texts
    good[4] = 100  # 2 % of the good texts: within the limit
    assert Q.choose_rung(risk, good, bad, 0.04, 0.0125) == 30
    good[3] = 150  # 5 % at or above 30
    assert Q.choose_rung(risk, good, bad, 0.04, 0.0125) == 40
    good[4] = 300
    assert Q.choose_rung(risk, good, bad, 0.04, 0.0125) is None
    assert Q.choose_rung(risk, np.zeros(5, int), bad, 0.04, 0.0125) is None
    few = np.zeros(5, int)
    few[0] = 100  # even without a rejected text, 107 do not tell 4 % from less at this confidence
    assert Q.choose_rung(risk, few, bad, 0.04, 0.0125) is None
    few[0] = 108
    assert Q.choose_rung(risk, few, bad, 0.04, 0.0125) == 30


def test_the_bound_holds_in_simulation():
    """The share of holdouts that certify a rung whose true false rejection exceeds the limit stays below delta."""
    import numpy as np

    rng = np.random.default_rng(4)
    risk, bad = np.arange(40), np.arange(40) * 10
    weights = np.linspace(1, 0.02, 40)
    weights /= weights.sum()
    true = weights[::-1].cumsum()[::-1]  # true share of good texts at or above each risk
    wrong = useful = 0
    for _ in range(2000):
        found = Q.choose_rung(risk, rng.multinomial(300, weights), bad, 0.04, 0.0125)
        useful += found is not None
        wrong += found is not None and true[found] > 0.04
    assert wrong / 2000 <= 0.0125 + 0.005 and useful > 1000


def test_ladder_by_definition():
    import numpy as np

    rng = np.random.default_rng(5)
    rest = rng.integers(0, 9, Q.GRID + 2)
    bad = rng.integers(0, rest + 1)
    got = Q.ladder(rest, bad).tolist()
    share = [int(bad[s:].sum()) * 1_000_000 // max(int(rest[s:].sum()), 1) for s in range(Q.GRID + 2)]
    assert got == [max(share[: s + 1]) for s in range(Q.GRID + 2)]


def test_labelled_bad_texts_go(spark):
    """On the smallest tables with labels enough, the method rejects what the base limits do not."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = Q.quality_report(docs, labels).join(labels, "doc_id").filter("not base_failed").groupBy("quality", "kept").count().collect()
    by = {(r.quality, r.kept): r["count"] for r in found}
    assert by.get((0, False), 0) >= 20 and by.get((1, False), 0) <= Q.ALPHA * by[(1, True)]


def test_very_long_text_and_ties(spark):
    long = " ".join(f"w{i}" for i in range(400_000))
    docs = spark.createDataFrame([(1, long, "en"), (1, long, "en"), (2, "x\n" * 100_000, None)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id, r.n_words, r.n_dup_lines, r.kept) for r in Q.quality_report(docs, none).collect())
    assert got == [(1, 400_000, 0, True), (1, 400_000, 0, True), (2, 100_000, 99_999, False)]


def corpus(n=3000):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(80)]
        bad = i % 6 == 0
        rows.append((i, ("| ".join(words) + " |" if bad else " ".join(words)), "en"))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_bad_texts_go_and_good_ones_stay(spark):
    rows, labels = corpus()
    rows += [(9000, None, None), (9001, "", "en"), (9002, "a b c " * 40, "en"), (9003, rows[1][1], "xx"), (1, rows[1][1], "en")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, n_words int")
    marks = spark.createDataFrame(labels + [(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    found = Q.quality_report(docs, marks).collect()
    assert len(found) == len(rows)
    kept = collections.Counter((r.doc_id % 6 == 0, r.kept) for r in found if r.doc_id < 9000)
    assert kept[(True, True)] == 0 and kept[(False, False)] == 0
    by = {r.doc_id: r for r in found}
    assert by[9000].base_failed and by[9001].base_failed and by[9002].base_failed and by[9003].kept
    clean = Q.keep_good(docs, marks)
    assert clean.columns == docs.columns and clean.count() == sum(r.kept for r in found)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "w " * 60, "en"), (2, " ".join(f"w{i}|" for i in range(60)), "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.kept for r in Q.quality_report(docs, none).collect()} == {1: False, 2: True}
    assert Q.quality_report(docs.filter("false"), none).count() == 0
    assert Q.keep_good(docs.filter("false"), none).count() == 0

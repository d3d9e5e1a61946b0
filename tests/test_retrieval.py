"""n-gram retrieval: brute force, copies weighed once, no join of the grams of all pairs."""

import math
import pickle
import random
from collections import Counter, defaultdict

import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from kindred.operators import retrieval
from kindred.plans import registry
from kindred.sources.adapters import part_truth

SCHEMA = "source int, entity_id string, text string"
TEXTS = [f"{a} {b}" for a in ("12 brand", "7 brand", "acme tools", "zebra") for b in ("00045", "00046", "rd 1", "rd", "ab", "00045 00045")] + ["xy", "", None, "acme tools 00045 brand rd"]


def rows_of(copies):
    """Copies of every text in three registries; ids do not follow the texts."""
    found = []
    for c in range(copies):
        for i, text in enumerate(TEXTS):
            found += [(s, f"S{s}-{(i * 7 + c * 13) % 29}{c}{i}", text) for s in (1, 2, 3)]
    return [*found, (1, "S1-two", "12 brand"), (1, "S1-two", "zebra rd"), (2, "S2-two", "zebra rd"), (2, "S2-two", "12 brand")]


def brute(rows, k, sublinear):
    def counts(source):
        out = defaultdict(Counter)
        for s, i, t in rows:
            if source(s) and t:
                out[i].update(t[j : j + n] for n in (3, 4, 5) for j in range(len(t) - n + 1))
        return out

    queries, targets = counts(lambda s: s == 1), counts(lambda s: s > 1)
    df = Counter(g for c in targets.values() for g in c)
    n = sum(s > 1 for s, _, _ in rows)

    def weigh(c):
        raw = {g: (1 + math.log(tf) if sublinear else tf) * (math.log((1 + n) / (1 + df[g])) + 1) for g, tf in c.items() if df[g] >= 2}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {g: x / norm for g, x in raw.items()}

    right = {i: weigh(c) for i, c in targets.items()}
    want = set()
    for q, c in queries.items():
        left = weigh(c)
        scored = sorted((-round(sum(x * w.get(g, 0.0) for g, x in left.items()), 9), i) for i, w in right.items())
        want |= {(q, i, -s) for s, i in scored[:k] if s < 0}
    return want


@pytest.mark.parametrize("k, copies, sizes", [(5, 1, (3, 4, 2)), (7, 4, (8192, 16_384, 64)), (3, 2, (8, 5, 3)), (100, 3, (10, 16_384, 4))])
def test_against_brute_force(spark, monkeypatch, k, copies, sizes):
    for name, value in zip(("QUERY_TEXTS", "TARGET_TEXTS", "SIDE"), sizes):
        monkeypatch.setattr(retrieval, name, value)
    rows = rows_of(copies)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", sizes[1])
    try:
        for sublinear in (False, True):
            got = [tuple(r) for r in retrieval.tfidf_top(spark.createDataFrame(rows, SCHEMA), F.lit(True), "text", sublinear, k).collect()]
            assert len(got) == len(set(got)) and set(got) == brute(rows, k, sublinear)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_sides(spark):
    rows = rows_of(1)
    for some in ([r for r in rows if r[0] == 1], [r for r in rows if r[0] > 1], []):
        assert retrieval.tfidf_top(spark.createDataFrame(some, SCHEMA), F.lit(True), "text").count() == 0


def test_copies_are_scored_once(spark, monkeypatch):
    """with few names, pairs of texts do not grow with the records."""
    seen, top = [], retrieval.sparse_top
    monkeypatch.setattr(retrieval, "sparse_top", lambda q, t, k=100: seen.extend(x.select("id").distinct().count() for x in (q, t)) or top(q, t, k))
    rows = [(s, f"S{s}-{i}", ("large ring", "old plate", "hot bolt")[i % 3]) for s in (1, 2, 3) for i in range(60)]
    found = retrieval.tfidf_top(spark.createDataFrame(rows, SCHEMA), F.lit(True), "text", k=10)
    assert found.count() == 600
    assert seen == [3, 3]


def test_grams_of_queries_and_targets_do_not_meet_in_a_join(spark, sf_dir):
    """a row for each pair and shared gram is what took too long on addresses."""
    plan = registry.queries()["tfidf_topk_addr"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "gram#" not in plan.replace("terms", "")


def test_grams_of_all_texts_are_no_rows(spark, monkeypatch):
    """with a new text in every record, a row for each text and gram is what takes most of the time."""

    def listed(*_, **__):
        raise AssertionError("the grams of all texts as rows")

    monkeypatch.setattr(retrieval, "grams", listed)
    monkeypatch.setattr(retrieval, "HELD_GRAMS", 20, raising=False)
    rows = [(1 + i % 3, f"S-{i:03}", f"{i * 7919 % 1000} road {i % 17}") for i in range(200)]
    got = [tuple(r) for r in retrieval.tfidf_top(spark.createDataFrame(rows, SCHEMA), F.lit(True), "text", True, 4).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 4, True)


def test_vectors_pass_the_driver_in_blocks_of_bounded_size(spark, monkeypatch):
    """a block of so many texts takes the more of the driver's memory, the longer they are."""
    sizes, send = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sizes.append(len(pickle.dumps(value))) or send(self, value))
    letters = random.Random(2)
    texts = ["".join(letters.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)) for _ in range(120)]
    rows = [(s, f"S{s}-{i:03}", text) for i, text in enumerate(texts) for s in (1, 2, 3)]
    best = retrieval.tfidf_top(spark.createDataFrame(rows, SCHEMA).repartition(8), F.lit(True), "text", k=2).collect()
    assert {tuple(r) for r in best} == {(f"S1-{i:03}", f"S{s}-{i:03}", 1.0) for i in range(120) for s in (2, 3)}
    assert sum(sizes) > 16_000_000 > max(sizes)


def test_lists_of_the_queries_only(spark, sf_dir):
    """lists of other records are not made."""
    asked = F.col("p_partkey") % 20 == 0
    every = {tuple(r) for r in part_truth(spark, sf_dir).collect()}
    some = {tuple(r) for r in part_truth(spark, sf_dir, asked).collect()}
    assert some == {r for r in every if int(r[0].split("-")[1]) % 20 == 0} and 0 < len(some) < len(every)

"""Every query with an oracle against DuckDB; the others for rows and a stable schema."""

import pytest

from kindred.operators.features import ORDER
from kindred.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracles()


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(plain(row[i]) for i in at) for row in found.fetchall()), key=str)
    assert sorted((tuple(plain(row[c]) for c in columns) for row in got.collect()), key=str) == want


LARGER = "/root/testdata/sf0.01"


def test_queries_without_oracle():
    assert set(QUERIES) - set(ORACLES) == {"train_gbt", "score_pairs", "predict_matches"}


def test_importances_of_the_trained_model(spark):
    rows = {r.feature: r.importance for r in QUERIES["train_gbt"](spark, LARGER).collect()}
    assert set(rows) == set(ORDER) and abs(sum(rows.values()) - 1) < 1e-6 and min(rows.values()) >= 0


def test_scores_tell_matches_from_others(spark):
    rows = QUERIES["score_pairs"](spark, LARGER).collect()
    pairs = {(r.s1_id, r.matched_id): r.label for r in QUERIES["training_set"](spark, LARGER).collect()}
    assert {(r.s1_id, r.matched_id): r.label for r in rows} == pairs and all(0 <= r.score <= 1 for r in rows)
    good, bad = ([r.score for r in rows if r.label == k] for k in (1, 0))
    better = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert better > 0.85


def test_predictions_are_one_list_an_entity(spark):
    rows = {r.source1_entity_id: set(filter(None, r.matched_entity_ids.split(","))) for r in QUERIES["predict_matches"](spark, LARGER).collect()}
    entities = {r.entity_id for r in QUERIES["scan_tsv"](spark, LARGER).filter("entity_id like 'S1-%'").collect()}
    assert set(rows) == entities
    truth = {(r.s1_id, r.matched_id) for r in QUERIES["training_set"](spark, LARGER).filter("label = 1").collect()}
    found = {(i, m) for i, ids in rows.items() for m in ids}
    assert len(found & truth) > 0.6 * len(truth) and len(found & truth) > 0.8 * len(found)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0

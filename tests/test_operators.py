from pyspark.sql import functions as F

from kindred.functions import similarity as S
from kindred.functions.normalize import normalize_records
from kindred.operators import blocking, features, labels, measure, retrieval, validate
from kindred.sources import records as R


def registry(spark, rows):
    df = spark.createDataFrame(rows, "source int, entity_id string, business_name string, business_address string, country string")
    return normalize_records(df)


def test_caps_and_null_country(spark):
    rows = [(1, "S1-0", "Acme", "", "US"), (1, "S1-9", "Acme", "", None)]
    rows += [(2, f"S2-{i}", "Acme", "", "US") for i in range(500)] + [(3, f"S3-{i}", "Acme", "", "US") for i in range(501)]
    pairs = blocking.candidates(registry(spark, rows), ["exact_name"])
    assert pairs.count() == 500
    assert pairs.filter(F.col("matched_id").startswith("S3-")).count() == 0
    fallback = blocking.candidates(registry(spark, rows[:2] + rows[2:103]), ["sorted_name"])
    assert fallback.count() == 0


def test_empty_parts_form_blocks(spark):
    rows = [(1, "S1-0", None, None, "US"), (2, "S2-0", None, None, "US")]
    assert blocking.candidates(registry(spark, rows)).count() == 1
    assert blocking.candidates(registry(spark, rows), require_parts=True).count() == 0


def test_pairs_appear_once(spark):
    rows = [(1, "S1-0", "Acme Tools", "5 Main Road 12345", "US"), (2, "S2-0", "Acme Tools", "5 Main Road 12345", "US")]
    found = registry(spark, rows)
    assert blocking.rule_pairs(blocking.keyed(found)).count() == 12
    assert blocking.candidates(found).count() == 1


def test_truth_and_sources(spark):
    truth = spark.createDataFrame([("S1-1", None), ("S1-2", "S2-1"), ("S1-3", "S2-1,S3-2,S2-1"), ("S1-4", "")], "source1_entity_id string, matched_entity_ids string")
    assert labels.truth_pairs(truth).count() == 3
    pairs = spark.createDataFrame([("S1-2", "S2-1"), ("S1-2", "X-1")], "s1_id string, matched_id string")
    found = {r.matched_id: (r.source, r.label) for r in labels.label(pairs, truth).collect()}
    assert found == {"S2-1": ("s2", 1), "X-1": ("unknown", 0)}


def test_negatives_are_capped(spark):
    rows = [("S1-1", f"S2-{i}", "s2", 0) for i in range(9)] + [("S1-1", "S3-1", "s3", 0)]
    found = labels.top_negatives(spark.createDataFrame(rows, "s1_id string, matched_id string, source string, label int"))
    assert found.count() == 4


def test_features_null_country_and_order(spark):
    rows = [(1, "S1-0", "Acme Tools", "5 Main Road 12345 Springfield", None), (2, "S2-0", "Acme Tools", "5 Main Road 12345 Springfield", None)]
    pairs = spark.createDataFrame([("S1-0", "S2-0"), ("S1-0", "S2-404")], "s1_id string, matched_id string")
    found = features.all_features(pairs, registry(spark, rows))
    assert found.columns[2:] == list(features.ORDER) and len(features.ORDER) == 37
    row = found.collect()
    assert len(row) == 1 and row[0].country_match == 1.0 and row[0].name_jw == 1.0 and row[0].name_and_addr_strong == 1.0


def test_thresholds(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.9, 1), (0.2, 0)], "score double, label int")
    best = measure.best_threshold(measure.threshold_table(scored)).first()
    assert best.step == 16 and best.f05 == 1.0
    none = measure.threshold_table(spark.createDataFrame([(0.0, 1)], "score double, label int")).collect()
    assert all(r.f05 == 0.0 for r in none) and len(none) == 91


def test_fuzzy_against_brute_force(spark):
    names = ["acme tools", "acme tool", "zebra", "acme", "tools acme ltd", ""]
    rows = [(1, f"S1-{i}", n, "", "US", i) for i, n in enumerate(names)] + [(2 + i % 2, f"S{2 + i % 2}-{i}", n, "", "US", i) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "source int, entity_id string, business_name string, business_address string, country string, k int")
    got = {(r.s1_id, r.matched_id, r.score) for r in retrieval.fuzzy_top(df, F.lit(True), F.col("business_name"), k=3).collect()}
    want = set()
    for i, a in enumerate(names):
        if a:
            found = sorted((-round(100 * S.one(S.weighteds, a, b), 6), f"S{2 + j % 2}-{j}") for j, b in enumerate(names) if b)
            want |= {(f"S1-{i}", m, -s) for s, m in found[:3] if -s >= 45}
    assert got == want


def test_result_files(spark, tmp_path):
    pairs = spark.createDataFrame([("S1-1", "S3-2"), ("S1-1", "S2-1")], "s1_id string, matched_id string")
    entities = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    path = f"file://{tmp_path}/out"
    R.write_result_lists(validate.result_lists(pairs, entities), path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["S1-1\tS2-1,S3-2", "S1-2\t", "source1_entity_id\tmatched_entity_ids"]
    back = R.read_result_lists(spark, path)
    assert validate.summary(back, entities).count() == 0
    assert R.read_ids(spark, path).count() == 2


def test_tsv_null_tokens(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNULL\tNone\tnull\nS1-2\t\ta \"b\" c\tUS\n")
    rows = {r.entity_id: r for r in R.read_tsv(spark, f"file://{tmp_path}/a.tsv").collect()}
    assert rows["S1-1"][1:] == (None, None, None)
    assert rows["S1-2"].business_name is None and rows["S1-2"].country == "US"


def test_header_checks():
    want = ["source1_entity_id", "matched_entity_ids"]
    assert validate.header_problems("Source1_entity_id\tmatched_entity_ids \n", want) == []
    assert validate.header_problems("", want) == ["the file is empty"]
    assert "commas" in validate.header_problems("a,b", want)[0]
    assert validate.header_problems("a\tb", want)

"""One query for each operator of the linkage engine, over whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import keys as K
from kindred.functions import normalize as N
from kindred.operators import blocking, features, labels, measure, model, retrieval, validate
from kindred.sources.adapters import indic_names, normalized_parts, part_records, part_truth, table
from kindred.sources.records import RECORD, read_ids, read_result_lists, read_tsv, read_tsv_filled, write_result_lists
from kindred.sources.scratch import cached_path, cached_stage, new_folder

#: Searches take every record of the first registry whose part number is divisible by this as a query.
QUERY_EVERY = 20


def is_query() -> Column:
    return F.col("p_partkey") % QUERY_EVERY == 0


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# ---- documents: normalisation over whole texts ----


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _normalized_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.with_normalized(_docs(spark, sf_dir), {"n": "text"}).select("doc_id", "text", "n")


def _doc_value(make, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized_docs(spark, sf_dir).select("doc_id", make().alias("value"))


def norm_fold(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", N.fold(F.col("text")).alias("value"))


def norm_translit(spark, sf_dir):
    """The Indic path, forced on every text."""
    return _docs(spark, sf_dir).select("doc_id", N.indic_normalize(F.col("text")).alias("value"))


def norm_indic(spark, sf_dir):
    return N.with_normalized(indic_names(spark), {"value": "name"}).select("id", "value")


def token_dedup(spark, sf_dir):
    return N.with_dedup(_normalized_docs(spark, sf_dir), "value", "n").select("doc_id", "value")


def name_core(spark, sf_dir):
    return N.with_name_core(_normalized_docs(spark, sf_dir), "value", "n").select("doc_id", "value")


def num_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(N.num_tokens(N.fold(F.col("text")))), ",").alias("value"))


def clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", N.clean(F.col("text")).alias("value"))


def informative_tokens(spark, sf_dir):
    return _normalized_docs(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(K.informative_tokens(N.addr_core(F.col("n")))), " ").alias("value"))


# ---- parts as three registries ----


def normalize_records(spark, sf_dir):
    return normalized_parts(spark, sf_dir).select("source", "entity_id", "country", "business_name", "business_address", "n_core", "n_ph", "n_sk", "a_core")


def _key(make, spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized_parts(spark, sf_dir).select("entity_id", *make())


def scan_tsv(spark, sf_dir):
    """Records written as a registry file in the shared folder and read back."""
    path = new_folder(spark, "registry")
    part_records(spark, sf_dir).select("entity_id", "business_name", "business_address", "country").write.option("sep", "\t").option("header", True).csv(path)
    return read_tsv(spark, path)


def scan_filled(spark, sf_dir):
    """The same with some countries missing, read with empty strings in their place."""
    path = new_folder(spark, "registry")
    some = F.when(F.col("p_partkey") % 10 != 0, F.col("country")).alias("country")
    part_records(spark, sf_dir).select("entity_id", "business_name", "business_address", some).write.option("sep", "\t").option("header", True).csv(path)
    return read_tsv_filled(spark, path, RECORD)


def scan_ids(spark, sf_dir):
    path = new_folder(spark, "ids")
    part_records(spark, sf_dir).select("entity_id", "business_name").write.option("sep", "\t").option("header", True).csv(path)
    return read_ids(spark, path)


def scan_project(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name")


def count_rows(spark, sf_dir):
    return table(spark, sf_dir, "part").agg(F.count("*").alias("n_rows"))


def filter_prefix(spark, sf_dir):
    return part_records(spark, sf_dir).filter(F.col("entity_id").startswith("S2-")).select("entity_id", "business_name")


def derive_source(spark, sf_dir):
    return part_records(spark, sf_dir).select("entity_id", labels.source_of(F.col("entity_id")).alias("registry"))


def limit_head(spark, sf_dir):
    return part_records(spark, sf_dir).orderBy("entity_id").limit(100).select("entity_id", "business_name")


def _block(rule: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.candidates(normalized_parts(spark, sf_dir), [rule])


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.keyed(normalized_parts(spark, sf_dir))


def block_sizes(spark, sf_dir):
    return _keys(spark, sf_dir).groupBy("source", "rule", "key").agg(F.count("*").alias("n"))


def block_cap(spark, sf_dir):
    return blocking.within_cap(blocking.block_sizes(_keys(spark, sf_dir))).select("rule", "key", "target", "n_left", "n_right")


def candidates_all(spark, sf_dir):
    return cached_stage(spark, sf_dir, "candidates", lambda: blocking.candidates(normalized_parts(spark, sf_dir)))


def distinct_pairs(spark, sf_dir):
    pairs = blocking.rule_pairs(_keys(spark, sf_dir))
    return pairs.groupBy("rule").agg(F.count("*").alias("pairs"), F.count_distinct("s1_id", "matched_id").alias("distinct_pairs"))


def union_all(spark, sf_dir):
    rec = part_records(spark, sf_dir).select("source", "entity_id", "country")
    return rec.filter("source = 2").unionByName(rec.filter("source = 3"))


def gt_pairs(spark, sf_dir):
    return labels.truth_pairs(part_truth(spark, sf_dir)).select("s1_id", "matched_id", F.col("is_positive").cast("int").alias("is_positive"))


def gt_semi_join(spark, sf_dir):
    """Lists of records that are no queries are left out before they are made, and so before they are taken apart."""
    asked = part_records(spark, sf_dir).filter((F.col("source") == 1) & is_query()).select(F.col("entity_id").alias("source1_entity_id"))
    lists = part_truth(spark, sf_dir, is_query()).join(asked, "source1_entity_id", "left_semi")
    return labels.truth_pairs(lists).select("s1_id", "matched_id")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label(candidates_all(spark, sf_dir), part_truth(spark, sf_dir))


def _plain(df: DataFrame) -> DataFrame:
    return df.select("s1_id", "matched_id", "source", F.col("label").cast("int").alias("label"))


def label_pairs(spark, sf_dir):
    return _plain(_labelled(spark, sf_dir))


def sort_labeled(spark, sf_dir):
    return label_pairs(spark, sf_dir).orderBy(F.asc("s1_id"), F.asc("source"), F.desc("label"), F.asc("matched_id"))


def negative_sample(spark, sf_dir):
    return _plain(labels.sample_negatives(_labelled(spark, sf_dir)))


def topk_negatives(spark, sf_dir):
    return _plain(labels.top_negatives(_labelled(spark, sf_dir)))


def training_set(spark, sf_dir):
    return cached_stage(spark, sf_dir, "training", lambda: _plain(labels.training_set(_labelled(spark, sf_dir))))


def proportional_sample(spark, sf_dir):
    rows = part_records(spark, sf_dir).select("country", "entity_id")
    return labels.proportional_sample(rows, "country", ["entity_id"], 500)


def train_val_split(spark, sf_dir):
    return labels.train_validation_split(training_set(spark, sf_dir)).select("s1_id", "matched_id", F.col("is_validation").cast("int").alias("is_validation"))


def class_balance(spark, sf_dir):
    return _rounded(measure.class_balance(training_set(spark, sf_dir)), "scale_pos_weight")


def missing_positives(spark, sf_dir):
    return measure.missing(gt_pairs(spark, sf_dir), candidates_all(spark, sf_dir))


def candidate_recall(spark, sf_dir):
    return _rounded(measure.recall(gt_pairs(spark, sf_dir), candidates_all(spark, sf_dir)), "recall")


def enrich_pairs(spark, sf_dir):
    return measure.enrich(gt_pairs(spark, sf_dir), normalized_parts(spark, sf_dir))


def signal_coverage(spark, sf_dir):
    return _rounded(measure.signal_coverage(gt_pairs(spark, sf_dir), normalized_parts(spark, sf_dir)), "coverage")


def block_size_sweep(spark, sf_dir):
    return measure.block_sweep(normalized_parts(spark, sf_dir))


# ---- retrieval ----


def addr_index(spark, sf_dir):
    return retrieval.address_index(normalized_parts(spark, sf_dir))


def addr_token_hits(spark, sf_dir):
    return retrieval.address_hits(normalized_parts(spark, sf_dir))


def addr_token_overlap(spark, sf_dir):
    return retrieval.address_overlap(normalized_parts(spark, sf_dir))


def addr_topk(spark, sf_dir):
    return retrieval.address_top(normalized_parts(spark, sf_dir))


def addr_overlap2(spark, sf_dir):
    pairs = measure.enrich(gt_pairs(spark, sf_dir), normalized_parts(spark, sf_dir))
    shared = F.size(F.array_intersect(K.long_tokens(F.col("business_address")), K.long_tokens(F.col("business_address_r"))))
    return pairs.select("s1_id", "matched_id", shared.cast("long").alias("shared")).filter("shared >= 2")


def _target_counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    targets = normalized_parts(spark, sf_dir).filter("source > 1").select("entity_id", "n_core")
    return retrieval.grams(targets, "entity_id", "n_core"), targets.count()


def tfidf_fit(spark, sf_dir):
    return _rounded(retrieval.fit(*_target_counts(spark, sf_dir)), "idf")


def tfidf_sublinear(spark, sf_dir):
    counts, n = _target_counts(spark, sf_dir)
    return _rounded(retrieval.weigh(counts, retrieval.fit(counts, n), sublinear=True), "w")


def tfidf_topk(spark, sf_dir):
    return _rounded(retrieval.tfidf_top(normalized_parts(spark, sf_dir), is_query(), "n_core"), "score")


def tfidf_topk_addr(spark, sf_dir):
    return _rounded(retrieval.tfidf_top(normalized_parts(spark, sf_dir), is_query(), "a_core", sublinear=True), "score")


def fuzzy_topk(spark, sf_dir):
    return retrieval.fuzzy_top(part_records(spark, sf_dir), is_query(), N.clean(F.col("business_name")))


def retrieval_recall(spark, sf_dir):
    return _rounded(measure.recall(gt_semi_join(spark, sf_dir), tfidf_topk_addr(spark, sf_dir)), "recall")


# ---- features, model, results ----


def _feature_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set(spark, sf_dir)


def pair_features_native(spark, sf_dir):
    return _rounded(features.native_features(_feature_pairs(spark, sf_dir), normalized_parts(spark, sf_dir)), *features.NATIVE)


def pair_features_jw(spark, sf_dir):
    return _rounded(features.jaro_winkler_features(_feature_pairs(spark, sf_dir), normalized_parts(spark, sf_dir)), *features.JARO_WINKLER)


def pair_features_fuzzy(spark, sf_dir):
    return _rounded(features.fuzzy_features(_feature_pairs(spark, sf_dir), normalized_parts(spark, sf_dir)), *features.FUZZY)


def pair_features_all(spark, sf_dir):
    return _rounded(features.all_features(_feature_pairs(spark, sf_dir), normalized_parts(spark, sf_dir)), *features.ORDER)


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labels.train_validation_split(training_set(spark, sf_dir))
    return cached_stage(spark, sf_dir, "features", lambda: features.all_features(rows, normalized_parts(spark, sf_dir), keep=("label", "is_validation")))


def _model(spark: SparkSession, sf_dir: str):
    """The trained model and its threshold, saved on first use and loaded."""

    def train(path: str) -> None:
        rows = _feature_table(spark, sf_dir)
        trained = model.train(rows)
        model.save(trained, model.choose_threshold(model.score(trained, rows.filter("is_validation"))), path)

    return model.load(cached_path(spark, sf_dir, "model", train))


def train_gbt(spark, sf_dir):
    """The importance that the trained trees give each feature."""
    trees = _model(spark, sf_dir)[0].stages[1]
    found = [(name, float(trees.featureImportances[i])) for i, name in enumerate(features.ORDER)]
    return spark.createDataFrame(found, "feature string, importance double")


def score_pairs(spark, sf_dir):
    scored = model.score(_model(spark, sf_dir)[0], _feature_table(spark, sf_dir))
    return scored.select("s1_id", "matched_id", F.col("label").cast("int").alias("label"), F.round("score", 6).alias("score"))


def predict_matches(spark, sf_dir):
    trained, threshold = _model(spark, sf_dir)
    return validate.result_lists(model.accept(model.score(trained, _feature_table(spark, sf_dir)), threshold), _entities(spark, sf_dir))


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_records(spark, sf_dir).filter("source = 1").select(F.col("entity_id").alias("s1_id"))


def _proxy_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs with a score that needs no model: the share of name and address tokens in common."""
    rows = training_set(spark, sf_dir)
    found = features.native_features(rows, normalized_parts(spark, sf_dir)).select("s1_id", "matched_id", F.round((F.col("name_common_tokens").cast("double") + F.col("addr_common_tokens").cast("double")) / 2, 6).alias("score"))
    return rows.join(found, ["s1_id", "matched_id"])


def threshold_sweep(spark, sf_dir):
    return _rounded(measure.threshold_table(_proxy_scores(spark, sf_dir)), "threshold", "precision", "recall", "f05")


def macro_f05(spark, sf_dir):
    accepted = _proxy_scores(spark, sf_dir).filter("score >= 0.7")
    return _rounded(measure.macro_f05(accepted, gt_pairs(spark, sf_dir), _entities(spark, sf_dir)), "macro_f05")


def result_lists(spark, sf_dir):
    return validate.result_lists(blocking.candidates(normalized_parts(spark, sf_dir), ["name_postal"]), _entities(spark, sf_dir))


def result_file(spark, sf_dir):
    """The lists written as the one output file and read back."""
    path = new_folder(spark, "results")
    write_result_lists(result_lists(spark, sf_dir), path)
    return read_result_lists(spark, path)


def validate_rows(spark, sf_dir):
    """Lines of a written file that do not have two fields: every seventh part adds a third."""
    path = new_folder(spark, "lines")
    more = F.when(F.col("p_partkey") % 7 == 0, F.lit("\t")).otherwise(F.lit(""))
    part_records(spark, sf_dir).select(F.concat("entity_id", F.lit("\t"), "country", more).alias("value")).write.text(path)
    return validate.malformed_rows(spark.read.text(path))


def _flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lists with planted faults: a row twice, an id twice, wrong prefixes, rows gone."""
    lists = validate.result_lists(blocking.candidates(normalized_parts(spark, sf_dir), ["addr_sig", "name_postal"]), _entities(spark, sf_dir))
    number = F.split("source1_entity_id", "-")[1].cast("long")
    ids = F.col("matched_entity_ids")
    bad = F.when(number % 30 == 0, F.concat(ids, F.lit(",S1-0"))).when(number % 42 == 0, F.concat(ids, F.lit(",X-1"))).when((number % 21 == 0) & (ids != ""), F.concat(ids, F.lit(","), ids)).otherwise(ids)
    lists = lists.withColumn("matched_entity_ids", bad).filter(number % 33 != 0)
    return lists.unionByName(lists.filter(number % 39 == 0))


def validate_missing(spark, sf_dir):
    return validate.coverage(_flawed(spark, sf_dir), _entities(spark, sf_dir))


def validate_dupes(spark, sf_dir):
    return validate.duplicate_rows(_flawed(spark, sf_dir))


def validate_repeats(spark, sf_dir):
    return validate.duplicate_ids(_flawed(spark, sf_dir)).distinct()


def validate_prefix(spark, sf_dir):
    return validate.wrong_prefixes(_flawed(spark, sf_dir)).distinct()


def validate_unknown(spark, sf_dir):
    return validate.unknown_ids(_flawed(spark, sf_dir), part_records(spark, sf_dir)).distinct()


def validate_subset(spark, sf_dir):
    narrow = validate.result_lists(blocking.candidates(normalized_parts(spark, sf_dir), ["name_postal"]), _entities(spark, sf_dir), "candidate_entity_ids")
    return validate.not_candidates(_flawed(spark, sf_dir), narrow).distinct()


def validate_summary(spark, sf_dir):
    narrow = validate.result_lists(blocking.candidates(normalized_parts(spark, sf_dir), ["name_postal"]), _entities(spark, sf_dir), "candidate_entity_ids")
    return validate.summary(_flawed(spark, sf_dir), _entities(spark, sf_dir), part_records(spark, sf_dir), narrow)


def validate_counts(spark, sf_dir):
    return validate.counts(_flawed(spark, sf_dir))


_TEXT = {"normalize": lambda: F.col("n"), "addr_core": lambda: N.addr_core(F.col("n")), "skeleton": lambda: N.skeleton(F.col("n")), "phonetic": lambda: N.phonetic(F.col("n"))}

_ADDRESS = "business_address"
_KEYS = {
    "key_postal_last": lambda: [K.postal_last(F.col(_ADDRESS)).alias("k")],
    "key_street_lead": lambda: [K.street_lead(F.col(_ADDRESS)).alias("k")],
    "key_first_last": lambda: [K.first_token(F.col("n_core")).alias("first"), K.last_token(F.col("n_core")).alias("last")],
    "key_sorted_name": lambda: [K.sorted_name(F.col("n_core")).alias("k")],
    "key_addr_sig": lambda: [K.addr_sig(F.col(_ADDRESS)).alias("k")],
    "key_num_any": lambda: [K.num_any(F.col(_ADDRESS)).alias("k")],
    "key_postal_56": lambda: [K.postal_56(F.col(_ADDRESS)).alias("k")],
    "key_postal_feat": lambda: [K.postal_feature(F.col(_ADDRESS)).alias("k")],
    "key_prefixes": lambda: [K.prefix(F.col("n_core"), 4).alias("p4"), K.prefix(F.col("n_core"), 6).alias("p6"), K.address_key(F.col("a_core")).alias("address")],
    "addr_city_state": lambda: [K.city(F.col("a_core")).alias("city"), K.state(F.col("a_core")).alias("state"), K.street_name(F.col("a_core")).alias("street")],
    "acronym": lambda: [K.acronym(F.col("n_core")).alias("acronym"), K.squashed(F.col("n_core")).alias("squashed"), K.token_count(F.col("n_core")).cast("long").alias("n_tok")],
}

_PLAIN = (
    norm_fold, norm_translit, norm_indic, token_dedup, name_core, num_tokens, clean_text, informative_tokens, normalize_records, scan_tsv, scan_filled, scan_ids, scan_project, count_rows,
    filter_prefix, derive_source, limit_head, block_sizes, block_cap, candidates_all, distinct_pairs, union_all, gt_pairs, gt_semi_join,
    label_pairs, sort_labeled, negative_sample, topk_negatives, training_set, proportional_sample, train_val_split, class_balance,
    missing_positives, candidate_recall, enrich_pairs, signal_coverage, block_size_sweep, addr_index, addr_token_hits, addr_token_overlap,
    addr_topk, addr_overlap2, tfidf_fit, tfidf_sublinear, tfidf_topk, tfidf_topk_addr, fuzzy_topk, retrieval_recall, pair_features_native,
    pair_features_jw, pair_features_fuzzy, pair_features_all, train_gbt, score_pairs, predict_matches, threshold_sweep, macro_f05,
    result_lists, result_file, validate_rows, validate_summary, validate_missing, validate_dupes, validate_repeats, validate_prefix, validate_unknown, validate_subset, validate_counts,
)

def queries() -> dict:
    found = {f.__name__: f for f in _PLAIN}
    found |= {name: partial(_doc_value, make) for name, make in _TEXT.items()}
    found |= {name: partial(_key, make) for name, make in _KEYS.items()}
    found |= {f"block_{rule}": partial(_block, rule) for rule in blocking.RULES}
    return found

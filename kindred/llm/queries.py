"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kindred.llm import oracles


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.pfor import token_file_digests

    return token_file_digests(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.bpe_tree import encode_decode

    return encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.quality import quality_report

    return quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.substring import passage_report

    return passage_report(_table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op6_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.pii import report

    return report(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.licenses import scan

    return scan(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.langid import label_texts

    return label_texts(_table(spark, sf_dir, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.ann import nearest_report

    return nearest_report(_table(spark, sf_dir, "embeddings"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kindred.llm.simhash import near_duplicate_classes

    return near_duplicate_classes(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_bpe_tree, op3_quality_rules, op4_substring_dedup, op5_best_fit_packing, op6_pii_bootstrap, op7_license_scan, op8_language_id, op9_nearest_neighbours, op10_simhash_dedup)}

ORACLES: dict[str, str] = {
    "op3_quality_rules": oracles.quality_rules(),
    "op4_substring_dedup": oracles.passages(),
    "op6_pii_bootstrap": oracles.personal_data(),
    "op7_license_scan": oracles.license_scan(),
    "op9_nearest_neighbours": oracles.nearest_neighbours(),
}

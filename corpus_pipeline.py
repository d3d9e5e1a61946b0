"""The corpus pipeline: documents through quality rules, near-dedup, passage dedup, PII removal and packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import packing, pii, quality, simhash, substring
from kindred.llm.common import stage


def _with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if there, counted again from the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the risk-controlled rules."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that texts with a Jaccard similarity of 0.8 on five-word shingles connect."""
    return simhash.keep_similar(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; documents that have nothing else go."""
    done = substring.drop_repeats(docs)
    done = done.filter((F.size(done.columns[-1]) == 0) | (F.trim("text") != ""))
    return _with_length(done.select(*docs.columns))


def remove_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _with_length(pii.redact(docs))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of every text lies in the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("passage dedup", passage_dedup),
    ("pii", remove_pii),
    ("packing", best_fit),
]

#: Similarity joins, risk-controlled cutoffs, passages and best fit are beyond SQL; tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's rows written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs

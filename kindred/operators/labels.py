"""Ground truth, labelled pairs, negative sampling and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One negative in so many stays, and so many of those a record and target registry.
SAMPLE_ONE_IN, NEGATIVES = 10, 3


def truth_pairs(truth: DataFrame) -> DataFrame:
    """Distinct (s1_id, matched_id, is_positive) of the comma-joined lists; null or empty lists give none."""
    ids = F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","))
    return truth.select(F.col("source1_entity_id").alias("s1_id"), ids.alias("matched_id")).filter("matched_id <> ''").distinct().withColumn("is_positive", F.lit(1).cast("byte"))


def source_of(matched: Column) -> Column:
    return F.when(matched.startswith("S2-"), "s2").when(matched.startswith("S3-"), "s3").otherwise("unknown")


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, matched_id, source, label) of candidate pairs."""
    joined = pairs.select("s1_id", "matched_id").join(truth_pairs(truth), ["s1_id", "matched_id"], "left")
    return joined.select("s1_id", "matched_id", source_of(F.col("matched_id")).alias("source"), F.coalesce("is_positive", F.lit(0)).cast("byte").alias("label"))


def bucket(*columns: str) -> Column:
    """A number from the first 32 bits of the MD5 of the joined columns; the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *columns).cast("binary")), 1, 8), 16, 10).cast("long")


def sample_negatives(labelled: DataFrame, one_in: int = SAMPLE_ONE_IN) -> DataFrame:
    return labelled.filter((F.col("label") == 1) | (bucket("s1_id", "matched_id") % one_in == 0))


def top_negatives(labelled: DataFrame, k: int = NEGATIVES) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("s1_id", "source").orderBy("matched_id"))
    return labelled.filter("label = 0").withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def training_set(labelled: DataFrame, one_in: int = SAMPLE_ONE_IN, k: int = NEGATIVES) -> DataFrame:
    """All positives and a few negatives a record and registry, distinct."""
    sampled = sample_negatives(labelled, one_in)
    return sampled.filter("label = 1").unionByName(top_negatives(sampled, k)).distinct()


def proportional_sample(rows: DataFrame, part: str, ids: list[str], most: int) -> DataFrame:
    """At most ``most`` rows, each part with its share of them (one at least), chosen by hash.

    Parts are ranked by range of hash within salted groups, so a part may hold any number of rows.
    """
    sizes = rows.groupBy(part).agg(F.count("*").alias("__n"))
    total = rows.count()
    quota = F.least(F.col("__n"), F.greatest(F.lit(1), F.round(F.lit(min(total, most)) * F.col("__n") / max(total, 1)).cast("long")))
    sizes = sizes.withColumn("__quota", quota)
    keyed = rows.join(sizes.select(part, "__quota"), part).withColumn("__b", bucket(*ids))
    by_slot = keyed.withColumn("__slot", F.shiftright("__b", 22))
    counts = by_slot.groupBy(part, "__slot").agg(F.count("*").alias("__c"))
    before = F.coalesce(F.sum("__c").over(Window.partitionBy(part).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("__before", before).drop("__c")
    rank = F.row_number().over(Window.partitionBy(part, "__slot").orderBy("__b", *ids))
    ranked = by_slot.join(counts, [part, "__slot"]).withColumn("__rank", rank + F.col("__before"))
    return ranked.filter("__rank <= __quota").drop("__quota", "__b", "__slot", "__before", "__rank")


def train_validation_split(rows: DataFrame, entity: str = "s1_id", one_in: int = 5) -> DataFrame:
    """``rows`` with is_validation: one entity in ``one_in``, all its rows together."""
    return rows.withColumn("is_validation", bucket(entity) % one_in == 0)

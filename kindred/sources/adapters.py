"""Business records out of the star-schema tables: the part table as three noisy registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.normalize import normalize_records
from kindred.sources.scratch import cached_stage


#: Names in Indic scripts, alone and among Latin text.
INDIC_NAMES = ("भारत", "संस्कृत", "\u0958ल", "१२", "दिल्ली", "মুম্বাই", "சென்னை", "ಕನ್ನಡ", "తెలుగు", "ગુજરાત", "ਪੰਜਾਬ", "Tata राम & Co.", "दुःख", "")


def indic_names(spark: SparkSession) -> DataFrame:
    """(id, name): a fixed list."""
    return spark.createDataFrame(list(enumerate(INDIC_NAMES)), "id int, name string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, entity_id, business_name, business_address, country, p_partkey): every part in one of three registries.

    To half of its names the second registry adds a legal form; the third shouts, adds another
    to half, and has lost the first letter of every seventh.
    """
    source = 1 + F.col("p_partkey") % 3
    form = F.when(F.floor(F.col("p_partkey") / 3) % 2 == 0, F.lit("")).otherwise(F.when(source == 2, " Inc.").otherwise(" SAS"))
    heard = F.when(F.floor(F.col("p_partkey") / 3) % 7 == 3, F.expr("substring(p_name, 2)")).otherwise(F.col("p_name"))
    name = F.when(source == 1, F.col("p_name")).when(source == 2, F.concat("p_name", form)).otherwise(F.concat(F.upper(heard), form))
    number = F.lpad((F.col("p_partkey") % 97).cast("string"), 5, "0")
    return table(spark, sf_dir, "part").select(
        source.cast("int").alias("source"),
        F.concat(F.lit("S"), source.cast("string"), F.lit("-"), F.col("p_partkey").cast("string")).alias("entity_id"),
        name.alias("business_name"),
        F.concat_ws(" ", F.col("p_size").cast("string"), F.col("p_brand"), F.lit("rd"), number).alias("business_address"),
        F.col("p_type").alias("country"),
        F.col("p_partkey"),
    )


def normalized_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised records, a stage that is written once a session and then read."""
    return cached_stage(spark, sf_dir, "norm", lambda: normalize_records(part_records(spark, sf_dir)))


def part_truth(spark: SparkSession, sf_dir: str, asked: Column | None = None) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): parts of the other registries with the same name and type, and the same last digit of the brand.

    ``asked``: the first registry's records whose lists are wanted, all if not given.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.right("p_brand", F.lit(1)).alias("digit"))
    rec = part_records(spark, sf_dir).select("source", "entity_id", "p_partkey").join(parts, "p_partkey")
    same = ["p_name", "p_type", "digit"]
    left = rec.filter("source = 1").filter(F.lit(True) if asked is None else asked).select(F.col("entity_id").alias("source1_entity_id"), *same)
    right = rec.filter("source > 1").select(F.col("entity_id").alias("other"), *same)
    lists = left.join(right, same).groupBy("source1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("other")), ",").alias("matched_entity_ids"))
    return left.select("source1_entity_id").join(lists, "source1_entity_id", "left").withColumn("matched_entity_ids", F.coalesce("matched_entity_ids", F.lit("")))

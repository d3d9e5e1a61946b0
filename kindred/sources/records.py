"""Sources and sinks: registry TSV files, ground truth, Parquet stages, result lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
#: Texts that stand for a missing value.
NULL_TOKENS = ("", "NULL", "null", "None")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """A tab-separated file with a header; the null tokens become null."""
    raw = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return raw.select(*(F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)).alias(c) for c in schema.fieldNames()))


def read_tsv_filled(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same file with empty strings for missing values, as the output checks want it."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path).na.fill("")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct first fields of a text file's lines, without blank lines and the header."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    ids = lines.select(F.trim(F.split("value", "\t")[0]).alias("id"))
    return ids.filter(~F.lower("id").isin("entity_id", "source1_entity_id")).distinct()


def write_stage(df: DataFrame, path: str, rebuild: bool = False) -> None:
    """Parquet with zstd; an existing stage is kept unless it is to be rebuilt."""
    df.write.mode("overwrite" if rebuild else "ignore").option("compression", "zstd").parquet(path)


def write_result_lists(lists: DataFrame, path: str) -> None:
    """One TSV file with a header and unquoted, possibly empty, comma-joined lists.

    The rows meet in one task only to be written; what makes them stays parallel.
    """
    lists.repartition(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "").csv(path)


def read_result_lists(spark: SparkSession, path: str, ids: str = "matched_entity_ids") -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", ids)])
    return read_tsv_filled(spark, path, schema)

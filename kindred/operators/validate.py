"""Result lists and the checks of the output contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def result_lists(pairs: DataFrame, entities: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    """One row an entity: its matches comma-joined in order, an empty string for none."""
    lists = pairs.groupBy(F.col("s1_id").alias("source1_entity_id")).agg(F.array_join(F.array_sort(F.collect_set("matched_id")), ",").alias(name))
    all_ = entities.select(F.col("s1_id").alias("source1_entity_id")).distinct()
    return all_.join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(name, F.lit("")).alias(name))


def ids(listed: Column) -> Column:
    return F.filter(F.split(F.coalesce(listed, F.lit("")), ","), lambda i: i != "")


def duplicate_rows(lists: DataFrame) -> DataFrame:
    return lists.groupBy("source1_entity_id").agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_ids(lists: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    found = ids(F.col(name))
    return lists.filter(F.size(found) != F.size(F.array_distinct(found))).select("source1_entity_id", (F.size(found) - F.size(F.array_distinct(found))).alias("repeats"))


def wrong_prefixes(lists: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    """(source1_entity_id, id, problem): matches within the first registry, and ids of no known registry."""
    each = lists.select("source1_entity_id", F.explode(ids(F.col(name))).alias("id")).filter(~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-"))
    return each.select("source1_entity_id", "id", F.when(F.col("id").startswith("S1-"), "self_match").otherwise("bad_prefix").alias("problem"))


def unknown_ids(lists: DataFrame, known: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    each = lists.select("source1_entity_id", F.explode(ids(F.col(name))).alias("id"))
    return each.join(known.select(F.col("entity_id").alias("id")).distinct(), "id", "left_anti").select("source1_entity_id", "id")


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source1_entity_id, extra): matched ids that are no candidates, comma-joined in order."""
    joined = matches.join(candidates.select("source1_entity_id", "candidate_entity_ids"), "source1_entity_id", "left")
    extra = F.array_sort(F.array_except(ids(F.col("matched_entity_ids")), ids(F.col("candidate_entity_ids"))))
    return joined.select("source1_entity_id", F.array_join(extra, ",").alias("extra")).filter("extra <> ''")


def coverage(lists: DataFrame, entities: DataFrame) -> DataFrame:
    """(source1_entity_id, problem): entities without a row, and rows of unknown entities."""
    rows = lists.select("source1_entity_id").distinct()
    all_ = entities.select(F.col("s1_id").alias("source1_entity_id")).distinct()
    missing = all_.join(rows, "source1_entity_id", "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(rows.join(all_, "source1_entity_id", "left_anti").withColumn("problem", F.lit("unknown")))


def header_problems(first_line: str | None, expected: list[str]) -> list[str]:
    """What is wrong with a result file's first line (read on the driver)."""
    if first_line is None or not first_line.strip():
        return ["the file is empty"]
    if "\t" not in first_line and "," in first_line:
        return ["fields are separated by commas, not tabs"]
    found = [f.strip().lower() for f in first_line.lstrip("﻿").rstrip("\r\n").split("\t")]
    return [] if found == expected else [f"the header is {found}, not {expected}"]


def malformed_rows(lines: DataFrame) -> DataFrame:
    """Lines of a text file that are not blank and don't have two fields."""
    return lines.filter((F.trim("value") != "") & (F.size(F.split("value", "\t")) != 2))


def summary(lists: DataFrame, entities: DataFrame, known: DataFrame | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """(check, problems, first): all checks, counted, each with its first example in order."""
    found = [
        duplicate_rows(lists).select(F.lit("duplicate_rows").alias("check"), F.col("source1_entity_id").alias("example")),
        duplicate_ids(lists).select(F.lit("duplicate_ids"), "source1_entity_id"),
        wrong_prefixes(lists).select("problem", "id"),
        coverage(lists, entities).select("problem", "source1_entity_id"),
    ]
    if known is not None:
        found.append(unknown_ids(lists, known).select(F.lit("unknown_ids"), "id"))
    if candidates is not None:
        found.append(not_candidates(lists, candidates).select(F.lit("not_candidates"), "source1_entity_id"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    each = rows.groupBy("check", "example").agg(F.count("*").alias("n"))
    first = each.groupBy("check").agg(F.sum("n").alias("problems"), F.min("example").alias("first"))
    return first.select("check", "problems", "first")


def counts(lists: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    empty = F.size(ids(F.col(name))) == 0
    return lists.agg(F.count("*").alias("rows"), F.count_if(empty).alias("empty"), F.count_if(~empty).alias("filled"))

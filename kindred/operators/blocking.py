"""Candidate pairs by twelve equi-key rules with capped blocks, in one pass over the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import keys as K

#: Largest block on either side: seven primary rules, five fallback rules.
PRIMARY_CAP, FALLBACK_CAP = 500, 100
#: The rules' names, in order.
RULES = "exact_name phonetic skeleton name_postal phonetic_postal name_street skeleton_street sorted_name last_street first_street prefix4_street addr_sig".split()


def rules() -> dict[str, tuple[int, list[Column]]]:
    """Cap and key parts of each rule; the country stands before them."""
    name, sound, bones = F.col("n_core"), F.col("n_ph"), F.col("n_sk")
    address = F.col("business_address")
    postal, street = K.postal_last(address), K.street_lead(address)
    return {
        "exact_name": (PRIMARY_CAP, [name]),
        "phonetic": (PRIMARY_CAP, [sound]),
        "skeleton": (PRIMARY_CAP, [bones]),
        "name_postal": (PRIMARY_CAP, [K.prefix(name, 6), postal]),
        "phonetic_postal": (PRIMARY_CAP, [K.prefix(sound, 8), postal]),
        "name_street": (PRIMARY_CAP, [K.prefix(name, 6), street]),
        "skeleton_street": (PRIMARY_CAP, [K.prefix(bones, 8), street]),
        "sorted_name": (FALLBACK_CAP, [K.sorted_name(name)]),
        "last_street": (FALLBACK_CAP, [K.last_token(name), street]),
        "first_street": (FALLBACK_CAP, [K.first_token(name), street]),
        "prefix4_street": (FALLBACK_CAP, [K.prefix(name, 4), street]),
        "addr_sig": (FALLBACK_CAP, [street, K.addr_sig(address)]),
    }


def keyed(records: DataFrame, names: list[str] | None = None, require_parts: bool = False) -> DataFrame:
    """(source, entity_id, rule, cap, key): a row for each record and rule.

    A null country gives no key.  An empty part still forms a key unless ``require_parts``.
    """
    chosen = {k: v for k, v in rules().items() if names is None or k in names}

    def entry(name: str, cap: int, parts: list[Column]) -> Column:
        pieces = [p for part in [F.col("country"), *parts] for p in (part, F.lit("|"))][:-1]
        key = F.concat(*pieces)
        if require_parts:
            filled = F.lit(True)
            for part in parts:
                filled = filled & (part != "")
            key = F.when(filled, key)
        return F.struct(F.lit(name).alias("rule"), F.lit(cap).alias("cap"), key.alias("key"))

    entries = F.array(*(entry(name, cap, parts) for name, (cap, parts) in chosen.items()))
    return records.select("source", "entity_id", F.explode(entries).alias("k")).select("source", "entity_id", "k.*").filter("length(key) > 0")


def block_sizes(keys: DataFrame) -> DataFrame:
    """(rule, cap, key, target, n_left, n_right): both sides' sizes for each target registry."""
    count = lambda s: F.count_if(F.col("source") == s)
    both = keys.groupBy("rule", "cap", "key").agg(count(1).alias("n_left"), count(2).alias("n2"), count(3).alias("n3"))
    sides = F.array(*(F.struct(F.lit(s).alias("target"), F.col(f"n{s}").alias("n_right")) for s in (2, 3)))
    return both.select("rule", "cap", "key", "n_left", F.explode(sides).alias("t")).select("rule", "cap", "key", "t.target", "n_left", "t.n_right").filter("n_left > 0 and n_right > 0")


def within_cap(sizes: DataFrame) -> DataFrame:
    return sizes.filter("n_left <= cap and n_right <= cap")


def rule_pairs(keys: DataFrame) -> DataFrame:
    """(rule, s1_id, matched_id) inside every block within its cap.

    Blocks that exceed it are dropped before the join, so no key gives more than cap * cap
    pairs, and both joins are on keys of bounded groups.
    """
    good = within_cap(block_sizes(keys)).select("rule", "key", "target")
    left = keys.filter("source = 1").join(good, ["rule", "key"]).select("rule", "key", "target", F.col("entity_id").alias("s1_id"))
    right = keys.filter("source > 1").select("rule", "key", F.col("source").alias("target"), F.col("entity_id").alias("matched_id"))
    return left.join(right, ["rule", "key", "target"]).select("rule", "s1_id", "matched_id")


def candidates(records: DataFrame, names: list[str] | None = None, require_parts: bool = False) -> DataFrame:
    """Distinct (s1_id, matched_id) of all rules."""
    return rule_pairs(keyed(records, names, require_parts)).select("s1_id", "matched_id").distinct()

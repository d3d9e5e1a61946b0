"""The 37 pair features, in their contractual order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import keys as K
from kindred.functions import similarity as S
from kindred.functions.normalize import fold, num_tokens

NATIVE = (
    "name_phonetic_eq name_len_ratio name_common_tokens addr_common_tokens addr_num_overlap addr_both_empty addr_one_empty num_name_overlap "
    "num_any_overlap country_match city_match city_conflict state_conflict numeric_conflict street_number_match postal_code_match "
    "first_token_match token_count_ratio acronym_match common_prefix_len state_match street_name_match postal_prefix_match"
).split()
JARO_WINKLER = {"name_jw": "n_norm", "name_jw_core": "n_core", "name_skeleton_sim": "n_sk", "name_phonetic_jw": "n_ph", "addr_jw": "a_norm", "addr_jw_core": "a_core"}
FUZZY = {
    "name_token_sort": ("token_sort", "n_norm"),
    "name_token_set": ("token_set", "n_norm"),
    "name_partial": ("partial", "n_norm"),
    "addr_token_sort": ("token_sort", "a_norm"),
    "addr_partial": ("partial", "a_norm"),
}
ORDER = (
    "name_jw name_jw_core name_token_sort name_token_set name_partial name_skeleton_sim name_phonetic_eq name_phonetic_jw name_len_ratio "
    "name_common_tokens addr_jw addr_jw_core addr_token_sort addr_partial addr_common_tokens addr_num_overlap addr_both_empty addr_one_empty "
    "num_name_overlap num_any_overlap name_addr_avg name_core_skeleton_agree country_match city_match city_conflict state_conflict "
    "numeric_conflict street_number_match postal_code_match first_token_match token_count_ratio acronym_match common_prefix_len state_match "
    "street_name_match postal_prefix_match name_and_addr_strong"
).split()


def profiles(records: DataFrame) -> DataFrame:
    """What each record brings to its pairs, computed once a record."""
    name, address, core, place = F.col("business_name"), F.col("business_address"), F.col("n_core"), F.col("a_core")
    return records.select(
        "entity_id",
        "country",
        *("n_norm n_core n_ph n_sk a_norm a_core".split()),
        num_tokens(fold(name)).alias("num_name"),
        num_tokens(fold(address)).alias("num_addr"),
        K.first_token(core).alias("tok1"),
        K.acronym(core).alias("acronym"),
        K.squashed(core).alias("squashed"),
        K.city(place).alias("city"),
        K.state(place).alias("state"),
        K.leading_num(address).alias("street_num"),
        K.postal_feature(address).alias("postal"),
        K.street_name(place).alias("street_name"),
        K.token_count(core).alias("n_tok"),
    )


def paired(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with both profiles as structs l and r; pairs with an unknown id are dropped."""
    known = profiles(records)
    side = lambda name, key: known.select(F.col("entity_id").alias(key), F.struct(*(c for c in known.columns if c != "entity_id")).alias(name))
    return pairs.select("s1_id", "matched_id").join(side("l", "s1_id"), "s1_id").join(side("r", "matched_id"), "matched_id")


def _both(field: str) -> tuple[Column, Column]:
    return F.col(f"l.{field}"), F.col(f"r.{field}")


def _same(field: str) -> Column:
    a, b = _both(field)
    return (a != "") & (a == b)


def _differ(field: str) -> Column:
    a, b = _both(field)
    return (a != "") & (b != "") & (a != b)


def native() -> dict[str, Column]:
    """The features that are plain expressions over l and r."""
    n, m = _both("num_addr")
    names = _both("num_name")
    empty = [F.trim(x) == "" for x in _both("a_norm")]
    a, b = _both("acronym")
    long_a, long_b = _both("squashed")
    few, many = (f(*_both("n_tok")) for f in (F.least, F.greatest))
    p, q = _both("postal")
    flags = {
        "name_phonetic_eq": _same("n_ph"),
        "addr_both_empty": empty[0] & empty[1],
        "addr_one_empty": empty[0] != empty[1],
        "num_any_overlap": F.arrays_overlap(F.concat(names[0], n), F.concat(names[1], m)),
        "country_match": F.col("l.country").eqNullSafe(F.col("r.country")),
        "city_match": _same("city"),
        "city_conflict": _differ("city"),
        "state_conflict": _differ("state"),
        "numeric_conflict": (F.size(n) > 0) & (F.size(m) > 0) & ~F.arrays_overlap(n, m),
        "street_number_match": _same("street_num"),
        "postal_code_match": _same("postal"),
        "first_token_match": _same("tok1"),
        "acronym_match": (a != "") & (b != "") & ((a == b) | (a == long_b) | (b == long_a)),
        "state_match": _same("state"),
        "street_name_match": _same("street_name"),
        "postal_prefix_match": (p != "") & (q != "") & (F.substring(p, 1, 3) == F.substring(q, 1, 3)),
    }
    values = {
        "name_len_ratio": S.length_ratio(*_both("n_norm")),
        "name_common_tokens": S.token_overlap(*_both("n_core")),
        "addr_common_tokens": S.token_overlap(*_both("a_core")),
        "addr_num_overlap": S.overlap(n, m),
        "num_name_overlap": S.overlap(*names),
        "token_count_ratio": few / F.greatest(many, F.lit(1)),
        "common_prefix_len": S.common_prefix(long_a, long_b),
    }
    return {k: v.cast("float") for k, v in {**{k: v.cast("int") for k, v in flags.items()}, **values}.items()}


def _scores(pairs: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    return pairs.withColumns({name: S.scorer(how)(*_both(field)) for name, (how, field) in wanted.items()})


def native_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    found = native()
    return paired(pairs, records).select("s1_id", "matched_id", *(found[k].alias(k) for k in NATIVE))


def jaro_winkler_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    return _scores(paired(pairs, records), {k: ("jw", f) for k, f in JARO_WINKLER.items()}).select("s1_id", "matched_id", *JARO_WINKLER)


def fuzzy_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    return _scores(paired(pairs, records), FUZZY).select("s1_id", "matched_id", *FUZZY)


def all_features(pairs: DataFrame, records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(s1_id, matched_id, *keep, the 37 features as floats); ``keep`` are columns of ``pairs``."""
    both = paired(pairs, records)
    if keep:
        both = both.join(pairs.select("s1_id", "matched_id", *keep), ["s1_id", "matched_id"])
    scored = _scores(both, {**{k: ("jw", f) for k, f in JARO_WINKLER.items()}, **FUZZY}).withColumns(native())
    mixed = {
        "name_addr_avg": (F.col("name_jw") + F.col("addr_jw")) / F.lit(2),
        "name_core_skeleton_agree": F.col("name_skeleton_sim") > F.lit(0.85).cast("float"),
        "name_and_addr_strong": (F.col("name_token_sort") >= F.lit(0.9).cast("float")) & (F.col("addr_token_sort") >= F.lit(0.7).cast("float")),
    }
    mixed = {k: (v if k == "name_addr_avg" else v.cast("int")).cast("float") for k, v in mixed.items()}
    return scored.withColumns(mixed).select("s1_id", "matched_id", *keep, *ORDER)

"""Recall, missed pairs, diagnosis of misses, block sweeps and threshold choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import keys as K
from kindred.operators.labels import source_of

SWEEP_CAPS = (20, 50, 100, 200, 500)
#: F0.5 weighs precision over recall.
BETA2 = 0.25
THRESHOLDS = 91


def missing(truth: DataFrame, found: DataFrame) -> DataFrame:
    return truth.select("s1_id", "matched_id").join(found.select("s1_id", "matched_id"), ["s1_id", "matched_id"], "left_anti")


def share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.greatest(whole, F.lit(1)))


def recall(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(source, total, found, recall) of each target registry and of all."""
    hit = found.select("s1_id", "matched_id").distinct().withColumn("hit", F.lit(1))
    joined = truth.select("s1_id", "matched_id").join(hit, ["s1_id", "matched_id"], "left").select(source_of(F.col("matched_id")).alias("source"), "hit")
    each = joined.groupBy("source").agg(F.count("*").alias("total"), F.count("hit").alias("found"))
    every = each.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "found"))).select(F.lit("all").alias("source"), "total", "found")
    return each.unionByName(every).select("source", "total", "found", share(F.col("found"), F.col("total")).alias("recall"))


def enrich(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with both records' attributes; those of the match end in ``_r``."""
    fields = ["country", "business_name", "business_address", "n_core", "n_ph", "n_sk", "a_core"]
    left = records.select(F.col("entity_id").alias("s1_id"), *fields)
    right = records.select(F.col("entity_id").alias("matched_id"), *(F.col(c).alias(f"{c}_r") for c in fields))
    return pairs.select("s1_id", "matched_id").join(left, "s1_id").join(right, "matched_id").select("s1_id", "matched_id", *fields, *(f"{c}_r" for c in fields))


def signals() -> dict[str, Column]:
    """The diagnostic tests on an enriched pair, by name.

    Name, sound and skeleton count as equal when both are empty; the tests on keys do not.
    """
    def pair(make, *fields: str) -> tuple[Column, Column]:
        return make(*(F.col(f) for f in fields)), make(*(F.col(f + "_r") for f in fields))

    def filled(sides: tuple[Column, Column]) -> Column:
        return (sides[0] != "") & (sides[0] == sides[1])

    eq = lambda field: F.col(field) == F.col(field + "_r")
    country, name, sound, bones = eq("country"), eq("n_core"), eq("n_ph"), eq("n_sk")
    postal = filled(pair(K.postal_last, "business_address"))
    place, number = filled(pair(lambda c: c, "a_core")), filled(pair(K.num_any, "business_address"))
    digits = filled(pair(K.postal_56, "business_address"))
    four, six = (filled(pair(lambda c, n=n: K.prefix(c, n), "n_core")) for n in (4, 6))
    heard, boned = filled(pair(lambda c: c, "n_ph")), filled(pair(lambda c: c, "n_sk"))
    shared = F.size(F.array_intersect(*pair(K.long_tokens, "business_address"))) >= 2
    return {
        "country": country, "name": name, "phonetic": sound, "skeleton": bones, "postal": postal,
        "country_postal": country & postal, "country_name": country & name, "country_phonetic": country & sound, "country_skeleton": country & bones,
        "name_postal": name & postal, "phonetic_postal": sound & postal, "skeleton_postal": bones & postal,
        "address_core": place, "street_number": number, "postal_digits": digits,
        "prefix4_number": four & number, "prefix6_number": six & number, "phonetic_number": heard & number, "skeleton_number": boned & number,
        "prefix4_postal": four & digits, "prefix6_postal": six & digits, "address_prefix4": place & four,
        "country_number": country & number, "country_digits": country & digits, "country_prefix4": country & four, "country_prefix6": country & six,
        "country_tokens": country & shared,
    }


def signal_coverage(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """(signal, hits, total, coverage): how many pairs meet each test, in one pass."""
    tests = signals()
    counted = enrich(pairs, records).agg(F.count("*").alias("total"), *(F.count_if(v).alias(k) for k, v in tests.items()))
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("signal"), F.col(k).alias("hits")) for k in tests)))
    return counted.select(rows.alias("s"), "total").select("s.signal", "s.hits", "total", share(F.col("hits"), F.col("total")).alias("coverage"))


def block_sweep(records: DataFrame) -> DataFrame:
    """(target, keys, cap, blocks, pairs): valid blocks and pair volume of three address keys at each cap.

    Only records with a number and a name prefix take part, for all three.
    """
    base = records.filter("country is not null").select("source", "country", K.num_any(F.col("business_address")).alias("num"), K.prefix(F.col("n_core"), 4).alias("p4"), K.prefix(F.col("n_core"), 6).alias("p6"), K.addr_sig(F.col("business_address")).alias("sig")).filter("num <> '' and p4 <> ''")
    kinds = F.array(*(F.struct(F.lit(k).alias("keys"), F.col(c).alias("part")) for k, c in (("num_p4", "p4"), ("num_p6", "p6"), ("num_sig", "sig"))))
    long = base.select("source", "country", "num", F.explode(kinds).alias("k")).select("source", "country", "num", "k.*")
    size = lambda s: F.count_if(F.col("source") == s)
    sizes = long.groupBy("keys", "country", "num", "part").agg(size(1).alias("n1"), size(2).alias("n2"), size(3).alias("n3"))
    targets = F.explode(F.array(*(F.struct(F.lit(t).alias("target"), F.col(f"n{t}").alias("n")) for t in (2, 3))))
    capped = sizes.select("keys", "n1", targets.alias("t")).filter("n1 > 0 and t.n > 0").select("keys", "n1", "t.*", F.explode(F.array(*map(F.lit, SWEEP_CAPS))).alias("cap"))
    fits = (F.col("n1") <= F.col("cap")) & (F.col("n") <= F.col("cap"))
    return capped.groupBy("target", "keys", "cap").agg(F.count_if(fits).alias("blocks"), F.coalesce(F.sum(F.when(fits, F.col("n1") * F.col("n"))), F.lit(0)).alias("pairs"))


def f_half(precision: Column, recalled: Column) -> Column:
    below = BETA2 * precision + recalled
    return F.when(below == 0, F.lit(0.0)).otherwise((1 + BETA2) * precision * recalled / F.when(below == 0, 1.0).otherwise(below))


def threshold_table(scored: DataFrame) -> DataFrame:
    """(step, threshold, tp, fp, fn, precision, recall, f05) at 91 thresholds from 0.05 to 0.95.

    Rows are counted by the last threshold they reach, so the sweep sums 92 counts instead of
    meeting every row with every threshold.
    """
    step = F.least(F.floor((F.col("score") - 0.05) * 100 + 1e-9), F.lit(THRESHOLDS - 1)).cast("int")
    reached = F.greatest(step, F.lit(-1))  # -1: below the first threshold
    counts = scored.groupBy(reached.alias("step")).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    grid = scored.sparkSession.range(-1, THRESHOLDS).select(F.col("id").cast("int").alias("step"))
    table = grid.join(counts, "step", "left").na.fill(0)
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)  # 92 rows, whatever the input
    below = Window.orderBy(F.desc("step")).rowsBetween(1, Window.unboundedFollowing)
    table = table.withColumns({"tp": F.sum("pos").over(above), "fp": F.sum("neg").over(above), "fn": F.coalesce(F.sum("pos").over(below), F.lit(0))}).filter("step >= 0")
    table = table.withColumns({"precision": share(F.col("tp"), F.col("tp") + F.col("fp")), "recall": share(F.col("tp"), F.col("tp") + F.col("fn"))})
    return table.select("step", (F.lit(0.05) + F.col("step") / 100).alias("threshold"), "tp", "fp", "fn", "precision", "recall", f_half(F.col("precision"), F.col("recall")).alias("f05"))


def best_threshold(table: DataFrame) -> DataFrame:
    """The row of the largest F0.5; of equal ones the lowest threshold."""
    return table.orderBy(F.desc(F.round("f05", 12)), "step").limit(1)


def class_balance(labelled: DataFrame) -> DataFrame:
    counted = labelled.agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))
    return counted.withColumn("scale_pos_weight", F.greatest(F.lit(1.0), F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))))


def macro_f05(predicted: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(entities, macro_f05): the mean over all entities; one with neither matches nor predictions counts 1."""
    hits = predicted.select("s1_id", "matched_id", F.lit(1).alias("p")).join(truth.select("s1_id", "matched_id", F.lit(1).alias("t")), ["s1_id", "matched_id"], "full")
    each = hits.groupBy("s1_id").agg(F.count("p").alias("np"), F.count("t").alias("nt"), F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("tp"))
    full = entities.select("s1_id").distinct().join(each, "s1_id", "left").na.fill(0)
    score = F.when((F.col("np") == 0) & (F.col("nt") == 0), F.lit(1.0)).otherwise(f_half(share(F.col("tp"), F.col("np")), share(F.col("tp"), F.col("nt"))))
    return full.agg(F.count("*").alias("entities"), F.avg(score).alias("macro_f05"))

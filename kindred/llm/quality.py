"""Quality rules with risk-controlled cutoffs.

Each rule rejects texts whose score exceeds a cutoff.  For every stratum (language) the cutoffs
of all rules move together along one ladder, which is laid out before any test: a score step of
a rule comes the earlier, the larger the share of labelled bad texts among all texts outside
the holdout that reach the step.  The holdout is three quarters of the labelled good texts.
Rungs are tested in order, from the one that rejects least: a rung passes if the exact binomial
probability of seeing so few rejected texts of the holdout, were the true share of good texts
rejected by any rule ALPHA, is at most DELTA / strata.  Testing stops at the first failure, so
each chosen rung is valid at once with all others (fixed sequence within a stratum, Bonferroni
across strata): with confidence 1 - DELTA no stratum loses more than ALPHA of its good texts.
Of the rungs passed, the mildest that still rejects as many of the labelled bad texts as the
strictest does is taken.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.common import fresh, map_arrow, stage

#: Largest share of good texts that the rules together may reject in a stratum, and the risk of more.
ALPHA, DELTA = 0.04, 0.05
#: Cutoffs tested, as shares in units of 1 / GRID; scores above 1 count as just above.
GRID = 20
#: Rules: score name and how it follows from the counts.
RULES = ("repeats", "symbols", "dup_lines", "capitals")
#: Base limits on words and on the percentage of words in repeated windows.
LEAST_WORDS, REPEAT_PERCENT = 50, 50
#: Strata that may be broadcast; more are joined by shuffle.
BROADCAST_STRATA = 10_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANKS = " \t\n\r\x0b\x0c"


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    code: dict[bytes, int] = {}
    ids = np.array([code.setdefault(w, len(code)) for w in words], dtype=np.int64)
    pairs = np.unique(ids[:-1] * len(code) + ids[1:], return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * len(code) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[which] > 1
    hit = np.zeros(len(words), dtype=bool)
    for k in range(3):
        hit[k : k + len(twice)] |= twice
    return int(hit.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word, capitals, letters (ASCII)."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    if not words:
        return (0,) * 8
    hist = np.zeros(256, dtype=np.int64)
    for i in range(0, len(raw), 1 << 20):
        hist += np.bincount(np.frombuffer(raw[i : i + (1 << 20)], np.uint8), minlength=256)
    points = int(hist.sum() - hist[0x80:0xC0].sum() - hist[_SPACE].sum())
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    capitals = int(hist[65:91].sum())
    return (len(words), points, int(hist[_SYMBOL].sum()), len(lines) - len(set(lines)), repeat_words(words), len(lines), capitals, capitals + int(hist[97:123].sum()))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters")


def measure(docs: DataFrame, text_col: str, names: list[str]) -> DataFrame:
    """``docs`` with the eight counts under ``names``; all columns pass through where they are read."""
    n, place = len(docs.columns), docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in names)])
    labels = [*docs.columns, *names]

    def run(batches):
        for batch in batches:
            found = np.array([counts(t) for t in batch.column(place).to_pylist()], dtype=np.int64).reshape(-1, 8)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n)), *(pa.array(found[:, k]) for k in range(8))], names=labels)

    return map_arrow(docs, run, schema)


def scores(names: list[str]) -> dict[str, F.Column]:
    """The grid step of each rule's score, from the count columns ``names``: 0 to GRID + 1, rounded up."""
    c = dict(zip(_COUNTS, names))
    share = {
        "repeats": (c["n_repeat_words"], c["n_words"]),
        "symbols": (c["n_symbols"], c["n_words"]),
        "dup_lines": (c["n_dup_lines"], c["n_lines"]),
        "capitals": (c["n_capitals"], c["n_letters"]),
    }
    return {rule: F.least(F.ceil(F.col(a) * GRID / F.greatest(F.col(b), F.lit(1))), F.lit(GRID + 1)).cast("int") for rule, (a, b) in share.items()}


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with n trials of probability p, exactly summed in logarithms."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = np.array([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) for x in i.tolist()])
    logs = logs + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return min(1.0, float(np.exp(top) * np.exp(logs - top).sum()))


def ladder(rest: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The risk of each grid step of one rule, from counts by step of the texts outside the holdout and of the bad ones among them.

    The risk is the share of bad texts, in millionths, among those that reach the step, or the
    largest such share of an earlier step.
    """
    tails = [np.cumsum(x[::-1])[::-1] for x in (rest, bad)]
    return np.maximum.accumulate(tails[1] * 1_000_000 // np.maximum(tails[0], 1))


def choose_rung(risk: np.ndarray, good: np.ndarray, bad: np.ndarray, alpha: float, delta: float) -> int | None:
    """The least risk that is rejected, from counts of holdout and bad texts by risk; None rejects nothing."""
    n, passed = int(good.sum()), []
    for level in np.unique(risk)[::-1].tolist():
        if not n or binomial_tail(int(good[risk >= level].sum()), n, alpha) > delta:
            break
        passed.append(level)
    if not passed:
        return None
    most = bad[risk >= passed[-1]].sum()
    return next(level for level in passed if bad[risk >= level].sum() == most)


def cutoffs(measured: DataFrame, names: list[str], labels: DataFrame, id_col: str, stratum_col: str, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one cutoff a rule) for every stratum with texts.

    A text with several labels is good only if all say so; a null label doesn't count.  Texts
    that fail the base limits have no part, as the rules never decide on them.  Good texts whose
    id's MD5 starts with 0 to 3 lay out the ladder with all other texts, the rest are the
    holdout.  Only counts by stratum and combination of grid steps leave the tasks.
    """
    verdict = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("labelled")).agg(F.min("quality").alias("quality"))
    steps = scores(names)
    texts = measured.filter(~base_failed(names)).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), *(s.alias(r) for r, s in steps.items()))
    texts = texts.join(verdict, F.col("doc_id") == F.col("labelled"), "left")
    holdout = F.coalesce((F.col("quality") > 0) & (F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) >= "4"), F.lit(False))
    count = lambda which: F.sum(F.when(which, 1).otherwise(0))
    table = stage(texts.groupBy("stratum", *RULES).agg(count(holdout).alias("good"), count(F.col("quality") <= 0).alias("bad"), count(~holdout).alias("rest")), "steps")
    strata = max(1, table.filter("good > 0").select("stratum").distinct().count())
    melted = table.select("stratum", "bad", "rest", F.posexplode(F.array(*RULES)).alias("rule", "step")).groupBy("stratum", "rule", "step").agg(F.sum("bad").alias("bad"), F.sum("rest").alias("rest"))

    def lay_out(frame: pd.DataFrame) -> pd.DataFrame:
        row = {"stratum": frame["stratum"].iloc[0]}
        for k, rule in enumerate(RULES):
            rest, bad = np.zeros(GRID + 2, dtype=np.int64), np.zeros(GRID + 2, dtype=np.int64)
            part = frame[frame["rule"] == k]
            rest[part["step"]], bad[part["step"]] = part["rest"], part["bad"]
            row[f"{rule}_risk"] = ladder(rest, bad)
        return pd.DataFrame([row])

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        found = choose_rung(*(frame[c].to_numpy() for c in ("risk", "good", "bad")), alpha, delta / strata)
        return pd.DataFrame({"stratum": frame["stratum"].iloc[:1], "level": pd.array([found], "Int64")})

    laid = stage(melted.groupBy("stratum").applyInPandas(lay_out, "stratum string, " + ", ".join(f"{r}_risk array<long>" for r in RULES)), "ladders")
    risk = F.greatest(*(F.col(f"{r}_risk")[F.col(r)] for r in RULES))
    by_risk = table.join(laid, "stratum").groupBy("stratum", risk.alias("risk")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    rungs = by_risk.groupBy("stratum").applyInPandas(choose, "stratum string, level long")
    below = lambda r: F.when(F.col("level").isNull(), GRID + 1).otherwise(F.size(F.filter(f"{r}_risk", lambda x: x < F.col("level"))) - 1)
    return stage(laid.join(rungs, "stratum").select("stratum", *(below(r).cast("int").alias(r) for r in RULES)), "cutoffs")


def base_failed(names: list[str]) -> F.Column:
    c = dict(zip(_COUNTS, names))
    return (F.col(c["n_words"]) < LEAST_WORDS) | (100 * F.col(c["n_repeat_words"]) > REPEAT_PERCENT * F.col(c["n_words"]))


def judge(measured: DataFrame, names: list[str], chosen: DataFrame, stratum_col: str, kept_col: str) -> DataFrame:
    """``measured`` with the verdict; a stratum without labels loses base failures only."""
    stratum, *limits = fresh(measured, "__stratum", *(f"__{r}" for r in RULES))
    chosen = chosen.select(F.col("stratum").alias(stratum), *(F.col(r).alias(x) for r, x in zip(RULES, limits)))
    small = chosen.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    joined = measured.join(F.broadcast(chosen) if small else chosen, F.coalesce(measured[stratum_col].cast("string"), F.lit("")) == F.col(stratum), "left")
    rejected = F.lit(False)
    for (_, step), limit in zip(scores(names).items(), limits):
        rejected = rejected | (step > F.coalesce(F.col(limit), F.lit(GRID + 1)))
    return joined.withColumn(kept_col, ~(base_failed(names) | rejected)).drop(stratum, *limits)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept: a row a document.

    A null text has no words and fails; repeated rows are judged each; a null language is a
    stratum of its own.  Empty tables give no rows; without labels only base failures go.
    """
    names = list(_COUNTS)
    measured = stage(measure(docs.select("doc_id", "lang", "text"), "text", names).drop("text"), "counts")
    chosen = cutoffs(measured, names, labels, "doc_id", "lang")
    judged = judge(measured, names, chosen, "lang", "kept")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed(names).alias("base_failed"), "kept")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``docs`` without the rejected rows; all columns are kept as they are."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("lang"), F.col(text_col).alias("text"))
    measured = measure(narrow, "text", list(_COUNTS)).drop("text")
    chosen = cutoffs(measured, list(_COUNTS), labels, "doc_id", "lang")
    *names, kept = fresh(docs, *(f"__{c}" for c in _COUNTS), "__kept")
    judged = judge(measure(docs, text_col, names), names, chosen, stratum_col, kept)
    return judged.filter(kept).select(*docs.columns)

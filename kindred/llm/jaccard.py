"""Near copies: texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

SimHash fingerprints of the sets are probed first and what meets is verified.  Then an exact
join connects what the fingerprints leave out.  Two sets that similar share a member among the
first n - ceil(0.8 n) + 1 of each, in any order that is the same for all texts; here members
come in the order of how many texts have them, counted over all texts in a table of fixed size,
so that few unlike texts meet.  Pairs that meet are held against bitmaps first: sets whose
bitmaps differ in d bits differ in d members at least.  What is left is compared shingle by
shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import simhash
from kindred.llm.common import fresh, map_arrow, stage, unstage
from kindred.llm.components import connected_components

WORDS = 5
#: Bits in which fingerprints may differ to be verified.
DISTANCE = 2
#: Counters that shingles share, by the low bits of their hash.
COUNTERS = 1 << 17
#: Rounds of comparisons with one member a bucket, before all members that are still apart are compared.
ROUNDS = 1
#: Longs of the bitmaps that the last join compares.
MARKS = 16
#: Keys of texts that are broadcast; more are joined.
BROADCAST = 1_000_000


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the word shingles, each once, ascending; a text of fewer words is one shingle, none without a word."""
    import xxhash

    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return np.zeros(0, dtype=np.int64)
    joined = map(b" ".join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
    return np.unique(np.array([xxhash.xxh64_intdigest(s, 42) for s in joined], dtype=np.uint64).view(np.int64))


def prefix(found: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 of n shingles, those with the smallest counters first."""
    size = len(found) - -(-4 * len(found) // 5) + 1 if len(found) else 0
    return found[np.lexsort((found, counters[found & (len(counters) - 1)]))[:size]]


def bitmap(found: np.ndarray, size: int | None = None) -> np.ndarray:
    """For each place, modulo ``size`` or a power of two of at least the set's size and 64, whether an odd number of shingles has it."""
    size = size or max(64, 1 << max(len(found) - 1, 0).bit_length())
    odd = np.bincount(found & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _counters(texts: DataFrame) -> np.ndarray:
    """For each of COUNTERS, how many times a text has a shingle of it, over all texts."""

    def run(batches):
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            found = [shingles(t) & (COUNTERS - 1) for t in batch.column(0).to_pylist()]
            total += np.bincount(np.concatenate(found), minlength=COUNTERS)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k])], names=["k", "n"])

    counted = map_arrow(texts.select("text"), run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, dtype=np.int64)
    out[counted["k"].to_numpy()] = counted["n"].to_numpy()
    return out


def _sets(texts: DataFrame) -> DataFrame:
    """(node, best, n, fp, prefix, bits, marks): a row for each set of shingles; best is its first row's (none, doc_id, h)."""
    counters = _counters(texts)

    def run(batches):
        import xxhash

        for batch in batches:
            found = [shingles(t) for t in batch.column(2).to_pylist()]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in found], dtype=np.uint64).view(np.int64)
            fps = np.array([simhash.majority(s) for s in found], dtype=np.uint64).view(np.int64)
            first = pa.array([prefix(s, counters) for s in found], pa.list_(pa.int64()))
            bits = pa.array([bitmap(s) for s in found], pa.list_(pa.int64()))
            marks = pa.array([bitmap(s, 64 * MARKS) for s in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes), pa.array([len(s) for s in found], pa.int32()), pa.array(fps), first, bits, marks], names=["doc_id", "h", "node", "n", "fp", "prefix", "bits", "marks"])

    rows = map_arrow(texts, run, "doc_id long, h long, node long, n int, fp long, prefix array<long>, bits array<long>, marks array<long>")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h"))
    return rows.groupBy("node").agg(best.alias("best"), *(F.first(c).alias(c) for c in ("n", "fp", "prefix", "bits", "marks")))


def _shingles_of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, found): all shingles of the sets in ``nodes``, each from its first row's text."""

    def run(batches):
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingles(text)
                yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([len(found)], pa.int32()), pa.array([found], pa.list_(pa.int64()))], names=["node", "n", "found"])

    keys = nodes.select("node", F.col("best.doc_id").alias("id_"), F.col("best.h").alias("h_"))
    keys = F.broadcast(keys) if keys.count() <= BROADCAST else keys
    rows = texts.join(keys, (F.col("h") == F.col("h_")) & F.col("doc_id").eqNullSafe(F.col("id_"))).select("node", "text")
    return map_arrow(rows, run, "node long, n int, found array<long>").dropDuplicates(["node"])


def _both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` with the columns of a and of b, named column_a and column_b."""
    for k in "ab":
        pairs = pairs.join(table.select(F.col("node").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in columns)), k)
    return pairs


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps allow to be similar; the longer bitmap is folded to the shorter."""
    rows = _both(pairs, nodes, "n", "bits").filter(5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b"))
    xor = "zip_with({0}, {1}, (x, y) -> x ^ y)"
    fold = "if(size({0}) > size({1}), " + xor.format("slice({0}, 1, size({1}))", "slice({0}, size({1}) + 1, size({1}))") + ", {0})"
    differ = xor.format(fold.format("bits_a", "bits_b"), fold.format("bits_b", "bits_a"))
    return rows.filter(F.expr(f"9 * aggregate({differ}, 0, (s, x) -> s + bit_count(x)) <= n_a + n_b")).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have a similarity of 0.8 or more."""
    pairs = stage(_near(pairs, nodes), "pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stage(_shingles_of(texts, nodes.select("node", "best").join(asked, "node", "left_semi")), "sets")
    both = F.size(F.array_intersect("found_a", "found_b"))
    done = stage(_both(pairs, sets, "n", "found").filter(9 * both >= 4 * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "similar")
    unstage(pairs)
    unstage(sets)
    return done


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _probed(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints are equal, or linked by ``simhash.links``; one set stands for a fingerprint."""
    fps = stage(nodes.groupBy("fp").agg(F.min("node").alias("a")), "fingerprints")
    same = nodes.select("fp", F.col("node").alias("b")).join(fps, "fp").filter("a <> b")
    linked = simhash.links(fps.select("fp"), DISTANCE).withColumnsRenamed({"a": "x", "b": "y"})
    other = linked.join(fps.withColumnsRenamed({"fp": "x"}), "x").join(fps.withColumnsRenamed({"fp": "y", "a": "b"}), "y")
    return same.select("a", "b").unionByName(other.select("a", "b"))


def links(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of similar sets that connect all that are similar.

    First come the pairs that the fingerprints give.  Sets that share a shingle of their
    prefixes form a bucket.  In each of ROUNDS, all of a bucket whose members are not all
    connected are compared with one of them; then every two that are still apart are, by
    bitmaps where they meet, so a row leaves the join only for a pair that may be similar.
    A group of near copies so costs rows in proportion to its members, and no pair is left out;
    only the comparisons of bitmaps go with the square of those members of a bucket that no
    round has connected.
    """
    found = _verified(_probed(nodes).select(*_pair("a", "b")).distinct(), texts, nodes)
    rows = nodes.select("node", "n", F.explode("prefix").alias("token"))
    often = rows.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select("token")
    shared = rows.join(often, "token", "left_semi").groupBy("node", "n").agg(F.collect_list("token").alias("tokens"))
    buckets = stage(shared, "buckets")
    similar = 5 * F.least("n", "n_") >= 4 * F.greatest("n", "n_")
    for k in range(ROUNDS + 1):
        roots = connected_components(found)
        joined = buckets.join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root"), F.explode("tokens").alias("token"))
        spread = F.struct("node", "n", "root")
        centre = joined.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min_by(spread, F.xxhash64("node", "token", F.lit(k))).alias("c")).filter("x <> y")
        centre = centre.select("token", F.col("c.node").alias("node_"), F.col("c.n").alias("n_"), F.col("c.root").alias("root_"))
        if k < ROUNDS:
            pairs = joined.join(centre, "token").filter(F.col("root") != F.col("root_")).filter(similar)
        else:
            live = staged = stage(joined.join(centre.select("token"), "token", "left_semi").join(nodes.select("node", "marks"), "node"), "apart")
            other = live.select("token", *(F.col(c).alias(c + "_") for c in ("node", "n", "root", "marks")))
            differ = " + ".join(f"bit_count(marks[{i}] ^ marks_[{i}])" for i in range(MARKS))
            pairs = live.join(other, "token").filter(F.col("root") < F.col("root_")).filter(similar).filter(F.expr(f"9 * ({differ}) <= n + n_"))
        found = found.unionByName(_verified(pairs.select(*_pair("node", "node_")).distinct(), texts, nodes))
    unstage(buckets)
    unstage(staged)
    return found


def _only(docs: DataFrame, best: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows_of``, without dealing out the texts if few rows go."""
    key, hash_ = fresh(docs, "__id", "__h")
    keyed = docs.withColumns({key: F.col(id_col).cast("long"), hash_: F.xxhash64(text_col)})
    best = best.select(F.col("best.doc_id").alias("i"), F.col("best.h").alias("j"), F.lit(True).alias("stays"))
    rows = keyed.groupBy(F.col(key).alias("id_"), F.col(hash_).alias("h_")).agg(F.count("*").alias("c"))
    rows = rows.join(best, F.col("id_").eqNullSafe(F.col("i")) & (F.col("h_") == F.col("j")), "left")
    odd = stage(rows.filter("stays is null or c > 1").select("id_", "h_", "stays"), "odd")
    if odd.count() > BROADCAST:
        return simhash.rows_of(docs, best.select(F.struct(F.col("i").alias("doc_id"), F.col("j").alias("h")).alias("best")), id_col, text_col)
    same = F.col(key).eqNullSafe(F.col("id_")) & (F.col(hash_) == F.col("h_"))
    once = keyed.join(F.broadcast(odd), same, "left_anti")
    repeated = keyed.join(F.broadcast(odd.filter("stays")), same, "left_semi").dropDuplicates([key, hash_])
    return once.unionByName(repeated).drop(key, hash_)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group that similar texts connect: the smallest id, then text hash; null ids last.

    Texts without a word are alike.  All columns are kept as they are.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    nodes = stage(_sets(texts), "nodes")
    roots = connected_components(links(texts, nodes))
    of = nodes.select("node", "best").join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "best")
    best = stage(of.groupBy("root").agg(F.min("best").alias("best")), "best")
    unstage(nodes)
    return _only(docs, best, id_col, text_col)

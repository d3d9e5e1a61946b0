"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within ``distance`` bits differ by at most t_i bits in some part i of the
bits, if the sum of (t_i + 1) over the parts is distance + 1.  Parts group correlated bits;
the t_i, which may be -1 (the part is not probed), come from dynamic programming on the
candidate counts that each part and threshold is estimated to give on all fingerprints.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import fresh, map_arrow, stage
from kindred.llm.components import connected_components

BITS = 64
#: Members of a bucket that are compared pair by pair; larger buckets go through ``_by_centres``.
PAIRWISE = 32
#: Cost of a probe row against that of a verified candidate.
PROBE_COST = 1.0
_CHUNK = 16384


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text; 0 if it has no word."""
    import xxhash

    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return 0
    joined = map(b" ".join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
    count = max(1, len(found) - words + 1)
    return majority(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in joined), "<u8", count))


def majority(hashes: np.ndarray) -> int:
    """The unsigned number whose bits are 1 where over half of the 64-bit ``hashes`` have a 1."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, h, fp): a row a document; h is the text's hash, fp the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "h", "fp"])

    return map_arrow(rows, run, "doc_id long, h long, fp long")


def _both_ones(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and for each pair of bits how many have both."""

    def run(batches):
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i * BITS + j, pa.int32()), pa.array(total[i, j])], names=["k", "n"])

    got = np.zeros(BITS * BITS, dtype=np.int64)
    for row in map_arrow(fps.select("fp"), run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        got[row["k"]] = row["n"]
    return fps.count(), got.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size; each group collects bits that correlate."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [min(free, key=lambda b: (abs(p[b] - 0.5), b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: corr[b, group].sum())
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def allocate(costs: list[list[float]], distance: int) -> list[int]:
    """Thresholds t_i of least total cost with sum of (t_i + 1) = distance + 1.

    ``costs[i][u]`` is the cost of giving part i u = t_i + 1 units.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for units in range(distance + 2 - used):
                found = (cost + part[units], [*chosen, units - 1])
                if used + units not in after or found[0] < after[used + units][0]:
                    after[used + units] = found
        best = after
    return best[distance + 1][1]


def plan(fps: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed part, chosen among 2 to distance + 1 parts.

    Candidates at threshold 0 are counted over all fingerprints; those at a higher one are
    estimated from them and the chance that the bits set aside agree.
    """
    n, both = _both_ones(fps)
    p = np.diag(both) / max(n, 1)
    agree = np.maximum(p**2 + (1 - p) ** 2, 0.5)
    layouts = [group_bits(n, both, m) for m in range(2, distance + 2)] if distance else [[list(range(BITS))]]
    masks = [_mask(g) for layout in layouts for g in layout]
    keyed = fps.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("part", "value"))
    sizes = keyed.groupBy("part", "value").agg(F.count("*").alias("c"))
    counted = {r["part"]: float(r["s"] or 0) for r in sizes.groupBy("part").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("s")).collect()}
    options, at = [], 0
    for layout in layouts:
        costs = []
        for group in layout:
            c0, at = counted.get(at, 0.0), at + 1
            part = [0.0]
            for t in range(distance + 1):
                sets = [s for s in combinations(group, t)]
                est = sum(np.prod([1 / agree[b] for b in s]) for s in sets) * max(c0, 1e-3)
                part.append(est + PROBE_COST * n * len(sets))
            costs.append(part)
        chosen = allocate(costs, distance)
        options.append((sum(c[t + 1] for c, t in zip(costs, chosen)), [(g, t) for g, t in zip(layout, chosen) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, a < b or from one centre, that connect all within ``distance`` bits.

    Every pair within the distance is linked or connected through links, and every link is
    verified.  Small buckets are compared pair by pair; members of larger ones are connected
    through the fingerprints half the distance around them, in rows in proportion to the members.
    The distance is even; an odd one is an error.
    """
    probes = [(k, _mask(group), [_mask(s) for s in combinations(group, t)]) for k, (group, t) in enumerate(plan(fps, distance))]
    keys = [F.struct(F.lit(k * 4096 + i).alias("slot"), F.col("fp").bitwiseAND(F.lit(mask & ~aside)).alias("value")) for k, mask, sets in probes for i, aside in enumerate(sets)]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.slot", "key.value")
    sizes = keyed.groupBy("slot", "value").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stage(keyed.join(sizes, ["slot", "value"]), "buckets")
    small = shared.filter(f"n <= {PAIRWISE}").groupBy("slot", "value").agg(F.collect_list("fp").alias("fps"))
    near = f"flatten(transform(fps, x -> transform(filter(fps, y -> y > x and bit_count(x ^ y) <= {distance}), y -> struct(x as a, y as b))))"
    pairs = small.select(F.explode(F.expr(near)).alias("p")).select("p.a", "p.b")
    large = shared.filter(f"n > {PAIRWISE}").select("fp").distinct()
    return pairs.unionByName(_by_centres(large, distance)).distinct()


def _by_centres(fps: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints that have a common centre within half of an even distance.

    Two fingerprints are within 2r bits exactly if some fingerprint is within r of both.  All
    around a centre are linked to the smallest of them.
    """
    if distance % 2:
        raise ValueError("an odd distance has no common centre")
    masks = [_mask(s) for t in range(distance // 2 + 1) for s in combinations(range(BITS), t)]
    around = fps.select("fp", F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: m.bitwiseXOR(F.col("fp")))).alias("centre"))
    least = around.groupBy("centre").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").select("centre", "b")
    return around.join(least, "centre").filter("fp <> b").select(F.col("b").alias("a"), F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, h, fp, component_id, root): a row a document.

    ``component_id`` is the smallest doc_id that linked fingerprints reach, ``root`` the
    smallest fingerprint.  Documents of one fingerprint are one node, so copies cost one row
    before any comparison.  Null and empty texts have fingerprint 0 and are linked like any
    other; repeated rows are returned each; a null doc_id counts as larger than any other
    (the component_id is null where all are null).  An empty table gives no row.  An odd
    distance is an error.
    """
    rows = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(links(nodes, distance))
    classes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of = classes.join(least, "root").select("fp", "root", "component_id")
    return rows.join(of, "fp").select("doc_id", "h", "fp", "component_id", "root")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def rows_of(docs: DataFrame, best: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each (none, doc_id, h) in the column ``best``."""
    key, hash_ = fresh(docs, "__id", "__h")
    chosen = best.select(F.col("best.doc_id").alias(key + "_"), F.col("best.h").alias(hash_ + "_"))
    keyed = docs.withColumns({key: F.col(id_col).cast("long"), hash_: F.xxhash64(text_col)})
    kept = keyed.join(chosen, keyed[key].eqNullSafe(chosen[key + "_"]) & (keyed[hash_] == chosen[hash_ + "_"]), "left_semi")
    return kept.dropDuplicates([key, hash_]).drop(key, hash_)


def keep_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group that a Jaccard similarity of 0.8 on five-word shingles connects.

    The fingerprints of the shingle sets are probed as in ``links``, and what meets is verified
    by its shingles.  Most pairs that similar differ in more bits than can be probed, so an
    exact join then finds the links that the fingerprints leave out (see ``jaccard``).  The row
    with the smallest id, then text hash, stays; null ids come last.  All columns are kept as
    they are.  Texts without a word are alike; an empty table gives no row.
    """
    from kindred.llm import jaccard

    return jaccard.keep_one(docs, id_col, text_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id, then text hash; null ids last.

    All columns are kept as they are.
    """
    found = near_duplicates(docs, id_col, text_col)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("best"))
    return rows_of(docs, best, id_col, text_col)

import collections
import random

import pandas as pd

from kindred.llm import packing


def slow_pack(items, capacity):
    """Best fit, largest first: every open sequence is tried for every item."""
    bins = []
    for now, (size, _, source, cluster) in enumerate(items):
        best = None
        for k, b in enumerate(bins):
            if b["room"] >= size and (source is None or source not in b["s"]) and cluster not in b["c"]:
                if best is None or (b["room"], b["at"]) < (bins[best]["room"], bins[best]["at"]):
                    best = k
        if best is None:
            bins.append({"room": capacity, "s": set(), "c": set()})
            best = len(bins) - 1
        bins[best]["room"] -= size
        bins[best]["at"] = now
        bins[best]["s"].add(source)
        bins[best]["c"].add(cluster)
    return len(bins), sorted(b["room"] for b in bins)


def test_group_against_brute_force():
    for seed in range(8):
        rng = random.Random(seed)
        n, capacity = 300, 100
        rows = [(i, rng.randrange(99), rng.choice([None, "a", "b", "c", f"u{i}"]), rng.randrange(200 if seed % 2 else 20), rng.randrange(1, capacity)) for i in range(n)]
        frame = pd.DataFrame(rows, columns=["doc_id", "h", "source", "cluster", "size"]).assign(shard=3)
        got = packing.pack_group(frame, capacity)
        items = sorted(((r[4], r[0], r[2], r[3]) for r in rows), key=lambda x: (-x[0], x[1]))
        used = got.groupby("bin_id")["n_bytes"].sum()
        count, rooms = slow_pack(items, capacity)
        assert len(used) == count
        assert abs(sum(capacity - u for u in used) - sum(rooms)) == 0


def test_whole_table(spark):
    rng = random.Random(9)
    rows = [(i, "x" * rng.randrange(0, 3000), rng.choice(["s0", "s0", "s1", f"t{i}", None])) for i in range(700)]
    rows += [(800, "y" * 20_001, "s1"), (801, None, "s1"), (801, None, "s1"), (None, "z" * 50, "s2"), (802, "", "s0"), (803, "é" * 1000, "s0")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, bin_id int").repartition(3)
    got = packing.pack(docs, capacity=4096, group=128).collect()
    size = collections.Counter()
    for r in got:
        size[r.doc_id] += r.n_bytes
    want = collections.Counter()
    for i, t, _ in rows:
        want[i] += len((t or "").encode()) + 1
    assert size == want
    source, text = {r[0]: r[2] for r in rows}, {r[0]: r[1] for r in rows}
    by = collections.defaultdict(list)
    for r in got:
        by[r.bin_id].append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r.bin_offset)
        assert all(a.bin_offset + a.n_bytes == b.bin_offset for a, b in zip(pieces, pieces[1:]))
        assert pieces[-1].bin_offset + pieces[-1].n_bytes <= 4096
        kinds = [source[r.doc_id] for r in pieces if source[r.doc_id]]
        assert len(kinds) == len(set(kinds))
        texts = [text[r.doc_id] for r in pieces]
        assert len(texts) == len(set(texts))
    assert packing.pack(docs.filter("false")).count() == 0

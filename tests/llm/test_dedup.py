import random

import numpy as np
from pyspark.sql import functions as F

from kindred.llm import components, simhash, substring


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def classes(pairs, nodes):
    parent = {n: n for n in nodes}
    for a, b in pairs:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    return {n: find(parent, n) for n in nodes}


def test_components_by_brute_force(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(500, 500 + i) for i in range(1, 80)]
    pairs = chain + star + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(3, 3), (5, 4)]
    df = spark.createDataFrame(pairs, "a long, b long").repartition(4)
    got = dict(map(tuple, components.connected_components(df).collect()))
    want = classes(pairs, {n for p in pairs for n in p if p[0] != p[1]})
    assert got == want
    assert components.connected_components(df.filter("false")).count() == 0


def slow_fingerprint(text, words=3):
    import re

    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_fingerprints_by_brute_force():
    rng = random.Random(2)
    for text in [None, "", "a", "A b", "É é x", *(" ".join(rng.choice(["Ab", "c", "É", "d\x1fe"]) for _ in range(rng.randrange(30))) for _ in range(60))]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def near(fps, distance):
    found = sorted(set(fps))
    a = np.array(found, dtype=np.int64).view(np.uint64)
    return [(found[i], found[int(j)]) for i in range(len(found)) for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= distance) + i + 1]


def test_links_lose_nothing(spark):
    """Dense clouds make buckets beyond the pairwise size; connections must equal brute force."""
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for centre in [0, rng.getrandbits(64), rng.getrandbits(64)]:
        for _ in range(150):
            x = centre
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    got = [tuple(r) for r in simhash.links(df, 2).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in got)
    assert classes(got, signed) == classes(near(signed, 2), signed)


def test_thresholds_sum_up():
    costs = [[0.0, 5.0, 9.0, 100.0], [0.0, 1.0, 50.0, 200.0], [0.0, 7.0, 8.0, 300.0]]
    chosen = simhash.allocate(costs, 2)
    assert sum(t + 1 for t in chosen) == 3
    assert sum(c[t + 1] for c, t in zip(costs, chosen)) == 9.0


def docs_of(spark):
    rng = random.Random(4)
    base = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400))
    texts = [(i, base if i % 3 else base + f" w{i}") for i in range(1, 60)] + [(100, None), (101, ""), (102, "x"), (102, "x"), (None, "x"), (None, None), (103, base.upper())]
    texts += [(200 + i, " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(50))) for i in range(20)]
    return texts, spark.createDataFrame([(*t, 1, "z") for t in texts], "doc_id long, text string, fp int, root string").repartition(3)


def test_classes_of_documents(spark):
    texts, docs = docs_of(spark)
    got = simhash.near_duplicate_classes(docs).collect()
    assert len(got) == len(texts)
    fps = {t: slow_fingerprint(t) for _, t in texts}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps.values()}
    root = classes(near(signed.values(), 2), signed.values())
    least = {}
    for i, t in texts:
        if i is not None:
            r = root[signed[fps[t]]]
            least[r] = min(least.get(r, i), i)
    want = sorted(((i, f"{fps[t]:016x}", least.get(root[signed[fps[t]]])) for i, t in texts), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert simhash.near_duplicate_classes(docs.filter("false")).count() == 0


def test_one_of_each_group_stays(spark):
    texts, docs = docs_of(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {r.root for r in simhash.near_duplicates(docs).collect()}
    assert kept.count() == len(groups)
    assert {r.doc_id for r in kept.collect()} >= {1, 100, 102}


def words(rng, n):
    return [rng.choice("abcdefghijklmnopqrst") + str(rng.randrange(10_000)) for _ in range(n)]


def test_passages_are_cut_from_all_but_the_first(spark):
    rng = random.Random(5)
    passage = " ".join(words(rng, 70))
    rows = []
    for i in range(40):
        own = words(rng, 60)
        rows.append((i, " ".join(own[:20]) + " " + passage + " " + " ".join(own[20:]) if i % 2 else " ".join(own) + "\nshort line\n" + " ".join(words(rng, 10))))
    rows += [(100, None), (101, ""), (102, rows[1][1]), (102, rows[1][1]), (None, rows[3][1]), (103, "\n".join([" ".join(f"v{k}" for k in range(25))] * 300))]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, unit int, removed string").repartition(4)
    done = substring.drop_repeats(docs, removed_col="cut")
    assert done.columns == [*docs.columns, "cut"]
    got = done.collect()
    assert len(got) == len(rows)
    original = {r[0]: r[1] for r in rows}
    for r in got:
        if r.doc_id is not None and r.doc_id < 40:
            if r.doc_id % 2 == 0 or r.doc_id == 1:
                assert r.text == original[r.doc_id] and not r.cut
            else:
                assert passage not in r.text and len(r.cut) == 1
                gone = original[r.doc_id][r.cut[0].start : r.cut[0].end]
                assert gone in passage and len(gone.split()) >= 35
                assert r.text == substring.without(original[r.doc_id], [tuple(c) for c in r.cut])
    by = {r.doc_id: r for r in got}
    assert by[100].text is None and by[101].text == "" and len({r.text for r in got if r.doc_id == 102}) == 1
    assert len(by[103].text.split()) == 25
    assert substring.drop_repeats(docs.filter("false"), removed_col="cut").count() == 0


def test_repeats_by_brute_force(spark):
    """The units removed are those that stood before, in runs that are long enough."""
    rng = random.Random(6)
    pool = [" ".join(words(rng, rng.randrange(3, 40))) for _ in range(12)]
    rows = [(i, "\n".join(" ".join(rng.sample(pool, 2)) for _ in range(3))) for i in range(30)]
    got = {r.doc_id: [(c.start, c.end) for c in r.removed] for r in substring.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    seen = set()
    for i, text in rows:
        units, spans = substring.text_units([text])[0], substring.unit_spans(text)
        assert [" ".join(u) for u in units] == [" ".join(text[a:b].lower().split()) for a, b in spans]
        old = []
        for k, u in enumerate(units):
            if tuple(u) in seen:
                old.append(k)
            seen.add(tuple(u))
        runs = substring.repeated_runs(old, [len(units[k]) for k in old], substring.MIN_WORDS) if old else []
        assert got[i] == [(spans[a][0], spans[b][1]) for a, b in runs]


def test_cuts_by_definition():
    import hashlib

    rng = random.Random(7)
    lines = [words(rng, rng.randrange(25)) for _ in range(60)] + [["x"] * 9 + ["y"] * 30, []]
    cut = iter(substring.text_units(["\n".join(map(" ".join, lines))])[0])
    for line in lines:
        h = [hashlib.md5(w.encode()).hexdigest()[:8] for w in line]
        want, start = [], 0
        for i in range(len(line)):
            before, after = h[max(0, i - 3) : i], h[i + 1 : i + 4]
            same = next((k for k in range(i) if h[i - k - 1] != h[i]), i)
            if all(h[i] < x for x in before) and all(h[i] <= x for x in after) or same % 8 == 7 or i == len(line) - 1:
                want.append(line[start : i + 1])
                start = i + 1
        assert [next(cut) for _ in want] == want
    assert next(cut, None) is None


def test_digests_tell_units_apart():
    rng = random.Random(8)
    texts = ["\n".join(" ".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(6)) for _ in range(300)] + ["", " \n ", "\n"]
    digest, n, which = substring.unit_digests(texts)
    units = [(k, tuple(u)) for k, found in enumerate(substring.text_units(texts)) for u in found]
    assert which.tolist() == [k for k, _ in units] and n.tolist() == [len(u) for _, u in units]
    assert len({u for _, u in units}) == len(set(digest.tolist())) == len(set(zip(digest.tolist(), (u for _, u in units))))


def test_no_long_line_repeats_and_odd_tables_pass(spark, sf_dir):
    """Afterwards no line of MIN_WORDS words or more, as it stood in the input, is found twice; a very long text is cut alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    long = "\n".join(" ".join(words(random.Random(i), 30)) for i in range(9000))
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(-2, long), (-1, long + "\nend")], "doc_id long, text string"))
    done = {r.doc_id: r.text for r in substring.drop_repeats(docs).collect()}
    assert done[-2] == long and done[-1] == "end"
    seen = {}
    for i, text in sorted(done.items()):
        for line in text.split("\n"):
            found = tuple(line.lower().split())
            if len(found) >= substring.MIN_WORDS:
                assert found not in seen, (i, seen[found])
                seen[found] = i
    clash = docs.limit(3).selectExpr("doc_id", "text", "1 as removed", "2 as __marks")
    assert substring.drop_repeats(clash).columns == ["doc_id", "text", "removed", "__marks", "_removed"]


def test_report_columns(spark, sf_dir):
    found = substring.passage_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert found.columns == ["doc_id", "text", "n_removed", "removed_spans"]
    assert found.filter((F.col("n_removed") > 0) != (F.col("removed_spans") != "")).count() == 0

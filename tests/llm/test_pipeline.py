import corpus_pipeline
from kindred.llm import queries
from kindred.llm.common import stage


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, count = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "test")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= count, name
        count = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.select("doc_id").distinct().count() == count


def test_stages_on_nothing(spark, sf_dir):
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("false")
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, sf_dir).count() == 0, name


def test_odd_documents(spark, sf_dir):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (1, "", "en", "s", 0, 2), (2, "w " * 80, "en", "s", 160, 3), (3, " ".join(f"w{i}" for i in range(90)), None, None, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, removed int")
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, sf_dir).columns == docs.columns, name
    assert corpus_pipeline.near_dedup(spark, docs, sf_dir).count() == 3


def test_registered(spark, duck, sf_dir):
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    found = duck.execute(queries.ORACLES["op7_license_scan"]).fetchall()
    assert len(found) == queries.QUERIES["op7_license_scan"](spark, sf_dir).count()


def test_stages_by_brute_force(spark, duck, sf_dir):
    """Each stage's rows against plain Python (the first against SQL), on what the stage before it kept."""
    import collections

    from test_near_copies import expected
    from test_pii_licenses import base

    from kindred.llm import substring

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)

    found = duck.execute(queries.ORACLES["op3_quality_rules"])
    names = [d[0] for d in found.description]
    kept = {row[names.index("doc_id")] for row in found.fetchall() if row[names.index("kept")]}
    docs = stage(steps["quality rules"](spark, docs, sf_dir), "test")
    assert {r.doc_id for r in docs.collect()} == kept

    first = expected([(i, texts[i]) for i in kept])
    docs = stage(steps["near-dedup"](spark, docs, sf_dir), "test")
    assert {r.doc_id for r in docs.collect()} == first

    seen, cut = set(), {}
    for i in sorted(first):
        units, spans = substring.text_units([texts[i]])[0], substring.unit_spans(texts[i])
        old = []
        for k, u in enumerate(units):
            if tuple(u) in seen:
                old.append(k)
            seen.add(tuple(u))
        runs = substring.repeated_runs(old, [len(units[k]) for k in old], substring.MIN_WORDS) if old else []
        text = substring.without(texts[i], [(spans[a][0], spans[b][1]) for a, b in runs])
        if not runs or text.strip(" "):
            cut[i] = text
    docs = stage(steps["passage dedup"](spark, docs, sf_dir), "test")
    assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {i: (t, len(t)) for i, t in cut.items()}

    clean = {}
    for i, text in cut.items():
        out, at = [], 0
        for start, _, end, kind in base(text):
            if start >= at:
                out += [text[at:start], f"<{kind.upper()}>"]
            at = max(at, end)
        clean[i] = "".join([*out, text[at:]])
    docs = stage(steps["pii"](spark, docs, sf_dir), "test")
    assert {r.doc_id: r.text for r in docs.collect()} == clean

    rows = {r.doc_id: r for r in docs.collect()}
    bins, size = collections.defaultdict(list), collections.Counter()
    for r in steps["packing"](spark, docs, sf_dir).collect():
        bins[r.bin_id].append(r)
        size[r.doc_id] += r.n_bytes
    assert size == {i: len(r.text.encode()) + 1 for i, r in rows.items()}
    for pieces in bins.values():
        assert sum(p.n_bytes for p in pieces) <= 8192
        assert len({rows[p.doc_id].source for p in pieces}) == len(pieces)

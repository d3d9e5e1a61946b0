import hashlib
import random
import re

from pyspark.sql import functions as F

from kindred.llm import licenses, pii

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def test_base_spans_by_brute_force(spark):
    rng = random.Random(3)
    parts = ["a.b@c.de", "x@y", "é", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "0" * 15, "+1 (555) 123-4567", "+12", " ", "@", "..d@e.f", "a@b.c_d@e.f", "5 5", "-", "😀", "\n", "+1+1", "007.08.9.255"]
    rows = [(None, None), (1, ""), (1, ""), (5000, "9" * 50_000), (5001, "a" * 200_000 + "@b.c"), (5002, "1.2.3.4 " * 1000)]
    rows += [(i + 2, "".join(rng.choice(parts) for _ in range(rng.randrange(12)))) for i in range(300)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, spans string")
    got = pii.report(docs).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        spans = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in PATTERNS]
        assert set(filter(None, listed(spans).split(","))) <= set(r.spans.split(","))


def test_contexts_find_new_identifiers(spark):
    rows = [(i, f"some words then call me maybe: +1 (555) 123-{1000 + i} bye {i}x") for i in range(40)]
    rows += [(100, "other thing call me maybe: 555-867-5309 ok"), (101, "nothing here 555-867-5310 ok the end"), (102, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, h int").repartition(3)
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert got[100] == "phone:27:39" and got[101] == "" and got[3] == "phone:31:48"
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[100] == "other thing call me maybe: <PHONE> ok" and texts[102] is None and texts[101] == rows[41][1]


def test_common_words_are_no_pattern(spark):
    """Words that mostly precede something else get no confidence, however many seeds follow them."""
    rows = [(i, f"it was of the +1 (555) 123-{1000 + i}") for i in range(20)] + [(100 + i, "of the people of the world of the sea") for i in range(100)] + [(999, "of the 555-867-5309")]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[999] == ""


def test_shapes_and_secrets(spark):
    """Numbers that look like many valid cards are marked though their check digit fails; quoted values of key words are secrets, and so are codes of their shape."""
    rng = random.Random(5)
    numbers = ["".join(rng.choice("0123456789") for _ in range(16)) for _ in range(60)]
    cards = [n[:15] + next(d for d in "0123456789" if luhn(n[:15] + d)) for n in numbers]
    rows = [(i, f"w{i} some {c} thing") for i, c in enumerate(cards)]
    rows += [(100, "odd " + next(n for n in numbers if not luhn(n)) + " end"), (101, "odd " + "7" * 11 + " end")]
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(38)) + "a7"
    rows += [(200 + i, f'x{i} token = "{key()}"!! y{i}') for i in range(30)] + [(300, f"see {key()}; there"), (301, f"see {key()[:30]}; there"), (302, 'TOKEN: "abcdefghijklmnopq"')]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, rank int, start int").repartition(3)).collect()}
    assert got[100].spans == "card:4:20" and got[100].n_card == 0 and got[100].n_added == 1 and got[101].spans == ""
    assert got[205].spans == "secret:12:52" and got[300].spans == "secret:4:44" and got[301].spans == got[302].spans == ""


def test_very_long_texts_take_linear_time(spark):
    """A dump of numbers on one line and one of addresses on many."""
    numbers, mails = " ".join(f"{i:07d};" for i in range(100_000)), "\n".join(f"m{i}@x.de" for i in range(2_000))
    docs = spark.createDataFrame([(1, numbers), (2, mails), (3, "a" * 3_000_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    assert got[1].spans == got[3].spans == "" and got[2].n_email == 2_000
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[1] == numbers and clean[2] == "\n".join(["<EMAIL>"] * 2_000)


def test_overlapping_spans_are_redacted_once(spark):
    docs = spark.createDataFrame([(1, "call +4111 1111 1111 111 now")], "doc_id long, text string")
    assert "<" in pii.redact(docs).first().text
    assert pii.report(docs.filter("false")).count() == 0 and pii.redact(docs.filter("false")).count() == 0


def slow_scan(text):
    hits = []
    text = text or ""
    units = set(text.split("\n")) | {p for p in re.split(r"\n(?:[^0-9A-Za-z\n]*\n)+", text) if "\n" in p} | ({text} if "\n" in text else set())
    parts = [(licenses.bigrams_of(u), range(len(licenses.TEMPLATES))) for u in units]
    words = licenses.words_of(text)
    for t, word, before, n in licenses.anchors(licenses.TEMPLATES, licenses.THRESHOLD):
        for i in [i for i, w in enumerate(words) if w == word]:
            window = words[max(i - before, 0) : max(i - before, 0) + n]
            parts.append(({f"{x} {y}" for x, y in zip(window, window[1:])}, [t]))
    for a, those in parts:
        for t in those:
            name, template = licenses.TEMPLATES[t]
            b = licenses.bigrams_of(template)
            dice = round(2 * len(a & b) / (len(a) + len(b)), 6)
            if dice >= licenses.THRESHOLD:
                hits.append((-dice, name, t))
    return (min(hits)[1], -min(hits)[0], len({t for _, _, t in hits}), ",".join(sorted({n for _, n, _ in hits}))) if hits else (None, None, 0, "")


def test_licenses_by_brute_force(spark):
    rng = random.Random(8)
    rows = [(None, None), (1, ""), (2, "Released under the MIT license"), (2, "Released under the MIT license"), (3, "\n\n")]
    for i in range(60):
        words = rng.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(["the", "other", "LICENSE"])
        cut = rng.randrange(len(words))
        rows.append((10 + i, "some text before it\n" + " ".join(words[:cut]) + rng.choice([" ", "\n"]) + " ".join(words[cut:]) + "\n\nafter"))
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, license string")
    got = sorted((tuple(r) for r in licenses.scan(docs).collect()), key=str)
    assert got == sorted(((i, *slow_scan(t)) for i, t in rows), key=str)
    assert licenses.scan(docs.filter("false")).count() == 0


def test_pattern_of_words():
    rng = random.Random(1)
    for _ in range(100):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 20))})
        pattern = re.compile(licenses.spelt(words))
        for w in {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(60)} | set(words):
            assert bool(pattern.fullmatch(w)) == (w in words)


def test_wrapped_and_embedded_notices(spark):
    gpl = next(t for n, t in licenses.TEMPLATES if n == "gpl-3.0" and len(t) > 100).split()
    wrapped = "int x;\n/*\n" + "\n".join(" * " + " ".join(gpl[i : i + 9]) for i in range(0, len(gpl), 9)) + "\n *\n * other words here\n */\nint y;"
    inside = "We wrote this. " + "lorem ipsum dolor " * 8 + "Released under the MIT License. " + "sit amet " * 9
    mit = max((t for n, t in licenses.TEMPLATES if n == "mit"), key=len)
    whole = "The MIT License\n\nCopyright (c) 2001 Someone\n\n" + mit.replace(". ", ".\n\n")
    rows = [(1, wrapped), (2, inside), (3, whole), (4, "license " * 50_000), (5, whole.upper().replace("\n", " \r\n"))]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].license == "gpl-3.0" and got[2].license == "mit" and got[3].license == got[5].license == "mit" and got[4].license is None
    assert got[3].dice > 0.95


def test_native_plans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for df in (pii.report(docs), licenses.scan(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    assert docs.select(F.col("doc_id")).count() == pii.report(docs).count()

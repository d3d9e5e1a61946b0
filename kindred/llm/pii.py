"""Personal data: fixed patterns, and patterns bootstrapped from what they find.

Fixed patterns find seeds: the base kinds, and secrets that a key word introduces.  What stands
around a seed and how it looks induces lexical patterns: the two words before it, the two words
after it, and its shape (digits as zeros).  Identifier-like tokens of the same family that a
pattern fits are its instances.  Patterns and instances form a graph whose scores are passed
back and forth: a pattern's confidence is the belief in its instances over all places in the
corpus where it occurs, an instance's belief is what its patterns jointly give it.  Patterns
with enough seeds and confidence mark their instances as personal data of the seeds' kind.

Everything is DataFrame and SQL expressions, and linear in a text's length: the gaps between
matches, from splitting by the same pattern, give offsets and neighbouring words, and running
sums and maxima over a text's matches replace searches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import fresh, stage

#: The base kinds in their order, each with its pattern.  A linear-time form: a
#: match starts at the front of a run of the kind's characters, or where the last match ended.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Secrets: a key word, an assignment and a quoted value; the value is the span.
SECRET = r"(?i)(?:token|secret|password|passwd|api[_-]?key)[\"\x27]?[ \t]*[:=][ \t]*[\"\x27][0-9A-Za-z+/_=-]{16,}[\"\x27]"
SEEDS = (*KINDS, "secret")
#: Tokens with a digit or an at sign, what is cut from their ends, and the families of them that may be identifiers.
TOKEN = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9@]*+[0-9@])[^\x20\x09-\x0D]++"
OPENING, CLOSING = r"^[\"\x27\[{<]+", r"[^0-9A-Za-z]+$"
NUMBER = r"^[(]?[0-9][0-9()./:-]*$"
CODE = r"^[0-9A-Za-z+/_=-]{16,}$"
#: Distinct seeds that a pattern needs, the least confidence, and the rounds of scoring.
SUPPORT, CONFIDENCE, ROUNDS = 5, 0.5, 3
#: Code points on either side of a match in which its pattern's words are looked for.
CONTEXT = 120
_TOKEN_RANK = 9
_BLANK, _INK = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))
    each = F.transform(F.split(digits, ""), lambda d, i: F.when(d == "", 0).otherwise(F.when(i % 2 == 0, d.cast("int")).otherwise(F.pmod(2 * d.cast("int"), F.lit(10)) + F.when(d >= "5", 1).otherwise(0))))
    return F.aggregate(each, F.lit(0), lambda s, v: s + v) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(_digits(match)).between(12, 19), _luhn(match)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return match.rlike("[0-9]") if kind == "secret" else F.lit(True)


def _hint(kind: str, text: Column) -> Column:
    """False only for texts without a match of the kind."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike({"ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "secret": r"[:=][ \t]*[\"\x27]", "token": "[0-9@]"}[kind])


def _matches(text: Column, kind: str, rank: int) -> Column:
    """(rank, value, width, left, right): each match with the gap before it, and a last row without a value.

    ``width`` is the length of gap and match; ``left`` holds the last two words of the gap,
    ``right`` its first two, which follow the match before.
    """
    pattern = {**PATTERNS, "secret": SECRET, "token": TOKEN}[kind]
    words = rf"({_INK}+{_BLANK}+{_INK}+)"

    def pair(piece: Column, where: str) -> Column:
        return F.regexp_replace(F.regexp_extract(F.lower(piece), where, 1), _BLANK + "+", " ")

    def row(match, gap):
        return F.struct(
            F.lit(rank).alias("rank"),
            match.alias("value"),
            (F.length(gap) + F.coalesce(F.length(match), F.lit(0))).alias("width"),
            pair(F.right(gap, F.lit(CONTEXT)), rf"(?:^|{_BLANK}){words}{_BLANK}*$").alias("left"),
            pair(F.left(gap, F.lit(CONTEXT)), rf"^{_BLANK}+{words}(?:{_BLANK}|$)").alias("right"),
        )

    found = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), row)
    return F.when(_hint(kind, text), found).otherwise(F.array().cast("array<struct<rank:int,value:string,width:int,left:string,right:string>>"))


def _family(value: Column) -> Column:
    """The family of an identifier-like token, null for other tokens."""
    number = value.rlike(NUMBER) & (F.length(_digits(value)) >= 7)
    code = value.rlike(CODE) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return F.when(F.contains(value, F.lit("@")) & (F.length(value) >= 5), "at").when(number, "number").when(code, "code")


def _shape(family: Column, value: Column) -> Column:
    """How an identifier looks: digits as zeros, or whether a code is hexadecimal and its length; null for addresses."""
    code = F.concat(F.when(value.rlike("^[0-9A-Fa-f]+$"), "x").otherwise("a"), F.length(value).cast("string"))
    return F.when(family == "number", F.regexp_replace(value, "[0-9]", "0")).when(family == "code", code)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))


def observe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, start, end, rank, seed, family, value, patterns): seeds, and identifier-like tokens outside them.

    One pass over the texts, whose matches become rows; rows with the same id and text count
    once.  A text without a match gives no row.  Positions are running sums over the matches
    of a kind, and a token is free if no seed's end before it, or start after it, reaches in.
    """
    text = F.col("text")
    each = F.posexplode(F.concat(*(_matches(text, kind, rank) for kind, rank in [*zip(SEEDS, range(9)), ("token", _TOKEN_RANK)])))
    rows = _keyed(docs, id_col, text_col).filter(text.rlike("[0-9@]")).select("doc_id", "h", each.alias("pos", "m")).select("doc_id", "h", "pos", "m.*")
    rows = rows.dropDuplicates(["doc_id", "h", "pos"])
    in_kind = Window.partitionBy("doc_id", "h", "rank").orderBy("pos")
    placed = rows.withColumns({"end": F.sum("width").over(in_kind).cast("int"), "after": F.lead("right").over(in_kind)}).filter("value is not null")
    inner = F.regexp_extract("value", r"([0-9A-Za-z+/_=-]+)[\"\x27]$", 1)
    is_secret, is_token = F.col("rank") == SEEDS.index("secret"), F.col("rank") == _TOKEN_RANK
    opened = F.regexp_replace("value", OPENING, "")
    cut = F.when(is_secret, inner).when(is_token, F.regexp_replace(opened, CLOSING, "")).otherwise(F.col("value"))
    tail = F.when(is_secret, 1).when(is_token, F.length(opened) - F.length(cut)).otherwise(0)
    placed = placed.select("doc_id", "h", "rank", (F.col("end") - tail).alias("end"), cut.alias("value"), "left", "after")
    valid = F.lit(False)
    for rank, kind in enumerate(SEEDS):
        valid = F.when(F.col("rank") == rank, _valid(kind, F.col("value"))).otherwise(valid)
    seed = F.element_at(F.array(*map(F.lit, SEEDS)), F.least(F.col("rank") + 1, F.lit(len(SEEDS))))
    placed = placed.withColumns({
        "start": F.col("end") - F.length("value"),
        "seed": F.when(~is_token, seed),
        "family": F.when(is_token, _family(F.col("value"))).when(F.col("rank") == 0, "at").when(is_secret, "code").otherwise("number"),
    }).filter(F.when(is_token, F.col("family").isNotNull()).otherwise(valid))
    before = Window.partitionBy("doc_id", "h").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("doc_id", "h").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
    reach = placed.withColumn("reached", F.max(F.when(~is_token, F.col("end"))).over(before)).withColumn("next", F.min(F.when(~is_token, F.col("start"))).over(behind))
    free = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    tagged = [F.when(F.col(c) != "", F.concat(F.lit(tag + " "), F.col(c))) for tag, c in (("L", "left"), ("R", "after"))]
    shaped = F.concat(F.lit("S "), _shape(F.col("family"), F.col("value")))
    patterns = F.filter(F.array(*tagged, shaped), lambda p: p.isNotNull())
    return reach.filter(~is_token | free).select("doc_id", "h", "start", "end", "rank", "seed", "family", F.xxhash64("value").alias("value"), patterns.alias("patterns"))


def word_pairs(docs: DataFrame, text_col: str) -> DataFrame:
    """(words): every pair of neighbouring words of every text, lower case, once for each place."""
    words = F.filter(F.split(F.lower(F.col(text_col)), r"\s+"), lambda w: w != "")
    lines = docs.filter(F.col(text_col).isNotNull()).select(words.alias("w")).filter("size(w) > 1")
    return lines.select(F.explode(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b))).alias("words"))


def discover(docs: DataFrame, observed: DataFrame, text_col: str, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, h, start, end, rank) of identifiers that high-confidence patterns add.

    A pattern's kind is that of most of its seeds, of the last in the alphabet among as many;
    a token that patterns of several kinds mark is of the first of them in ``SEEDS``.
    """
    places = observed.select("doc_id", "h", "start", "end", "seed", "family", "value", F.explode("patterns").alias("pattern"))
    edges = places.groupBy("family", "pattern", "value").agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    by_kind = edges.filter("seed is not null").groupBy("family", "pattern", "seed").agg(F.count("*").alias("seeds"))
    best = by_kind.groupBy("family", "pattern").agg(F.max_by("seed", F.struct("seeds", "seed")).alias("kind"), F.sum("seeds").alias("seeds")).filter(F.col("seeds") >= support)
    fresh_ones = edges.filter("seed is null").select("family", "pattern").distinct()
    useful = stage(best.join(fresh_ones, ["family", "pattern"]).withColumn("words", F.when(~F.col("pattern").startswith("S "), F.expr("substring(pattern, 3)"))), "patterns")
    # no words are asked for in small tables, but the texts are read alike at every size: the empty ones keep the join
    asked = useful.filter("words is not null").select("words").distinct().unionByName(docs.sparkSession.range(1).select(F.lit("").alias("words")))
    said = word_pairs(docs, text_col).join(asked, "words").groupBy("words").agg(F.count("*").alias("total"))
    graph = edges.join(useful.join(said, "words", "left"), ["family", "pattern"])
    graph = stage(graph, "graph")
    belief = graph.select("family", "value", F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0).alias("belief")).groupBy("family", "value").agg(F.max("belief").alias("belief"))
    for _ in range(rounds):
        over = F.coalesce(F.max("total"), F.sum("n"))
        trust = graph.join(belief, ["family", "value"]).groupBy("family", "pattern").agg(F.least(F.lit(0.999), F.sum(F.col("n") * F.col("belief")) / over).alias("trust"))
        joint = 1 - F.exp(F.sum(F.log1p(-F.col("trust"))))
        belief = graph.join(trust, ["family", "pattern"]).groupBy("family", "value").agg(F.when(F.max("seed").isNotNull(), 1.0).otherwise(joint).alias("belief"))
    sure = graph.filter("seed is null").join(trust.filter(F.col("trust") >= confidence), ["family", "pattern"]).join(belief.filter(F.col("belief") >= confidence), ["family", "value"])
    sure = sure.select("family", "pattern", "value", _rank(F.col("kind")).alias("rank")).distinct()
    found = places.filter("seed is null").join(sure, ["family", "pattern", "value"])
    return found.groupBy("doc_id", "h", "start", "end").agg(F.min("rank").alias("rank"))


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEEDS)), kind).cast("int") - 1


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, start, end, rank, kind, added): a row a span; texts without one give none.

    ``added`` is false for the base kinds' own matches.  Rows of ``docs`` with the same id and
    text give their spans once.
    """
    observed = stage(observe(docs, id_col, text_col), "observed")
    seeds = observed.filter("seed is not null").select("doc_id", "h", "start", "end", "rank", (F.col("rank") >= len(KINDS)).alias("added"))
    more = discover(docs, observed, text_col).select("doc_id", "h", "start", "end", "rank", F.lit(True).alias("added"))
    return seeds.unionByName(more).withColumn("kind", F.element_at(F.array(*map(F.lit, SEEDS)), F.col("rank") + 1))


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, all spans as kind:start:end,... , and how many were added.

    A row a document, also for null and empty texts, which have no spans, and for repeated
    rows.  An empty table gives no row.
    """
    ordered = F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind", "added")))
    by_doc = spans(docs).groupBy("doc_id", "h").agg(ordered.alias("all")).withColumnsRenamed({"doc_id": "d", "h": "g"})
    rows = _keyed(docs, "doc_id", "text").drop("text")
    joined = rows.join(by_doc, rows["doc_id"].eqNullSafe(by_doc["d"]) & (rows["h"] == by_doc["g"]), "left")
    joined = joined.withColumn("all", F.coalesce("all", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,added:boolean>>")))
    base = F.filter("all", lambda s: ~s["added"])

    def count(kind: str) -> Column:
        return F.size(F.filter("all", lambda s: ~s["added"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return joined.select("doc_id", *map(count, KINDS), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("all")).alias("spans"), F.size(F.filter("all", lambda s: s["added"])).cast("long").alias("n_added"))


def redacted(text: Column, found: Column, end: Column) -> Column:
    """``text`` with each span (start, before, kind) of the ordered array replaced by its kind; ``before`` is the end of the one before, ``end`` the last end."""
    piece = lambda s: F.concat(F.substring(text, s["before"] + 1, s["start"] - s["before"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
    return F.when(found.isNotNull(), F.concat(F.array_join(F.transform(found, piece), ""), F.substring(text, end + 1, F.length(text)))).otherwise(text)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced by its kind; all other columns are kept.

    Of overlapping spans the first names the joint range.
    """
    before = Window.partitionBy("doc_id", "h").orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, -1)
    placed = spans(docs, id_col, text_col).withColumn("before", F.coalesce(F.max("end").over(before), F.lit(0)))
    key, hash_, all_, end = fresh(docs, "__id", "__h", "__spans", "__end")
    first = F.when(F.col("start") >= F.col("before"), F.struct("start", "before", "kind"))
    found = placed.groupBy(F.col("doc_id").alias(key), F.col("h").alias(hash_)).agg(F.array_sort(F.collect_list(first)).alias(all_), F.max("end").alias(end))
    joined = docs.join(found, F.col(id_col).cast("long").eqNullSafe(found[key]) & (F.xxhash64(docs[text_col]) == found[hash_]), "left")
    clean = redacted(docs[text_col], F.col(all_), F.col(end))
    return joined.select(*(clean.alias(c) if c == text_col else docs[c] for c in docs.columns))

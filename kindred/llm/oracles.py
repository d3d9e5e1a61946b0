"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_scan() -> str:
    from kindred.llm.licenses import TEMPLATES, THRESHOLD, anchors

    rows = ", ".join(f"({t}, {_text(name)}, {_text(text)})" for t, (name, text) in enumerate(TEMPLATES))
    places = ", ".join(f"({t}, {_text(w)}, {o}, {m})" for t, w, o, m in anchors(TEMPLATES, THRESHOLD))
    grams = "list_distinct(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))"
    words = "list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
    dice = "round(2.0 * len(list_intersect(s.g, t.g)) / (len(s.g) + len(t.g)), 6)"
    return f"""
WITH template AS (
  SELECT t, name, {grams} AS g FROM (SELECT t, name, {words.format("x")} AS w FROM (VALUES {rows}) v(t, name, x))
),
unit AS (
  SELECT DISTINCT doc_id, u FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS u FROM documents
    UNION ALL
    SELECT doc_id, u FROM (SELECT doc_id, unnest(string_split_regex(text, '\\n(?:[^0-9A-Za-z\\n]*\\n)+')) AS u FROM documents) WHERE contains(u, chr(10))
    UNION ALL
    SELECT doc_id, text FROM documents WHERE contains(text, chr(10))
  )
),
sized AS (SELECT doc_id, u, {grams} AS g FROM (SELECT doc_id, u, {words.format("u")} AS w FROM unit)),
anchor AS (SELECT * FROM (VALUES {places}) v(t, word, o, m)),
doc AS (SELECT doc_id, {words.format("text")} AS w FROM documents WHERE text IS NOT NULL),
mark AS (SELECT doc_id, w, i, w[i + 1] AS word FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM doc)),
win AS (SELECT doc_id, t, {grams} AS g FROM (SELECT doc_id, t, w[greatest(i - o + 1, 1):greatest(i - o + 1, 1) + m - 1] AS w FROM mark JOIN anchor USING (word))),
hit AS (
  SELECT doc_id, t.t, name, {dice} AS dice
  FROM sized s JOIN template t
    ON len(s.g) BETWEEN len(t.g) * {THRESHOLD / (2 - THRESHOLD)!r} - 1e-9 AND len(t.g) * {(2 - THRESHOLD) / THRESHOLD!r} + 1e-9
  UNION ALL
  SELECT doc_id, t.t, name, {dice} AS dice FROM win s JOIN template t ON t.t = s.t
),
good AS (SELECT * FROM hit WHERE dice >= {THRESHOLD}),
best AS (
  SELECT doc_id, arg_min(name, (-dice, name)) AS license, max(dice) AS dice, count(DISTINCT t) AS n_matches, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM good GROUP BY doc_id
)
SELECT d.doc_id, b.license, b.dice, coalesce(b.n_matches, 0) AS n_matches, coalesce(b.licenses, '') AS licenses
FROM documents d LEFT JOIN best b USING (doc_id)
"""


def nearest_neighbours() -> str:
    usable = "len(v) = (SELECT len(embedding) FROM embeddings WHERE len(embedding) > 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0"
    square = "list_transform(range(1, len(q.v) + 1), lambda i: (c.v[i] - q.v[i]) * (c.v[i] - q.v[i]))"
    return f"""
WITH e AS (SELECT * FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL) WHERE {usable}),
q AS (SELECT vec_id, min(v) AS v FROM e WHERE vec_id % 100 = 0 GROUP BY vec_id),
d AS (SELECT q.vec_id AS query_id, c.vec_id, min(sqrt(list_reduce({square}, lambda a, b: a + b))) AS score FROM q JOIN e c ON c.vec_id <> q.vec_id GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS k FROM d)
SELECT query_id, CAST(k AS INT) AS rank, vec_id, score FROM r WHERE k <= 10
"""


def quality_rules() -> str:
    """The counts, and the cutoffs by the same risk control: sums of binomial terms, tested in order."""
    from kindred.llm.quality import ALPHA, DELTA, GRID, LEAST_WORDS, REPEAT_PERCENT, RULES

    step = lambda a, b: f"CAST(least(ceil({a} * {GRID} / CAST(greatest({b}, 1) AS DOUBLE)), {GRID + 1}) AS INT)"
    alpha = ALPHA
    blank = "[\\x09-\\x0D ]"
    term = f"exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({alpha!r}) + (n - i) * ln(1 - {alpha!r}))"
    steps = {"repeats": step("n_repeat_words", "n_words"), "symbols": step("n_symbols", "n_words"), "dup_lines": step("n_dup_lines", "n_lines"), "capitals": step("n_capitals", "n_letters")}
    melt = " UNION ALL ".join(f"SELECT stratum, bad, rest, '{r}' AS rule, {r} AS step FROM held" for r in RULES)
    risks = " UNION ALL ".join(f"SELECT rid, risk FROM f JOIN risk r ON r.stratum = f.stratum AND rule = '{r}' AND r.step = f.{r}" for r in RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, list_filter(string_split_regex(text, '{blank}+'), lambda x: x <> '') AS w FROM d),
win AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(w[1:len(w) - 2]) AS x, unnest(w[2:len(w) - 1]) AS y, unnest(w[3:len(w)]) AS z FROM w WHERE len(w) > 2),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x, y, z) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) o(k) GROUP BY rid),
line AS (SELECT rid, l FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x09-\x0D ]')),
lines AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM line GROUP BY rid),
base AS (
  SELECT d.rid, doc_id, stratum, len(w) AS n_words, length(regexp_replace(text, '{blank}', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(lines.n, 0) AS n_lines, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals, length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)
),
f AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed, {", ".join(f"{v} AS {k}" for k, v in steps.items())} FROM base),
verdict AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT f.*, coalesce(good AND md5(CAST(doc_id AS VARCHAR))[1] >= '4', false) AS holdout, NOT holdout AS rest, coalesce(NOT good, false) AS bad FROM f LEFT JOIN verdict USING (doc_id) WHERE NOT base_failed),
strata AS (SELECT greatest(count(DISTINCT stratum), 1) AS n FROM held WHERE holdout),
melted AS ({melt}),
step AS (SELECT stratum, rule, s AS step FROM (SELECT DISTINCT stratum, rule FROM melted), range(0, {GRID + 2}) x(s)),
share AS (SELECT s.stratum, s.rule, s.step, count(*) FILTER (WHERE bad) * 1000000 // greatest(count(*) FILTER (WHERE rest), 1) AS share FROM step s LEFT JOIN melted m ON m.stratum = s.stratum AND m.rule = s.rule AND m.step >= s.step GROUP BY ALL),
risk AS (SELECT stratum, rule, step, max(share) OVER (PARTITION BY stratum, rule ORDER BY step) AS risk FROM share),
doc AS (SELECT rid, max(risk) AS risk FROM ({risks}) GROUP BY rid),
scored AS (SELECT stratum, holdout, bad, risk FROM held JOIN doc USING (rid)),
tried AS (
  SELECT l.stratum, l.risk AS level, max(n) AS n, count(*) FILTER (WHERE holdout) AS k, count(*) FILTER (WHERE bad) AS caught
  FROM (SELECT DISTINCT stratum, risk FROM scored) l JOIN scored s ON s.stratum = l.stratum AND s.risk >= l.risk
  JOIN (SELECT stratum, count(*) FILTER (WHERE holdout) AS n FROM scored GROUP BY stratum) t ON t.stratum = l.stratum GROUP BY ALL
),
tail AS (SELECT *, CASE WHEN n = 0 THEN 2.0 WHEN k >= n THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: {term})) END AS p FROM tried),
passed AS (SELECT * FROM (SELECT *, bool_and(p <= {DELTA!r} / (SELECT n FROM strata)) OVER (PARTITION BY stratum ORDER BY level DESC) AS ok FROM tail) WHERE ok),
c AS (SELECT stratum, max(level) FILTER (WHERE caught = most) AS level FROM (SELECT *, max(caught) OVER (PARTITION BY stratum) AS most FROM passed) GROUP BY ALL)
SELECT doc_id, n_words, word_chars, CASE WHEN n_words = 0 THEN 0 ELSE n_symbols END AS n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR coalesce(doc.risk >= c.level, false)) AS kept
FROM f LEFT JOIN c USING (stratum) LEFT JOIN doc USING (rid)
"""


def personal_data() -> str:
    """Seeds from plain patterns, and the contextual search with its rounds unrolled."""
    from kindred.llm.pii import CLOSING, CODE, CONFIDENCE, CONTEXT, KINDS, NUMBER, OPENING, ROUNDS, SECRET, SEEDS, SUPPORT

    blank, ink = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "secret": SECRET,
        "tok": ink + "+",
    }
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN (length({digits}) - i) % 2 = 0 THEN CAST({digits}[i] AS INT) ELSE (2 * CAST({digits}[i] AS INT)) % 10 + CAST(CAST({digits}[i] AS INT) >= 5 AS INT) END)) % 10 = 0"
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(nullif(ltrim(p, '0'), '') AS BIGINT), 0) > 255)) = 0",
        "card": f"length({digits}) BETWEEN 12 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "secret": "regexp_matches(value, '[0-9]')",
    }
    two = f"{ink}+{blank}+{ink}+"

    def pair(piece: str, where: str) -> str:
        return f"regexp_replace(regexp_extract(lower({piece}), '{where}', 1), '{blank}+', ' ', 'g')"

    def found(name: str, rank: int) -> str:
        """Matches with their places and the two words of the gaps on either side."""
        pattern = patterns[name]
        gaps = f"string_split_regex(text, '{pattern}')"
        if name == "tok":  # a token without a digit or an at sign is part of the gap
            gaps = "NULL"
            return f"""
tok_l AS (SELECT rid, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS g FROM d WHERE regexp_matches(text, '[0-9@]')),
tok_u AS (SELECT rid, unnest(m) AS value, unnest(g[1:len(m)]) AS gap, unnest(range(1, len(m) + 1)) AS i FROM tok_l),
tok_e AS (SELECT rid, value, CAST(sum(length(value) + length(gap)) OVER (PARTITION BY rid ORDER BY i) AS INT) AS stop FROM tok_u),
tok_p AS (SELECT rid, value, stop, coalesce(lag(stop) OVER w, 0) AS had, lead(stop - length(value)) OVER w AS next FROM tok_e WHERE regexp_matches(value, '[0-9@]') WINDOW w AS (PARTITION BY rid ORDER BY stop)),
tok AS (SELECT rid, stop, value, text[had + 1 : stop - length(value)] AS gap, text[stop + 1 : coalesce(next, length(text))] AS later FROM tok_p JOIN d USING (rid))"""
        cut = "regexp_extract(value, '([0-9A-Za-z+/_=-]+)[\"\\x27]$', 1)" if name == "secret" else "value"
        stop = "stop - 1" if name == "secret" else "stop"
        return f"""
{name}_l AS (SELECT rid, regexp_extract_all(text, '{pattern}') AS m, {gaps} AS g FROM d WHERE regexp_matches(text, '[0-9@]')),
{name}_u AS (SELECT rid, unnest(m) AS value, unnest(g[1:len(m)]) AS gap, unnest(g[2:len(m) + 1]) AS later, unnest(range(1, len(m) + 1)) AS i FROM {name}_l),
{name}_e AS (SELECT rid, value, gap, later, CAST(sum(length(value) + length(gap)) OVER (PARTITION BY rid ORDER BY i) AS INT) AS stop FROM {name}_u),
{name} AS (SELECT rid, {stop} AS stop, {cut} AS value, gap, later, {rank} AS rank, '{name}' AS kind FROM {name}_e)"""

    seeds = ",".join(found(k, r) for r, k in enumerate(SEEDS))
    seed = " UNION ALL ".join(f"SELECT *, stop - length(value) AS start FROM {k} WHERE {valid[k]}" for k in SEEDS)
    number = f"regexp_matches(value, '{NUMBER}') AND length({digits}) >= 7"
    code = f"regexp_matches(value, '{CODE}') AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')"
    shape = "CASE family WHEN 'number' THEN regexp_replace(value, '[0-9]', '0', 'g') WHEN 'code' THEN CASE WHEN regexp_matches(value, '^[0-9A-Fa-f]+$') THEN 'x' ELSE 'a' END || length(value) END"
    left = pair(f"right(gap, {CONTEXT})", f"(?:^|{blank})({two}){blank}*$")
    after = pair(f"left(later, {CONTEXT})", f"^{blank}+({two})(?:{blank}|$)")
    rounds = "b0 AS (SELECT family, value, max(CAST(seed IS NOT NULL AS INT)) * 1.0 AS belief FROM graph GROUP BY ALL)"
    for k in range(ROUNDS):
        rounds += f""",
t{k} AS (SELECT family, pattern, least(0.999, sum(n * belief) / coalesce(max(total), sum(n))) AS trust FROM graph JOIN b{k} USING (family, value) GROUP BY ALL),
b{k + 1} AS (SELECT family, value, CASE WHEN max(seed) IS NOT NULL THEN 1.0 ELSE 1 - exp(sum(ln(1 - trust))) END AS belief FROM graph JOIN t{k} USING (family, pattern) GROUP BY ALL)"""
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in KINDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),{seeds},{found("tok", 9)},
seed AS ({seed}),
base AS (SELECT * FROM seed WHERE rank < {len(KINDS)}),
opened AS (SELECT rid, stop, gap, later, regexp_replace(value, '{OPENING}', '') AS whole, regexp_replace(whole, '{CLOSING}', '') AS value FROM tok),
free AS (SELECT rid, stop - length(whole) AS start, stop - length(whole) + length(value) AS stop, value, gap, later, CASE WHEN contains(value, '@') AND length(value) >= 5 THEN 'at' WHEN {number} THEN 'number' WHEN {code} THEN 'code' END AS family FROM opened),
seen AS (
  SELECT rid, start, stop, value, gap, later, kind AS seed, CASE kind WHEN 'email' THEN 'at' WHEN 'secret' THEN 'code' ELSE 'number' END AS family FROM seed
  UNION ALL
  SELECT rid, start, stop, value, gap, later, NULL, family FROM free f WHERE family IS NOT NULL AND NOT EXISTS (SELECT 1 FROM seed b WHERE b.rid = f.rid AND b.start < f.stop AND f.start < b.stop)
),
worded AS (SELECT rid, start, stop, value, seed, family, 'L ' || nullif({left}, '') AS l, 'R ' || nullif({after}, '') AS r, 'S ' || ({shape}) AS s FROM seen),
place AS (SELECT rid, start, stop, value, seed, family, pattern FROM (SELECT rid, start, stop, value, seed, family, unnest([l, r, s]) AS pattern FROM worded) WHERE pattern IS NOT NULL),
edge AS (SELECT family, pattern, value, max(seed) AS seed, count(*) AS n FROM place GROUP BY ALL),
kinds AS (SELECT family, pattern, seed, count(*) AS seeds FROM edge WHERE seed IS NOT NULL GROUP BY ALL),
best AS (SELECT family, pattern, arg_max(seed, (seeds, seed)) AS kind FROM kinds GROUP BY ALL HAVING sum(seeds) >= {SUPPORT}),
useful AS (SELECT *, CASE WHEN NOT starts_with(pattern, 'S ') THEN pattern[3:] END AS words FROM best SEMI JOIN (SELECT family, pattern FROM edge WHERE seed IS NULL) USING (family, pattern)),
lw AS (SELECT rid, list_filter(string_split_regex(lower(text), '{blank}+'), lambda w: w <> '') AS w FROM d),
pair AS (SELECT a || ' ' || b AS words FROM (SELECT unnest(w[1:len(w) - 1]) AS a, unnest(w[2:len(w)]) AS b FROM lw WHERE len(w) > 1)),
total AS (SELECT words, count(*) AS total FROM pair SEMI JOIN (SELECT words FROM useful WHERE words IS NOT NULL) USING (words) GROUP BY words),
graph AS (SELECT edge.*, kind, total FROM edge JOIN useful USING (family, pattern) LEFT JOIN total USING (words)),
{rounds},
sure AS (SELECT DISTINCT family, pattern, value, kind FROM graph JOIN t{ROUNDS - 1} USING (family, pattern) JOIN b{ROUNDS} USING (family, value) WHERE seed IS NULL AND trust >= {CONFIDENCE} AND belief >= {CONFIDENCE}),
more AS (SELECT rid, start, stop, min(list_position({list(SEEDS)!r}, s.kind) - 1) AS rank FROM place p JOIN sure s USING (family, pattern, value) WHERE p.seed IS NULL GROUP BY ALL),
extra AS (SELECT rid, start, stop, rank, kind FROM seed WHERE rank >= {len(KINDS)} UNION ALL SELECT rid, start, stop, rank, ({list(SEEDS)!r})[rank + 1] FROM more),
every AS (SELECT rid, start, stop, rank, kind FROM base UNION ALL FROM extra),
b AS (SELECT rid, {counts}, {listed} AS l FROM base GROUP BY rid),
e AS (SELECT rid, {listed} AS l FROM every GROUP BY rid),
m AS (SELECT rid, count(*) AS n FROM extra GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(b.l, '')) AS base_sha256, coalesce(e.l, '') AS spans, coalesce(m.n, 0) AS n_added
FROM d LEFT JOIN b USING (rid) LEFT JOIN e USING (rid) LEFT JOIN m USING (rid)
"""


def passages() -> str:
    """Units, first occurrences, runs and the cut texts, by window functions."""
    from kindred.llm.substring import MIN_WORDS, REACH, SAME

    earlier = " AND ".join(f"(hv < lag(hv, {k}) OVER line OR lag(hv, {k}) OVER line IS NULL)" for k in range(1, REACH + 1))
    later = " AND ".join(f"(hv <= lead(hv, {k}) OVER line OR lead(hv, {k}) OVER line IS NULL)" for k in range(1, REACH + 1))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
ln AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(0, len(string_split(text, chr(10))))) AS li FROM d WHERE text <> ''),
lo AS (SELECT *, sum(length(l) + 1) OVER (PARTITION BY rid ORDER BY li) - length(l) - 1 AS base FROM ln),
ws AS (SELECT rid, doc_id, li, base, regexp_extract_all(l, '\\S+') AS m, string_split_regex(l, '\\S+') AS g FROM lo),
wu AS (SELECT rid, doc_id, li, base, unnest(m) AS w, unnest(g[1:len(m)]) AS gap, unnest(range(0, len(m))) AS wi FROM ws WHERE len(m) > 0),
wo AS (SELECT rid, doc_id, li, wi, lower(w) AS w, CAST('0x' || md5(lower(w))[1:8] AS BIGINT) AS hv,
  CAST(base + sum(length(gap) + length(w)) OVER (PARTITION BY rid, li ORDER BY wi) AS BIGINT) AS stop, length(w) AS size FROM wu),
wr AS (SELECT *, {earlier} AND {later} AS least, lead(wi) OVER line IS NULL AS last, coalesce(hv <> lag(hv) OVER line, true) AS fresh FROM wo WINDOW line AS (PARTITION BY rid, li ORDER BY wi)),
wp AS (SELECT *, wi - max(CASE WHEN fresh THEN wi END) OVER (PARTITION BY rid, li ORDER BY wi) AS place FROM wr),
wc AS (SELECT *, least OR last OR place % {SAME} = {SAME - 1} AS cut FROM wp),
wn AS (SELECT *, coalesce(sum(CAST(cut AS INT)) OVER (PARTITION BY rid ORDER BY li, wi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unit FROM wc),
un AS (SELECT rid, doc_id, unit, string_agg(w, ' ' ORDER BY li, wi) AS u, count(*) AS words, min(stop - size) AS start, max(stop) AS stop FROM wn GROUP BY ALL),
old AS (SELECT *, unit - row_number() OVER (PARTITION BY rid ORDER BY unit) AS run FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY doc_id, unit) AS nth FROM un) WHERE nth > 1),
sp AS (SELECT rid, CAST(min(start) AS BIGINT) AS a, CAST(max(stop) AS BIGINT) AS b FROM old GROUP BY rid, run HAVING sum(words) >= {MIN_WORDS}),
st AS (SELECT sp.*, text, a = 0 OR text[a] IN (' ', chr(10)) AS blank, a = 0 OR text[a] = chr(10) AS fresh FROM sp JOIN d USING (rid)),
s1 AS (SELECT *, b + CAST(blank AND text[b + 1] = ' ' AS INT) AS e FROM st),
s2 AS (SELECT *, e + CAST(fresh AND text[e + 1] = chr(10) AS INT) AS resume FROM s1),
s3 AS (SELECT *, coalesce(lag(resume) OVER (PARTITION BY rid ORDER BY a), 0) AS since FROM s2),
s4 AS (SELECT rid, a, b, resume, CASE WHEN text[b + 1] IN ('', chr(10)) THEN rtrim(text[since + 1:a], ' ' || chr(9)) ELSE text[since + 1:a] END AS piece FROM s3),
cuts AS (SELECT rid, string_agg(piece, '' ORDER BY a) AS head, max(resume) AS resume, count(*) AS n, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM s4 GROUP BY rid)
SELECT doc_id, CASE WHEN n IS NULL THEN text ELSE head || text[resume + 1:length(text)] END AS text, coalesce(n, 0) AS n_removed, coalesce(spans, '') AS removed_spans
FROM d LEFT JOIN cuts USING (rid)
"""

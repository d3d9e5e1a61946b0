"""DuckDB SQL for the queries, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from kindred.functions.keys import GENERIC
from kindred.functions.normalize import ADDR_ABBREV, LEGAL, PHONETIC_CLASSES, PHONETIC_DIGRAPHS, STOP, TLD_TAIL, WEB
from kindred.operators.blocking import FALLBACK_CAP, PRIMARY_CAP
from kindred.operators.features import FUZZY, JARO_WINKLER, NATIVE, ORDER
from kindred.operators.measure import SWEEP_CAPS
from kindred.operators.retrieval import CUTOFF, TOP_K


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _n(x: str) -> str:
    return f"trim(regexp_replace(replace(lower(strip_accents(coalesce({x}, ''))), '&', ' and '), '[^0-9a-z\\x{{0900}}-\\x{{0D7F}}]+', ' ', 'g'))"


def _toks(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda x: x <> '')"


def _phonetic(n: str) -> str:
    s = f"replace({n}, ' ', '')"
    for pair, to in PHONETIC_DIGRAPHS:
        s = f"replace({s}, '{pair}', '{to}')"
    s = f"regexp_replace(regexp_replace({s}, '[aeiou]', '', 'g'), '[^a-z0-9CSFTKPNR]', '', 'g')"
    s = f"translate({s}, '{''.join(PHONETIC_CLASSES.values())}', '{''.join(k * len(v) for k, v in PHONETIC_CLASSES.items())}')"
    for symbol in "SPTKNMRLHY0123456789":
        s = f"regexp_replace({s}, '{symbol}+', '{symbol}', 'g')"
    return s


def _skeleton(n: str) -> str:
    return f"regexp_replace(replace({n}, ' ', ''), '[aeiou]', '', 'g')"


_ABBREV = "CASE x " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ADDR_ABBREV.items()) + " ELSE x END"


def _addr_core(n: str) -> str:
    spelt = f"list_transform({_toks(n)}, lambda x: {_ABBREV})"
    drop = f"x NOT IN {_list([*LEGAL, *STOP])}"
    return f"array_to_string(list_filter(string_split(array_to_string(list_filter({spelt}, lambda x: {drop}), ' '), ' '), lambda x: {drop} AND x <> ''), ' ')"


def _name_core_ctes(source: str, n: str, to: str) -> str:
    """CTEs that add n_core to ``source`` from its normalised column ``n``."""
    return f"""
{to}_a AS (SELECT *, {_toks(n)} AS t0 FROM {source}),
{to}_b AS (SELECT *, list_filter(CASE WHEN len(t0) > 1 AND t0[-1] IN {_list(TLD_TAIL)} THEN t0[:-2] ELSE t0 END, lambda x: x NOT IN {_list([*LEGAL, *WEB])}) AS t1 FROM {to}_a),
{to}_c AS (SELECT *, list_filter(t1, lambda x, i: i = 1 OR x <> t1[i - 1]) AS t2 FROM {to}_b),
{to}_d AS (SELECT *, list_filter(t2, lambda x: len(list_filter(t2, lambda y: y = x)) = 1) AS t3 FROM {to}_c),
{to} AS (SELECT * EXCLUDE (t0, t1, t2, t3), array_to_string(CASE WHEN len(t3) > 0 THEN t3 ELSE t2 END, ' ') AS n_core FROM {to}_d)"""


_REC = """
rec AS (
  SELECT CAST(1 + p_partkey % 3 AS INT) AS source, 'S' || CAST(1 + p_partkey % 3 AS VARCHAR) || '-' || CAST(p_partkey AS VARCHAR) AS entity_id,
    CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || CASE WHEN p_partkey // 3 % 2 = 0 THEN '' ELSE ' Inc.' END ELSE upper(CASE WHEN p_partkey // 3 % 7 = 3 THEN p_name[2:] ELSE p_name END) || CASE WHEN p_partkey // 3 % 2 = 0 THEN '' ELSE ' SAS' END END AS business_name,
    CAST(p_size AS VARCHAR) || ' ' || p_brand || ' rd ' || lpad(CAST(p_partkey % 97 AS VARCHAR), 5, '0') AS business_address,
    p_type AS country, p_partkey, p_name, p_brand, p_type
  FROM part
)"""

_NORM = f"""{_REC},
n1 AS (SELECT *, {_n("business_name")} AS n_norm, {_n("business_address")} AS a_norm FROM rec),
{_name_core_ctes("n1", "n_norm", "n2")},
norm AS (SELECT *, {_phonetic("n_norm")} AS n_ph, {_skeleton("n_norm")} AS n_sk, {_addr_core("a_norm")} AS a_core FROM n2)"""

_A = "business_address"
_LAST = f"coalesce(regexp_extract_all({_A}, '[0-9]+')[-1], '')"
_LEAD = f"regexp_extract({_A}, '^\\s*([0-9]+)', 1)"
_ANY = f"regexp_extract({_A}, '([0-9]+)', 1)"
_FIVE = f"regexp_extract({_A}, '([0-9]{{5,6}})', 1)"
_LONG = f"list_filter(string_split(regexp_replace(lower({_A}), '[^a-z0-9]', ' ', 'g'), ' '), lambda x: length(x) >= 3)"
_SIG = f"array_to_string(list_sort({_LONG}), '_')"
_NT = _toks("n_core")
_AT = _toks("a_core")
_FIRST, _FINAL = f"coalesce(({_NT})[1], '')", f"coalesce(({_NT})[-1], '')"
_PLACES = f"list_filter({_AT}, lambda x: length(x) > 3)"
_CITY, _STATE = f"coalesce(({_PLACES})[-1], '')", f"coalesce(({_PLACES})[-2], '')"
_STREET = f"coalesce(list_filter({_AT}, lambda x: length(x) > 2 AND NOT regexp_full_match(x, '[0-9]+'))[1], '')"
_ACRONYM = f"CASE WHEN len({_NT}) >= 2 THEN array_to_string(list_transform({_NT}, lambda x: x[1]), '') ELSE '' END"
_POSTAL = f"coalesce(list_filter(regexp_extract_all({_A}, '[0-9]+'), lambda x: length(x) IN (5, 6))[1], '')"

_RULES = {
    "exact_name": (PRIMARY_CAP, "n_core"),
    "phonetic": (PRIMARY_CAP, "n_ph"),
    "skeleton": (PRIMARY_CAP, "n_sk"),
    "name_postal": (PRIMARY_CAP, f"n_core[1:6] || '|' || {_LAST}"),
    "phonetic_postal": (PRIMARY_CAP, f"n_ph[1:8] || '|' || {_LAST}"),
    "name_street": (PRIMARY_CAP, f"n_core[1:6] || '|' || {_LEAD}"),
    "skeleton_street": (PRIMARY_CAP, f"n_sk[1:8] || '|' || {_LEAD}"),
    "sorted_name": (FALLBACK_CAP, f"array_to_string(list_sort({_NT}), ' ')"),
    "last_street": (FALLBACK_CAP, f"{_FINAL} || '|' || {_LEAD}"),
    "first_street": (FALLBACK_CAP, f"{_FIRST} || '|' || {_LEAD}"),
    "prefix4_street": (FALLBACK_CAP, f"n_core[1:4] || '|' || {_LEAD}"),
    "addr_sig": (FALLBACK_CAP, f"{_LEAD} || '|' || {_SIG}"),
}


def _pairs(names=tuple(_RULES), to: str = "cand") -> str:
    """CTEs of the pairs (rule, s1_id, matched_id) by the named rules."""
    keyed = " UNION ALL ".join(f"SELECT source, entity_id, '{k}' AS rule, {cap} AS cap, country || '|' || {expr} AS key FROM norm" for k, (cap, expr) in _RULES.items() if k in names)
    return f"""
{to}_k AS (SELECT * FROM ({keyed}) WHERE key IS NOT NULL AND length(key) > 0),
{to}_n AS (SELECT source, rule, key, cap, count(*) AS n FROM {to}_k GROUP BY ALL),
{to}_s AS (SELECT l.rule, l.key, r.source AS target, l.n AS n_left, r.n AS n_right FROM {to}_n l JOIN {to}_n r USING (rule, key) WHERE l.source = 1 AND r.source > 1 AND l.n <= l.cap AND r.n <= r.cap),
{to}_p AS (SELECT s.rule, l.entity_id AS s1_id, r.entity_id AS matched_id FROM {to}_s s JOIN {to}_k l ON l.source = 1 AND l.rule = s.rule AND l.key = s.key JOIN {to}_k r ON r.source = s.target AND r.rule = s.rule AND r.key = s.key),
{to} AS (SELECT DISTINCT s1_id, matched_id FROM {to}_p)"""


_TRUTH = """
gt AS (
  SELECT DISTINCT l.entity_id AS s1_id, r.entity_id AS matched_id
  FROM rec l JOIN rec r ON l.p_name = r.p_name AND l.p_type = r.p_type AND l.p_brand[-1] = r.p_brand[-1] WHERE l.source = 1 AND r.source > 1
)"""
_REGISTRY = "CASE WHEN starts_with(matched_id, 'S2-') THEN 's2' WHEN starts_with(matched_id, 'S3-') THEN 's3' ELSE 'unknown' END"
_BUCKET = "CAST('0x' || md5({})[1:8] AS BIGINT)"
_PAIR_BUCKET = _BUCKET.format("s1_id || '|' || matched_id")
_LABEL = f"""{_pairs()},{_TRUTH},
lab AS (SELECT c.s1_id, c.matched_id, {_REGISTRY.replace("matched_id", "c.matched_id")} AS source, CAST(g.s1_id IS NOT NULL AS INT) AS label FROM cand c LEFT JOIN gt g USING (s1_id, matched_id))"""
_TRAIN = f"""{_LABEL},
sampled AS (SELECT * FROM lab WHERE label = 1 OR {_PAIR_BUCKET} % 10 = 0),
train AS (
  SELECT s1_id, matched_id, source, label FROM sampled WHERE label = 1
  UNION
  SELECT s1_id, matched_id, source, label FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY matched_id) AS r FROM sampled WHERE label = 0) WHERE r <= 3
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().strip(",") for c in ctes)


def _share(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / greatest({b}, 1) END"


def _recall(found: str) -> str:
    return f"""
SELECT coalesce(source, 'all') AS source, total, found, round({_share("found", "total")}, 6) AS recall FROM (
  SELECT source, count(*) AS total, count(h.s1_id) AS found FROM (SELECT *, {_REGISTRY} AS source FROM asked) a
  LEFT JOIN (SELECT DISTINCT s1_id, matched_id FROM {found}) h USING (s1_id, matched_id) GROUP BY ROLLUP (source))"""


_INFORMATIVE = f"list_distinct(list_filter(regexp_extract_all(lower(a_core), '[a-z0-9]+'), lambda x: length(x) >= 3 AND x NOT IN {_list(GENERIC)}))"
_ADDRESS = f"""
tok AS (SELECT source, entity_id, country || '|' || t AS key FROM (SELECT source, entity_id, country, unnest({_INFORMATIVE}) AS t FROM norm WHERE country IS NOT NULL)),
idx AS (SELECT key, entity_id AS matched_id FROM tok WHERE source > 1 AND key IN (SELECT key FROM tok WHERE source > 1 GROUP BY key HAVING count(*) <= 100)),
hit AS (SELECT t.key, t.entity_id AS s1_id, i.matched_id FROM tok t JOIN idx i USING (key) WHERE t.source = 1),
over AS (SELECT s1_id, matched_id, count(*) AS token_overlap FROM hit GROUP BY ALL)"""


def _grams(field: str, sublinear: bool) -> str:
    tf = "1 + ln(tf)" if sublinear else "tf"
    grams = "list_concat(" + ", ".join(f"list_transform(range(1, greatest(length({field}) - {n - 2}, 1)), lambda i: {field}[i:i + {n - 1}])" for n in (3, 4, 5)) + ")"
    return f"""
gram AS (SELECT source, entity_id, p_partkey, g, count(*) AS tf FROM (SELECT source, entity_id, p_partkey, unnest({grams}) AS g FROM norm) GROUP BY ALL),
voc AS (SELECT g, count(*) AS df, ln((1.0 + (SELECT count(*) FROM norm WHERE source > 1)) / (1.0 + count(*))) + 1.0 AS idf FROM gram WHERE source > 1 GROUP BY g HAVING count(*) >= 2 ORDER BY sum(tf) DESC, g LIMIT 100000),
raw AS (SELECT source, entity_id, p_partkey, g, ({tf}) * idf AS raw FROM gram JOIN voc USING (g)),
wt AS (SELECT source, entity_id, p_partkey, g, raw / sqrt(sum(raw * raw) OVER (PARTITION BY entity_id)) AS w FROM raw)"""


_TOP = """
dot AS (SELECT q.entity_id AS s1_id, t.entity_id AS matched_id, round(sum(q.w * t.w), 9) AS score FROM wt q JOIN wt t USING (g) WHERE q.source = 1 AND q.p_partkey % 20 = 0 AND t.source > 1 GROUP BY ALL),
best AS (SELECT s1_id, matched_id, score FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, matched_id) AS r FROM dot WHERE score > 0) WHERE r <= 100)"""

_PROFILE = f"""
prof AS (
  SELECT entity_id, country, n_norm, n_core, n_ph, n_sk, a_norm, a_core, business_address, business_name,
    list_distinct(regexp_extract_all(business_name, '[0-9]+')) AS num_name, list_distinct(regexp_extract_all({_A}, '[0-9]+')) AS num_addr,
    {_FIRST} AS tok1, {_ACRONYM} AS acronym, replace(n_core, ' ', '') AS squashed, {_CITY} AS city, {_STATE} AS state,
    {_ANY} AS street_num, {_POSTAL} AS postal, {_STREET} AS street_name, len({_NT}) AS n_tok, {_NT} AS nt, {_AT} AS at
  FROM norm
)"""
_JOINED = "FROM train p JOIN prof l ON l.entity_id = p.s1_id JOIN prof r ON r.entity_id = p.matched_id"


def _overlap(a: str, b: str) -> str:
    x, y = f"list_distinct({a})", f"list_distinct({b})"
    return f"CASE WHEN greatest(len({x}), len({y})) = 0 THEN 1.0 ELSE CAST(len(list_intersect({x}, {y})) AS DOUBLE) / greatest(len({x}), len({y}), 1) END"


def _eq(f: str) -> str:
    return f"l.{f} <> '' AND l.{f} = r.{f}"


def _ne(f: str) -> str:
    return f"l.{f} <> '' AND r.{f} <> '' AND l.{f} <> r.{f}"


_FLAGS = {
    "name_phonetic_eq": _eq("n_ph"),
    "addr_both_empty": "trim(l.a_norm) = '' AND trim(r.a_norm) = ''",
    "addr_one_empty": "(trim(l.a_norm) = '') <> (trim(r.a_norm) = '')",
    "num_any_overlap": "list_has_any(list_concat(l.num_name, l.num_addr), list_concat(r.num_name, r.num_addr))",
    "country_match": "l.country IS NOT DISTINCT FROM r.country",
    "city_match": _eq("city"),
    "city_conflict": _ne("city"),
    "state_conflict": _ne("state"),
    "numeric_conflict": "len(l.num_addr) > 0 AND len(r.num_addr) > 0 AND NOT list_has_any(l.num_addr, r.num_addr)",
    "street_number_match": _eq("street_num"),
    "postal_code_match": _eq("postal"),
    "first_token_match": _eq("tok1"),
    "acronym_match": "l.acronym <> '' AND r.acronym <> '' AND (l.acronym = r.acronym OR l.acronym = r.squashed OR r.acronym = l.squashed)",
    "state_match": _eq("state"),
    "street_name_match": _eq("street_name"),
    "postal_prefix_match": "l.postal <> '' AND r.postal <> '' AND l.postal[1:3] = r.postal[1:3]",
}
_PREFIX = """CASE WHEN least(length(l.squashed), length(r.squashed)) = 0 THEN 0.0 ELSE CAST(coalesce(
  list_min(list_filter(range(1, least(length(l.squashed), length(r.squashed)) + 1), lambda i: l.squashed[i] <> r.squashed[i])) - 1,
  least(length(l.squashed), length(r.squashed))) AS DOUBLE) / greatest(least(length(l.squashed), length(r.squashed)), 1) END"""
_VALUES = {
    "name_len_ratio": "CASE WHEN greatest(length(l.n_norm), length(r.n_norm)) = 0 THEN 1.0 ELSE CAST(least(length(l.n_norm), length(r.n_norm)) AS DOUBLE) / greatest(length(l.n_norm), length(r.n_norm)) END",
    "name_common_tokens": _overlap("l.nt", "r.nt"),
    "addr_common_tokens": _overlap("l.at", "r.at"),
    "addr_num_overlap": _overlap("l.num_addr", "r.num_addr"),
    "num_name_overlap": _overlap("l.num_name", "r.num_name"),
    "token_count_ratio": "CAST(least(l.n_tok, r.n_tok) AS DOUBLE) / greatest(l.n_tok, r.n_tok, 1)",
    "common_prefix_len": _PREFIX,
}


def _as_float(x: str) -> str:
    return f"round(CAST(CAST({x} AS FLOAT) AS DOUBLE), 6)"


def _native() -> str:
    found = {**{k: f"CAST({v} AS INT)" for k, v in _FLAGS.items()}, **_VALUES}
    return ", ".join(f"{_as_float(found[k])} AS {k}" for k in NATIVE)


def _one_jw(f: str) -> str:
    return f"CASE WHEN l.{f} = '' AND r.{f} = '' THEN 1.0 WHEN l.{f} = '' OR r.{f} = '' THEN 0.0 ELSE jaro_winkler_similarity(l.{f}, r.{f}) END"


def _jw() -> str:
    return ", ".join(f"{_as_float(_one_jw(f))} AS {k}" for k, f in JARO_WINKLER.items())


# ---- scorers, from the longest common subsequence ----


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: the bits of a row that fall as the characters of b pass over a."""
    hit = f"coalesce(list_sum(list_transform(range(0, length({a})), lambda i: CASE WHEN ({a})[i + 1] = c THEN CAST(pow(2, i) AS HUGEINT) ELSE 0 END)), 0)::HUGEINT"
    masks = f"list_transform(list_filter(string_split({b}, ''), lambda c: c <> ''), lambda c: {hit})"
    full = f"(CAST(pow(2, length({a})) AS HUGEINT) - 1)"
    return f"(length({a}) - bit_count(list_reduce({masks}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}, {full})))"


def _ratio(a: str, b: str) -> str:
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 ELSE 2.0 * {_lcs(a, b)} / (length({a}) + length({b})) END)"


def _partial(a: str, b: str) -> str:
    """The best ratio of the shorter string and a window of the longer, windows being cut at either end."""

    def best(x: str, y: str) -> str:
        windows = f"list_concat(list_transform(range(1, length({x})), lambda k: ({y})[1:k]), list_transform(range(0, length({y}) - length({x}) + 1), lambda k: ({y})[k + 1:k + length({x})]), list_transform(range(1, length({x})), lambda k: ({y})[length({y}) - k + 1:]))"
        return f"list_max(list_transform(list_distinct({windows}), lambda w: {_ratio(x, 'w')}))"

    return f"""(CASE WHEN {a} = '' OR {b} = '' THEN CAST({a} = {b} AS DOUBLE) WHEN length({a}) = length({b}) THEN greatest({best(a, b)}, {best(b, a)})
  WHEN length({a}) < length({b}) THEN {best(a, b)} ELSE {best(b, a)} END)"""


def _scored(source: str, *names: str) -> str:
    """CTEs that add the named scores to the distinct strings (a, b) of ``source``."""
    joint = lambda x: f"array_to_string(list_sort({x}), ' ')"
    gap = "CAST(common <> '' AS INT)"
    shared, first, second = "length(common)", f"(length(common) + {gap} + length(l))", f"(length(common) + {gap} + length(r))"
    token_set = f"""CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0 WHEN common <> '' AND (l = '' OR r = '') THEN 1.0 ELSE greatest(
  1 - (length(l) + length(r) - 2 * {_lcs("l", "r")}) / CAST({first} + {second} AS DOUBLE),
  CASE WHEN common <> '' THEN 1 - (1 + length(l)) / CAST({shared} + {first} AS DOUBLE) ELSE 0 END, CASE WHEN common <> '' THEN 1 - (1 + length(r)) / CAST({shared} + {second} AS DOUBLE) ELSE 0 END) END"""
    scores = {"plain": _ratio("a", "b"), "token_sort": _ratio("sa", "sb"), "token_set": token_set, "part": _partial("a", "b"), "part_token": f"CASE WHEN common <> '' THEN 1.0 ELSE greatest({_partial('sa', 'sb')}, {_partial('l', 'r')}) END"}
    empty = lambda e: f"CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 ELSE {e} END"
    return f"""
{source}_w AS (SELECT a, b, {_toks("a")} AS ta, {_toks("b")} AS tb, {joint("ta")} AS sa, {joint("tb")} AS sb, {joint("list_intersect(list_distinct(ta), list_distinct(tb))")} AS common,
  {joint("list_distinct(list_filter(ta, lambda x: NOT list_contains(tb, x)))")} AS l, {joint("list_distinct(list_filter(tb, lambda x: NOT list_contains(ta, x)))")} AS r FROM {source}),
{source}_s AS (SELECT a, b, {", ".join(f"{empty(scores[n])} AS {n}" for n in names)} FROM {source}_w)"""


_SCORE_NAMES = {"token_sort": "token_sort", "token_set": "token_set", "partial": "part"}
_TEXT_PAIRS = f"""
txt AS (SELECT DISTINCT a, b FROM (SELECT l.n_norm AS a, r.n_norm AS b {_JOINED} UNION ALL SELECT l.a_norm, r.a_norm {_JOINED})),
{_scored("txt", *_SCORE_NAMES.values())}"""
_WITH_SCORES = f"{_JOINED} JOIN txt_s xn ON xn.a = l.n_norm AND xn.b = r.n_norm JOIN txt_s xa ON xa.a = l.a_norm AND xa.b = r.a_norm"


def _fuzzy() -> str:
    return ", ".join(f"{_as_float(('xn.' if f == 'n_norm' else 'xa.') + _SCORE_NAMES[how])} AS {k}" for k, (how, f) in FUZZY.items())


def _all_features() -> str:
    """The 37 features; three of them follow from others."""
    jw = {k: f"CAST({_one_jw(f)} AS FLOAT)" for k, f in JARO_WINKLER.items()}
    mixed = {
        "name_addr_avg": _as_float(f"({jw['name_jw']} + {jw['addr_jw']}) / 2"),
        "name_core_skeleton_agree": _as_float(f"CAST({jw['name_skeleton_sim']} > CAST(0.85 AS FLOAT) AS INT)"),
        "name_and_addr_strong": _as_float("CAST(CAST(xn.token_sort AS FLOAT) >= CAST(0.9 AS FLOAT) AND CAST(xa.token_sort AS FLOAT) >= CAST(0.7 AS FLOAT) AS INT)"),
    }
    return f"""{_with(_NORM, _TRAIN, _PROFILE, _TEXT_PAIRS)},
each AS (SELECT p.s1_id, p.matched_id, {_native()}, {_jw()}, {_fuzzy()}, {", ".join(f"{v} AS {k}" for k, v in mixed.items())} {_WITH_SCORES})
SELECT s1_id, matched_id, {", ".join(ORDER)} FROM each"""


def _fuzzy_top() -> str:
    spread = "(greatest(length(a), length(b)) / CAST(least(length(a), length(b)) AS DOUBLE))"
    scale = f"(CASE WHEN {spread} <= 8 THEN 0.9 ELSE 0.6 END)"
    weighted = f"CASE WHEN {spread} < 1.5 THEN greatest(plain, 0.95 * greatest(token_sort, token_set)) ELSE greatest(plain, {scale} * part, 0.95 * {scale} * part_token) END"
    return f"""{_with(_REC)},
cl AS (SELECT source, entity_id, p_partkey, trim(regexp_replace(lower(business_name), '[^a-z0-9]+', ' ', 'g')) AS t FROM rec),
qt AS (SELECT q.entity_id AS s1_id, x.entity_id AS matched_id, q.t AS a, x.t AS b FROM cl q, cl x WHERE q.source = 1 AND q.p_partkey % 20 = 0 AND x.source > 1 AND q.t <> '' AND x.t <> ''),
two AS (SELECT DISTINCT a, b FROM qt),{_scored("two", "plain", "token_sort", "token_set", "part", "part_token")},
sc AS (SELECT s1_id, matched_id, round(100 * ({weighted}), 6) AS score FROM qt JOIN two_s USING (a, b))
SELECT s1_id, matched_id, score FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, matched_id) AS k FROM sc WHERE score >= {CUTOFF}) WHERE k <= {TOP_K}"""


_PROXY = f"""
proxy AS (SELECT p.s1_id, p.matched_id, p.label, round((CAST(CAST({_VALUES["name_common_tokens"]} AS FLOAT) AS DOUBLE) + CAST(CAST({_VALUES["addr_common_tokens"]} AS FLOAT) AS DOUBLE)) / 2, 6) AS score {_JOINED})"""

_F05 = "CASE WHEN 0.25 * p + r = 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END"

_SIGNALS = {
    "country": "c", "name": "n", "phonetic": "ph", "skeleton": "sk", "postal": "po", "country_postal": "c AND po", "country_name": "c AND n",
    "country_phonetic": "c AND ph", "country_skeleton": "c AND sk", "name_postal": "n AND po", "phonetic_postal": "ph AND po",
    "skeleton_postal": "sk AND po", "address_core": "ac", "street_number": "nu", "postal_digits": "pd", "prefix4_number": "p4 AND nu",
    "prefix6_number": "p6 AND nu", "phonetic_number": "ph AND phx AND nu", "skeleton_number": "sk AND skx AND nu", "prefix4_postal": "p4 AND pd",
    "prefix6_postal": "p6 AND pd", "address_prefix4": "ac AND p4", "country_number": "c AND nu", "country_digits": "c AND pd",
    "country_prefix4": "c AND p4", "country_prefix6": "c AND p6", "country_tokens": "c AND tk",
}


def _side(expr: str, side: str) -> str:
    return expr.replace(_A, f"{side}.{_A}").replace("n_core", f"{side}.n_core").replace("a_core", f"{side}.a_core")


def _signal_rows() -> str:
    eq = lambda e: f"({_side(e, 'l')} <> '' AND {_side(e, 'l')} = {_side(e, 'r')})"
    tests = f"""
sig AS (SELECT l.country = r.country AS c, l.n_core = r.n_core AS n, l.n_ph = r.n_ph AS ph, l.n_sk = r.n_sk AS sk, l.n_ph <> '' AS phx, l.n_sk <> '' AS skx,
  {eq(_LAST)} AS po, {eq("a_core")} AS ac, {eq(_ANY)} AS nu, {eq(_FIVE)} AS pd, {eq("n_core[1:4]")} AS p4, {eq("n_core[1:6]")} AS p6,
  len(list_intersect({_side(_LONG, "l")}, {_side(_LONG, "r")})) >= 2 AS tk
  FROM gt g JOIN norm l ON l.entity_id = g.s1_id JOIN norm r ON r.entity_id = g.matched_id)"""
    rows = " UNION ALL ".join(f"SELECT '{k}' AS signal, count(*) FILTER (WHERE {v}) AS hits, count(*) AS total FROM sig" for k, v in _SIGNALS.items())
    return f"{_with(_NORM, _TRUTH, tests)} SELECT signal, hits, total, round({_share('hits', 'total')}, 6) AS coverage FROM ({rows})"


def _sweep() -> str:
    base = f"base AS (SELECT source, country, {_ANY} AS num, n_core[1:4] AS p4, n_core[1:6] AS p6, {_SIG} AS sg FROM norm WHERE country IS NOT NULL AND {_ANY} <> '' AND n_core[1:4] <> '')"
    long = "lng AS (" + " UNION ALL ".join(f"SELECT '{k}' AS keys, source, country, num, {c} AS part FROM base" for k, c in (("num_p4", "p4"), ("num_p6", "p6"), ("num_sig", "sg"))) + ")"
    sizes = "cnt AS (SELECT keys, source, country, num, part, count(*) AS n FROM lng GROUP BY ALL), blk AS (SELECT l.keys, r.source AS target, l.n AS n1, r.n AS n2 FROM cnt l JOIN cnt r USING (keys, country, num, part) WHERE l.source = 1 AND r.source > 1)"
    caps = ", ".join(f"({c})" for c in SWEEP_CAPS)
    return f"""{_with(_NORM, base, long, sizes)}
SELECT target, keys, cap, count(*) FILTER (WHERE n1 <= cap AND n2 <= cap) AS blocks, CAST(coalesce(sum(n1 * n2) FILTER (WHERE n1 <= cap AND n2 <= cap), 0) AS BIGINT) AS pairs
FROM blk, (VALUES {caps}) c(cap) GROUP BY ALL"""


_ENTITIES = "SELECT entity_id AS s1_id FROM rec WHERE source = 1"


def _lists(pairs: str, name: str, to: str) -> str:
    return f"""
{to} AS (SELECT e.s1_id AS source1_entity_id, coalesce(l.ids, '') AS {name} FROM (SELECT entity_id AS s1_id FROM rec WHERE source = 1) e
  LEFT JOIN (SELECT s1_id, string_agg(matched_id, ',' ORDER BY matched_id) AS ids FROM {pairs} GROUP BY s1_id) l USING (s1_id))"""


_FLAWED = f"""{_NORM},{_pairs(("addr_sig", "name_postal"), "two")},{_lists("two", "matched_entity_ids", "clean")},
numbered AS (SELECT *, CAST(string_split(source1_entity_id, '-')[2] AS BIGINT) AS k FROM clean),
bent AS (SELECT source1_entity_id, k, CASE WHEN k % 30 = 0 THEN matched_entity_ids || ',S1-0' WHEN k % 42 = 0 THEN matched_entity_ids || ',X-1'
  WHEN k % 21 = 0 AND matched_entity_ids <> '' THEN matched_entity_ids || ',' || matched_entity_ids ELSE matched_entity_ids END AS matched_entity_ids FROM numbered WHERE k % 33 <> 0),
flawed AS (SELECT source1_entity_id, matched_entity_ids FROM bent UNION ALL SELECT source1_entity_id, matched_entity_ids FROM bent WHERE k % 39 = 0)"""
_IDS = "list_filter(string_split(matched_entity_ids, ','), lambda x: x <> '')"
_EACH = f"one AS (SELECT DISTINCT source1_entity_id, unnest({_IDS}) AS id FROM flawed)"

_ENRICHED = "country business_name business_address n_core n_ph n_sk a_core".split()


def _docs(value: str, ctes: str = "") -> str:
    return f"WITH d AS (SELECT doc_id, text, {_n('text')} AS n FROM documents){ctes} SELECT doc_id, {value} AS value FROM d"


def _sampled() -> str:
    return f"""{_with(_REC)}, q AS (SELECT country, count(*) AS n, sum(count(*)) OVER () AS total FROM rec GROUP BY country),
r AS (SELECT country, entity_id, row_number() OVER (PARTITION BY country ORDER BY {_BUCKET.format("entity_id")}, entity_id) AS k FROM rec)
SELECT country, entity_id FROM r JOIN q USING (country) WHERE k <= least(n, greatest(1, CAST(round(least(total, 500) * n / total) AS BIGINT)))"""


def oracles() -> dict[str, str]:
    norm, rec = _with(_NORM), _with(_REC)
    keyed = lambda select: f"{norm} SELECT entity_id, {select} FROM norm"
    dedup_docs = "WITH d0 AS (SELECT doc_id, " + _toks(_n("text")) + " AS t FROM documents), d1 AS (SELECT doc_id, list_filter(t, lambda x, i: i = 1 OR x <> t[i - 1]) AS t FROM d0), c AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest(t) AS w FROM d1) GROUP BY ALL), m AS (SELECT doc_id, list(w) AS twice FROM c WHERE k > 1 GROUP BY doc_id), e AS (SELECT d1.doc_id, t, list_filter(t, lambda x: NOT list_contains(coalesce(twice, []), x)) AS once FROM d1 LEFT JOIN m USING (doc_id))"
    core_docs = _name_core_ctes("d", "n", "dc")
    found = {
        "norm_fold": "SELECT doc_id, lower(strip_accents(text)) AS value FROM documents",
        "norm_translit": _docs("n"),
        # worked out by hand, letter by letter
        "norm_indic": "SELECT CAST(id AS INT) AS id, value FROM (VALUES (0, 'bhaarata'), (1, 'sanskrita'), (2, 'ka la'), (3, '१२'), (4, 'dillee'), (5, 'mumbaai'), (6, 'chennai'), (7, 'kannada'), (8, 'telugu'), (9, 'gujaraata'), (10, 'pa jaaba'), (11, 'tata raama co'), (12, 'duhkha'), (13, '')) v(id, value)",
        "normalize": _docs("n"),
        "token_dedup": dedup_docs + " SELECT doc_id, array_to_string(CASE WHEN len(once) > 0 THEN once ELSE t END, ' ') AS value FROM e",
        "name_core": f"WITH d AS (SELECT doc_id, {_n('text')} AS n FROM documents),{core_docs} SELECT doc_id, n_core AS value FROM dc",
        "addr_core": _docs(_addr_core("n")),
        "skeleton": _docs(_skeleton("n")),
        "phonetic": _docs(_phonetic("n")),
        "num_tokens": "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[0-9]+'))), ',') AS value FROM documents",
        "clean_text": "SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS value FROM documents",
        "informative_tokens": f"WITH d AS (SELECT doc_id, {_addr_core(_n('text'))} AS a_core FROM documents) SELECT doc_id, array_to_string(list_sort({_INFORMATIVE}), ' ') AS value FROM d",
        "normalize_records": f"{norm} SELECT source, entity_id, country, business_name, business_address, n_core, n_ph, n_sk, a_core FROM norm",
        "scan_tsv": f"{rec} SELECT entity_id, business_name, business_address, country FROM rec",
        "scan_filled": f"{rec} SELECT entity_id, business_name, business_address, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE country END AS country FROM rec",
        "scan_ids": f"{rec} SELECT entity_id AS id FROM rec",
        "scan_project": "SELECT p_partkey, p_name FROM part",
        "count_rows": "SELECT count(*) AS n_rows FROM part",
        "filter_prefix": f"{rec} SELECT entity_id, business_name FROM rec WHERE starts_with(entity_id, 'S2-')",
        "derive_source": f"{rec} SELECT entity_id, {_REGISTRY.replace('matched_id', 'entity_id')} AS registry FROM rec",
        "limit_head": f"{rec} SELECT entity_id, business_name FROM rec ORDER BY entity_id LIMIT 100",
        "key_postal_last": keyed(f"{_LAST} AS k"),
        "key_street_lead": keyed(f"{_LEAD} AS k"),
        "key_first_last": keyed(f"{_FIRST} AS first, {_FINAL} AS last"),
        "key_sorted_name": keyed(f"array_to_string(list_sort({_NT}), ' ') AS k"),
        "key_addr_sig": keyed(f"{_SIG} AS k"),
        "key_num_any": keyed(f"{_ANY} AS k"),
        "key_postal_56": keyed(f"{_FIVE} AS k"),
        "key_postal_feat": keyed(f"{_POSTAL} AS k"),
        "key_prefixes": keyed("n_core[1:4] AS p4, n_core[1:6] AS p6, a_core AS address"),
        "addr_city_state": keyed(f"{_CITY} AS city, {_STATE} AS state, {_STREET} AS street"),
        "acronym": keyed(f"{_ACRONYM} AS acronym, replace(n_core, ' ', '') AS squashed, len({_NT}) AS n_tok"),
        "block_sizes": f"{_with(_NORM, _pairs())} SELECT source, rule, key, n FROM cand_n",
        "block_cap": f"{_with(_NORM, _pairs())} SELECT rule, key, target, n_left, n_right FROM cand_s",
        "candidates_all": f"{_with(_NORM, _pairs())} SELECT s1_id, matched_id FROM cand",
        "distinct_pairs": f"{_with(_NORM, _pairs())} SELECT rule, count(*) AS pairs, count(DISTINCT (s1_id, matched_id)) AS distinct_pairs FROM cand_p GROUP BY rule",
        "union_all": f"{rec} SELECT source, entity_id, country FROM rec WHERE source = 2 UNION ALL SELECT source, entity_id, country FROM rec WHERE source = 3",
        "gt_pairs": f"{_with(_REC, _TRUTH)} SELECT s1_id, matched_id, 1 AS is_positive FROM gt",
        "gt_semi_join": f"{_with(_REC, _TRUTH)} SELECT s1_id, matched_id FROM gt WHERE s1_id IN (SELECT entity_id FROM rec WHERE p_partkey % 20 = 0)",
        "label_pairs": f"{_with(_NORM, _LABEL)} SELECT * FROM lab",
        "sort_labeled": f"{_with(_NORM, _LABEL)} SELECT * FROM lab ORDER BY s1_id, source, label DESC, matched_id",
        "negative_sample": f"{_with(_NORM, _TRAIN)} SELECT * FROM sampled",
        "topk_negatives": f"{_with(_NORM, _LABEL)} SELECT s1_id, matched_id, source, label FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY matched_id) AS r FROM lab WHERE label = 0) WHERE r <= 3",
        "training_set": f"{_with(_NORM, _TRAIN)} SELECT * FROM train",
        "proportional_sample": _sampled(),
        "train_val_split": f"{_with(_NORM, _TRAIN)} SELECT s1_id, matched_id, CAST({_BUCKET.format('s1_id')} % 5 = 0 AS INT) AS is_validation FROM train",
        "class_balance": f"{_with(_NORM, _TRAIN)} SELECT positives, negatives, round(greatest(1.0, CAST(negatives AS DOUBLE) / greatest(positives, 1)), 6) AS scale_pos_weight FROM (SELECT count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives FROM train)",
        "missing_positives": f"{_with(_NORM, _TRUTH, _pairs())} SELECT s1_id, matched_id FROM gt EXCEPT SELECT s1_id, matched_id FROM cand",
        "candidate_recall": f"{_with(_NORM, _TRUTH, _pairs())}, asked AS (SELECT * FROM gt) {_recall('cand')}",
        "enrich_pairs": f"{_with(_NORM, _TRUTH)} SELECT s1_id, matched_id, {', '.join(f'l.{c} AS {c}, r.{c} AS {c}_r' for c in _ENRICHED)} FROM gt JOIN norm l ON l.entity_id = s1_id JOIN norm r ON r.entity_id = matched_id",
        "signal_coverage": _signal_rows(),
        "block_size_sweep": _sweep(),
        "addr_index": f"{_with(_NORM, _ADDRESS)} SELECT key, matched_id FROM idx",
        "addr_token_hits": f"{_with(_NORM, _ADDRESS)} SELECT key, s1_id, matched_id FROM hit",
        "addr_token_overlap": f"{_with(_NORM, _ADDRESS)} SELECT * FROM over",
        "addr_topk": f"{_with(_NORM, _ADDRESS)} SELECT s1_id, matched_id, token_overlap FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY token_overlap DESC, matched_id) AS r FROM over) WHERE r <= {TOP_K}",
        "addr_overlap2": f"{_with(_NORM, _TRUTH)} SELECT * FROM (SELECT s1_id, matched_id, len(list_intersect({_side(_LONG, 'l')}, {_side(_LONG, 'r')})) AS shared FROM gt JOIN norm l ON l.entity_id = s1_id JOIN norm r ON r.entity_id = matched_id) WHERE shared >= 2",
        "tfidf_fit": f"{_with(_NORM, _grams('n_core', False))} SELECT g AS gram, df, round(idf, 6) AS idf FROM voc",
        "tfidf_sublinear": f"{_with(_NORM, _grams('n_core', True))} SELECT entity_id AS id, g AS gram, round(w, 6) AS w FROM wt WHERE source > 1",
        "tfidf_topk": f"{_with(_NORM, _grams('n_core', False), _TOP)} SELECT s1_id, matched_id, round(score, 6) AS score FROM best",
        "tfidf_topk_addr": f"{_with(_NORM, _grams('a_core', True), _TOP)} SELECT s1_id, matched_id, round(score, 6) AS score FROM best",
        "retrieval_recall": f"{_with(_NORM, _TRUTH, _grams('a_core', True), _TOP)}, asked AS (SELECT * FROM gt WHERE s1_id IN (SELECT entity_id FROM rec WHERE p_partkey % 20 = 0)) {_recall('best')}",
        "pair_features_native": f"{_with(_NORM, _TRAIN, _PROFILE)} SELECT p.s1_id, p.matched_id, {_native()} {_JOINED}",
        "pair_features_jw": f"{_with(_NORM, _TRAIN, _PROFILE)} SELECT p.s1_id, p.matched_id, {_jw()} {_JOINED}",
        "pair_features_fuzzy": f"{_with(_NORM, _TRAIN, _PROFILE, _TEXT_PAIRS)} SELECT p.s1_id, p.matched_id, {_fuzzy()} {_WITH_SCORES}",
        "pair_features_all": _all_features(),
        "fuzzy_topk": _fuzzy_top(),
        "threshold_sweep": f"""{_with(_NORM, _TRAIN, _PROFILE, _PROXY)},
t AS (SELECT CAST(step AS INT) AS step, (5 + step) / 100.0 AS threshold FROM range(91) x(step)),
c AS (SELECT step, threshold, count(*) FILTER (WHERE label = 1 AND score >= threshold - 1e-9) AS tp, count(*) FILTER (WHERE label = 0 AND score >= threshold - 1e-9) AS fp, count(*) FILTER (WHERE label = 1 AND score < threshold - 1e-9) AS fn FROM t, proxy GROUP BY ALL),
m AS (SELECT *, {_share("tp", "tp + fp")} AS p, {_share("tp", "tp + fn")} AS r FROM c)
SELECT step, round(threshold, 6) AS threshold, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round({_F05}, 6) AS f05 FROM m""",
        "macro_f05": f"""{_with(_NORM, _TRAIN, _PROFILE, _PROXY)},
ok AS (SELECT s1_id, matched_id FROM proxy WHERE score >= 0.7),
e AS (SELECT x.s1_id, (SELECT count(*) FROM ok WHERE ok.s1_id = x.s1_id) AS np, (SELECT count(*) FROM gt WHERE gt.s1_id = x.s1_id) AS nt, (SELECT count(*) FROM ok JOIN gt USING (s1_id, matched_id) WHERE ok.s1_id = x.s1_id) AS tp FROM ({_ENTITIES}) x),
m AS (SELECT np, nt, {_share("tp", "np")} AS p, {_share("tp", "nt")} AS r FROM e)
SELECT count(*) AS entities, round(avg(CASE WHEN np = 0 AND nt = 0 THEN 1.0 ELSE {_F05} END), 6) AS macro_f05 FROM m""",
        "result_lists": f"{_with(_NORM, _pairs(('name_postal',), 'one'), _lists('one', 'matched_entity_ids', 'res'))} SELECT * FROM res",
        "result_file": f"{_with(_NORM, _pairs(('name_postal',), 'one'), _lists('one', 'matched_entity_ids', 'res'))} SELECT * FROM res",
        "validate_rows": f"{rec} SELECT entity_id || chr(9) || country || chr(9) AS value FROM rec WHERE p_partkey % 7 = 0",
        "validate_summary": f"""{_with(_FLAWED, _pairs(("name_postal",), "np"))},
one AS (SELECT source1_entity_id, unnest({_IDS}) AS id FROM flawed),
row_ AS (SELECT row_number() OVER () AS r, source1_entity_id, matched_entity_ids FROM flawed),
extra AS (SELECT DISTINCT r, source1_entity_id FROM (SELECT r, source1_entity_id, unnest({_IDS}) AS id FROM row_) o WHERE NOT EXISTS (SELECT 1 FROM np WHERE np.s1_id = o.source1_entity_id AND np.matched_id = o.id)),
found AS (
  SELECT 'duplicate_rows' AS problem, source1_entity_id AS example FROM flawed GROUP BY source1_entity_id HAVING count(*) > 1
  UNION ALL SELECT 'duplicate_ids', source1_entity_id FROM flawed WHERE len({_IDS}) <> len(list_distinct({_IDS}))
  UNION ALL SELECT CASE WHEN starts_with(id, 'S1-') THEN 'self_match' ELSE 'bad_prefix' END, id FROM one WHERE NOT starts_with(id, 'S2-') AND NOT starts_with(id, 'S3-')
  UNION ALL SELECT 'missing', s1_id FROM ({_ENTITIES}) WHERE s1_id NOT IN (SELECT source1_entity_id FROM flawed)
  UNION ALL SELECT DISTINCT 'unknown', source1_entity_id FROM flawed WHERE source1_entity_id NOT IN ({_ENTITIES})
  UNION ALL SELECT 'unknown_ids', id FROM one WHERE id NOT IN (SELECT entity_id FROM rec)
  UNION ALL SELECT 'not_candidates', source1_entity_id FROM extra)
SELECT problem AS "check", count(*) AS problems, min(example) AS first FROM found GROUP BY ALL""",
        "validate_missing": f"{_with(_FLAWED)} SELECT s1_id AS source1_entity_id, 'missing' AS problem FROM ({_ENTITIES}) WHERE s1_id NOT IN (SELECT source1_entity_id FROM flawed) UNION ALL SELECT DISTINCT source1_entity_id, 'unknown' FROM flawed WHERE source1_entity_id NOT IN ({_ENTITIES})",
        "validate_dupes": f"{_with(_FLAWED)} SELECT source1_entity_id, count(*) AS n FROM flawed GROUP BY ALL HAVING count(*) > 1",
        "validate_repeats": f"{_with(_FLAWED)} SELECT DISTINCT source1_entity_id, CAST(len({_IDS}) - len(list_distinct({_IDS})) AS INT) AS repeats FROM flawed WHERE len({_IDS}) <> len(list_distinct({_IDS}))",
        "validate_prefix": f"{_with(_FLAWED, _EACH)} SELECT source1_entity_id, id, CASE WHEN starts_with(id, 'S1-') THEN 'self_match' ELSE 'bad_prefix' END AS problem FROM one WHERE NOT starts_with(id, 'S2-') AND NOT starts_with(id, 'S3-')",
        "validate_unknown": f"{_with(_FLAWED, _EACH)} SELECT source1_entity_id, id FROM one WHERE id NOT IN (SELECT entity_id FROM rec)",
        "validate_subset": f"""{_with(_FLAWED, _EACH, _pairs(("name_postal",), "np"))}
SELECT source1_entity_id, string_agg(id, ',' ORDER BY id) AS extra FROM one o WHERE NOT EXISTS (SELECT 1 FROM np WHERE np.s1_id = o.source1_entity_id AND np.matched_id = o.id) GROUP BY source1_entity_id""",
        "validate_counts": f"{_with(_FLAWED)} SELECT count(*) AS rows, count(*) FILTER (WHERE len({_IDS}) = 0) AS empty, count(*) FILTER (WHERE len({_IDS}) > 0) AS filled FROM flawed",
    }
    for rule in _RULES:
        found[f"block_{rule}"] = f"{_with(_NORM, _pairs((rule,), 'cand'))} SELECT s1_id, matched_id FROM cand"
    return found

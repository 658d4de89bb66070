"""DuckDB SQL that gives the rows of corpus queries where SQL can: quality rules, suffix dedup, URL filters, the n-gram join, license scans, targets of a mix."""

from __future__ import annotations

from tessera.llm import licenses, mixing, ngramjoin, quality, urlgraph
from tessera.llm.licenses import LOWER, UPPER

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _double(v: float) -> str:
    return f"'{v!r}'::DOUBLE"


# -- quality rules ------------------------------------------------------------------------------------

_QUALITY_BASE = f"""
d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, key) AS n FROM (SELECT r, i, array_to_string(w[i:i + {quality.WINDOW - 1}], ' ') AS key FROM (SELECT r, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) AS i FROM d))),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {quality.WINDOW})) AS p FROM windows WHERE n > 1) GROUP BY r),
stats AS (SELECT r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^!?;:~^_=+@\\\\/]', '', 'g')) AS n_marks
    FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats)
"""
_CUTOFFS = ", ".join(f"({i}, '{r.name}', {k}, {_double(c)})" for i, r in enumerate(quality.RULES) for k, c in enumerate(r.cutoffs()))
_VALUE = "CASE rule " + " ".join(f"WHEN {i} THEN {r.value}" for i, r in enumerate(quality.RULES)) + " END"
_P = _double(quality.ALPHA)
_TAIL = f"list_sum(list_transform(range(0, rejected + 1), lambda i: exp(lgamma(good + 1.0) - lgamma(i + 1.0) - lgamma(good - i + 1.0) + i * ln({_P}) + (good - i) * ln(1 - {_P}))))"

QUALITY = f"""
WITH {_QUALITY_BASE},
cutoffs(rule, name, level, cutoff) AS (VALUES {_CUTOFFS}),
over_ AS (SELECT r, level, rule, name FROM judged, cutoffs WHERE {_VALUE} > cutoff),
good AS (SELECT j.r, j.lang FROM judged j JOIN (SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id) USING (doc_id) WHERE q = 1 AND NOT base_failed),
size AS (SELECT lang, count(*) AS n FROM good GROUP BY lang),
share AS (SELECT {_double(quality.DELTA)} / greatest(count(*), 1) AS s FROM size),
strata AS (SELECT lang, n < ceil(ln(s) / ln(1 - {_P})) AS pooled FROM size, share),
tested AS (SELECT g.r, CASE WHEN pooled THEN NULL ELSE g.lang END AS name, pooled FROM good g JOIN strata s ON s.lang IS NOT DISTINCT FROM g.lang),
counts AS (SELECT t.name, t.pooled, l.level, count(DISTINCT t.r) AS good, count(DISTINCT o.r) AS rejected FROM tested t, (SELECT DISTINCT level FROM cutoffs) l LEFT JOIN over_ o ON o.r = t.r AND o.level = l.level GROUP BY 1, 2, 3),
passing AS (SELECT name, pooled, level, rejected <= {_P} * good AND (rejected >= good OR {_TAIL} <= s) AS ok FROM counts, share),
levels AS (SELECT name, pooled, max(level) AS level FROM (SELECT *, bool_and(ok) OVER (PARTITION BY name, pooled ORDER BY level) AS all_ok FROM passing) WHERE all_ok GROUP BY 1, 2),
of_lang AS (SELECT s.lang, l.level FROM strata s JOIN levels l ON l.pooled = s.pooled AND l.name IS NOT DISTINCT FROM (CASE WHEN s.pooled THEN NULL ELSE s.lang END)),
failed AS (SELECT j.r, string_agg(o.name, ',' ORDER BY o.rule) AS failed_rules FROM judged j JOIN of_lang f ON f.lang IS NOT DISTINCT FROM j.lang JOIN over_ o ON o.r = j.r AND o.level = f.level GROUP BY j.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules FROM judged LEFT JOIN failed USING (r)
"""

# -- suffix dedup -------------------------------------------------------------------------------------

SUFFIX = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, p, row_number() OVER (PARTITION BY m ORDER BY r, p) > 1 AS again FROM (SELECT r, p, md5_number(substr(h, 2 * p + 1, 200)) AS m FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d))),
s AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM w WHERE again),
runs AS (SELECT r, min(p) AS a, max(p) + 100 AS b FROM (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS k FROM s) GROUP BY r, k),
kept AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS from_, a AS to_ FROM runs UNION ALL SELECT d.r, coalesce(max(b), 0), any_value(length(h)) // 2 FROM d LEFT JOIN runs USING (r) GROUP BY d.r),
rest AS (SELECT d.r, string_agg(substr(h, 2 * from_ + 1, 2 * (to_ - from_)), '' ORDER BY from_, to_) AS h2 FROM kept JOIN d USING (r) GROUP BY d.r),
sums AS (SELECT r, sum(b - a) AS n, count(*) AS k FROM runs GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans, sha256(unhex(h2)) AS kept_sha256 FROM d JOIN rest USING (r) LEFT JOIN sums USING (r)
"""

# -- URL filters --------------------------------------------------------------------------------------

_RULES = sorted(urlgraph.RULES, key=lambda r: -len(r[1] + r[2]))


def _host(url: str) -> str:
    return f"translate(regexp_extract(substr({url}, strpos({url}, '://') + 3), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _when(value) -> str:
    return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'" for v, h, p in _RULES) + " END"


#: The walks go on for 80 rounds, after which less than a millionth is still to come.
URLS = f"""
WITH RECURSIVE p AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN {_host("url")} ELSE '' END AS host, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
k AS (SELECT *, {_when(lambda v, h, p: h + p)} AS rule, {_when(lambda v, h, p: v)} AS ruled FROM p),
seeds AS (SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS trust, avg(CASE WHEN ruled = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS distrust FROM k WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\\s*=\\s*["'']?([^"''\\s>]*)', 1)) AS href FROM k),
full_ AS (SELECT src, CASE WHEN starts_with(href, '//') THEN 'http:' || href ELSE href END AS url FROM links WHERE contains(href, '//')),
e0 AS (SELECT src, dst, count(*) AS n FROM (SELECT src, CASE WHEN strpos(url, '://') > 0 THEN {_host("url")} ELSE '' END AS dst FROM full_) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
e1 AS (SELECT 0 AS kind, src, dst, n FROM e0 UNION ALL SELECT 1, dst, src, n FROM e0),
e AS (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS w FROM e1),
walk AS (SELECT 0 AS k, kind, host, (1 - {_double(urlgraph.DAMPING)}) * s AS r FROM (SELECT 0 AS kind, host, trust AS s FROM seeds UNION ALL SELECT 1, host, distrust FROM seeds) WHERE s > 0
    UNION ALL SELECT k + 1, walk.kind, dst, {_double(urlgraph.DAMPING)} * sum(r * w) FROM walk JOIN e ON e.kind = walk.kind AND e.src = walk.host WHERE k < 80 GROUP BY k, walk.kind, dst),
score AS (SELECT host, sum(CASE WHEN kind = 0 THEN r ELSE 0 END) AS trust, sum(CASE WHEN kind = 1 THEN r ELSE 0 END) AS distrust FROM walk GROUP BY host)
SELECT page_id, k.host, path, rule, coalesce(ruled, CASE WHEN coalesce(distrust, 0) - coalesce(trust, 0) > {urlgraph.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust FROM k LEFT JOIN score ON score.host = k.host
"""

# -- n-gram join --------------------------------------------------------------------------------------

_N, _T = ngramjoin.SIZE, ngramjoin.THRESHOLD
JOIN = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, md5_number(array_to_string(w[i:i + {_N - 1}], ' ') || CASE WHEN len(w) < {_N} THEN ' short' ELSE '' END) AS x FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {_N - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.x = b.x AND a.r < b.r JOIN n na ON na.r = a.r JOIN n nb ON nb.r = b.r WHERE {_T.denominator} * least(na.n, nb.n) >= {_T.numerator} * greatest(na.n, nb.n) GROUP BY a.r, b.r, na.n, nb.n HAVING {_T.denominator} * count(*) >= {_T.numerator} * (na.n + nb.n - count(*))),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON both_.a = reach.b),
least_ AS (SELECT a AS r, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, f.doc_id AS component_id FROM d LEFT JOIN n USING (r) JOIN least_ USING (r) JOIN d f ON f.r = least_.c
"""

# -- licenses -----------------------------------------------------------------------------------------


def _list(text: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in text.split()) + "]"


def _places(phrase: str) -> str:
    """Places of a phrase in the list w, from 0."""
    parts = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(phrase.split()))
    return f"list_filter(range(0, len(w)), lambda i: {parts})"


_BASE = ", ".join(f"{_places(p)} AS p{k}" for k, (p, _) in enumerate(licenses.PHRASES))
_NAMES = ", ".join(f"len({_places(p)}) > 0 AS q{k}" for k, (p, _) in enumerate(licenses.NAMES))
_HALF = licenses.BLOCK // 2
_SETS = ", ".join(f"('{k}', list_distinct({_list(t)}), {len(set(t.split()))})" for k, t in licenses.TEMPLATES.items())
_ALL = "list_concat(" + ", ".join(f"p{k}" for k in range(len(licenses.PHRASES))) + ")"
_LABELS = "list_filter([" + ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{x}' END" for k, (_, x) in enumerate(licenses.PHRASES)) + "], lambda x: x IS NOT NULL)"
_NAMED = "list_filter([" + ", ".join(f"CASE WHEN q{k} THEN '{x}' END" for k, (_, x) in enumerate(licenses.NAMES)) + "], lambda x: x IS NOT NULL)"
LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t(label, words, n) AS (VALUES {_SETS}),
blocks AS (SELECT r, w[i + 1:i + {licenses.BLOCK}] AS b FROM (SELECT r, w, unnest(CASE WHEN len(w) <= {licenses.BLOCK} THEN [0] ELSE range(0, len(w) - {_HALF}, {_HALF}) END) AS i FROM d)),
found AS (SELECT r, label, max(len(list_intersect(b, words)) / n) AS score FROM blocks, t GROUP BY 1, 2),
best AS (SELECT r, list(label) AS more, max(score) AS best FROM found JOIN t USING (label) WHERE round(score * n) >= ceil(round({licenses.THRESHOLD} * n, 9)) GROUP BY r),
p AS (SELECT r, doc_id, len(w) AS n_words, {_BASE}, {_NAMES} FROM d)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len({_ALL}) AS BIGINT) AS n_base, CAST(list_min({_ALL}) AS BIGINT) AS first_word, CAST(list_max({_ALL}) AS BIGINT) AS last_word, array_to_string(list_sort(list_distinct({_LABELS})), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat({_LABELS}, {_NAMED}, coalesce(more, [])))), ',') AS labels, CASE WHEN len({_ALL}) > 0 OR len({_NAMED}) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0) END AS score FROM p LEFT JOIN best USING (r)
"""

# -- targets of a mix ---------------------------------------------------------------------------------

_WEIGHT = "CASE rank % " + str(len(mixing.WEIGHTS)) + " " + " ".join(f"WHEN {k} THEN {float(w)}::DOUBLE" for k, w in enumerate(mixing.WEIGHTS)) + " END"
TARGETS = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
src AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
c AS (SELECT source, CAST(n AS BIGINT) AS source_size, rank, {_WEIGHT} AS w, CAST({mixing.MAX_REPEAT} * n AS DOUBLE) AS cap FROM src),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
f AS (SELECT *, max(CASE WHEN cap > w * level THEN level END) OVER () AS final FROM l)
SELECT d.doc_id, d.size, f.source_size, CASE WHEN cap <= w * level THEN cap ELSE w * final END AS target FROM d JOIN f ON f.source IS NOT DISTINCT FROM d.source
"""

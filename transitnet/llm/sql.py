"""DuckDB SQL for the queries of this subpackage that SQL can express.

Left out: op3 and op5 (trained models), op7 (approximate, and its sums round in another order), op8 (draws by Spark's hash),
op9 (a fold over characters), op10 (the merges of a vocabulary). Tests hold those against plain versions.
"""

from transitnet.llm import quality_rules as rules
from transitnet.llm import url_reputation as urls

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], chr(31)) AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, origin) AS (SELECT doc_id, doc_id FROM w UNION SELECT both_ways.b, reach.origin FROM reach JOIN both_ways ON both_ways.a = reach.node)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.origin) AS component_id
FROM w JOIN reach ON reach.node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY 1
"""

_OP4 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents),
keyed AS (SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS key FROM l),
repeated AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY 1
"""


def _rule_sql(what: int) -> str:
    out = "NULL"
    for h, p, v in sorted(reversed(urls.RULES), key=lambda r: len(r[0] + r[1])):
        out = f"CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[what]}' ELSE {out} END"
    return out


def _strength_sql(members: str, above: str) -> str:
    rate = "((good + 0.5) / (n + 1))"
    rho = f"coalesce(((greatest(squares - coalesce(good * good / nullif(n, 0), 0), 0) / ({rate} * (1 - {rate})) - (k - 1)) / nullif(n - k, 0)), 0)"
    return (
        f"SELECT {above}, good, n, CASE WHEN k > 1 THEN CASE WHEN rho > 0 THEN least(greatest((1 - rho) / rho, {urls.WEAKEST}), {urls.STRONGEST}) ELSE {urls.STRONGEST} END ELSE {urls.UNKNOWN} END AS strength "
        f"FROM (SELECT *, {rho} AS rho FROM (SELECT {above}, sum(good) AS good, sum(n) AS n, sum(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS k, sum(coalesce(good * good / nullif(n, 0), 0)) AS squares FROM {members} GROUP BY 1))"
    )


_HOST = f"translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}')"
_SITE = f"regexp_replace(regexp_replace(regexp_replace({_HOST}, '^.*@', ''), ':[0-9]*$', ''), '\\.+$', '')"
_PAGE = "regexp_replace(html, '<[^<>]*>', chr(10), 'g')"
for _code, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
    _PAGE = f"replace({_PAGE}, '{_code}', '{_char}')"


def _longest_sql(text: str) -> str:
    return f"list_max(list_transform(string_split({text}, chr(10)), lambda x: {{'n': length(trim(x, {_SPACE})), 'line': trim(x, {_SPACE})}})).line"


def _labels_sql(site: str, most: int, whole: str) -> str:
    tail = lambda k: f"array_to_string(string_split({site}, '.')[-{k}:], '.')"
    return f"CASE WHEN regexp_matches({site}, '{urls.ADDRESS}') THEN {whole} WHEN regexp_matches({site}, '{urls.TWO_LABELS}') THEN {tail(most + 1)} ELSE {tail(most)} END"


def _bound_sql(a: str, b: str) -> str:
    tail, h = f"{(urls.DEVIATIONS**2 - 3) / 6!r}", f"(2 / (1 / (2 * {a} - 1) + 1 / (2 * {b} - 1)))"
    w = f"({urls.DEVIATIONS!r} * sqrt({tail} + {h}) / {h} - (1 / (2 * {b} - 1) - 1 / (2 * {a} - 1)) * ({tail} + {5 / 6!r} - 2 / (3 * {h})))"
    return f"({a} / ({a} + {b} * exp(2 * {w})))"


_OP2 = f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_SITE} AS site, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path, {_longest_sql(_PAGE)} AS article FROM pages),
y AS (SELECT doc_id, max(quality) AS y FROM labels WHERE quality IS NOT NULL GROUP BY 1),
known AS (SELECT article, avg(y) AS rate FROM (SELECT doc_id, {_longest_sql("text")} AS article FROM documents) JOIN y USING (doc_id) GROUP BY 1),
counted AS (SELECT site, sum(m * rate) AS good, sum(m)::DOUBLE AS n FROM (SELECT site, article, count(*) AS m FROM p WHERE article <> '' AND site <> '' GROUP BY 1, 2) JOIN known USING (article) GROUP BY 1),
hosts AS (SELECT site, coalesce(good, 0.0) AS good, coalesce(n, 0.0) AS n, {_labels_sql("site", 2, "site")} AS domain FROM (SELECT DISTINCT site FROM p) LEFT JOIN counted USING (site)),
domains AS (SELECT *, {_labels_sql("domain", 1, "'address'")} AS suffix FROM ({_strength_sql("hosts", "domain")})),
suffixes AS (SELECT *, 1 AS every FROM ({_strength_sql("domains", "suffix")})),
alls AS ({_strength_sql("suffixes", "every")}),
s AS (SELECT suffixes.suffix, (alls.good + 0.5) / (alls.n + 1) AS m0, (suffixes.good + (alls.good + 0.5) / (alls.n + 1) * alls.strength) / (suffixes.n + alls.strength) AS m, suffixes.strength AS k FROM suffixes, alls),
d AS (SELECT domain, s.m0, (good + s.m * s.k) / (n + s.k) AS m, strength AS k FROM domains JOIN s USING (suffix)),
c AS (SELECT domain, least(greatest(m0, 0.01), 0.99) AS m0, least(greatest(m, 0.01), 0.99) AS m, k FROM d),
h AS (SELECT site, m0, good + m * greatest(k, 1 / least(m, 1 - m)) AS a, n - good + (1 - m) * greatest(k, 1 / least(m, 1 - m)) AS b FROM hosts JOIN c USING (domain)),
u AS (SELECT *, m0 * greatest(a + b, 1 / least(m0, 1 - m0)) AS a0, (1 - m0) * greatest(a + b, 1 / least(m0, 1 - m0)) AS b0 FROM h),
r AS (SELECT site, {_bound_sql("a", "b")} AS bound, {_bound_sql("a0", "b0")} AS usual FROM u)
SELECT page_id, host, path, {_rule_sql(0)} AS rule, coalesce({_rule_sql(1)}, CASE WHEN site <> '' AND bound >= {urls.LEAST_SHARE} * usual THEN 'allow' ELSE 'block' END) AS verdict, round(bound, 6) AS bound
FROM p JOIN r USING (site)
"""

_MARGIN = " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.MARGINS.items())


def _bounds_sql(keys: str) -> str:
    by = f"{keys}, " if keys else ""
    return (
        f"SELECT {by}measure, docs, q75 + {rules.SPREAD} * (q75 - q50) + CASE measure {_MARGIN} END AS bound FROM (SELECT {by}measure, any_value(docs) AS docs, min(most) FILTER (100 * upto >= 50 * docs) AS q50, min(most) FILTER (100 * upto >= 75 * docs) AS q75 "
        f"FROM (SELECT {by}measure, most, sum(n) OVER (PARTITION BY {by}measure) AS docs, sum(n) OVER (PARTITION BY {by}measure ORDER BY bucket) AS upto FROM (SELECT {by}measure, bucket, sum(n) AS n, max(most) AS most FROM sketch GROUP BY {by}measure, bucket)) GROUP BY {by}measure)"
    )


_OP6 = f"""
WITH w AS (SELECT doc_id, coalesce('=' || lang, '') AS lang, coalesce('=' || source, '') AS source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], chr(31)) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY 1),
base AS (SELECT w.doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines FROM w LEFT JOIN l USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
m AS (SELECT doc_id, lang, source, base_failed, unnest(['symbols', 'repeats', 'lines', 'length']) AS measure,
  unnest([1000 * n_symbols // nullif(n_words, 0), 1000 * n_repeat_words // nullif(n_words, 0), 1000 * n_dup_lines // nullif(n_lines, 0), 1000 * word_chars // nullif(n_words, 0)]) AS x FROM b),
sketch AS (SELECT lang, source, measure, CASE WHEN x < 64 THEN x ELSE 32 * (length(bin(x)) - 6) + (x >> (length(bin(x)) - 6)) END AS bucket, count(*) AS n, max(x) AS most FROM m WHERE NOT base_failed AND x IS NOT NULL GROUP BY ALL),
own AS ({_bounds_sql("lang, source")}), lg AS ({_bounds_sql("lang")}), al AS ({_bounds_sql("")}),
pairs AS (SELECT DISTINCT lang, source, measure FROM own),
limits AS (SELECT p.lang, p.source, p.measure, coalesce(CASE WHEN own.docs >= {rules.LEAST_GROUP} THEN own.bound END, CASE WHEN lg.docs >= {rules.LEAST_GROUP} THEN lg.bound END, al.bound) AS bound
  FROM pairs p JOIN own USING (lang, source, measure) JOIN lg ON lg.lang = p.lang AND lg.measure = p.measure JOIN al ON al.measure = p.measure),
far AS (SELECT DISTINCT doc_id FROM m JOIN limits USING (lang, source, measure) WHERE x > bound)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM far) AS kept FROM b
"""

ORACLES: dict[str, str] = {"op1_ngram_jaccard_join": _OP1, "op2_url_reputation": _OP2, "op4_line_dedup": _OP4, "op6_quality_rules": _OP6}

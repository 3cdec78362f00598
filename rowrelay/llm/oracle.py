"""SQL of the registered queries, for those that SQL can express."""

from __future__ import annotations

from html.entities import html5

from rowrelay.llm import licenses, warc

#: The letters that are folded.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
c AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM c)),
dw AS (SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw))),
hit AS (SELECT rid, i, dw.n, dw.win FROM dw JOIN (SELECT DISTINCT n, win FROM iw) k ON k.n = dw.n AND k.win = dw.win),
inside AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item FROM hit JOIN iw ON iw.win = hit.win AND iw.n = hit.n) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN inside USING (rid) LEFT JOIN items USING (rid)
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
      / coalesce(1.0::DOUBLE / (1.0::DOUBLE + 100.0::DOUBLE * (length(text) - length(translate(text, '#*$%&|<>', ''))) / greatest(length(text), 1)), 1.0::DOUBLE) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight FROM s),
f AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio, sum(source_size) OVER () AS sizes, sum(weight) OVER () AS weights,
    row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS place FROM r),
g AS (SELECT *, coalesce(sum(source_size) OVER w, 0) AS size_before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM f WINDOW w AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT *, ratio < (1.5::DOUBLE * CAST(sizes AS DOUBLE) - 2 * CAST(size_before AS DOUBLE)) / CAST(weights - weight_before AS DOUBLE) AS filled FROM g),
l AS (SELECT (1.5::DOUBLE * CAST(max(sizes) AS DOUBLE) - 2 * CAST(coalesce(sum(source_size) FILTER (filled), 0) AS DOUBLE))
    / CAST(max(weights) - coalesce(sum(weight) FILTER (filled), 0) AS DOUBLE) AS level FROM h),
t AS (SELECT source, source_size, round(CASE WHEN filled THEN 2.0::DOUBLE * source_size ELSE level * weight END, 6) AS target FROM h, l),
x AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target - epochs * source_size) AS BIGINT) - before)) AS BIGINT) AS taken
FROM x
"""


_RATIO = licenses.LEAST / (2 - licenses.LEAST)
_TEMPLATES = ", ".join(f"('{name}', '{' '.join(licenses.words_of(text))}')" for name, text in licenses.TEMPLATES.items())
LICENSES = rf"""
WITH t AS (SELECT license, string_split(words, ' ') AS w, len(string_split(words, ' ')) - 1 AS m FROM (VALUES {_TEMPLATES}) v(license, words)),
tg AS (SELECT license, m, gram, count(*) AS times
  FROM (SELECT license, m, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT license, m, w, unnest(range(1, len(w))) AS i FROM t)) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9\n]+', ' ', 'g') AS plain FROM documents),
ln AS (SELECT rid, i, x, string_split(x, ' ') AS w FROM (
    SELECT rid, unnest(xs) AS x, unnest(range(1, len(xs) + 1)) AS i FROM (SELECT rid, list_transform(string_split(plain, chr(10)), lambda x: trim(x)) AS xs FROM d)) WHERE x <> ''),
lg AS (SELECT rid, i, count(*) AS n, count(g.gram) AS hits FROM (SELECT rid, i, w[j] || ' ' || w[j + 1] AS gram FROM (SELECT rid, i, w, unnest(range(1, len(w))) AS j FROM ln)) o
  LEFT JOIN (SELECT DISTINCT gram FROM tg) g USING (gram) GROUP BY rid, i),
lk AS (SELECT rid, i, x, row_number() OVER (PARTITION BY rid ORDER BY i) AS k FROM ln),
st AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS words FROM (
    SELECT rid, i, x, k - row_number() OVER (PARTITION BY rid ORDER BY i) AS island FROM lk JOIN lg USING (rid, i) WHERE 2 * hits >= n) GROUP BY rid, island),
u AS (SELECT rid, words FROM st UNION SELECT DISTINCT rid, unnest(list_concat(
    list_transform(string_split(plain, chr(10)), lambda x: trim(x)),
    list_transform(list_filter(string_split_regex(plain, '\n *\n'), lambda x: contains(x, chr(10))), lambda x: trim(regexp_replace(x, '[ \n]+', ' ', 'g'))),
    [trim(regexp_replace(plain, '[ \n]+', ' ', 'g'))])) AS words FROM d),
n AS (SELECT rid, words, string_split(words, ' ') AS w, length(words) - length(replace(words, ' ', '')) AS n FROM u),
near AS (SELECT rid, words, n, license, m FROM n JOIN t ON least(n, m) >= {_RATIO!r} * greatest(n, m) AND n > 0),
counted AS (SELECT rid, count(DISTINCT words) AS n_units FROM near GROUP BY rid),
ug AS (SELECT rid, words, gram, count(*) AS times FROM (
    SELECT rid, words, w[i] || ' ' || w[i + 1] AS gram
    FROM (SELECT rid, words, w, unnest(range(1, len(w))) AS i FROM n SEMI JOIN near USING (rid, words))) GROUP BY ALL),
shared AS (SELECT rid, words, license, sum(least(ug.times, tg.times)) AS s FROM ug JOIN tg USING (gram) GROUP BY ALL),
dice AS (SELECT rid, license, words, round(2.0::DOUBLE * s / (n + m), 6) AS dice FROM near JOIN shared USING (rid, words, license)),
best AS (SELECT rid, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best_dice
  FROM dice WHERE dice >= {licenses.LEAST} GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, CAST(coalesce(n_matches, 0) AS BIGINT) AS n_matches,
  coalesce(licenses, '') AS licenses, coalesce(best_dice, 0.0::DOUBLE) AS best_dice
FROM d LEFT JOIN counted USING (rid) LEFT JOIN best USING (rid)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(signs: dict[str, str]) -> str:
    return ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in sorted(signs.items()))


def _uuid(*parts: str) -> str:
    code = "md5(" + " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({code}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


_CRLF = "chr(13) || chr(10)"
_LINE = r"trim(regexp_replace({}, '[ \t\r\n\f]+', ' ', 'g'))"
_NAMES = {n[:-1]: t for n, t in html5.items() if n.endswith(";")}
_SHORT = {n: t for n, t in html5.items() if not n.endswith(";")}
_PREFIX = "^(?:" + "|".join(sorted(_SHORT, key=len, reverse=True)) + ")"
_WINDOWS = ", ".join(f"chr({ord(bytes([n]).decode('cp1252', 'ignore') or chr(n))})" for n in range(128, 160))
_QUOTES = _quoted(r"""(?:[^<>"']|"[^"]*"|'[^']*')*""")[1:-1]
_ATTRIBUTE = _quoted(r"""(?s)[\s/"'][^\s"'<>/=]+\s*=\s*(?:"[^"]*|'[^']*|[^\s"'>][^\s>]*)""")
_HREF = _quoted(r"""(?is)^.href\s*=\s*["']?(.*)$""")
_LINES = (
    "html|head|header|body|main|footer|nav|aside|section|article|address|search|hgroup|h1|h2|h3|h4|h5|h6|p|pre|hr|br|blockquote|center|div|"
    "ul|ol|li|menu|dir|dl|dt|dd|table|caption|colgroup|col|thead|tbody|tfoot|tr|th|td|figure|figcaption|details|summary|dialog|"
    "form|fieldset|legend|select|optgroup|option"
)
_OUT = r"(?is)<!--.*?(?:-->|\z)|<script(?:[\s/][^<>]*)?>.*?(?:</script\s*>|\z)|<style(?:[\s/][^<>]*)?>.*?(?:</style\s*>|\z)|<title(?:[\s/][^<>]*)?>.*?(?:</title\s*>|\z)"
WARC = rf"""
WITH names(name, sign) AS (VALUES {_values(_NAMES)}),
short(name, sign) AS (VALUES {_values(_SHORT)}),
p AS (SELECT row_number() OVER () AS rid, page_id, url AS target_uri, coalesce(html, '') AS payload, 'sha256:' || sha256(coalesce(html, '')) AS source_digest FROM pages),
a AS (SELECT rid, unnest(tags) AS tag, unnest(range(1, len(tags) + 1)) AS place
  FROM (SELECT rid, regexp_extract_all(payload, '(?i)<a[\s/]{_QUOTES}>') AS tags FROM p)),
x AS (SELECT rid, 'title' AS kind, CAST(0 AS BIGINT) AS place, regexp_extract(payload, '(?is)<title(?:[\s/][^<>]*)?>(.*?)(?:</title|\z)', 1) AS text FROM p
  UNION ALL SELECT rid, 'text', 0, regexp_replace(regexp_replace(regexp_replace(regexp_replace(payload, {_quoted(_OUT)}, '', 'g'),
    '[ \t\r\n\f]+', ' ', 'g'), '(?i)</?(?:{_LINES})(?:[\s/]{_QUOTES})?>', chr(10), 'g'), '<[A-Za-z/!?]{_QUOTES}>|<[A-Za-z/!?][^<>]*>', '', 'g') FROM p
  UNION ALL SELECT rid, 'link', place, regexp_extract(list_filter(regexp_extract_all(tag, {_ATTRIBUTE}), lambda v: regexp_matches(v, {_HREF}))[1], {_HREF}, 1) FROM a),
y AS (SELECT rid, kind, place, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT *, string_split(text, '&') AS parts FROM x WHERE text IS NOT NULL)),
z AS (SELECT *, regexp_extract(part, '^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)', 1) AS code, regexp_extract(part, '{_PREFIX}') AS prefix FROM y),
n AS (SELECT *, substr(part, length(code) + 1) AS tail, regexp_replace(substr(part, length(code) + 1), '^;', '') AS after, substr(part, length(prefix) + 1) AS behind,
    coalesce(CASE WHEN code[2] IN ('x', 'X') THEN TRY_CAST('0x' || regexp_replace(code, '^#[xX]0*', '') AS BIGINT) ELSE TRY_CAST(regexp_replace(code, '^#0*', '') AS BIGINT) END, 0) AS n FROM z),
u AS (SELECT rid, kind, place, string_agg(CASE WHEN i = 1 THEN part
    WHEN code[1] = '#' AND (n <= 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111) THEN chr(65533) || after
    WHEN code[1] = '#' AND n BETWEEN 128 AND 159 THEN [{_WINDOWS}][n - 127] || after
    WHEN code[1] = '#' AND (n < 9 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534) THEN after
    WHEN code[1] = '#' THEN chr(CAST(n AS INTEGER)) || after
    WHEN tail[1] = ';' AND names.sign IS NOT NULL THEN names.sign || after
    WHEN short.sign IS NOT NULL AND NOT (kind = 'link' AND regexp_matches(behind, '^[=A-Za-z0-9]')) THEN short.sign || behind
    ELSE '&' || part END, '' ORDER BY i) AS text
  FROM n LEFT JOIN names ON names.name = n.code LEFT JOIN short ON short.name = n.prefix GROUP BY rid, kind, place),
v AS (SELECT rid, max({_LINE.format("text")}) FILTER (kind = 'title') AS title, max(replace(text, chr(160), ' ')) FILTER (kind = 'text') AS stripped,
    coalesce(list('outlink: ' || {_LINE.format("text")} ORDER BY place) FILTER (kind = 'link'), []) AS links FROM u GROUP BY rid),
r AS (SELECT *, {_uuid("'response'", "page_id", "target_uri", "source_digest")} AS refers_to FROM p JOIN v USING (rid)),
b AS (SELECT page_id, target_uri, source_digest, refers_to, 'metadata' AS warc_type,
    array_to_string(list_concat(['title: ' || title, 'source-payload-digest: ' || source_digest,
      'source-header: Content-Type: text/html; charset=utf-8', 'source-header: Content-Length: ' || strlen(payload)], links), {_CRLF}) || {_CRLF} AS block FROM r
  UNION ALL SELECT page_id, target_uri, source_digest, refers_to, 'conversion',
    regexp_replace(regexp_replace(regexp_replace(stripped, ' *\n[ \n]*', chr(10), 'g'), ' +', ' ', 'g'), '^[ \n]+|[ \n]+$', '', 'g') FROM r),
c AS (SELECT *, {_uuid("warc_type", "refers_to")} AS record_id, 'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length FROM b)
SELECT page_id, warc_type, record_id, refers_to, target_uri, source_digest, block_digest, content_length,
  sha256(concat_ws({_CRLF}, '{warc.VERSION}', 'WARC-Type: ' || warc_type, 'WARC-Record-ID: ' || record_id, 'WARC-Refers-To: ' || refers_to,
    'WARC-Refers-To-Target-URI: ' || target_uri, 'WARC-Target-URI: ' || target_uri, 'WARC-Date: {warc.DATE}', 'WARC-Block-Digest: ' || block_digest,
    'WARC-Source-Payload-Digest: ' || source_digest,
    'Content-Type: ' || CASE WHEN warc_type = 'conversion' THEN 'text/plain; charset=utf-8' ELSE 'application/warc-fields' END,
    'Content-Length: ' || content_length)) AS header_sha256
FROM c
"""

TOOL_CALLS = r"""
WITH u AS (SELECT CAST(conv_id AS VARCHAR) AS conv, turn, text, conv_id || ':' || turn AS id, conv_id || ':' || (turn - 2) AS after,
    turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
  FROM conversations WHERE role = 'user'),
c AS (SELECT *, row_number() OVER (PARTITION BY conv, turn % 2, island ORDER BY turn) - 1 AS level FROM u),
a AS (SELECT CAST(conv_id AS VARCHAR) AS conv, conv_id || ':' || (turn - 1) AS id, count(*) AS n_results, min(text) AS content
  FROM conversations WHERE role = 'assistant' GROUP BY ALL),
j AS (SELECT c.*, n_results, content FROM c LEFT JOIN a ON a.conv = c.conv AND a.id = c.id)
SELECT conv, id, CASE WHEN n_results > 0 THEN 'linked' ELSE 'unanswered' END AS status, level, false AS cyclic, coalesce(n_results, 0) AS n_results,
  '' AS faults, true AS valid, sha256('{"after":"' || after || '","arguments":{"chars":' || length(text) || ',"text":' || CAST(to_json(text) AS VARCHAR)
    || ',"turn":' || turn || '},"conversation":"' || conv || '","id":"' || id || '","level":' || level || ',"name":"reply","result":'
    || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}') AS json_sha256
FROM j
UNION ALL SELECT conv, id, 'orphan', NULL, false, n_results, 'no call', false,
  sha256('{"conversation":"' || conv || '","id":"' || id || '","result":' || CAST(to_json(content) AS VARCHAR) || '}')
FROM a ANTI JOIN c ON a.conv = c.conv AND a.id = c.id
"""


NEIGHBOURS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda x, y: x + y) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v) AS p,
    1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= 10
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_license_scan": LICENSES,
        "op2_warc_derivatives": WARC,
        "op4_benchmark_decontamination": DECONTAMINATION,
        "op6_source_mixing": MIXING,
        "op9_tool_call_linking": TOOL_CALLS,
        "op11_onebit_neighbours": NEIGHBOURS,
        "op12_source_divergence": DIVERGENCE,
    }

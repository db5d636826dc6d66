"""Reference SQL, in DuckDB's dialect, for the operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{pattern}')"


NGRAM_JOIN = rf"""WITH RECURSIVE w AS (SELECT doc_id, {_words(r"[^\x20\x09-\x0D]+")} AS ws FROM documents),
own AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w)),
size AS (SELECT doc_id, count(*) AS n FROM own GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM own a JOIN own b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id
    WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id FROM w
LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)"""

_CLEAN_WORDS = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINNOWING = f"""WITH w AS (SELECT doc_id, {_CLEAN_WORDS} AS ws FROM documents),
item AS (SELECT *, least(10, len(ws)) AS k FROM (
    SELECT item_id::VARCHAR AS item, {_CLEAN_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS s FROM (
    SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM item)),
own AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS s FROM (
    SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w CROSS JOIN (SELECT DISTINCT k FROM item))),
hit AS (SELECT doc_id, i, k, item FROM own JOIN win USING (k, s)),
place AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS m, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(m, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM w LEFT JOIN place USING (doc_id) LEFT JOIN named USING (doc_id)"""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({bits} >> {shift}) & 31)::INTEGER + 1, 1)"
_BASE32 = " || ".join(
    _DIGIT.format(bits=f"('0x' || substr(h, {5 * k + 1}, 5))::BIGINT", shift=shift) for k in range(8) for shift in (15, 10, 5, 0)
)
ARC_TO_WARC = f"""SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)"""

SUFFIX_DEDUP = """WITH d AS (SELECT doc_id, x, length(x) // 2 AS n FROM (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents)),
string AS (SELECT doc_id, i, hash(substr(x, (2 * i + 1)::BIGINT, 800)) AS k FROM (
    SELECT doc_id, x, unnest(range(0, n - 399)) AS i FROM d)),
again AS (SELECT doc_id, i FROM string JOIN (SELECT k FROM string GROUP BY k HAVING count(*) > 1) USING (k)),
island AS (SELECT doc_id, i, sum(apart) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
    SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 1 ELSE 0 END AS apart FROM again)),
run AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM island GROUP BY doc_id, g),
piece AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM run),
cut AS (SELECT doc_id, count(*) AS runs, sum(b - a) AS gone, max(b) AS last,
    string_agg(substr(x, (2 * since + 1)::BIGINT, (2 * (a - since))::BIGINT), '' ORDER BY a) AS before
    FROM piece JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(before || substr(x, (2 * last + 1)::BIGINT), x))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""

SOURCE_MIX = r"""WITH own AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
doc AS (SELECT doc_id, source, digest, len(ws)::BIGINT AS size, -ln((('0x' || substr(md5(concat_ws(':',
    coalesce(doc_id::VARCHAR, ''), digest)), 1, 12))::BIGINT::DOUBLE + 0.5e0) / 281474976710656e0)
    / CASE WHEN len(ws) = 0 THEN 1e0 ELSE greatest(0.25e0, len(list_distinct(ws))::DOUBLE / len(ws)) END AS key FROM own),
src AS (SELECT *, list_extract([3, 1, 2], (place % 3 + 1)::INTEGER)::BIGINT AS w FROM (SELECT source, sum(size)::BIGINT AS s,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM doc GROUP BY source)),
level AS (SELECT arg_min(words_per_weight, row) AS l FROM (SELECT *, (1.5e0 * (SELECT sum(s) FROM src)::DOUBLE - full_before)
    / (all_weights - weight_before)::DOUBLE AS words_per_weight FROM (SELECT *, row_number() OVER o AS row, sum(w) OVER () AS all_weights,
    coalesce(sum(2 * s) OVER b, 0) AS full_before, coalesce(sum(w) OVER b, 0) AS weight_before FROM src
    WINDOW o AS (ORDER BY 2e0 * s / w, place), b AS (ORDER BY 2e0 * s / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
    WHERE 2 * s > w * words_per_weight),
aim AS (SELECT source, s, least((2 * s)::DOUBLE, w * coalesce(l, 1e300)) AS target FROM src CROSS JOIN level),
plan AS (SELECT *, (b // s)::BIGINT AS epochs, b % s AS rest FROM (SELECT source, nullif(s, 0) AS s, target,
    floor(target + 0.5e0)::BIGINT AS b FROM aim)),
mixed AS (SELECT doc_id, size, coalesce(s, 0) AS source_size, target, epochs, rest, coalesce(sum(size) OVER (PARTITION BY doc.source
    ORDER BY key, doc_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM doc JOIN plan ON doc.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, source_size, target,
    coalesce(epochs * size + greatest(0, least(size, rest - before)), 0)::BIGINT AS taken FROM mixed"""

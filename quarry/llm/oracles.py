"""DuckDB SQL for the operators whose rows SQL can express, written from their definitions."""

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP3 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
                  substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS h FROM documents),
s AS (SELECT source, sum(size) AS source_size, 2.0 * sum(size) AS most FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM s),
-- the level at which sources that stop are all below, and all others above: tried at each source
l AS (SELECT a.most / a.w AS r, (1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(b.most) FILTER (b.most / b.w < a.most / a.w), 0))
             / sum(b.w) FILTER (b.most / b.w >= a.most / a.w) AS level FROM w a, w b GROUP BY a.source, a.most, a.w),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
             least(most, w * coalesce((SELECT arg_min(level, r) FROM l WHERE r > level), most / w)) AS target FROM w),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
c AS (SELECT doc_id, d.size, d.source, h, source_size, target, passes, target - passes * source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(d.size) OVER (PARTITION BY d.source, h) AS same
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(size * (passes + CASE WHEN rest > 0 AND rest - (upto - same) >= same / 2.0 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""

OP6 = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, p.vec_id, CAST(list_sum(list_transform(list_zip(q.e, p.e), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
      FROM v q JOIN v p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id),
r AS (SELECT query_id, vec_id, coalesce(score, 0) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY coalesce(score, 0) DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS k FROM x),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM r, range(0, 20) AS t(j)),
f AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) AS kept FROM u ANTI JOIN c ON u.doc_id = c.doc_id AND u.i = c.i GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN f USING (doc_id) LEFT JOIN k USING (doc_id)
"""

_HOST = r"rtrim(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.')"
_PATH = r"list_filter(string_split(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '')"
_FIRST = r"string_split(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/')[2]"

OP8 = rf"""
WITH p AS (SELECT page_id, url, DATE '2023-01-01' + CAST(page_id * 37 % 730 AS INTEGER) AS fetched_at, {_HOST} AS host, {_PATH} AS path, {_FIRST} AS dir FROM pages),
n AS (SELECT host AS entry, 'host' AS category, min(page_id) AS k FROM p WHERE host <> '' GROUP BY host HAVING min(page_id) % 3 = 0
      UNION ALL SELECT host || '/' || dir, 'path', min(page_id) FROM p WHERE host <> '' AND dir <> '' GROUP BY host || '/' || dir HAVING min(page_id) % 5 = 1),
i AS (SELECT entry, category, DATE '2023-01-01' + CAST(k * 11 % 300 AS INTEGER) AS since, DATE '2023-01-01' + CAST(k * 11 % 300 + 200 AS INTEGER) AS until FROM n
      UNION ALL SELECT entry, category, DATE '2023-01-01' + CAST(k * 11 % 300 + 320 AS INTEGER), NULL FROM n),
m AS (SELECT p.page_id, i.* FROM p JOIN i ON p.fetched_at >= since AND (until IS NULL OR p.fetched_at < until)
      AND p.host <> '' AND (p.host = entry OR ends_with(p.host, '.' || entry) OR (contains(entry, '/') AND starts_with(p.host || '/' || array_to_string(p.path, '/') || '/', entry || '/')))),
b AS (SELECT page_id, count(*) AS n, min({{'l': -length(entry), 'e': entry, 'c': category, 's': since}}) AS b FROM m GROUP BY page_id)
SELECT p.page_id, url, fetched_at, b IS NOT NULL AS blocked, CAST(coalesce(n, 0) AS BIGINT) AS n_matches, b.e AS entry, b.c AS category, b.s AS since
FROM p LEFT JOIN b ON p.page_id = b.page_id
"""

_BOILER = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie policy|we use cookies|enable javascript|(licensed|released) under"
           r"|is licensed under|copyright \(c\)|©|click here|sign up for|subscribe to our|back to top|skip to content)")
_LINE_WORDS = WORDS.replace("coalesce(text, '')", "line")

OP9 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
l AS (SELECT doc_id, line, {_LINE_WORDS} AS lw FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
a AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(len(lw)) FILTER (
        100 * len(list_filter(lw, lambda x: regexp_matches(x, '[!?#*$%&|<>^~=_]{{2,}}'))) > 30 * len(lw)
        OR 100 * len(list_filter(lw, lambda x: regexp_matches(x, '^[|>»·•/]+$'))) > 25 * len(lw) OR regexp_matches(line, '{_BOILER}')), 0) AS lost
      FROM l WHERE len(lw) > 0 GROUP BY doc_id),
x AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 4)) AS n FROM x),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM g, range(0, 5) AS t(j) WHERE n > 1 GROUP BY doc_id),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM d LEFT JOIN a USING (doc_id) LEFT JOIN r USING (doc_id)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * lost <= 50 * n_words AS kept FROM v
"""

#: crc32 bit by bit: eight steps of the reflected polynomial, for each byte of a text.
_CRC_TABLE = """t AS (SELECT list(c ORDER BY b) AS t FROM (
  WITH RECURSIVE s(b, c, i) AS (SELECT b, b, 0 FROM range(256) r(b) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM s WHERE i < 8)
  SELECT b, c FROM s WHERE i = 8))"""

OP11 = rf"""
WITH {_CRC_TABLE},
d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents),
u AS (SELECT k, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n FROM d GROUP BY ALL),
x AS (SELECT k, r, n, list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(k || ':' || r))), lambda i: CAST('0x' || hex(encode(k || ':' || r))[2 * i + 1:2 * i + 2] AS BIGINT))) AS bytes FROM u WHERE length(r) >= 6),
h AS (SELECT r, n, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM x, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1),
v AS (SELECT word, n FROM w WHERE length(word) >= 6 AND n >= 5),
-- one letter out: equal leftovers with the place in front are a replacement, a leftover that is a word is an insertion
g AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest, substr(word, i, 1) AS c FROM v, range(1, length(word) + 1) q(i)),
p AS (SELECT DISTINCT a, b FROM (
  SELECT a.word AS a, b.word AS b FROM g a JOIN g b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT g.word, v.word FROM g JOIN v ON g.rest = v.word UNION ALL SELECT v.word, g.word FROM g JOIN v ON g.rest = v.word)),
e AS (SELECT a AS word, count(*) AS n_near, min({{'m': -v.n, 'w': b}}) AS best FROM p JOIN v ON b = v.word GROUP BY a),
f AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * n THEN best.w END AS form, CASE WHEN -best.m >= 5 * n THEN -best.m END AS form_n FROM v LEFT JOIN e ON v.word = e.word),
c AS (WITH RECURSIVE c(word, cur, next) AS (SELECT word, word, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON c.next = f.word) SELECT word, cur AS root FROM c WHERE next IS NULL)
SELECT f.word, n, n_near, form, form_n, root FROM f JOIN c ON f.word = c.word
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT k, lang, source, unnest(w) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
l AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS total, count(*) AS terms FROM v GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN v ON o.lang = v.lang AND o.term = v.term GROUP BY ALL),
s AS (SELECT g.lang, g.source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
a AS (SELECT s.lang, s.source, v.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * l.terms) AS BIGINT) AS p,
             CAST(1 + (1000000000::HUGEINT * (v.n + 5)) // (l.total + 5 * l.terms) AS BIGINT) AS q
      FROM s JOIN v ON s.lang = v.lang JOIN l ON s.lang = l.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = v.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM a JOIN a b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM a WHERE n > 0 AND p > q),
y AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT * FROM y WHERE part = 'pair' OR rank <= 50
"""

"""DuckDB SQL for the registered queries of this subpackage that SQL can express, written from their definitions."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_PLAIN_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_PLAIN_WORD}) AS w FROM documents),
i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, {_PLAIN_WORD}) AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS t
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(p) WHERE len(w) > 0
),
dw AS (
  SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS t
  FROM (SELECT d.r, d.w, l.n FROM d, (SELECT DISTINCT n FROM iw) AS l WHERE len(d.w) >= l.n) AS x, unnest(range(1, len(w) - n + 2)) AS u(p)
),
hits AS (SELECT r, n, p, t FROM dw WHERE t IN (SELECT t FROM iw)),
n AS (SELECT r, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + n)) AS u(q) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits JOIN iw USING (t) WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN named USING (r)
"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
win AS (SELECT r, doc_id, p, array_to_string(w[p : p + 49], ' ') AS t FROM d, unnest(range(1, len(w) - 48)) AS u(p)),
first AS (SELECT t, min(doc_id) AS first_doc FROM win GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, q, TRUE AS gone FROM win JOIN first USING (t), unnest(range(p, p + 50)) AS u(q) WHERE first_doc < doc_id),
one AS (SELECT r, q, w[q] AS x FROM d, unnest(range(1, len(w) + 1)) AS u(q)),
kept AS (SELECT r, count(gone) AS n_removed, string_agg(x, ' ' ORDER BY q) FILTER (WHERE gone IS NULL) AS t FROM one LEFT JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 3], ' ') AS t FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(p) WHERE len(w) > 0),
sized AS (SELECT doc_id, count(*) AS n, md5(string_agg(t, chr(10) ORDER BY t)) AS k FROM s GROUP BY doc_id),
class AS (SELECT k, any_value(n) AS n, min(doc_id) AS node FROM sized GROUP BY k),
cs AS (SELECT node, n, t FROM s JOIN class ON node = doc_id),
pair AS (SELECT x.node AS a, y.node AS b FROM cs AS x JOIN cs AS y ON x.t = y.t AND x.node < y.node GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
way AS (SELECT a, b FROM pair UNION SELECT b, a FROM pair),
reach AS (SELECT node AS a, node AS b FROM class UNION SELECT reach.a, way.b FROM reach JOIN way ON way.a = reach.b),
least_of AS (SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN (SELECT doc_id, n, component_id FROM (SELECT doc_id, k FROM sized) JOIN class USING (k) JOIN least_of USING (node)) USING (doc_id)
"""

LINE_DEDUP = rf"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
line AS (SELECT doc_id, q, l[q] AS line FROM d, unnest(range(1, len(l) + 1)) AS u(q)),
words AS (SELECT doc_id, q, regexp_extract_all(line, {_WORD}) AS w FROM line),
runs AS (SELECT DISTINCT doc_id, q, array_to_string(w[p : p + 4], ' ') AS t FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(p) WHERE len(w) > 0),
sized AS (SELECT doc_id, q, count(*) AS n, md5(string_agg(t, chr(10) ORDER BY t)) AS k FROM runs GROUP BY doc_id, q),
class AS (SELECT k, any_value(n) AS n, min(struct_pack(doc_id := doc_id, q := q)) AS spot FROM sized GROUP BY k),
cs AS (SELECT k, n, spot, t FROM class JOIN runs ON runs.doc_id = spot.doc_id AND runs.q = spot.q),
pair AS (
  SELECT y.k FROM cs AS x JOIN cs AS y ON x.t = y.t AND x.spot < y.spot AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
  GROUP BY x.k, y.k, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
),
gone AS (
  SELECT doc_id, q, TRUE AS gone FROM sized JOIN class USING (k)
  WHERE k IN (SELECT k FROM pair) OR struct_pack(doc_id := doc_id, q := q) > spot
),
kept AS (
  SELECT doc_id, count(gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY q) FILTER (WHERE gone IS NULL), '') AS t
  FROM line LEFT JOIN gone USING (doc_id, q) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(t) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: A SHA-1 of 160 bits is 8 groups of 5 hex digits, each 4 base32 digits.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
hashed AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
digit AS (
  SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(x, 5 * (j // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (j % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1), '' ORDER BY j) AS payload_digest
  FROM hashed, unnest(range(0, 32)) AS u(j) GROUP BY page_id
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed JOIN digit USING (page_id)
"""

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w)) AS terms FROM d),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2.0 * docs + 2) / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), size),
i AS (SELECT DISTINCT item_id, text FROM benchmark),
it AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS t FROM i) GROUP BY item_id, t),
m AS (SELECT r, doc_id, CAST(75 + (25 * len(w) * docs) // terms AS BIGINT) AS m FROM d, size),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM it JOIN weight USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""

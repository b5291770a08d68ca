"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

import string

SUFFIX_DEDUP = """
WITH d AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
r AS MATERIALIZED (
  SELECT w.doc_id, w.i FROM w JOIN (SELECT s, min(doc_id) AS first FROM w GROUP BY s) m ON m.s = w.s WHERE m.first < w.doc_id),
o AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM r),
g AS (
  SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM o),
spans AS MATERIALIZED (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, k),
pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p, a AS q FROM spans
  UNION ALL
  SELECT d.doc_id, coalesce(max(s.b), 0), any_value(d.n) FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
kept AS (
  SELECT p.doc_id, string_agg(substr(d.h, 2 * p.p + 1, 2 * (p.q - p.p)), '' ORDER BY p.p) AS h
  FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id),
sizes AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.n_spans, 0) AS n_spans,
  sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

MINHASH = f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingle FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.both >= 85 * (na.n + nb.n - p.both)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

# Five hexadecimal digits are four base32 letters.
WARC = f"""
WITH p AS MATERIALIZED (
  SELECT page_id, coalesce(html, '') AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
x AS MATERIALIZED (
  SELECT page_id, h, payload_bytes,
    list_transform(range(0, 8), lambda i: CAST('0x' || substr(sha1(h), CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS v,
    max(page_id) OVER (PARTITION BY h) AS owner FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('{string.ascii_uppercase}234567',
    CAST(((v[CAST(j // 4 + 1 AS BIGINT)] >> CAST(15 - 5 * (j % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN owner = page_id THEN NULL ELSE owner END AS refers_to
FROM x
"""

ORACLE = {"op3_suffix_dedup": SUFFIX_DEDUP, "op5_minhash": MINHASH, "op7_warc": WARC}

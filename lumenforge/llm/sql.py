"""SQL for DuckDB that says the same as an operator's query, where SQL can."""

from __future__ import annotations

#: Sets as lists of texts, pairs by shared shingles, components by recursion.
PARITY_JOIN = """WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM words),
texts AS (SELECT min(doc_id) AS doc_id, any_value(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
shingles AS (SELECT doc_id, n, unnest(s) AS x FROM texts),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS total, count(*) AS same FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * same >= 90 * (total - same)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS component FROM texts UNION SELECT e.b, r.component FROM reached r JOIN edges e ON e.a = r.node),
named AS (SELECT node, min(component) AS component FROM reached GROUP BY node)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, CASE WHEN sets.doc_id IS NULL THEN NULL ELSE coalesce(named.component, sets.doc_id) END AS component_id
FROM sets LEFT JOIN (SELECT list_sort(s) AS s, doc_id FROM texts) t ON t.s = list_sort(sets.s) LEFT JOIN named ON named.node = t.doc_id"""

#: Every window of 200 bytes, in hexadecimal, by its hash.
SUFFIX_DEDUP = """WITH raw AS (SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT id, unnest(range(0, len(h) // 2 - 199)) AS i, h FROM raw WHERE len(h) >= 400),
windows AS (SELECT id, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 400)) AS m FROM starts),
twice AS (SELECT m FROM windows GROUP BY m HAVING count(*) > 1),
hits AS (SELECT id, i, lag(i) OVER (PARTITION BY id ORDER BY i) AS before, lead(i) OVER (PARTITION BY id ORDER BY i) AS after FROM windows WHERE m IN (SELECT m FROM twice)),
runs AS (SELECT id, i, row_number() OVER (PARTITION BY id ORDER BY i) AS k FROM hits WHERE before IS NULL OR i - before > 200),
ends AS (SELECT id, i + 200 AS e, row_number() OVER (PARTITION BY id ORDER BY i) AS k FROM hits WHERE after IS NULL OR after - i > 200),
spans AS (SELECT r.id, r.i AS low, e.e AS high, r.k, coalesce(lag(e.e) OVER (PARTITION BY r.id ORDER BY r.k), 0) AS kept_from FROM runs r JOIN ends e ON e.id = r.id AND e.k = r.k),
gone AS (SELECT s.id, sum(high - low) AS removed, count(*) AS n, string_agg(substr(raw.h, CAST(2 * kept_from + 1 AS BIGINT), CAST(2 * (low - kept_from) AS BIGINT)), '' ORDER BY k) AS front, max(high) AS last FROM spans s JOIN raw ON raw.id = s.id GROUP BY s.id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM raw LEFT JOIN gone ON gone.id = raw.id"""

#: Every anchor against every row, ranked by windows.
HARD_NEGATIVES = """WITH clean AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS s
  FROM clean a JOIN clean b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
positives AS (SELECT anchor, other, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY s DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.s DESC, n.other) AS INTEGER) AS rank, n.other AS negative_id,
  p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.s <= 100 * n.s AND n.s <= p.s
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.s DESC, n.other) <= 5"""

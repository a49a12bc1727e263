"""DuckDB SQL for the registered queries that SQL can express, over whole tables."""

from __future__ import annotations

OP1 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
v AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS g
  FROM d WHERE len(w) >= 13),
m AS (SELECT md5(g) AS h, min(doc_id) AS first_doc FROM v GROUP BY 1),
c AS (SELECT DISTINCT doc_id, i + j AS p FROM v JOIN m ON md5(v.g) = m.h, range(13) AS r(j) WHERE doc_id > first_doc),
x AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
k AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (c.p IS NOT NULL) AS n_removed,
         sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (c.p IS NULL), '')) AS kept_sha256
  FROM x LEFT JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
c AS (SELECT *, length(bin(size)) * 16 + ((size >> greatest(length(bin(size)) - 5, 0)) & 15) AS cls FROM d),
s0 AS (SELECT k, sum(size)::BIGINT AS source_size FROM d GROUP BY k),
s1 AS (SELECT *, (row_number() OVER (ORDER BY k) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s0),
s2 AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS goal,
         coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
         (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS others
  FROM s1),
s3 AS (SELECT *, max((goal - capped) / others) OVER () AS level FROM s2),
s AS (
  SELECT k, source_size, least(level * w, cap::DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN least(level * w, cap::DOUBLE) / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix' || k), 1, 5))::INTEGER / 1048576.0::DOUBLE AS u
  FROM s3),
r AS (SELECT c.*, row_number() OVER (PARTITION BY k ORDER BY cls, coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 5))::INTEGER % 256, 0), doc_id, size) AS i FROM c)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * least(floor(i * rate + u) - floor((i - 1) * rate + u), 3))::BIGINT AS taken
FROM r JOIN s USING (k)
"""

OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g
  FROM d),
n AS (SELECT doc_id, len(g) AS n_shingles FROM s),
e AS (SELECT doc_id, md5(unnest(g)) AS h FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * o >= 90 * (x.n_shingles + y.n_shingles - o)),
t AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, t.b FROM r JOIN t ON r.reached = t.a)
SELECT n.doc_id, n_shingles, min(reached) AS component_id FROM n JOIN r USING (doc_id) GROUP BY 1, 2
"""

OP5 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

OP9 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT k.*, m.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN m USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op2_mix_sources": OP2,
    "op4_jaccard_join": OP4,
    "op5_exact_topk": OP5,
    "op9_line_dedup": OP9,
}

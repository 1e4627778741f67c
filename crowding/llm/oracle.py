"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .queries import SHARD_BYTES

ORACLE = {
    "op8_sharding": f"""
WITH h AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9))::BIGINT AS path
  FROM documents),
d AS (SELECT CAST(range AS INTEGER) AS depth FROM range(0, 37)),
total AS (
  SELECT depth, path >> (36 - depth) AS shard, sum(n_bytes) AS bytes
  FROM h, d GROUP BY 1, 2),
leaf AS (
  SELECT h.doc_id, h.n_bytes, h.path, min(t.depth) AS depth
  FROM h, d JOIN total t ON t.depth = d.depth AND t.shard = h.path >> (36 - d.depth)
  WHERE t.bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(depth AS INTEGER) AS depth,
       CAST(path >> (36 - depth) AS BIGINT) AS shard
FROM leaf
""",
    "op9_preference": """
WITH c AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS a
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
p AS (
  SELECT *, coalesce(list_max(list_transform(range(1, len(a) + 1),
                       lambda i: CASE WHEN a[i].role = 'assistant' THEN i ELSE 0 END)), 0) AS place
  FROM c),
s AS (
  SELECT p.conv_id, p.a, CASE WHEN p.place = 0 THEN p.a ELSE list_transform(range(1, len(p.a) + 1),
           lambda i: CASE WHEN i = p.place THEN struct_pack(role := 'assistant',
                       text := coalesce(CASE WHEN o.place > 0 THEN o.a[o.place].text END, ''))
                ELSE p.a[i] END) END AS b
  FROM p LEFT JOIN p o ON o.conv_id = xor(p.conv_id, 1)),
n AS (
  SELECT *, coalesce(list_min(list_filter(range(1, len(a) + 1), lambda i: a[i] <> b[i])) - 1, len(a)) AS k FROM s),
parts AS (
  SELECT conv_id, k, a[1:k] AS x, a[k + 1:] AS y, b[k + 1:] AS z FROM n),
r AS (
  SELECT conv_id, k, y, z,
    coalesce(array_to_string(list_transform(x, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || chr(10) || '<|end|>' || chr(10)), ''), '') AS prompt,
    list_transform(y, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || chr(10) || '<|end|>' || chr(10)) AS ry,
    list_transform(z, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || chr(10) || '<|end|>' || chr(10)) AS rz
  FROM parts),
m AS (
  SELECT *,
    list_filter(range(1, len(y) + 1), lambda i: y[i].role = 'assistant') AS iy,
    list_filter(range(1, len(z) + 1), lambda i: z[i].role = 'assistant') AS iz
  FROM r)
SELECT conv_id, CAST(k AS INTEGER) AS n_common, prompt,
  coalesce(array_to_string(ry, ''), '') AS chosen, coalesce(array_to_string(rz, ''), '') AS rejected,
  coalesce(array_to_string(list_transform(iy, lambda i:
    CAST(length(prompt) + length(coalesce(array_to_string(ry[1:i - 1], ''), '')) + length(y[i].role) + 5 AS VARCHAR)
    || ':' || CAST(length(y[i].text) AS VARCHAR)), ','), '') AS chosen_loss,
  coalesce(array_to_string(list_transform(iz, lambda i:
    CAST(length(prompt) + length(coalesce(array_to_string(rz[1:i - 1], ''), '')) + length(z[i].role) + 5 AS VARCHAR)
    || ':' || CAST(length(z[i].text) AS VARCHAR)), ','), '') AS rejected_loss,
  CAST(coalesce(list_sum(list_transform(iy, lambda i: length(y[i].text))), 0) AS BIGINT) AS chosen_loss_chars,
  CAST(coalesce(list_sum(list_transform(iz, lambda i: length(z[i].text))), 0) AS BIGINT) AS rejected_loss_chars
FROM m
""",
    "op10_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
""",
    "op12_exact": """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents),
g AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)
""",
}

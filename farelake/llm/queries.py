"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from farelake.llm.op01_suffixes import op1_suffix_dedup
from farelake.llm.op02_minhash import op2_bottom_k_near_dedup
from farelake.llm.op03_language import op3_crf_language
from farelake.llm.op04_mixing import op4_soft_mixing
from farelake.llm.op05_warc import op5_warc_round_trip
from farelake.llm.op06_shards import op6_byte_prefix_shards
from farelake.llm.op07_decontaminate import op7_cgk_decontaminate
from farelake.llm.op08_vectors import op8_projection_near_dedup
from farelake.llm.op09_lines import op9_fuzzy_lines
from farelake.llm.op10_tokens import op10_range_coded_tokens
from farelake.llm.op11_runs import op11_periodic_runs
from farelake.llm.op12_negatives import op12_angular_negatives
from farelake.llm.op13_packing import op13_vector_packing

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_bottom_k_near_dedup, op3_crf_language, op4_soft_mixing, op5_warc_round_trip,
    op6_byte_prefix_shards, op7_cgk_decontaminate, op8_projection_near_dedup, op9_fuzzy_lines, op10_range_coded_tokens,
    op11_periodic_runs, op12_angular_negatives, op13_vector_packing)}

_NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                                    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(node, root) AS (
  SELECT u, u FROM edges
  UNION
  SELECT e.v, r.root FROM reach r JOIN edges e ON e.u = r.node WHERE r.root <= e.v),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id,
       s.doc_id = coalesce(c.root, s.doc_id) AS kept
FROM sets s LEFT JOIN comp c ON c.node = s.doc_id"""

_VECTORS = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(e, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(node, root) AS (
  SELECT u, u FROM links
  UNION
  SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node WHERE r.root <= l.v),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.root, v.vec_id) AS component_id,
       v.vec_id = coalesce(c.root, v.vec_id) AS kept
FROM v LEFT JOIN n ON n.u = v.vec_id LEFT JOIN comp c ON c.node = v.vec_id"""

_WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT page_id, body, hex,
         list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS INTEGER), 1)),
           'string_agg', '') AS digest
  FROM p),
g AS (SELECT body, max(page_id) AS keep FROM p GROUP BY body)
SELECT b.page_id, CAST(strlen(b.body) AS BIGINT) AS payload_bytes, b.digest AS payload_digest,
       CASE WHEN b.page_id = g.keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN b.page_id = g.keep THEN NULL ELSE g.keep END AS refers_to
FROM bits b JOIN g ON g.body = b.body"""

_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
q AS (
  SELECT vec_id, label, list_transform(e, lambda x: floor(256 * x)) AS q FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 10"""

ORACLE = {"op2_bottom_k_near_dedup": _NEAR, "op8_projection_near_dedup": _VECTORS, "op5_warc_round_trip": _WARC, "op12_angular_negatives": _NEGATIVES}

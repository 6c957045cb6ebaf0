"""SQL for those of the queries that SQL can express."""

from .queries import HOST_RULES
from .urls import PATTERNS, pattern_rule

_SIGNS = "list_transform(embedding, lambda x: x > 0)"

TOPK = f"""
WITH v AS (
  SELECT vec_id, {_SIGNS} AS bits FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(len(list_filter(list_zip(q.bits, v.bits), lambda z: z[1] <> z[2])) AS BIGINT) AS distance
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS n FROM pairs)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, distance FROM ranked WHERE n <= 10"""


def _host_rule_values() -> str:
    return ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in HOST_RULES)


def _pattern_test() -> str:
    fold = "translate(place, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return " OR ".join(f"regexp_matches({fold}, '{pattern_rule(p).regex}')" for p in PATTERNS)


URLS = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
numbered AS (SELECT *, row_number() OVER () AS n, host || path AS place FROM parts),
rules AS (SELECT * FROM (VALUES {_host_rule_values()}) AS t(h, p, v)),
fits AS (
  SELECT n, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM numbered JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN {_pattern_test()} THEN 'block' ELSE 'allow' END) AS verdict
FROM numbered LEFT JOIN fits USING (n)"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS code
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
pairs AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.code, v.code) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id % 100 = 0 AND v.vec_id <> a.vec_id),
near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10"""

#: All links there are; the operator has found each of them wherever the two were compared.
EMBEDDING_CLASSES = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, coalesce(vec_id <= b, TRUE) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN counted ON vec_id = counted.a"""

ORACLES = {"op11_hard_negatives": HARD_NEGATIVES, "op13_embedding_dedup": EMBEDDING_CLASSES, "op2_exact_topk": TOPK, "op3_url_filter": URLS}

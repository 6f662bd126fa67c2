"""SQL twins of the queries that SQL can express.

The others are tested otherwise: tokenizers, checksums of ids, trained models, suffix arrays,
signatures and ring positions are not in SQL; see ``tests/llm``.
"""

from __future__ import annotations

SQL: dict[str, str] = {
    "op11_exact_topk": """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op10_embedding_dedup": """WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)""",
    "op13_merkle_manifest": """WITH RECURSIVE
d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, n_chars,
    concat(coalesce(concat(octet_length(encode(CAST(doc_id AS VARCHAR))), ':', doc_id), '-'), coalesce(concat(octet_length(encode(source)), ':', source), '-'),
           coalesce(concat(octet_length(encode(lang)), ':', lang), '-')) AS head,
    coalesce(concat(octet_length(encode(text)), ':', text), '-') AS tail,
    list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS BIGINT), 1)) AS BIGINT)),
      lambda crc, byte: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)), CAST(4294967295 AS BIGINT)) AS raw
  FROM documents),
leaves AS (
  SELECT doc_id, tree, sha256(concat(head, coalesce(concat(length(CAST(n_chars AS VARCHAR)), ':', n_chars), '-'), tail)) AS leaf,
    CASE WHEN xor(raw, 4294967295) % 7 = 0 AND n_chars IS NOT NULL
      THEN sha256(concat(head, length(CAST(n_chars + 1 AS VARCHAR)), ':', n_chars + 1, tail)) END AS altered FROM d),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(concat(digest, coalesce(other, ''))), (size + 1) // 2
  FROM (SELECT *, lead(digest) OVER (PARTITION BY tree ORDER BY pos) AS other FROM nodes WHERE size > 1) WHERE pos % 2 = 0),
subroots AS (SELECT tree, level, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS number FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, number AS pos, subroot AS digest, count(*) OVER () AS size FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(concat(digest, coalesce(other, ''))), (size + 1) // 2
  FROM (SELECT *, lead(digest) OVER (ORDER BY pos) AS other FROM tops WHERE size > 1) WHERE pos % 2 = 0),
climb AS (
  SELECT doc_id, tree, leaf, 0 AS level, pos, coalesce(altered, leaf) AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT c.doc_id, c.tree, c.leaf, c.level + 1, c.pos // 2,
    CASE WHEN c.pos % 2 = 1 THEN sha256(concat(s.digest, c.folded)) ELSE sha256(concat(c.folded, coalesce(s.digest, ''))) END, concat(c.proof, coalesce(s.digest, ''))
  FROM climb c JOIN subroots r ON r.tree = c.tree AND c.level < r.level
  LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, CAST(1 AS BIGINT))),
rise AS (
  SELECT c.doc_id, c.leaf, r.subroot, 0 AS level, r.number AS pos, c.folded, c.proof FROM climb c JOIN subroots r ON r.tree = c.tree AND c.level = r.level
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.pos // 2,
    CASE WHEN c.pos % 2 = 1 THEN sha256(concat(s.digest, c.folded)) ELSE sha256(concat(c.folded, coalesce(s.digest, ''))) END, concat(c.proof, coalesce(s.digest, ''))
  FROM rise c LEFT JOIN tops s ON s.level = c.level AND s.pos = xor(c.pos, CAST(1 AS BIGINT))
  WHERE c.level < (SELECT max(level) FROM tops))
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM rise c JOIN tops t ON t.size = 1 AND t.level = c.level""",
}

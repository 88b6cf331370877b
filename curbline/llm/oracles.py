"""SQL counterparts, for DuckDB, of the registered queries that SQL can express."""

from __future__ import annotations

WARC = r"""
WITH pages_read AS (SELECT page_id, CAST(encode(coalesce(html, '')) AS BLOB) AS body FROM pages),
known AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM pages_read),
largest AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM known)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM largest
"""

MINHASH = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM words
), sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, s.n AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept FROM sizes s JOIN least l USING (doc_id)
"""

EMBEDDINGS = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT m.vec_id, coalesce(n, 0) AS n_links, component_id, m.vec_id = component_id AS kept FROM least m LEFT JOIN counts ON a = m.vec_id
"""

TOPK = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM words GROUP BY 1, 2 HAVING count(DISTINCT row) >= 3
), sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), vocabulary AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY 1),
sizes AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM sources LEFT JOIN counts USING (lang, source) GROUP BY 1, 2),
chances AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (s.n + v.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.total + 1)) // (v.n + v.v) AS whole
  FROM sizes s JOIN vocabulary v USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM chances a JOIN chances b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - whole) * (p - whole) // whole FROM chances WHERE n > 0 AND p > whole
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

SUBSTRINGS = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS seq FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), least AS (SELECT *, min({'d': doc_id, 'i': i}) OVER (PARTITION BY seq) AS first FROM windows),
late AS (SELECT doc_id, i FROM least WHERE first.d < doc_id OR first.i < i),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM late),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
left_over AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op2_warc": WARC, "op7_minhash": MINHASH, "op9_embeddings": EMBEDDINGS, "op10_topk": TOPK, "op11_divergence": DIVERGENCE,
    "op12_substrings": SUBSTRINGS,
}

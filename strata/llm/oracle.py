"""DuckDB SQL for those queries that SQL can express."""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos, w FROM d
), o AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(w[pos : pos + 19], ' ') ORDER BY doc_id, pos) AS n FROM p
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM o WHERE n > 1
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d
), marked AS (
  SELECT words.doc_id, word, words.pos, gone.pos IS NOT NULL AS removed
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.pos = gone.pos
), totals AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN totals USING (doc_id)
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT lang, source, r, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM t GROUP BY lang, source, term
), k AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 30
), l AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang
), o AS (
  SELECT c.lang, c.source, sum(c.n) AS total FROM c JOIN k USING (lang, term) GROUP BY c.lang, c.source
), g AS (
  SELECT d.lang, d.source, coalesce(any_value(o.total), 0) AS total
  FROM d LEFT JOIN o USING (lang, source) GROUP BY d.lang, d.source
), s AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(apart.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM f
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE: dict[str, str] = {
    "op8_top_k": OP8,
    "op10_substring_dedup": OP10,
    "op11_hard_negatives": OP11,
    "op12_source_divergence": OP12,
}

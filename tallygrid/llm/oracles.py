"""SQL that DuckDB runs on the same tables."""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM s),
c AS (SELECT *, row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS r,
             sum(source_size) OVER () * 3 / 2.0 AS total, sum(w) OVER () AS all_w FROM w),
l AS (SELECT *, (CAST(total AS DOUBLE) - CAST(coalesce(sum(2 * source_size) OVER b, 0) AS DOUBLE))
             / CAST(all_w - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS lev
      FROM c WINDOW b AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT first(lev ORDER BY r) AS lev FROM l WHERE lev * w <= 2 * source_size),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), f.lev * w) AS target FROM l, f),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, CAST(floor(target) AS BIGINT) - before))
          + greatest(0, least(size, CAST(floor(target) AS BIGINT) - before - source_size)) AS BIGINT) AS taken
FROM q
"""

_WHOLE = """
WITH v AS (
  SELECT vec_id, label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS ints FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)"""

HIGHEST = f"""{_WHOLE},
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

HARD_NEGATIVES = f"""{_WHOLE},
l AS (SELECT vec_id, ints, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM v WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_inner_product(a.ints, c.ints) AS BIGINT) AS score
      FROM l a JOIN l c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

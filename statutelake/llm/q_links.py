"""Queries of the link operators (2, 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .embedding_links import embedding_links
from .registry import query
from .shingle_join import jaccard_join
from .session import table

EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), u AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a AS n, a AS c FROM links UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.n
), comp AS (SELECT n, min(c) AS c FROM reach GROUP BY n),
degree AS (SELECT a, count(*) AS d FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d, 0)::BIGINT AS n_links, coalesce(c, v.vec_id)::BIGINT AS component_id,
  v.vec_id = coalesce(c, v.vec_id) AS kept
FROM v LEFT JOIN comp ON n = v.vec_id LEFT JOIN degree ON degree.a = v.vec_id
"""


@query("op2_embedding_links", EMBEDDING_SQL)
def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept rows of all vectors."""
    return embedding_links(table(spark, sf_dir, "embeddings"))


JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w
), n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)
), both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS v, a AS k FROM both_ways UNION SELECT t.b, r.k FROM r JOIN both_ways t ON t.a = r.v),
comp AS (SELECT v, min(k) AS k FROM r GROUP BY v)
SELECT doc_id, n AS n_shingles, coalesce(k, doc_id) AS component_id FROM n LEFT JOIN comp ON v = doc_id
"""


@query("op10_jaccard_join", JACCARD_SQL)
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts and components of all documents."""
    return jaccard_join(table(spark, sf_dir, "documents"))

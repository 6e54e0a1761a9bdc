"""Queries of the operators on a corpus as a whole (11, 12, 13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .centroid_clusters import clusters
from .collocations import collocations
from .order_minhash import edit_likeness
from .registry import query
from .session import table

COLLOCATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents
), p AS (SELECT lang, list_filter(string_split_regex(unnest(p), '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY 1),
g AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
), f AS MATERIALIZED (SELECT lang, k, g, count(*)::BIGINT AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
cut AS (
  SELECT c.lang, c.g, c.a, j, x.a AS l, y.a AS r, ((1000::HUGEINT * c.a * n.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1) c
  JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, j) JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, j + 1, c.k)
  JOIN n ON n.lang = c.lang
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
longer AS (
  SELECT lang, list_slice(g, s, s + m - 1) AS g, max(a) AS a FROM (
    SELECT *, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2)) GROUP BY ALL
), kept AS (
  SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, n.n, b.score FROM best b JOIN n ON n.lang = b.lang
  LEFT JOIN longer ON longer.lang = b.lang AND longer.g = b.g WHERE longer.a IS NULL OR 100 * longer.a < 100 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


def _cluster_sql(rounds: int = 10) -> str:
    """Every round as a step of its own: distances of all vectors to the centroids, then the new centroids."""

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT vec_id, row, e, cluster, d FROM (
    SELECT v.vec_id, v.row, v.e, c.cluster, list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v, c{i} c) QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, cluster) = 1)"""

    steps = []
    for i in range(rounds):
        steps += [assigned(i), f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS e FROM (
      SELECT cluster, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n
      FROM (SELECT cluster, unnest(e) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY 1, 2) GROUP BY 1) m ON m.cluster = c.cluster)"""]
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, e) - 1)::INT AS cluster, e
  FROM (SELECT e, sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, e LIMIT 8)
), {", ".join(steps)}, {assigned(rounds)}
SELECT vec_id, a.cluster, d AS distance, (sum(d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster
"""


@query("op11_collocations", COLLOCATION_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language."""
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_order_minhash")
def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited forms."""
    return edit_likeness(table(spark, sf_dir, "documents"))


@query("op13_centroid_clusters", _cluster_sql())
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors."""
    return clusters(table(spark, sf_dir, "embeddings"))

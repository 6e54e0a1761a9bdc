"""Queries of the native filters (6, 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import license_scan, url_rules
from .registry import query
from .session import table


def _url_sql() -> str:
    """The rules, and the mined ones by counting every token combination of the labelled URLs."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cases = {"rule": "", "kind": ""}
    for kind, host, path in sorted(url_rules.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN"
        cases["rule"] += f" {fits} '{host}{path}'"
        cases["kind"] += f" {fits} '{kind}'"
    return rf"""
WITH p AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
u AS (
  SELECT page_id, url, rest, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, coalesce(regexp_extract(rest, '\?([^#]*)', 1), '') AS q FROM p
), t AS (
  SELECT *, CASE WHEN rest IS NULL THEN [] ELSE list_sort(list_distinct(list_concat(
    ['scheme=' || lower(split_part(url, '://', 1)), 'host=' || host],
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'name=' || x),
    list_transform(list_filter(regexp_split_to_array(translate(path, '{upper}', '{lower}'), '[^a-z0-9]+'),
      lambda x: x <> '' AND NOT regexp_full_match(x, '[0-9]+')), lambda x: 'path=' || x),
    list_transform(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '=[0-9]+$')), lambda x: 'pair=' || x),
    list_transform(list_filter(list_transform(string_split(q, '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'key=' || x)
  ))) END AS tokens FROM u
), bad AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS block FROM labels GROUP BY 1),
labelled AS (
  SELECT tokens, block FROM t JOIN bad ON doc_id = try_cast(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1) AS BIGINT)
  WHERE block IS NOT NULL AND url IS NOT NULL
), n AS (SELECT count(*)::DOUBLE AS n FROM labelled),
parts AS (
  SELECT list_filter(tokens, lambda x, i: (m >> (i - 1)::INT) & 1 = 1) AS part, block
  FROM (SELECT tokens, block, unnest(range(1, (1 << len(tokens))::BIGINT)) AS m FROM labelled)
), mined AS (
  SELECT part FROM parts, n GROUP BY part, n
  HAVING count(*) FILTER (block) >= ceil(least(1.0, greatest({url_rules.MIN_SUPPORT}::DOUBLE, {url_rules.MIN_ROWS} / n)) * n)
    AND count(*) FILTER (block)::DOUBLE / count(*) >= {url_rules.MIN_CONFIDENCE}
), hit AS (SELECT DISTINCT url FROM t JOIN mined ON list_has_all(tokens, part))
SELECT page_id, host, path, CASE {cases["rule"]} END AS rule,
  coalesce(CASE {cases["kind"]} END, CASE WHEN hit.url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM t LEFT JOIN hit ON hit.url = t.url
"""


def _license_sql() -> str:
    """Shares of the templates' five-word runs in every window, counted from the runs' places."""
    split = [(name, license_scan.words_of(text)) for name, text in license_scan.TEMPLATES]
    classes = license_scan.size_classes([len(w) for _, w in split])
    rows = []
    for name, words in split:
        _, _, size, stride = next(c for c in classes if c[0] <= len(words) <= c[1])
        runs = dict.fromkeys(" ".join(words[i : i + 5]) for i in range(len(words) - 4))
        rows += [f"('{name}', {size}, {stride}, {len(runs)}, '{run}')" for run in runs]
    return rf"""
WITH t(template, size, stride, n, run) AS (VALUES {", ".join(rows)}),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w),
h AS (
  SELECT doc_id, template, size, stride, n, run, i - 1 AS pos FROM g
  JOIN t ON run = w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]
), k AS (
  SELECT doc_id, template, n, run, stride, unnest(range(greatest(0, ceil((pos + 5 - size) / stride::DOUBLE))::BIGINT, pos // stride + 1)) AS k FROM h
), s AS (
  SELECT doc_id, template, (k * stride)::INT AS start_word, count(DISTINCT run) / n::DOUBLE AS share FROM k GROUP BY doc_id, template, k, stride, n
)
SELECT doc_id, template, max(share) AS containment, arg_min(start_word, (-share, start_word)) AS start_word
FROM s WHERE share * 100 >= {license_scan.PERCENT} - 1e-9 GROUP BY 1, 2
"""


@query("op6_url_rules", _url_sql())
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.label_urls(pages, table(spark, sf_dir, "labels")))


@query("op8_license_scan", _license_sql())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return license_scan.scan(table(spark, sf_dir, "documents"))

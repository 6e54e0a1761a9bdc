"""Citation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.operators import citations as cit
from statutelake.plans import corpus
from statutelake.plans.oracle import NUM, NUMERALS, cte, sql
from statutelake.plans.registry import query

PRC = corpus.PRC
_ALL = "unnest(regexp_extract_all(content, '{p}', {g})) AS {n}"
_Q = f"[《〈]([^》〉]{{2,40}})[》〉]第({NUM})条"
_S = f"本法[^第]{{0,10}}第({NUM})条"
_B = f"参照([^，。《》第]+)第({NUM})条"


def _pass(number: int, pattern: str, title: str, label_group: int) -> str:
    return f"""SELECT law_id, global_order, article_num, {number} AS pass, i AS pos, m[i] AS raw_text, {title} AS to_title,
      '第' || regexp_extract(m[i], '{pattern}', {label_group}) || '条' AS to_label
    FROM (SELECT law_id, global_order, article_num, regexp_extract_all(content, '{pattern}') AS m,
      generate_subscripts(regexp_extract_all(content, '{pattern}'), 1) AS i FROM articles)"""


cte("cite1", _pass(1, _Q, f"regexp_extract(m[i], '{_Q}', 1)", 2), "articles")
cte(
    "shorts",
    f"""SELECT replace(title, '{PRC}', '') AS short, max(title) AS full_title FROM laws WHERE is_current = 1
    GROUP BY 1 HAVING count(*) = 1 AND length(short) >= 2""",
    "laws",
)
cte(
    "cite2",
    f"""SELECT c.law_id, c.global_order, c.article_num, 2 AS pass, c.pos, s.short || c.to_label AS raw_text, s.full_title AS to_title, c.to_label
    FROM ({_pass(2, _B, f"regexp_extract(m[i], '{_B}', 1)", 2)}) c JOIN shorts s ON s.short = c.to_title""",
    "articles", "shorts",
)
cte("cite3", _pass(3, _S, "CAST(NULL AS VARCHAR)", 1), "articles")
cte(
    "title_ids",
    "SELECT title, max(pub_date || '#' || lpad(CAST(id AS VARCHAR), 12, '0')) AS top FROM laws WHERE is_current = 1 GROUP BY title",
    "laws",
)
cte(
    "art_index",
    f"""SELECT key, label, law_id, global_order, article_num, chapter_num, section_num FROM (
      SELECT key, label, law_id, global_order, article_num, chapter_num, section_num,
        row_number() OVER (PARTITION BY key, label ORDER BY CASE WHEN law_id = pref THEN 0 ELSE 1 END, law_id, global_order) AS rn FROM (
        SELECT unnest([l.title, replace(l.title, '{PRC}', '')]) AS key, a.article_number AS label, a.*,
          CAST(split_part(t.top, '#', 2) AS BIGINT) AS pref
        FROM articles a JOIN laws l ON a.law_id = l.id LEFT JOIN title_ids t ON t.title = l.title WHERE a.article_number IS NOT NULL)) WHERE rn = 1""",
    "articles", "laws", "title_ids",
)
cte(
    "cites",
    """SELECT * FROM (SELECT c.law_id, c.global_order, c.article_num, l.title AS law_title, pass, pos, raw_text, to_label,
      CASE WHEN pass = 3 THEN 'self_ref' ELSE 'cross_law' END AS ref_type,
      CASE WHEN pass = 3 THEN l.title ELSE coalesce(s.full_title, c.to_title) END AS to_title
    FROM (SELECT * FROM cite1 UNION ALL SELECT * FROM cite2 UNION ALL SELECT * FROM cite3) c
    JOIN laws l ON l.id = c.law_id AND l.is_current = 1
    LEFT JOIN shorts s ON s.short = replace(c.to_title, '""" + PRC + """', ''))
    WHERE pass <> 2 OR to_title <> law_title""",
    "cite1", "cite2", "cite3", "laws", "shorts",
)
cte(
    "resolved",
    f"""SELECT * FROM (SELECT c.*, x.law_id AS loc_law_id, x.article_num AS to_article_num, x.chapter_num AS to_chapter_num, x.section_num AS to_section_num,
      row_number() OVER (PARTITION BY c.law_id, c.global_order, c.to_title, c.to_label ORDER BY c.pass, c.pos) AS rn,
      coalesce(x.law_id, CASE WHEN c.ref_type = 'self_ref' THEN c.law_id END, CAST(split_part(t.top, '#', 2) AS BIGINT)) AS to_law_id,
      CASE WHEN x.law_id IS NULL THEN 0 ELSE 1 END AS resolved
    FROM cites c LEFT JOIN art_index x ON x.key = c.to_title AND x.label = c.to_label LEFT JOIN title_ids t ON t.title = c.to_title) WHERE rn = 1""",
    "cites", "art_index", "title_ids",
)
cte("node_index", "SELECT law_id, article_num, max(global_order) AS node_order FROM articles GROUP BY 1, 2", "articles")
cte(
    "edges",
    """SELECT r.law_id AS from_law_id, f.node_order AS from_order, r.article_num AS from_article_num, r.to_law_id, t.node_order AS to_order,
      r.to_article_num, r.to_chapter_num, r.to_section_num, r.ref_type, r.resolved, r.raw_text
    FROM resolved r JOIN node_index f ON f.law_id = r.law_id AND f.article_num = r.article_num
    LEFT JOIN node_index t ON t.law_id = r.to_law_id AND t.article_num = r.to_article_num
    WHERE NOT (r.ref_type = 'cross_law' AND r.to_law_id IS NOT NULL AND r.to_article_num IS NOT NULL AND t.node_order IS NULL)""",
    "resolved", "node_index",
)
cte(
    "case_cites",
    f"""SELECT doc_key, i AS pos, m[i] AS raw_ref, regexp_extract(m[i], '《([^》]{{2,30}})》第({NUM})条', 1) AS title,
      list_position({NUMERALS}, regexp_extract(m[i], '《([^》]{{2,30}})》第({NUM})条', 2)) AS article_num
    FROM (SELECT doc_key, regexp_extract_all(full_text, '《([^》]{{2,30}})》第({NUM})条') AS m, generate_subscripts(regexp_extract_all(full_text, '《([^》]{{2,30}})》第({NUM})条'), 1) AS i FROM cases)""",
    "cases",
)
cte(
    "case_links",
    f"""SELECT doc_key, law_id, node_order, CAST(article_num AS INT) AS article_num, raw_ref, ref_law_title FROM (
      SELECT c.doc_key, k.law_id, c.article_num, c.raw_ref, c.title AS ref_law_title, n.node_order,
        row_number() OVER (PARTITION BY c.doc_key, k.law_id, c.article_num ORDER BY c.pos) AS rn
      FROM case_cites c
      JOIN (SELECT title, CASE WHEN f IS NOT NULL THEN f ELSE s END AS law_id FROM (
         SELECT DISTINCT c.title, f.id AS f, s.id AS s FROM case_cites c
         LEFT JOIN (SELECT title, max(id) AS id FROM laws WHERE is_current = 1 GROUP BY 1) f ON f.title = c.title
         LEFT JOIN (SELECT replace(title, '{PRC}', '') AS short, min(id) AS id FROM laws WHERE is_current = 1 GROUP BY 1) s ON s.short = replace(c.title, '{PRC}', ''))) k
        ON k.title = c.title AND k.law_id IS NOT NULL
      LEFT JOIN node_index n ON n.law_id = k.law_id AND n.article_num = c.article_num) WHERE rn = 1""",
    "case_cites", "laws", "node_index",
)


def edges(spark, sf_dir):
    return cit.build_citations(corpus.articles(spark, sf_dir), corpus.laws(spark, sf_dir))


@query("j1_cite_quoted", sql("SELECT law_id, global_order, CAST(pos - 1 AS INT) AS pos, raw_text, to_title, to_label FROM cite1", "cite1"))
def j1(spark, sf_dir):
    return cit.cite_quoted(corpus.articles(spark, sf_dir), ["law_id", "global_order"])


@query("j2_cite_short", sql("SELECT law_id, global_order, raw_text, to_title, to_label FROM cite2", "cite2"))
def j2(spark, sf_dir):
    titles = cit.short_titles(corpus.laws(spark, sf_dir))
    return cit.cite_short(corpus.articles(spark, sf_dir), ["law_id", "global_order"], titles).drop("pos")


@query("j3_cite_self", sql("SELECT law_id, global_order, CAST(pos - 1 AS INT) AS pos, raw_text, to_label FROM cite3", "cite3"))
def j3(spark, sf_dir):
    return cit.cite_self(corpus.articles(spark, sf_dir), ["law_id", "global_order"]).drop("to_title")


@query("c2_resolve_citations", sql("SELECT law_id, global_order, to_title, to_label, to_law_id, to_article_num, resolved FROM resolved", "resolved"))
def c2(spark, sf_dir):
    out = cit.resolved_citations(corpus.articles(spark, sf_dir), corpus.laws(spark, sf_dir))
    return out.select(
        "law_id", "global_order", "to_title", "to_label", "to_law_id",
        F.col("loc_article_num").alias("to_article_num"), F.col("resolved").cast("int").alias("resolved"),
    )


@query("e6_first_citation", sql("SELECT law_id, global_order, pass, raw_text, to_title, to_label FROM resolved", "resolved"))
def e6(spark, sf_dir):
    cites = cit.citation_passes(corpus.articles(spark, sf_dir), corpus.laws(spark, sf_dir))
    first = cit.first_citation(cites, ["law_id", "global_order"], ["to_title", "to_label"], ["pass", "pos"])
    return first.select("law_id", "global_order", "pass", "raw_text", "to_title", "to_label")


@query("j5_build_citations", sql("SELECT * FROM edges", "edges"))
def j5(spark, sf_dir):
    return edges(spark, sf_dir)


@query("c3_bind_edges", sql("SELECT ref_type, resolved, to_order IS NULL AS open_end, count(*) AS n FROM edges GROUP BY 1, 2, 3", "edges"))
def c3(spark, sf_dir):
    return edges(spark, sf_dir).groupBy("ref_type", "resolved", F.col("to_order").isNull().alias("open_end")).agg(F.count("*").alias("n"))


_STATS = "count(*) AS total, count(*) FILTER (ref_type = 'cross_law') AS cross_law, count(*) FILTER (ref_type = 'self_ref') AS self_ref, count(*) FILTER (resolved = 1) AS resolved, round(count(*) FILTER (resolved = 1) * 100.0 / count(*), 1) AS rate"


@query("d6_citation_stats", sql(f"SELECT {_STATS} FROM edges", "edges"))
def d6(spark, sf_dir):
    return cit.citation_stats(edges(spark, sf_dir))


@query("d6_citation_stats_by_domain", sql(f"SELECT l.legal_domain, {_STATS} FROM edges e JOIN laws l ON l.id = e.from_law_id GROUP BY 1", "edges", "laws"))
def d6_domain(spark, sf_dir):
    domains = corpus.laws(spark, sf_dir).select(F.col("id").alias("from_law_id"), "legal_domain")
    return cit.citation_stats(edges(spark, sf_dir).join(domains, "from_law_id"), ["legal_domain"])


@query(
    "d7_citation_tiers",
    sql(
        """SELECT l.id, l.title, coalesce(c.n, 0) AS cited, CASE WHEN coalesce(c.n, 0) >= 50 THEN 'T0' WHEN c.n >= 20 THEN 'T1' WHEN c.n >= 10 THEN 'T2'
           WHEN c.n >= 5 THEN 'T3' WHEN c.n >= 1 THEN 'T4' ELSE 'T5' END AS tier
           FROM laws l LEFT JOIN (SELECT to_law_id, count(*) AS n FROM edges GROUP BY 1) c ON c.to_law_id = l.id""",
        "laws", "edges",
    ),
)
def d7(spark, sf_dir):
    return cit.citation_tiers(corpus.laws(spark, sf_dir), edges(spark, sf_dir))


@query(
    "j12_citation_degree",
    sql(
        """SELECT coalesce(o.id, i.id) AS law_id, coalesce(cites, 0) AS cites, coalesce(cites_resolved, 0) AS cites_resolved, coalesce(cited, 0) AS cited,
             CASE WHEN cites > 0 THEN round(cites_resolved * 100.0 / cites, 1) END AS rate
           FROM (SELECT from_law_id AS id, count(*) AS cites, count(*) FILTER (resolved = 1) AS cites_resolved FROM edges GROUP BY 1) o
           FULL JOIN (SELECT to_law_id AS id, count(*) AS cited FROM edges WHERE to_law_id IS NOT NULL GROUP BY 1) i ON o.id = i.id""",
        "edges",
    ),
)
def j12(spark, sf_dir):
    return cit.citation_degree(edges(spark, sf_dir))


@query("j8_cited_laws", sql("SELECT DISTINCT from_law_id, to_law_id FROM edges WHERE ref_type = 'cross_law' AND to_law_id IS NOT NULL", "edges"))
def j8(spark, sf_dir):
    return cit.cited_laws(edges(spark, sf_dir))


@query(
    "c15_cited_by",
    sql(
        """SELECT e.to_law_id, e.to_article_num, e.from_law_id, e.from_article_num, l.title AS from_title FROM edges e JOIN laws l ON l.id = e.from_law_id
           WHERE e.resolved = 1 AND e.ref_type = 'cross_law' AND e.to_article_num IS NOT NULL""",
        "edges", "laws",
    ),
)
def c15(spark, sf_dir):
    return cit.cited_by(edges(spark, sf_dir), corpus.laws(spark, sf_dir))


@query("c4_link_cases", sql("SELECT * FROM case_links", "case_links"))
def c4(spark, sf_dir):
    return cit.link_cases(corpus.cases(spark, sf_dir), corpus.laws(spark, sf_dir), corpus.articles(spark, sf_dir))


@query(
    "i19_cases_for_article",
    sql(
        """SELECT l.title AS law_title, k.article_num, k.doc_key, d.title AS case_title, d.pub_date FROM case_links k
           JOIN cases d ON d.doc_key = k.doc_key JOIN laws l ON l.id = k.law_id""",
        "case_links", "cases", "laws",
    ),
)
def i19(spark, sf_dir):
    laws, docs = corpus.laws(spark, sf_dir), corpus.cases(spark, sf_dir)
    return cit.cases_for_article(cit.link_cases(docs, laws, corpus.articles(spark, sf_dir)), docs, laws)

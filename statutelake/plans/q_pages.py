"""Queries of menu places, pages at them, changes between runs and retrieval in layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.functions import rules as r
from statutelake.operators import classify as cl
from statutelake.operators import documents as doc
from statutelake.operators import quality as qa
from statutelake.operators import search as se
from statutelake.operators.lineage import materialize, step
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, sql, words
from statutelake.plans.q_citations import edges
from statutelake.plans.q_classify import menu
from statutelake.plans.q_search import DOMAINS, expert_hits, expert_table, expert_terms
from statutelake.plans.registry import query

L, N, A = corpus.laws, corpus.nodes, corpus.articles
c = F.col

_OWN = " ".join(f"WHEN menu_group = '{g}' THEN list_position({words(names)}, subgroup)" for g, names in r.SUBGROUP_ORDER.items())
_BELOW = "行政法规/"
query("f5_menu_places", sql(
    f"""SELECT menu_group, subgroup, dense_rank() OVER (ORDER BY group_pos NULLS LAST, menu_group) AS group_place, row_number() OVER (PARTITION BY menu_group ORDER BY tier, pos NULLS LAST, subgroup) AS place
        FROM (SELECT *, CASE WHEN own IS NOT NULL THEN 0 WHEN starts_with(subgroup, '{_BELOW}') THEN 1 ELSE 2 END AS tier,
          CASE WHEN own IS NOT NULL THEN own WHEN starts_with(subgroup, '{_BELOW}') THEN list_position({words(r.SUBJECT_ORDER)}, replace(subgroup, '{_BELOW}', '')) END AS pos
        FROM (SELECT *, CASE {_OWN} END AS own, list_position({words(r.GROUP_ORDER)}, menu_group) AS group_pos FROM (SELECT DISTINCT menu_group, subgroup FROM menu)))""", "menu"))(
    lambda s, d: cl.menu_places(menu(s, d), cl.order_table(s)))

_NAMES = ", ".join("('" + "', '".join(x.replace("'", "''") for x in (kind, *pair)) + "')" for kind, table in r.ENGLISH_NAMES.items() for pair in table.items())
cte("en_names", f"SELECT * FROM (VALUES {_NAMES}) AS t(kind, name, name_en)")


def _named(kind: str, value: str) -> str:
    return f"coalesce((SELECT name_en FROM en_names WHERE kind = '{kind}' AND name = {value}), {value})"


query("h17_english_names", sql(
    f"""SELECT id, {_named('category', 'category')} AS category_en, {_named('domain', 'legal_domain')} AS domain_en, {_named('body', 'issuing_org')} AS body_en, {_named('group', 'menu_group')} AS group_en,
        CASE WHEN starts_with(subgroup, '{_BELOW}') THEN 'Administrative Regulations: ' || {_named('subject', f"replace(subgroup, '{_BELOW}', '')")} ELSE {_named('subgroup', 'subgroup')} END AS subgroup_en FROM menu""", "menu", "en_names"))(
    lambda s, d: cl.english_names(menu(s, d), cl.name_table(s)).select("id", "category_en", "domain_en", "body_en", "group_en", "subgroup_en"))

# L3: probes in the search over court documents, and the keys of their translations.
PROBES = [*corpus.WORDS, "裁判要点", "无此词"]
query("l3_search_probes", sql(
    f"""SELECT term, count(doc_key) AS docs, count(doc_key) > 0 AS found FROM (SELECT unnest({words(PROBES)}) AS term) t
        LEFT JOIN cases c ON contains(lower(c.title), t.term) OR contains(lower(c.full_text), t.term) GROUP BY 1""", "cases"))(
    lambda s, d: qa.case_probes(corpus.cases(s, d), s.createDataFrame([(w,) for w in PROBES], "term string"), ["title", "full_text"]))
query("l3_translation_keys", sql(
    """SELECT "check", value FROM (UNPIVOT (
         SELECT count(t) AS translations, count(*) FILTER (t AND k) AS known_keys, count(*) FILTER (t AND k AND titled) AS known_with_title, count(*) FILTER (k IS NULL) AS unknown_keys,
           count(*) FILTER (t IS NULL AND titled) AS title_without_translation FROM (
             SELECT t.t, c.k, c.titled FROM (SELECT DISTINCT doc_key, true AS t FROM (SELECT doc_key FROM cases WHERE length(doc_key) % 2 = 0 OR doc_key LIKE '%3' UNION ALL SELECT 'x/' || s_suppkey FROM supplier)) t
             FULL JOIN (SELECT doc_key, true AS k, coalesce(title_en, '') <> '' AS titled FROM cases) c ON c.doc_key = t.doc_key))
       ON COLUMNS(*) INTO NAME "check" VALUE value)""", "cases"))(
    lambda s, d: qa.translation_keys(corpus.cases(s, d), corpus.cases(s, d).filter("length(doc_key) % 2 = 0 OR doc_key LIKE '%3'").select("doc_key").unionByName(
        corpus.table(s, d, "supplier").select(F.concat(F.lit("x/"), "s_suppkey").alias("doc_key")))))

# The run before had other citations: some are gone, some new, some had no target.
cte("edges_before", "SELECT * REPLACE (CASE WHEN from_law_id % 5 = 1 THEN 0 ELSE resolved END AS resolved) FROM edges WHERE from_law_id % 7 <> 3", "edges")
cte("edges_after", "SELECT * REPLACE (CASE WHEN from_law_id % 13 = 4 THEN 0 ELSE resolved END AS resolved) FROM edges WHERE from_law_id % 11 <> 2", "edges")
_KEYS = ["from_law_id", "from_article_num", "raw_text", "ref_type"]
_SAME = ", ".join(_KEYS)
cte("edge_sides", f"""SELECT {_SAME}, sum(n0) AS n0, sum(r0) AS r0, sum(n1) AS n1, sum(r1) AS r1 FROM (
    SELECT {_SAME}, 1 AS n0, resolved AS r0, 0 AS n1, 0 AS r1 FROM edges_before UNION ALL SELECT {_SAME}, 0, 0, 1, resolved FROM edges_after) GROUP BY ALL""", "edges_before", "edges_after")


def _runs(s, d):
    all_ = materialize(edges(s, d).select("from_law_id", "from_article_num", "raw_text", "ref_type", "resolved"))
    before = all_.filter(c("from_law_id") % 7 != 3).withColumn("resolved", F.when(c("from_law_id") % 5 == 1, 0).otherwise(c("resolved")))
    after = all_.filter(c("from_law_id") % 11 != 2).withColumn("resolved", F.when(c("from_law_id") % 13 == 4, 0).otherwise(c("resolved")))
    return qa.edge_deltas(before, after, _KEYS)


query("l14_edge_deltas", sql(
    """SELECT ref_type, kind, CAST(sum(n) AS BIGINT) AS n FROM (
         SELECT ref_type, unnest(['kept', 'lost', 'won', 'resolved', 'unresolved']) AS kind,
           unnest([least(n0, n1), greatest(n0 - n1, 0), greatest(n1 - n0, 0), greatest(r1 - r0, 0), greatest(r0 - r1, 0)]) AS n FROM edge_sides) GROUP BY 1, 2 HAVING sum(n) > 0""", "edge_sides"))(_runs)
query("l14_edge_totals", sql(
    """SELECT item, CAST(change AS BIGINT) AS change FROM (
         SELECT 'total' AS item, sum(n1) - sum(n0) AS change FROM edge_sides UNION ALL SELECT 'resolved', sum(r1) - sum(r0) FROM edge_sides
         UNION ALL SELECT ref_type, sum(n1) - sum(n0) FROM edge_sides WHERE n0 <> n1 GROUP BY 1)""", "edge_sides"))(lambda s, d: qa.edge_totals(_runs(s, d)))

# Pages at their menu places.
cte("paths", """SELECT id AS law_id, title, array_to_string(list_append(p, title || '.md'), '/') AS path, repeat('../', len(p)) AS up FROM (
    SELECT id, title, list_filter(string_split(menu_group || '/' || subgroup, '/'), lambda x: trim(x) <> '') AS p FROM menu WHERE is_current = 1)""", "menu")
cte("marks", """SELECT law_id, article_num, n, '&thinsp;' || string_agg(mark, '&thinsp;' ORDER BY i) AS marks FROM (
    SELECT e.*, CASE WHEN f.path IS NULL THEN '<sup>[' || i || ']</sup>' ELSE '<sup><a href="' || coalesce(t.up, '') || f.path || '#art-' || from_article_num || '" title="被《' || l.title || '》第' || from_article_num || '条引用">[' || i || ']</a></sup>' END AS mark
    FROM (SELECT to_law_id AS law_id, to_article_num AS article_num, from_law_id, from_article_num, row_number() OVER w AS i, count(*) OVER (PARTITION BY to_law_id, to_article_num) AS n FROM edges
          WHERE resolved = 1 AND ref_type = 'cross_law' AND to_article_num IS NOT NULL WINDOW w AS (PARTITION BY to_law_id, to_article_num ORDER BY from_law_id, from_order, raw_text)) e
    JOIN laws l ON l.id = e.from_law_id LEFT JOIN paths f ON f.law_id = e.from_law_id LEFT JOIN paths t ON t.law_id = e.law_id WHERE i <= 20) GROUP BY 1, 2, 3""", "edges", "laws", "paths")
cte("links", """SELECT DISTINCT from_law_id AS law_id, from_order AS global_order, raw_text AS raw, '[' || raw_text || '](' || CASE WHEN ref_type = 'self_ref' THEN '' ELSE coalesce(o.up, '') || t.path END || '#art-' || to_article_num || ')' AS link
    FROM edges LEFT JOIN paths o ON o.law_id = from_law_id LEFT JOIN paths t ON t.law_id = to_law_id
    WHERE resolved = 1 AND raw_text <> '' AND to_article_num IS NOT NULL AND (ref_type = 'self_ref' OR t.path IS NOT NULL)""", "edges", "paths")


def _places(s, d):
    return materialize(menu(s, d).filter("is_current = 1").select("id", "menu_group", "subgroup"))


query("g19_cited_by", sql("SELECT law_id, article_num, n, marks FROM marks", "marks"))(
    lambda s, d: doc.cited_by(step(lambda: edges(s, d)), L(s, d), doc.law_paths(L(s, d), _places(s, d)), 20))
query("g19_page_links", sql("SELECT * FROM links", "links"))(lambda s, d: doc.page_links(step(lambda: edges(s, d)), doc.law_paths(L(s, d), _places(s, d))))


@query("g19_render_pages", sql(
    """SELECT n.law_id, n.global_order, CASE type WHEN 'chapter' THEN '### ' || trim(content) WHEN 'section' THEN '#### ' || trim(content) ELSE '<a id="art-' || n.article_num || '"></a>' ||
         replace(coalesce(linked, trim(content)) || coalesce(marks, ''), chr(10), '  ' || chr(10)) END AS line
       FROM nodes n LEFT JOIN marks m ON m.law_id = n.law_id AND m.article_num = n.article_num AND n.type = 'article' LEFT JOIN (
         SELECT law_id, global_order, list_reduce(list_prepend({'raw': '', 'link': text}, links), lambda a, x: {'raw': '', 'link': replace(a.link, x.raw, x.link)}).link AS linked FROM (
           SELECT k.law_id, k.global_order, any_value(trim(a.content)) AS text, list({'raw': raw, 'link': link} ORDER BY length(raw) DESC, raw, link) AS links
           FROM links k JOIN articles a USING (law_id, global_order) GROUP BY 1, 2)) t ON t.law_id = n.law_id AND t.global_order = n.global_order""", "nodes", "marks", "links", "articles"))
def g19_pages(s, d):
    nodes = N(s, d).withColumn("content_en", F.lit(None).cast("string"))
    found = step(lambda: edges(s, d))
    return doc.render_pages(nodes, L(s, d), found, _places(s, d), 20).filter("global_order >= 0")


_FIELDS = [("分类", "category"), ("法律部门", "legal_domain"), ("发布机关", "issuing_org"), ("发文字号", "doc_number"), ("公布日期", "pub_date"), ("生效日期", "effective_date")]
_META = ", ".join(f"CASE WHEN trim(coalesce({col}::VARCHAR, '')) <> '' THEN '**{name}**：' || {col} END" for name, col in _FIELDS)
cte("plain_links", """SELECT DISTINCT from_law_id AS law_id, from_order AS global_order, raw_text AS raw,
      '[' || raw_text || '](' || CASE WHEN ref_type = 'self_ref' THEN '' ELSE 'law-' || to_law_id END || '#art-' || to_article_num || ')' AS link
    FROM edges WHERE resolved = 1 AND raw_text <> ''""", "edges")
query("g19_render_laws", sql(
    f"""SELECT id AS law_id, -1::BIGINT AS global_order, '# ' || title || chr(10) || chr(10) || concat_ws('  ' || chr(10), {_META}) || chr(10) || chr(10) || '> ' || promulgation_info || chr(10) || chr(10) || '---' AS line FROM laws
        UNION ALL SELECT n.law_id, n.global_order, CASE type WHEN 'chapter' THEN '### ' || content WHEN 'section' THEN '#### ' || content ELSE '<a id="art-' || n.article_num || '"></a>' ||
          replace(trim(coalesce(linked, content), ' '), chr(10), '  ' || chr(10)) || coalesce(english, '') END FROM nodes n LEFT JOIN (
            SELECT law_id, global_order, list_reduce(list_prepend({{'raw': '', 'link': text}}, links), lambda a, x: {{'raw': '', 'link': replace(a.link, x.raw, x.link)}}).link AS linked FROM (
              SELECT k.law_id, k.global_order, any_value(a.content) AS text, list({{'raw': raw, 'link': link}} ORDER BY length(raw) DESC, raw, link) AS links
              FROM plain_links k JOIN articles a USING (law_id, global_order) GROUP BY 1, 2)) t ON t.law_id = n.law_id AND t.global_order = n.global_order
          LEFT JOIN (SELECT law_id, global_order, chr(10) || chr(10) || '**' || CASE WHEN label <> '' THEN label ELSE 'Article ' || article_num END || '** ' ||
              replace(CASE WHEN label <> '' THEN trim(content_en[length(label) + 1:], ' ') ELSE content_en END, chr(10), '  ' || chr(10)) AS english
            FROM (SELECT *, regexp_extract(content_en, '^(Article \\d+)', 1) AS label FROM articles WHERE content_en IS NOT NULL)) e ON e.law_id = n.law_id AND e.global_order = n.global_order""",
    "laws", "nodes", "plain_links", "articles"))(lambda s, d: doc.render_laws(N(s, d), L(s, d), step(lambda: edges(s, d))))

# Groups of law with domains of their own.
_DOMAIN = f"({words(DOMAINS)})"
cte("chain_domains", f"SELECT DISTINCT expert AS q_id, unnest([{_DOMAIN}[length(law_title) % 4 + 1], {_DOMAIN}[(length(law_title) + 1) % 4 + 1]]) AS legal_domain FROM experts", "experts")


def _domains(s, d):
    names = F.array(*[F.lit(x) for x in DOMAINS])
    pick = [F.element_at(names, ((F.length("law_title") + i) % 4 + 1).cast("int")) for i in (0, 1)]
    return expert_table(s, d).select(c("expert").alias("q_id"), F.explode(F.array(*pick)).alias("legal_domain"))


def _group(categories: str, k: int, layer: int) -> str:
    return f"""SELECT q_id, law_id, global_order, {layer} AS layer, pos AS term_rank, hit_rank, 0 AS pinned FROM (
      SELECT t.expert AS q_id, t.pos, h.law_id, h.global_order, row_number() OVER (PARTITION BY t.expert, t.term ORDER BY h.law_id, h.global_order) AS hit_rank
      FROM expert_terms t JOIN ehits h ON h.term = t.term JOIN laws l ON l.id = h.law_id AND l.is_current = 1 AND list_contains({categories}, l.category)
      JOIN chain_domains x ON x.q_id = t.expert AND x.legal_domain = l.legal_domain) WHERE hit_rank <= {k}"""


_CHAIN = f"""SELECT q_id, law_id, global_order, layer, pinned FROM (SELECT *, row_number() OVER (PARTITION BY q_id, law_id, global_order ORDER BY layer, term_rank, hit_rank) AS rn FROM (
  SELECT expert AS q_id, law_id, global_order, 0 AS layer, 0 AS term_rank, hit_rank, 1 AS pinned FROM chapter_arts WHERE hit_rank <= 25
  UNION ALL SELECT t.expert, x.law_id, x.global_order, 1, t.pos, x.hit_rank, 0 FROM expert_terms t JOIN experts e ON e.expert = t.expert JOIN (
    SELECT * FROM (SELECT h.*, l.title, row_number() OVER (PARTITION BY term, l.title ORDER BY h.law_id, h.global_order) AS hit_rank FROM ehits h JOIN laws l ON l.id = h.law_id AND l.is_current = 1) WHERE hit_rank <= 10) x
    ON x.term = t.term AND x.title = e.law_title
  UNION ALL {_group(words(se.LAW_CATEGORIES), 10, 2)} UNION ALL {_group(words(se.INTERPRETATIONS), 8, 3)}
  UNION ALL SELECT q_id, law_id, global_order, 4, pos, hit_rank, 0 FROM (
    SELECT t.expert AS q_id, t.pos, h.law_id, h.global_order, row_number() OVER (PARTITION BY t.expert, t.term, h.law_id ORDER BY h.global_order) AS hit_rank
    FROM expert_terms t JOIN (SELECT DISTINCT e.expert, i.id FROM experts e JOIN (
        SELECT * FROM (SELECT p.title, l.id, row_number() OVER (PARTITION BY p.title ORDER BY l.pub_date DESC, l.id) AS place FROM (SELECT DISTINCT replace(law_title, '{corpus.PRC}', '') AS title FROM experts) p
        JOIN laws l ON l.category = '司法解释' AND l.is_current = 1 AND length(p.title) >= 1 AND (contains(l.title, p.title[1:6]) OR contains(l.promulgation_info, p.title[1:6]))) WHERE place <= 5) i
      ON i.title = replace(e.law_title, '{corpus.PRC}', '')) s ON s.expert = t.expert
    JOIN ehits h ON h.term = t.term AND h.law_id = s.id WHERE t.pos < 3) WHERE hit_rank <= 5)) WHERE rn = 1"""


@query("i17_chain_layers", sql(_CHAIN, "chapter_arts", "expert_terms", "experts", "ehits", "laws", "chain_domains"))
def i17(s, d):
    primary = expert_table(s, d).withColumnRenamed("expert", "q_id")
    terms = expert_terms(s, d).withColumnRenamed("expert", "q_id")
    found = se.retrieve_chain(primary, _domains(s, d), terms, N(s, d), L(s, d), expert_hits(s, d))
    return found.select("q_id", "law_id", "global_order", "layer", "pinned")

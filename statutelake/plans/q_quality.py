"""Quality suites, ids and translation import."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.operators import identity as ident
from statutelake.operators import quality as qa
from statutelake.operators import relational as rel
from statutelake.operators.citations import link_cases
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, sql, words
from statutelake.plans.q_citations import edges
from statutelake.plans.q_relational import _MARKS, keyed_laws, marks, snapshot
from statutelake.plans.q_search import alias_tables, hint_table, hits
from statutelake.plans.registry import query

L, N, A, D, T = corpus.laws, corpus.nodes, corpus.articles, corpus.cases, corpus.table
c = F.col
NODE = ["law_id", "global_order"]


def union_rules(table: str, keys: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT {keys}, '{sev}' AS severity, '{name}' AS rule FROM {table} WHERE {test}" for sev, name, test in rules)


cte("noise", union_rules("articles", "law_id, global_order", [
    ("high", "page_field", "regexp_matches(content, '[-－]\\s*PAGE\\s+\\d+\\s*[-－]')"), ("high", "hyperlink", "contains(content, 'HYPERLINK')"),
    ("high", "javascript", "contains(lower(content), 'javascript:')"), ("medium", "l_before_digit", "regexp_matches(content, '(^|[^\\p{L}\\p{N}_])l\\d')"),
    ("medium", "l_before_unit", "regexp_matches(content, '(^|[^\\p{L}\\p{N}_])l[月年日]')")]), "articles")
query("l6_noise", sql("SELECT * FROM noise", "noise"))(lambda s, d: qa.noise(A(s, d)))
cte("style", union_rules("articles", "law_id, global_order", [
    ("medium", "court_possessive", "contains(lower(content_en), 'people court')"), ("high", "untranslated_title_mark", "regexp_matches(content_en, '[《》]')"),
    ("low", "no_modal_verb", "length(content_en) > 100 AND NOT regexp_matches(lower(content_en), 'shall|may|must')"),
    ("medium", "will_or_would", "regexp_matches(content_en, '(?i)\\b(?:will|would)\\b')"), ("high", "untranslated_article", "regexp_matches(content_en, '第[一二三四五六七八九十百千\\d]+条')"),
    *[("high", f"chinese_punctuation {sign}", f"contains(content_en, '{sign}')") for sign in '，。；：、（）！？"'],
    ("medium", "full_width_blank", "contains(content_en, chr(12288))"), ("low", "lower_case_article", "regexp_matches(content_en, '\\barticle\\s+\\d+')")]), "articles")
query("l5_translation_style", sql("SELECT * FROM style", "style"))(lambda s, d: qa.translation_style(A(s, d)))
query("d10_issue_summary", sql("SELECT severity, rule, count(*) AS n, count(DISTINCT law_id) AS laws FROM style GROUP BY CUBE (severity, rule)", "style"))(
    lambda s, d: rel.issue_summary(qa.translation_style(A(s, d))))
query("l7_suspicious_latin", sql(
    f"""SELECT DISTINCT law_id, global_order, f AS fragment FROM (SELECT law_id, global_order, content, unnest(regexp_extract_all(content, '[A-Za-z][A-Za-z0-9\\-]*')) AS f FROM articles)
        WHERE NOT list_contains({words(qa.LEGAL_WORDS)}, upper(f)) AND NOT list_contains({words(qa.LEGAL_WORDS)}, f) AND NOT regexp_matches(f, '[A-Za-z]\\d')
        AND (length(f) > 1 OR regexp_matches(content[greatest(strpos(content, f) - 4, 1):strpos(content, f) + 4], '\\d' || f || '[月年日万]|' || f || '\\d'))""", "articles"))(lambda s, d: qa.suspicious_latin(A(s, d)))
query("l2_structure_issues", sql(
    """SELECT law_id, global_order, CASE WHEN article_num = p THEN 'duplicate' WHEN article_num > p + 1 THEN 'gap' ELSE 'reversal' END AS rule FROM (
       SELECT *, lag(article_num) OVER w AS p, lag(chapter_num) OVER w AS pc, lag(section_num) OVER w AS ps FROM articles
       WINDOW w AS (PARTITION BY law_id ORDER BY global_order)) WHERE pc = chapter_num AND ps = section_num AND article_num <> p + 1""", "articles"))(
    lambda s, d: qa.structure_issues(N(s, d), corpus.SEGMENT))


def reloaded(s, d):
    """The node table as a faulty load would leave it: noise was cut and
    articles without a label are missing."""
    return N(s, d).filter("type <> 'article' OR article_number IS NOT NULL").withColumn("content", F.regexp_replace("content", "－PAGE  2－", ""))


query("l1_source_against_table", sql(
    """SELECT law_id, global_order, rule, sample FROM (SELECT *, row_number() OVER (PARTITION BY law_id ORDER BY global_order) AS sample FROM (
       SELECT law_id, global_order, CASE WHEN article_number IS NULL THEN 'not_loaded' ELSE 'content' END AS rule FROM articles WHERE article_number IS NULL OR contains(content, 'PAGE  2'))) WHERE sample <= 5""", "articles"))(
    lambda s, d: qa.source_against_table(N(s, d), reloaded(s, d)))
_CHECKS = [("docs", "count(*)", "cases"), ("empty_text", "count(*) FILTER (full_text = '')", "cases"), ("with_keywords", "count(*) FILTER (keywords <> '')", "cases"),
           ("with_gist", "count(*) FILTER (ruling_gist <> '')", "cases"), ("links", "count(*)", "case_links"), ("resolved_links", "count(node_order)", "case_links"), ("linked_docs", "count(DISTINCT doc_key)", "case_links")]
query("l3_case_suite", sql(" UNION ALL ".join(f"SELECT '{n}' AS \"check\", {e} AS value FROM {t}" for n, e, t in _CHECKS), "cases", "case_links"))(
    lambda s, d: qa.case_suite(D(s, d), link_cases(D(s, d), L(s, d), A(s, d))))


def _currency(name: str, source: str) -> str:
    return f"""SELECT id, CASE WHEN repealed_by <> '' THEN CASE WHEN is_current <> 0 THEN 'repealed_but_current' END WHEN versions = 1 THEN CASE WHEN is_current <> 1 THEN 'should_be_current' END
      WHEN at_max > 1 THEN 'several_newest' WHEN pub_date = max_pub THEN CASE WHEN is_current <> 1 THEN 'should_be_current' END ELSE CASE WHEN is_current <> 0 THEN 'should_not_be_current' END END AS rule
    FROM (SELECT *, count(*) FILTER (pub_date = max_pub) OVER (PARTITION BY title_key, repealed_by = '') AS at_max FROM (SELECT *, count(*) OVER (PARTITION BY title_key, repealed_by = '') AS versions,
      max(pub_date) OVER (PARTITION BY title_key, repealed_by = '') AS max_pub FROM {source}))"""


query("l8_currency_suite", sql(
    f""", first_source AS (SELECT * FROM keyed WHERE source = 'flk'), lone AS (SELECT * FROM keyed WHERE source = 'gazette' AND title_key NOT IN (SELECT title_key FROM keyed WHERE source = 'flk' AND is_current = 1)),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title_key ORDER BY id DESC) AS rn FROM keyed WHERE source = 'flk' AND is_current = 1) WHERE rn = 1),
    pairs AS (SELECT b.id, b.is_current, (CASE WHEN a.doc_number <> '' AND b.doc_number <> '' THEN a.doc_number = b.doc_number WHEN a.doc_number = '' AND b.doc_number = '' THEN abs(a.pub_date::DATE - b.pub_date::DATE) <= 90 ELSE false END)
      AND NOT (a.pub_date = '2020-12-29' AND b.pub_date < '2020-01-01') AS same FROM one a JOIN keyed b USING (title_key) WHERE b.source = 'gazette' AND b.repealed_by = '')
    SELECT * FROM ({_currency('a', 'first_source')} UNION ALL {_currency('b', 'lone')} UNION ALL
      SELECT id, CASE WHEN same AND is_current <> 1 THEN 'same_version_not_current' WHEN NOT same AND is_current = 1 THEN 'other_version_current' END FROM pairs) WHERE rule IS NOT NULL""", "keyed"))(
    lambda s, d: qa.currency_suite(keyed_laws(s, d)))
query("l9_repeal_suite", sql(
    f""", m AS ({_MARKS}), g AS (SELECT * FROM keyed WHERE source = 'gazette'), r AS (SELECT g.* FROM m JOIN g ON m.title_key = g.title_key AND (m.doc_number = '' OR m.doc_number = g.doc_number))
    SELECT DISTINCT id, 'mark_not_applied' AS rule FROM r WHERE is_current <> 0 UNION SELECT DISTINCT id, 'newer_than_repeal' FROM r WHERE pub_date > '2021-01-01'
    UNION SELECT id, 'unexplained_zero' FROM g WHERE is_current = 0 AND id NOT IN (SELECT id FROM r)""", "keyed"))(
    lambda s, d: qa.repeal_suite(marks(s, d), keyed_laws(s, d).filter("source = 'gazette'")))


def _pairs(s, d):
    first, once, back = alias_tables(s, d)
    return first.unionByName(once).unionByName(back)


query("l10_enhancement_suite", sql(
    """, now AS (SELECT term, count(*) AS n FROM hits GROUP BY 1)
    SELECT target AS item, CASE WHEN now.n IS NULL THEN 'no_hits' ELSE 'stale_hits' END AS rule FROM alias_pairs p LEFT JOIN now ON now.term = p.target WHERE now.n IS NULL OR now.n <> p.hits
    UNION ALL SELECT target, 'duplicate' FROM (SELECT source, target FROM alias_pairs GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT law_title, 'title_not_current' FROM hints WHERE law_title NOT IN (SELECT title FROM laws WHERE is_current = 1)""", "hits", "alias_pairs", "hints", "laws"))(
    lambda s, d: qa.enhancement_suite(_pairs(s, d), hits(s, d), hint_table(s, d), L(s, d)))


def index(s, d):
    """A law index of 2015 in which the repealed files had other ids."""
    old = L(s, d).filter("pub_date < '2015-01-01'")
    return old.select("filename", "category", F.when(c("repealed_by") != "", c("id") + 1_000_000_000).otherwise(c("id")).alias("id"))


cte("files", "SELECT *, title || '_' || replace(pub_date, '-', '') AS filename FROM laws", "laws")
cte("law_index", "SELECT filename, category, CASE WHEN repealed_by <> '' THEN id + 1000000000 ELSE id END AS id FROM files WHERE pub_date < '2015-01-01'", "files")
query("l11_id_consistency", sql("SELECT f.id, i.id AS index_id FROM files f JOIN law_index i USING (filename) WHERE f.id <> i.id", "files", "law_index"))(
    lambda s, d: qa.id_consistency(index(s, d), L(s, d).select("filename", "id")).select("id", "index_id"))
query("c20_resolve_ids", sql(
    """SELECT f.title || '#' || f.id AS filename, coalesce(b.s_suppkey + 5000000, i.id) AS id, CASE WHEN b.s_suppkey IS NOT NULL THEN 'blocklist' WHEN i.id IS NOT NULL THEN 'embedded' ELSE 'orphan' END AS status
       FROM files f LEFT JOIN supplier b ON b.s_suppkey = f.id LEFT JOIN law_index i ON i.id = f.id""", "files", "law_index"))(
    lambda s, d: ident.resolve_ids(
        L(s, d).select(F.concat("title", F.lit("#"), "id").alias("filename"), c("id").alias("embedded_id")),
        L(s, d).join(T(s, d, "supplier").select(c("s_suppkey").alias("id")), "id").select(F.concat("title", F.lit("#"), "id").alias("filename"), (c("id") + 5000000).alias("id")), index(s, d)))
query("l12_changed_ids", sql("SELECT f.id AS old_id, i.id AS new_id, CASE WHEN i.id IS NULL THEN 'orphan' ELSE 'changed' END AS rule FROM files f LEFT JOIN law_index i ON i.filename = f.filename WHERE i.id IS NULL OR i.id <> f.id", "files", "law_index"))(
    lambda s, d: qa.changed_ids(L(s, d).select("filename", c("id").alias("old_id")), index(s, d)))
query("l13_without_output", sql("SELECT doc_key FROM cases WHERE full_text_en IS NULL", "cases"))(
    lambda s, d: qa.without_output(D(s, d).select("doc_key"), D(s, d).filter("full_text_en IS NOT NULL"), "doc_key"))
query("l14_run_report", sql(
    """SELECT 'added ' || legal_domain AS item, count(*) AS n FROM laws WHERE id NOT IN (SELECT id FROM snap) GROUP BY 1 UNION ALL SELECT 'removed', count(*) FROM snap WHERE id NOT IN (SELECT id FROM laws)
       UNION ALL SELECT 'currency ' || s.is_current || ' to ' || l.is_current, count(*) FROM snap s JOIN laws l USING (id) WHERE s.is_current <> l.is_current GROUP BY 1""", "laws", "snap"))(
    lambda s, d: qa.run_report(snapshot(s, d), L(s, d)))
query("l15_edge_integrity", sql(
    """SELECT to_law_id AS law_id, to_order AS global_order, 'to_order' AS side FROM edges JOIN articles a ON a.law_id = to_law_id AND a.global_order = to_order WHERE a.content_en IS NULL
       UNION ALL SELECT from_law_id, from_order, 'from_order' FROM edges JOIN articles a ON a.law_id = from_law_id AND a.global_order = from_order WHERE a.content_en IS NULL""", "edges", "articles"))(
    lambda s, d: qa.edge_integrity(edges(s, d), A(s, d).filter("content_en IS NOT NULL")))
query("l4_d11_match_translations", sql(
    """, own AS (SELECT law_id, article_number AS label, count(*) AS have FROM articles WHERE article_number IS NOT NULL GROUP BY 1, 2),
    tr AS (SELECT law_id, article_number AS label, count(*) FILTER (content_en IS NOT NULL) AS want, count(*) AS total FROM articles WHERE chapter_num = 1 AND article_number IS NOT NULL GROUP BY 1, 2)
    SELECT t.law_id, o.db_count, t.en_count, t.matched, CASE WHEN t.want = 0 THEN 'no_translation' WHEN t.matched = 0 THEN 'no_match' WHEN t.matched < t.en_count THEN 'partial' ELSE 'full' END AS status FROM (
      SELECT tr.law_id, CAST(sum(total) AS BIGINT) AS en_count, CAST(sum(want) AS BIGINT) AS want, CAST(sum(least(want, have)) AS BIGINT) AS matched FROM tr JOIN own USING (law_id, label) GROUP BY 1) t
    JOIN (SELECT law_id, CAST(sum(have) AS BIGINT) AS db_count FROM own GROUP BY 1) o USING (law_id)""", "articles"))(
    lambda s, d: ident.match_translations(A(s, d), A(s, d).filter("chapter_num = 1 AND article_number IS NOT NULL").select("law_id", "article_number", "content_en")))
query("c17_import_translations", sql(
    """, tr AS (SELECT law_id, coalesce(article_number, '') AS k, max(content_en || '') AS any_en FROM articles WHERE content_en IS NOT NULL AND article_number IS NOT NULL GROUP BY 1, 2),
    last_tr AS (SELECT law_id, article_number AS k, arg_max(content_en, global_order) AS en FROM articles WHERE content_en IS NOT NULL AND article_number IS NOT NULL GROUP BY 1, 2)
    SELECT a.law_id, a.global_order, coalesce(a.content_en, t.en) AS content_en FROM articles a LEFT JOIN last_tr t ON t.law_id = a.law_id AND t.k = coalesce(a.article_number, '')""", "articles"))(
    lambda s, d: ident.import_translations(A(s, d), A(s, d).filter("article_number IS NOT NULL").select(
        "law_id", c("global_order").alias("pos"), F.concat(F.lit("第"), "article_num", F.lit("条")).alias("article_number"), "content_en")))
query("c18_import_by_number", sql(
    """SELECT a.law_id, a.global_order, 'T' || a.article_num AS new_en FROM articles a JOIN laws l ON l.id = a.law_id WHERE l.category = '法律' AND a.article_num <= 60""", "articles", "laws"))(
    lambda s, d: ident.import_by_number(A(s, d), L(s, d).withColumn("filename", F.concat("filename", F.lit("#"), "id")),
                                        T(s, d, "part").select("p_partkey").join(L(s, d).filter("category = '法律'").select(c("id").alias("p_partkey"), F.concat("filename", F.lit("#"), "id").alias("filename"), "category"), "p_partkey")
                                        .select("filename", "category", F.explode(F.sequence(F.lit(1), F.lit(60))).alias("number")).withColumn("content_en", F.concat(F.lit("T"), "number"))))
_RANGES = {"法律": (2_000_000_000, 100_000_000_000), "行政法规": (200_000_000_000, 100_000_000_000), "司法解释": (400_000_000_000, 100_000_000_000), "修正案": (600_000_000_000, 100_000_000_000)}


def files(s, d):
    return L(s, d).select(F.concat("title", F.lit("#"), "id").alias("filename"), "category", "pub_date", "id")


_BASE = "CASE category " + " ".join(f"WHEN '{k}' THEN {v[0]}" for k, v in _RANGES.items()) + " END"
cte("assigned", f"""SELECT title || '#' || id AS filename, category, pub_date, {_BASE} + row_number() OVER (PARTITION BY category, pub_date < '2015-01-01' ORDER BY pub_date, title || '#' || id)
    + CASE WHEN pub_date < '2015-01-01' THEN -1 ELSE (SELECT count(*) FROM laws x WHERE x.category = laws.category AND x.pub_date < '2015-01-01') - 1 END AS id FROM laws""", "laws")
query("e1_assign_ids", sql("SELECT filename, category, pub_date, CAST(id AS BIGINT) AS id FROM assigned", "assigned"))(
    lambda s, d: (lambda f: ident.assign_ids(f, ident.assign_ids(f.filter("pub_date < '2015-01-01'"), files(s, d).filter("false"), _RANGES), _RANGES))(files(s, d).drop("id")))
query("m1_changed_files", sql(
    """SELECT doc_id AS path, CASE WHEN NOT (lang IN ('en', 'de', 'fr')) THEN 'removed' WHEN source IN ('src0', 'src1') THEN 'new' WHEN n_chars > 2000 THEN 'modified' ELSE 'no_output' END AS change FROM documents
       WHERE (lang IN ('en', 'de', 'fr') AND (source IN ('src0', 'src1') OR n_chars > 2000 OR n_chars < 300)) OR (NOT (lang IN ('en', 'de', 'fr')) AND NOT (source IN ('src0', 'src1')))"""))(
    lambda s, d: (lambda t: ident.changed_files(
        t.filter("source NOT IN ('src0', 'src1')").select(c("doc_id").alias("path"), F.md5(F.when(c("n_chars") > 2000, F.concat("text", F.lit("old"))).otherwise(c("text"))).alias("md5")),
        t.filter("lang IN ('en', 'de', 'fr')").select(c("doc_id").alias("path"), F.md5("text").alias("md5")),
        t.filter("n_chars >= 300").select(c("doc_id").alias("path"))))(T(s, d, "documents")))
query("m5_fill_empty", sql(
    """SELECT doc_key, CASE WHEN ruling_gist <> '' THEN ruling_gist ELSE nullif(u.g, '') END AS ruling_gist, coalesce(title_en, u.t) AS title_en FROM cases
       LEFT JOIN (SELECT doc_key, regexp_extract(full_text, '【裁判要点】([^。]*。)', 1) AS g, 'Case' AS t FROM cases WHERE source <> 'court') u USING (doc_key)""", "cases"))(
    lambda s, d: ident.fill_empty(D(s, d).select("doc_key", "ruling_gist", "title_en"), D(s, d).filter("source <> 'court'").select(
        "doc_key", F.nullif(F.regexp_extract("full_text", "【裁判要点】([^。]*。)", 1), F.lit("")).alias("ruling_gist"), F.lit("Case").alias("title_en")), ["doc_key"], ["ruling_gist", "title_en"]))

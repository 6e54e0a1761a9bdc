"""Filters, joins, aggregates, windows and set jobs over the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.operators import relational as rel
from statutelake.operators.ordered import top_per_group
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, sql
from statutelake.plans.registry import query

L, N, A, D = corpus.laws, corpus.nodes, corpus.articles, corpus.cases
SPAN = corpus.SEGMENT
cte("keyed", "SELECT *, regexp_replace(title, '[\\s　]', '', 'g') AS title_key FROM laws", "laws")
cte("snap", "SELECT id, title, CASE WHEN repealed_by <> '' THEN 1 ELSE is_current END AS is_current FROM laws WHERE pub_date < '2015-01-01'", "laws")


def keyed_laws(s, d):
    return L(s, d).withColumn("title_key", F.regexp_replace("title", r"[\s　]", ""))


def snapshot(s, d):
    """The law table of a run in 2015, before any repeal was known."""
    return L(s, d).filter("pub_date < '2015-01-01'").select(
        "id", "title", F.when(F.col("repealed_by") != "", 1).otherwise(F.col("is_current")).alias("is_current")
    )


query("b1_current_laws", sql("SELECT id, title, source, legal_domain FROM laws WHERE is_current = 1 AND (source = 'flk' OR (source = 'gazette' AND legal_domain <> ''))", "laws"))(
    lambda s, d: rel.current_laws(L(s, d)).select("id", "title", "source", "legal_domain"))
query("b2_article_range", sql("SELECT law_id, global_order, article_number, content FROM articles WHERE law_id = 7 AND article_num BETWEEN 3 AND 20", "articles"))(
    lambda s, d: rel.article_range(A(s, d), 7, 3, 20).select("law_id", "global_order", "article_number", "content"))
query("b3_reading_order", sql("SELECT law_id, global_order, type FROM nodes", "nodes"))(
    lambda s, d: rel.reading_order(N(s, d).select("law_id", "global_order", "type")))
query("b4_find_laws", sql("SELECT id, title FROM laws WHERE contains(title, '专利') OR contains(aliases, '专利')", "laws"))(
    lambda s, d: rel.find_laws(L(s, d), "专利").select("id", "title"))
query("b5_laws_by_org", sql("SELECT id, title, pub_date FROM laws WHERE issuing_org = '国务院' AND category = '行政法规'", "laws"))(
    lambda s, d: rel.laws_by_org(L(s, d), "国务院", "行政法规").select("id", "title", "pub_date"))
query("b6_title_contains", sql("SELECT id, title FROM laws WHERE contains(title, '保险')", "laws"))(
    lambda s, d: rel.title_contains(L(s, d), "保险").select("id", "title"))
query("b7_latin_articles", sql("SELECT law_id, global_order FROM articles WHERE regexp_matches(content, '[A-Za-z]')", "articles"))(
    lambda s, d: rel.latin_articles(A(s, d)).select("law_id", "global_order"))
query("b8_apply_blocklist", sql("SELECT id, title FROM laws WHERE id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)", "laws"))(
    lambda s, d: rel.apply_blocklist(L(s, d), corpus.table(s, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("id"))).select("id", "title"))
query("b9_multi_paragraph", sql("SELECT law_id, global_order FROM articles WHERE len(string_split(content, chr(10))) - 1 >= 2", "articles"))(
    lambda s, d: rel.multi_paragraph(A(s, d), 2).select("law_id", "global_order"))
query("b10_outline", sql("SELECT law_id, type, content, global_order FROM headings", "headings"))(
    lambda s, d: rel.outline(N(s, d)).select("law_id", "type", "content", "global_order"))
query("c1_articles_with_law", sql("SELECT a.law_id, a.global_order, l.title AS law_title, l.category, l.is_current FROM articles a JOIN laws l ON l.id = a.law_id", "articles", "laws"))(
    lambda s, d: rel.articles_with_law(A(s, d), L(s, d)).select("law_id", "global_order", "law_title", "category", "is_current"))
_DOM = "['" + "','".join(rel.STATUTE_DOMAINS) + "']"
query("c5_d4_coverage_by_domain", sql(
    f"""SELECT legal_domain, count(DISTINCT l.id) AS laws, count(DISTINCT CASE WHEN a.content_en <> '' THEN l.id END) AS translated_laws,
        CAST(list_position({_DOM}, legal_domain) AS INT) AS domain_order FROM laws l LEFT JOIN articles a ON a.law_id = l.id
        WHERE l.is_current = 1 AND legal_domain <> '' GROUP BY legal_domain""", "laws", "articles"))(
    lambda s, d: rel.coverage_by_domain(L(s, d), A(s, d)))
query("c6_untranslated_laws", sql("SELECT id, title FROM laws WHERE is_current = 1 AND id NOT IN (SELECT law_id FROM articles WHERE contains(content_en, 'will'))", "laws", "articles"))(
    lambda s, d: rel.untranslated_laws(L(s, d), A(s, d).filter(F.col("content_en").contains("will"))).select("id", "title"))
query("c7_nodes_of_current", sql("SELECT type, count(*) AS n FROM nodes WHERE law_id IN (SELECT id FROM laws WHERE is_current = 1) GROUP BY 1", "nodes", "laws"))(
    lambda s, d: rel.count_by(rel.nodes_of_current(N(s, d), L(s, d)), "type"))
query("c8_diff_snapshots", sql(
    """SELECT id, change, ot AS old_title, oc AS old_is_current, nt AS new_title, nc AS new_is_current FROM (
       SELECT coalesce(o.id, n.id) AS id, o.title AS ot, o.is_current AS oc, n.title AS nt, n.is_current AS nc,
         CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.is_current <> n.is_current THEN 'changed' END AS change
       FROM snap o FULL JOIN (SELECT * FROM laws WHERE category <> '修正案') n ON n.id = o.id) WHERE change IS NOT NULL""", "snap", "laws"))(
    lambda s, d: rel.diff_snapshots(snapshot(s, d), L(s, d).filter("category <> '修正案'"), "id", ["title", "is_current"]))
query("c11_match_versions", sql(
    """SELECT title_key, a.id AS a_id, a.doc_number AS a_doc, a.pub_date AS a_pub, b.id AS b_id, b.doc_number AS b_doc, b.pub_date AS b_pub,
       CAST((CASE WHEN a.doc_number <> '' AND b.doc_number <> '' THEN a.doc_number = b.doc_number
            WHEN a.doc_number = '' AND b.doc_number = '' THEN abs(a.pub_date::DATE - b.pub_date::DATE) <= 90 ELSE false END)
         AND NOT (a.pub_date = '2020-12-29' AND b.pub_date < '2020-01-01') AS INT) AS same_version
       FROM (SELECT * FROM keyed WHERE id IN (SELECT max(id) FROM keyed WHERE source = 'flk' AND is_current = 1 GROUP BY title_key)) a JOIN keyed b USING (title_key) WHERE b.source = 'gazette'""", "keyed"))(
    lambda s, d: rel.match_versions(keyed_laws(s, d).filter("source = 'flk' AND is_current = 1"), keyed_laws(s, d).filter("source = 'gazette'")))
_HN = "SELECT p_partkey AS law_id, 'chapter' AS type, 1 AS order_index, 'Chapter ' || p_name AS name_en FROM part WHERE p_size < 25"


def _heading_names(s, d):
    return corpus.table(s, d, "part").filter("p_size < 25").select(
        F.col("p_partkey").alias("law_id"), F.lit("chapter").alias("type"), F.lit(1).alias("order_index"), F.concat(F.lit("Chapter "), "p_name").alias("name_en"))


query("c13_apply_headings", sql(
    f"""SELECT h.law_id, h.type, coalesce(h.chapter_num, 0) AS order_index, coalesce(nullif(h.content_en, ''), m.name_en) AS content_en FROM headings h
        LEFT JOIN ({_HN}) m ON m.law_id = h.law_id AND m.type = h.type AND m.order_index = coalesce(h.chapter_num, 0)""", "headings"))(
    lambda s, d: rel.apply_headings(corpus.headings(s, d).withColumn("order_index", F.col("chapter_num")), _heading_names(s, d)).select("law_id", "type", "order_index", "content_en"))
query("c14_backfill_headings", sql(
    """SELECT h.law_id, h.global_order, CASE WHEN coalesce(h.content_en, '') <> '' THEN h.content_en WHEN h.content = l.title THEN l.title_en
       WHEN h.content = '第一章　总则' THEN 'Chapter I General Provisions' END AS content_en
       FROM headings h LEFT JOIN laws l ON l.id = h.law_id AND l.title_en IS NOT NULL""", "headings", "laws"))(
    lambda s, d: rel.backfill_headings(corpus.headings(s, d), L(s, d), {"第一章　总则": "Chapter I General Provisions"}).select("law_id", "global_order", "content_en"))
query("c19_apply_translations", sql("SELECT doc_key, nullif(title_en, '') AS title_en, nullif(full_text_en, '') AS full_text_en FROM cases", "cases"))(
    lambda s, d: rel.apply_document_translations(D(s, d).select("doc_key"), D(s, d), "doc_key", ["title_en", "full_text_en"]))
query("c21_enrich_domain", sql(
    """SELECT l.id, CASE WHEN l.legal_domain = '' THEN coalesce(o.m, '') ELSE l.legal_domain END AS legal_domain FROM laws l
       LEFT JOIN (SELECT s_suppkey AS id, 'domain ' || s_nationkey AS m FROM supplier) o ON o.id = l.id""", "laws"))(
    lambda s, d: rel.enrich_domain(L(s, d).select("id", "legal_domain"), corpus.table(s, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("domain "), "s_nationkey").alias("domain"))).select("id", "legal_domain"))
_MARKS = "SELECT DISTINCT title_key, CASE WHEN id % 2 = 0 THEN doc_number ELSE '' END AS doc_number, repealed_by AS mark FROM keyed WHERE source = 'gazette' AND repealed_by <> ''"


def marks(s, d):
    return keyed_laws(s, d).filter("source = 'gazette' AND repealed_by <> ''").select(
        "title_key", F.when(F.expr("id % 2 = 0"), F.col("doc_number")).otherwise("").alias("doc_number"), F.col("repealed_by").alias("mark"))


query("c22_match_repeals", sql(
    f"""SELECT m.doc_number AS mark_number, k.id, k.pub_date, k.is_current FROM ({_MARKS}) m JOIN keyed k ON k.title_key = m.title_key
        AND k.source = 'gazette' AND (m.doc_number = '' OR m.doc_number = k.doc_number)""", "keyed"))(
    lambda s, d: rel.match_repeals(marks(s, d), keyed_laws(s, d).filter("source = 'gazette'").select("title_key", "doc_number", "id", "pub_date", "is_current")).select("mark_number", "id", "pub_date", "is_current"))
query("d1_count_by_source", sql("SELECT source, count(*) AS n FROM cases GROUP BY 1", "cases"))(lambda s, d: rel.count_by(D(s, d), "source"))
_COLS = ["title", "ruling_gist", "keywords", "title_en", "full_text_en"]
_UNP = " UNION ALL ".join(f"SELECT source, '{c}' AS column_name, CASE WHEN coalesce(trim({c}), '') <> '' THEN 1 ELSE 0 END AS f FROM cases" for c in _COLS)
query("d2_column_coverage", sql(
    f"""SELECT coalesce(source, 'ALL') AS source, column_name, count(*) AS total, CAST(sum(f) AS BIGINT) AS filled, round(sum(f) * 100.0 / count(*), 1) AS rate
        FROM ({_UNP}) GROUP BY GROUPING SETS ((source, column_name), (column_name))""", "cases"))(
    lambda s, d: rel.column_coverage(D(s, d), _COLS, "source"))
query("d3_node_coverage", sql(
    """SELECT type, count(*) AS total, count(*) FILTER (content_en <> '') AS translated, round(count(*) FILTER (content_en <> '') * 100.0 / count(*), 1) AS rate,
       CAST(round(count(*) FILTER (content_en <> '') * 100.0 / count(*), 1) >= 95 AS INT) AS ok FROM nodes WHERE law_id IN (SELECT id FROM laws WHERE is_current = 1) GROUP BY 1""", "nodes", "laws"))(
    lambda s, d: rel.node_coverage(N(s, d), L(s, d)))
query("d5_short_laws", sql(
    """SELECT l.id, l.title, count(*) AS articles FROM laws l JOIN (SELECT * FROM articles WHERE content_en IS NULL OR contains(content_en, 'will')) a ON a.law_id = l.id
       WHERE is_current = 1 GROUP BY 1, 2 HAVING count(*) <= 100 AND count(*) FILTER (content_en <> '') = 0""", "laws", "articles"))(
    lambda s, d: rel.short_laws(L(s, d), A(s, d).filter("content_en IS NULL OR contains(content_en, 'will')"), 100))
query("d8_version_history", sql("SELECT title, count(*) AS version_count, min(pub_date) AS earliest, max(pub_date) AS latest FROM laws GROUP BY 1 HAVING count(*) > 1", "laws"))(
    lambda s, d: rel.version_history(L(s, d)))
query("d8_version_rows", sql("SELECT title, pub_date, id, category FROM laws WHERE title IN (SELECT title FROM laws GROUP BY 1 HAVING count(*) > 1)", "laws"))(
    lambda s, d: rel.version_rows(L(s, d)))
query("d9_latest_version", sql("SELECT title, id, pub_date FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY pub_date DESC, id) AS rn FROM laws) WHERE rn = 1", "laws"))(
    lambda s, d: rel.latest_version(L(s, d)))
query("d12_laws_covered", sql("SELECT count(DISTINCT law_id) AS laws FROM articles WHERE content_en <> ''", "articles"))(lambda s, d: rel.laws_covered(A(s, d)))
query("d13_duplicates", sql("SELECT law_id, article_number, count(*) AS n FROM articles GROUP BY 1, 2 HAVING count(*) > 1", "articles"))(
    lambda s, d: rel.duplicates(A(s, d), ["law_id", "article_number"]))
_RANGES = [("low", 0, 500), ("mid", 500, 700), ("high", 1200, 1_000_000_000_000_000)]
query("d15_max_id_per_range", sql(
    """SELECT CASE WHEN p_partkey < 500 THEN 'low' WHEN p_partkey < 1200 THEN 'mid' ELSE 'high' END AS range, max(p_partkey) AS max_id FROM part GROUP BY 1"""))(
    lambda s, d: rel.max_id_per_range(corpus.table(s, d, "part").select(F.col("p_partkey").alias("id")), _RANGES))
query("d18_corpus_overview", sql(
    "SELECT category, count(*) AS laws, count(*) FILTER (is_current = 1) AS current_laws, min(pub_date) AS earliest, max(pub_date) AS latest FROM laws GROUP BY ROLLUP (category)", "laws"))(
    lambda s, d: rel.corpus_overview(L(s, d)))
query("d19_translation_progress", sql(
    """SELECT count(*) AS files, count(*) FILTER (a = t) AS files_complete, CAST(sum(a) AS BIGINT) AS articles, CAST(sum(t) AS BIGINT) AS articles_done FROM (
       SELECT law_id, count(*) AS a, count(*) FILTER (content_en <> '') AS t FROM articles GROUP BY 1)""", "articles"))(
    lambda s, d: rel.translation_progress(A(s, d)))
query("d20_latin_fragment_counts", sql("SELECT a.law_id, count(*) AS n, l.title FROM articles a JOIN laws l ON l.id = a.law_id WHERE regexp_matches(content, '[A-Za-z]') GROUP BY 1, 3", "articles", "laws"))(
    lambda s, d: rel.latin_fragments(A(s, d), L(s, d))[0])
query("d20_latin_fragment_samples", sql(
    """SELECT law_id, sample, article_number, array_to_string(regexp_extract_all(content, '[A-Za-z][A-Za-z0-9\\-]*'), ' ') AS fragments FROM (
       SELECT *, row_number() OVER (PARTITION BY law_id ORDER BY global_order) AS sample FROM articles WHERE regexp_matches(content, '[A-Za-z]')) WHERE sample <= 3""", "articles"))(
    lambda s, d: rel.latin_fragments(A(s, d), L(s, d))[1])
query("d21_pending_work", sql(
    """SELECT count(*) FILTER (title_en IS NULL) AS titles, count(*) FILTER (a > t) AS laws, CAST(sum(a - t) AS BIGINT) AS articles FROM (
       SELECT l.id, any_value(l.title_en) AS title_en, count(a.law_id) AS a, count(a.law_id) FILTER (a.content_en <> '') AS t
       FROM laws l LEFT JOIN articles a ON a.law_id = l.id WHERE l.is_current = 1 GROUP BY 1)""", "laws", "articles"))(
    lambda s, d: rel.pending_work(L(s, d), A(s, d)))
query("d22_pending_documents", sql("SELECT source, count(*) AS docs, CAST(sum(length(full_text)) AS BIGINT) AS chars FROM cases WHERE full_text_en IS NULL GROUP BY 1", "cases"))(
    lambda s, d: rel.pending_documents(D(s, d)))
query("e2_article_gaps", sql(
    """SELECT law_id, global_order, CASE WHEN article_num = p THEN 'duplicate' WHEN article_num > p + 1 THEN 'gap' ELSE 'reversal' END AS issue,
       p AS from_num, article_num AS to_num, CASE WHEN article_num > p + 1 THEN article_num - p - 1 ELSE 0 END AS missing_articles FROM (
       SELECT *, lag(article_num) OVER w AS p, lag(chapter_num) OVER w AS pc, lag(section_num) OVER w AS ps FROM articles
       WINDOW w AS (PARTITION BY law_id ORDER BY global_order)) WHERE pc = chapter_num AND ps = section_num AND article_num <> p + 1""", "articles"))(
    lambda s, d: rel.article_gaps(A(s, d), SPAN))
query("e3_empty_headings", sql(
    """SELECT law_id, global_order, type, p AS heading, content AS next_heading FROM (SELECT *, lag(content) OVER w AS p, lag(type) OVER w AS pt
       FROM (SELECT * FROM headings UNION ALL SELECT * FROM articles WHERE content_en IS NULL) WINDOW w AS (PARTITION BY law_id ORDER BY global_order)) WHERE type <> 'article' AND pt = type""", "headings", "articles"))(
    lambda s, d: rel.empty_headings(corpus.headings(s, d).unionByName(A(s, d).filter("content_en IS NULL")), SPAN))
query("e4_order_violations", sql(
    """SELECT law_id, doc_order, global_order, p AS prev_global_order FROM (SELECT law_id, global_order % 400000000000000000 AS doc_order, global_order,
       lag(global_order) OVER (PARTITION BY law_id ORDER BY global_order % 400000000000000000) AS p FROM articles) WHERE global_order <= p""", "articles"))(
    lambda s, d: rel.order_violations(A(s, d).withColumn("doc_order", F.expr(f"global_order % {corpus.CHAPTER_BIT}")), SPAN))
query("e9_unique_labels", sql(
    """SELECT law_id, global_order, CASE WHEN c > 1 THEN base || '_' || c ELSE base END AS label FROM (
       SELECT *, row_number() OVER (PARTITION BY law_id, base ORDER BY global_order) AS c FROM (
         SELECT law_id, global_order, coalesce(article_number, '_' || row_number() OVER (PARTITION BY law_id ORDER BY global_order)) AS base FROM articles))""", "articles"))(
    lambda s, d: rel.unique_labels(A(s, d), SPAN))
cte("currency", """SELECT * FROM (SELECT id, title_key, pub_date, is_current, CASE WHEN repealed_by <> '' THEN CASE WHEN is_current <> 0 THEN 'repealed_but_current' END
       WHEN versions = 1 THEN CASE WHEN is_current <> 1 THEN 'should_be_current' END WHEN at_max > 1 THEN 'several_newest'
       WHEN pub_date = max_pub THEN CASE WHEN is_current <> 1 THEN 'should_be_current' END ELSE CASE WHEN is_current <> 0 THEN 'should_not_be_current' END END AS problem FROM (
       SELECT *, count(*) FILTER (pub_date = max_pub) OVER (PARTITION BY title_key, live) AS at_max FROM (
         SELECT *, repealed_by = '' AS live, count(*) OVER (PARTITION BY title_key, repealed_by = '') AS versions, max(pub_date) OVER (PARTITION BY title_key, repealed_by = '') AS max_pub FROM keyed)))
       WHERE problem IS NOT NULL""", "keyed")
query("e10_check_currency", sql("SELECT * FROM currency", "currency"))(lambda s, d: rel.check_currency(keyed_laws(s, d)))
query("e11_dedupe_first", sql("SELECT title, id, category FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY id) AS rn FROM laws) WHERE rn = 1", "laws"))(
    lambda s, d: rel.dedupe_first(L(s, d).select("title", "id", "category"), ["title"], [F.col("id")]))
query("f6_most_revised", sql("SELECT title, count(*) AS version_count, min(pub_date) AS earliest, max(pub_date) AS latest FROM laws GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 15", "laws"))(
    lambda s, d: rel.most_revised(L(s, d)))
query("f7_cap_per_law", sql(
    "SELECT law_id, global_order FROM (SELECT *, row_number() OVER (PARTITION BY law_id ORDER BY global_order) AS rn FROM articles) WHERE rn <= 25", "articles"))(
    lambda s, d: top_per_group(A(s, d).select("law_id", "global_order"), ["law_id"], [F.col("global_order")], 25))
query("n1_union_sources", sql(
    "SELECT id, title, 'flk' AS src FROM laws WHERE source = 'flk' UNION ALL SELECT s_suppkey, s_name, 'gazette' FROM supplier WHERE s_suppkey NOT IN (SELECT id FROM laws WHERE source = 'flk')", "laws"))(
    lambda s, d: rel.union_sources(L(s, d).filter("source = 'flk'").select("id", "title", F.lit("flk").alias("src")),
                                   corpus.table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"), F.lit("gazette").alias("src"))))
query("n3_append_new", sql("SELECT id, title FROM snap UNION ALL SELECT id, title FROM laws WHERE id NOT IN (SELECT id FROM snap)", "snap", "laws"))(
    lambda s, d: rel.append_new(snapshot(s, d).select("id", "title"), L(s, d).select("id", "title")))
query("n2_keep_missing_entries", sql("SELECT id, title FROM laws WHERE category <> '修正案' UNION ALL SELECT id, title FROM snap WHERE id NOT IN (SELECT id FROM laws WHERE category <> '修正案')", "snap", "laws"))(
    lambda s, d: rel.append_new(L(s, d).filter("category <> '修正案'").select("id", "title"), snapshot(s, d).select("id", "title")))
query("n5_key_changes", sql(
    "SELECT id, 'added' AS change FROM laws WHERE category <> '修正案' AND id NOT IN (SELECT id FROM snap) UNION ALL SELECT id, 'removed' FROM snap WHERE id IN (SELECT id FROM laws WHERE category = '修正案')", "snap", "laws"))(
    lambda s, d: rel.key_changes(snapshot(s, d), L(s, d).filter("category <> '修正案'"), "id"))

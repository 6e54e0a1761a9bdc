"""Classification and knowledge-graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.functions import rules as r
from statutelake.operators import classify as cl
from statutelake.operators import relational as rel
from statutelake.operators.ordered import top_per_group
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, sql
from statutelake.plans.q_relational import keyed_laws
from statutelake.plans.registry import query

L, A, D, T = corpus.laws, corpus.articles, corpus.cases, corpus.table
c = F.col


def values(rules) -> str:
    rows = [f"({i}, '{name}', '{word}')" for i, (name, words) in enumerate(rules) for word in words]
    return f"(VALUES {', '.join(rows)}) AS rule(pos, target, word)"


def case_map(key: str, table: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


_SIGNALS = "(VALUES " + ", ".join(f"('{a}', '{b}', {n})" for a, b, n in r.STRONG_SIGNALS) + ") AS sig(word, target, bonus)"
cte("scored", f"""SELECT id, target FROM (SELECT s.id, s.target, row_number() OVER (PARTITION BY s.id ORDER BY sum(points) DESC, min(pos)) AS rn FROM (
      SELECT id, target, pos, 1 AS points FROM laws JOIN {values(r.DOMAIN_RULES)} ON contains(title, word)
      UNION ALL SELECT id, sig.target, p.pos, bonus FROM laws JOIN {_SIGNALS} ON contains(title, sig.word)
        JOIN (SELECT DISTINCT pos, target FROM {values(r.DOMAIN_RULES)}) p ON p.target = sig.target) s GROUP BY 1, 2) WHERE rn = 1""", "laws")
cte("domained", f"SELECT l.*, coalesce(s.target, {case_map('category', r.DOMAIN_DEFAULTS)}) AS domain FROM laws l LEFT JOIN scored s ON s.id = l.id", "laws", "scored")
query("k1_classify_domain", sql(
    """SELECT d.id, coalesce(e.dom, d.domain) AS domain FROM domained d LEFT JOIN (
       SELECT replace(title, '中华人民共和国', '') AS k, max(legal_domain) AS dom FROM laws WHERE legal_domain <> '' AND repealed_by <> '' GROUP BY 1) e
       ON e.k = replace(d.title, '中华人民共和国', '')""", "domained", "laws"))(
    lambda s, d: cl.classify_domain(L(s, d), L(s, d).filter("legal_domain <> '' AND repealed_by <> ''").select("title", c("legal_domain").alias("domain"))).select("id", "domain"))
query("k2_reclassify", sql("SELECT id, CASE WHEN source = 'gazette' THEN coalesce(domain, '') ELSE legal_domain END AS domain FROM domained", "domained"))(
    lambda s, d: cl.reclassify(L(s, d), "gazette").select("id", "domain"))
query("k7_classification_diff", sql("SELECT legal_domain AS from_domain, domain AS to_domain, count(*) AS n FROM domained WHERE legal_domain IS DISTINCT FROM domain GROUP BY 1, 2", "domained"))(
    lambda s, d: cl.classification_diff(cl.classify_domain(L(s, d)), "legal_domain", "domain"))
cte("subjects", f"""SELECT l.*, CASE WHEN category = '行政法规' THEN coalesce(t.target, '其他') END AS subject_area FROM laws l LEFT JOIN (
      SELECT id, arg_min(target, pos) AS target FROM laws JOIN {values(r.SUBJECT_RULES)} ON contains(title, word) GROUP BY 1) t ON t.id = l.id""", "laws")
query("k3_subject_area", sql("SELECT id, subject_area FROM subjects", "subjects"))(lambda s, d: cl.subject_area(L(s, d)).select("id", "subject_area"))
_SUB = " ".join(
    f"WHEN menu_group = '{g}' THEN coalesce((SELECT arg_min(target, pos) FROM {values(rules)} WHERE contains(title, word)), '{default}')"
    for g, (rules, default) in r.SUBGROUP_RULES.items())
_HIT = "coalesce((SELECT arg_min(target, pos) FROM {} WHERE contains(title, word)), '{}')"
_SUB += f""" WHEN menu_group = '刑事' THEN CASE WHEN category IN ('法律', '修正案', '法律解释') OR regexp_matches(title, '{"|".join(r.CRIMINAL_CODE_WORDS)}') THEN '刑法及修正案'
      ELSE {_HIT.format(values(r.CRIMINAL_RULES), "检察院")} END WHEN menu_group = '行政与公法' THEN CASE WHEN category = '法律' THEN {_HIT.format(values(r.ADMIN_LAW_RULES), "行政法律")}
      WHEN regexp_matches(title, '国家赔偿|行政赔偿') THEN '国家赔偿' ELSE '行政法律' END"""
cte("menu", f"""SELECT *, CASE WHEN menu_group = '民事与商事' AND (legal_domain = '民法典' OR contains(title, '民法典')) THEN '民法典'
      WHEN category = '行政法规' AND menu_group <> '其他' THEN '行政法规/' || subject_area
      WHEN menu_group = '宪法与国家机构' THEN CASE WHEN category = '宪法' THEN '宪法' WHEN category IN ('司法解释', '法律解释') THEN '司法解释' ELSE '法律及决定' END {_SUB} ELSE '' END AS subgroup
    FROM (SELECT *, coalesce({case_map('legal_domain', r.DOMAIN_GROUPS)}, {case_map('category', r.CATEGORY_GROUPS)}, '其他') AS menu_group FROM subjects)""", "subjects")


def menu(s, d):
    return cl.menu_path(cl.subject_area(L(s, d)))


query("k4_menu_path", sql("SELECT id, menu_group, subgroup FROM menu", "menu"))(lambda s, d: menu(s, d).select("id", "menu_group", "subgroup"))
query("d14_menu_counts", sql("SELECT menu_group, subgroup, count(*) AS n FROM menu WHERE is_current = 1 GROUP BY ROLLUP (menu_group, subgroup)", "menu"))(
    lambda s, d: rel.menu_counts(menu(s, d).filter("is_current = 1")))
query("f5_menu_order", sql(
    f"SELECT DISTINCT menu_group, subgroup, CAST(list_position({'[' + ', '.join(repr(g) for g in r.GROUP_ORDER) + ']'}, menu_group) AS INT) AS group_pos FROM menu", "menu"))(
    lambda s, d: cl.menu_order(menu(s, d).select("menu_group", "subgroup").distinct()))
cte("taxed", f"""SELECT l.*, coalesce(t.target, '其他') AS taxonomy FROM laws l LEFT JOIN (SELECT id, target FROM (
      SELECT id, target, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, min(pos)) AS rn FROM laws JOIN {values(r.TAXONOMY_RULES)} ON contains(title || ' ' || full_text, word) GROUP BY 1, 2) WHERE rn = 1) t ON t.id = l.id""", "laws")
query("k5_taxonomy_domain", sql("SELECT id, taxonomy FROM taxed", "taxed"))(lambda s, d: cl.taxonomy_domain(L(s, d)).select("id", "taxonomy"))
cte("tax_title", "SELECT title, arg_max(taxonomy, id) AS domain FROM taxed GROUP BY 1", "taxed")
query("d17_taxonomy_members", sql(
    """SELECT t.domain AS taxonomy, l.id, l.title, l.category, l.pub_date AS latest_pub_date FROM (
       SELECT *, row_number() OVER (PARTITION BY title ORDER BY pub_date DESC, id) AS rn FROM laws) l JOIN tax_title t ON t.title = l.title WHERE rn = 1""", "laws", "tax_title"))(
    lambda s, d: cl.taxonomy(L(s, d)))
query("d17_taxonomy_counts", sql("SELECT domain AS taxonomy, count(*) AS n FROM tax_title GROUP BY 1", "tax_title"))(
    lambda s, d: rel.count_by(cl.taxonomy(L(s, d)), "taxonomy"))
query("k6_law_aliases", sql("SELECT id, CASE WHEN n.a IS NULL THEN NULL ELSE n.a END AS known_aliases FROM laws l LEFT JOIN (SELECT title, max(aliases) || ',简称' AS a FROM laws WHERE aliases <> '' GROUP BY 1) n ON n.title = l.title", "laws"))(
    lambda s, d: cl.law_aliases(L(s, d), L(s, d).filter("aliases <> ''").groupBy("title").agg(F.concat(F.max("aliases"), F.lit(",简称")).alias("aliases"))).select("id", "known_aliases"))
cte("parents", """SELECT DISTINCT l.id AS child_id, l.title AS child, l.category AS child_category, p AS parent, CASE WHEN category = '行政法规' THEN '实施依据' ELSE '解释依据' END AS relation
    FROM (SELECT *, unnest(list_concat(regexp_extract_all(title || ' ' || full_text, '《([^》]+)》', 1), [regexp_extract(title, '(.{4,30}法)实施(条例|细则|办法|规定)', 1)])) AS p FROM laws) l
    WHERE p <> l.title AND p IN (SELECT title FROM laws WHERE category IN ('法律', '宪法'))""", "laws")
query("j9_hierarchy_links", sql("SELECT * FROM parents", "parents"))(lambda s, d: cl.hierarchy_links(L(s, d)))
query("j10_rank_levels", sql("SELECT id, CASE category WHEN '法律' THEN 3 WHEN '行政法规' THEN 4 WHEN '司法解释' THEN 5 ELSE 3 END AS level FROM laws", "laws"))(
    lambda s, d: cl.rank_levels(L(s, d)).select("id", "level"))
query("j11_relations", sql(
    """SELECT DISTINCT l.id AS from_id, p AS to_title, f.domain AS from_domain, t.domain AS to_domain FROM (
       SELECT *, unnest(regexp_extract_all(title || ' ' || full_text, '《([^》]{4,40})》', 1)) AS p FROM laws) l
       JOIN tax_title t ON t.title = p JOIN tax_title f ON f.title = l.title WHERE p <> l.title""", "laws", "tax_title"))(
    lambda s, d: cl.relations(L(s, d)))
query("c9_terms_in_text", sql(f"SELECT law_id, global_order, word AS term FROM articles JOIN (SELECT unnest({'[' + ', '.join(repr(w) for w in corpus.WORDS) + ']'}) AS word) ON contains(content, word)", "articles"))(
    lambda s, d: cl.terms_in_text(A(s, d).select("law_id", "global_order", "content"), corpus.WORDS, "content"))
query("h17_category_names", sql(f"SELECT id, {case_map('category', r.CATEGORY_EN)} AS category_en FROM laws", "laws"))(
    lambda s, d: L(s, d).select("id", cl.map_value(c("category"), r.CATEGORY_EN).alias("category_en")))
query("a14_export_titles", sql("SELECT DISTINCT title FROM laws WHERE is_current = 1", "laws"))(
    lambda s, d: L(s, d).filter("is_current = 1").select("title").distinct().orderBy("title"))
query("f8_sample_issues", sql("SELECT problem, id, sample FROM (SELECT *, row_number() OVER (PARTITION BY problem ORDER BY id) AS sample FROM currency) WHERE sample <= 5", "currency"))(
    lambda s, d: top_per_group(rel.check_currency(keyed_laws(s, d)).select("problem", "id"), ["problem"], [c("id")], 5, rank="sample"))

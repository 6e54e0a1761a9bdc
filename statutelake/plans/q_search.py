"""Search and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.operators import citations as cit
from statutelake.operators import search as se
from statutelake.operators.lineage import materialize
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, num, short, sql, words
from statutelake.plans.registry import query

L, N, A, D, T = corpus.laws, corpus.nodes, corpus.articles, corpus.cases, corpus.table
c = F.col
DOMAINS = ["民法商法", "经济法", "行政法", "民法典"]
GROUPS = [("民法专家组", ["赔", "合同", "租", "借"]), ("刑法专家组", ["打人", "坐牢", "撞人", "刑事"]), ("劳动专家组", ["欠薪", "工伤", "雇佣", "五险"])]
FIELDS = [("金额", "\\d+元"), ("时间", "\\d{4}年\\d{1,2}月"), ("对象", "合同|工资|权利")]
EXPERTS = [("合同专家", "中华人民共和国合同甲法", ["合同", "总则"]), ("保险专家", "中华人民共和国保险丙戊法", ["特别"]), ("证券专家", "中华人民共和国银行丙壬法", ["合同"])]


def long_terms(s, d):
    return corpus.question_terms(s, d).select("term").distinct()


def hits(s, d):
    """(term, law_id, global_order) for every distinct question term."""
    return materialize(se.match_terms(A(s, d), se.NODE, "content", long_terms(s, d), (1, 2, 3)))


cte("hits", "SELECT t.term, a.law_id, a.global_order FROM (SELECT DISTINCT term FROM question_terms) t JOIN articles a ON contains(lower(a.content), lower(t.term))", "question_terms", "articles")
query("i1_phrase_match", sql("SELECT term, law_id, global_order FROM hits WHERE length(term) >= 3", "hits"))(
    lambda s, d: se.match_terms(A(s, d), se.NODE, "content", long_terms(s, d)))
query("i1_postings", sql("SELECT gram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, length(content) - 1), lambda i: lower(content)[i:i + 2])) AS gram FROM articles) GROUP BY 1", "articles"))(
    lambda s, d: se.build_postings(A(s, d), se.NODE, "content").groupBy("gram").agg(F.count("*").alias("n")))
query("i1_phrase_match_postings", sql("SELECT t.term, k.doc_key FROM (SELECT DISTINCT term FROM question_terms) t JOIN cases k ON contains(k.full_text, t.term) WHERE length(t.term) >= 3", "question_terms", "cases"))(
    lambda s, d: se.phrase_match(long_terms(s, d).filter(F.length("term") >= 3), se.build_postings(D(s, d), ["doc_key"], "full_text"), ["doc_key"]))
query("i2_short_match", sql("SELECT term, law_id, global_order FROM hits WHERE length(term) < 3", "hits"))(
    lambda s, d: se.match_terms(A(s, d), se.NODE, "content", long_terms(s, d), (1, 2)))
query("i3_search_docs", sql(
    " UNION ALL ".join(f"SELECT t.term, k.doc_key, '{f}' AS field FROM (SELECT DISTINCT term FROM question_terms) t JOIN cases k ON contains(lower(k.{f}), lower(t.term))" for f in ("title", "ruling_gist", "keywords", "full_text", "title_en", "full_text_en")), "question_terms", "cases"))(
    lambda s, d: se.search_docs(D(s, d), "doc_key", ["title", "ruling_gist", "keywords", "full_text", "title_en", "full_text_en"], long_terms(s, d)))
query("i3_search_documents", sql("SELECT w.term, d.doc_id FROM (SELECT DISTINCT lower(p_name) AS term FROM part UNION SELECT unnest(['thion', 'éeau', 'nicht', 'license'])) w JOIN documents d ON contains(lower(d.text), w.term)"))(
    lambda s, d: se.match_terms(T(s, d, "documents"), ["doc_id"], "text", T(s, d, "part").select(F.lower("p_name").alias("term")).distinct().unionByName(
        T(s, d, "region").limit(1).select(F.explode(F.array(*[F.lit(w) for w in ("thion", "éeau", "nicht", "license")])).alias("term")))))
query("d16_term_hits", sql("SELECT t.term, count(h.law_id) AS hits FROM (SELECT DISTINCT term FROM question_terms) t LEFT JOIN hits h ON h.term = t.term GROUP BY 1", "question_terms", "hits"))(
    lambda s, d: se.term_hits(long_terms(s, d), hits(s, d)))
query("f4_terms_by_rarity", sql("SELECT t.term, count(h.law_id) AS hits FROM (SELECT DISTINCT term FROM question_terms WHERE length(term) >= 3) t LEFT JOIN hits h ON h.term = t.term GROUP BY 1", "question_terms", "hits"))(
    lambda s, d: se.terms_by_rarity(long_terms(s, d), hits(s, d)))
_DOM, _LAWC = words(DOMAINS), words(se.LAW_CATEGORIES)


def top(cats: str, k: int, dom: bool = True) -> str:
    where = f"AND list_contains({_DOM}, l.legal_domain)" if dom else ""
    return f"""(SELECT * FROM (SELECT h.term, h.law_id, h.global_order, l.title AS law_title, l.category, row_number() OVER (PARTITION BY term ORDER BY h.law_id, h.global_order) AS hit_rank
      FROM hits h JOIN laws l ON l.id = h.law_id WHERE l.is_current = 1 AND list_contains({cats}, l.category) {where}) WHERE hit_rank <= {k})"""


cte("top_laws", f"SELECT * FROM {top(_LAWC, 10)}", "hits", "laws")
cte("top_interp", f"SELECT * FROM {top(words(se.INTERPRETATIONS), 10)}", "hits", "laws")
cte("top_all", f"SELECT * FROM {top(words(se.LAW_CATEGORIES + se.INTERPRETATIONS + ['行政法规']), 10, False)}", "hits", "laws")
query("i4_c12_search", sql("SELECT * FROM top_laws", "top_laws"))(lambda s, d: se.search(hits(s, d), L(s, d), 10, DOMAINS, se.LAW_CATEGORIES))
cte("named", """SELECT * FROM (SELECT h.term, h.law_id, h.global_order, l.title AS law_title, l.category, row_number() OVER (PARTITION BY term, l.title ORDER BY h.law_id, h.global_order) AS hit_rank
      FROM hits h JOIN laws l ON l.id = h.law_id WHERE l.is_current = 1 AND l.title IN (SELECT law_title FROM hints)) WHERE hit_rank <= 10""", "hits", "laws", "hints")
def hint_table(s, d):
    """Topic words to preferred law titles, a short curated table: one row per
    nation."""
    topics = F.array(*[F.lit(w) for w in corpus.WORDS])
    return T(s, d, "nation").select(
        F.element_at(topics, (c("n_nationkey") + 1).cast("int")).alias("topic"),
        F.concat(F.lit(corpus.PRC), corpus.short_title(c("n_nationkey") * 10 + c("n_regionkey"))).alias("law_title"),
        c("n_regionkey").alias("priority"))


cte("hints", f"SELECT {words(corpus.WORDS)}[n_nationkey + 1] AS topic, '{corpus.PRC}' || {short('n_nationkey * 10 + n_regionkey')} AS law_title, n_regionkey AS priority FROM nation")
query("i5_search_in_laws", sql("SELECT * FROM named", "named"))(
    lambda s, d: se.search_in_laws(hits(s, d), L(s, d), hint_table(s, d).select(c("law_title").alias("title")), 10))
cte("first_topk", """SELECT q_id, law_id, global_order, pos, hit_rank, term FROM (SELECT *, row_number() OVER (PARTITION BY q_id, law_id, global_order ORDER BY pos, hit_rank) AS rn
    FROM question_terms JOIN top_laws USING (term)) WHERE rn = 1""", "question_terms", "top_laws")
query("e12_topk_per_term", sql("SELECT q_id, law_id, global_order, CAST(pos AS INT) AS pos, hit_rank, term FROM first_topk", "first_topk"))(
    lambda s, d: se.topk_per_term(corpus.question_terms(s, d), se.search(hits(s, d), L(s, d), 10, DOMAINS, se.LAW_CATEGORIES)))


def alias_tables(s, d):
    """Lay word to legal word, three tables of different strength."""
    pairs = corpus.questions(s, d)
    first = pairs.groupBy(c("lay_term").alias("source"), c("legal_term").alias("target")).agg(F.count("*").alias("hits"))
    back = pairs.groupBy(c("legal_term").alias("source"), c("lay_term").alias("target")).agg(F.count("*").alias("hits"))
    return [first.filter("hits > 1"), first.filter("hits = 1"), back]


cte("alias_pairs", """SELECT source, target, hits, CASE WHEN hits > 1 THEN 1 ELSE 2 END AS rank FROM (SELECT lay_term AS source, legal_term AS target, count(*) AS hits FROM questions GROUP BY 1, 2)
    UNION ALL SELECT legal_term, lay_term, count(*), 3 FROM questions GROUP BY 1, 2""", "questions")
cte("expanded", """SELECT q_id, CAST(row_number() OVER (PARTITION BY q_id ORDER BY stage, pos, rank, neg, term) - 1 AS INT) AS pos, term FROM (
      SELECT *, row_number() OVER (PARTITION BY q_id, term ORDER BY stage, pos, rank, neg) AS rn FROM (
        SELECT q_id, term, 0 AS stage, pos, 0 AS rank, 0 AS neg FROM question_terms
        UNION ALL SELECT q.q_id, p.target, 1, q.pos, p.rank, -p.hits FROM question_terms q JOIN alias_pairs p ON p.source = q.term)) WHERE rn = 1""", "question_terms", "alias_pairs")
query("i6_expand_terms", sql("SELECT * FROM expanded", "expanded"))(lambda s, d: se.expand_terms(corpus.question_terms(s, d), alias_tables(s, d)))
cte("preferred", """SELECT q_id, law_title, priority, pos FROM (SELECT q_id, law_title, priority, pos, row_number() OVER (PARTITION BY q_id, law_title ORDER BY pos, priority) AS rn
    FROM question_terms t JOIN hints h ON h.topic = t.term) WHERE rn = 1""", "question_terms", "hints")
query("i7_topic_laws", sql("SELECT q_id, law_title, priority, CAST(pos AS INT) AS pos FROM preferred", "preferred"))(
    lambda s, d: se.topic_laws(corpus.question_terms(s, d), hint_table(s, d)))
cte("rarity", "SELECT t.term, count(h.law_id) AS hits FROM (SELECT DISTINCT term FROM question_terms WHERE length(term) >= 3) t LEFT JOIN hits h ON h.term = t.term GROUP BY 1", "question_terms", "hits")
cte("layered", """SELECT q_id, law_id, global_order, layer, term_rank, hit_rank, pinned FROM (
      SELECT *, row_number() OVER (PARTITION BY q_id, law_id, global_order ORDER BY layer, term_rank, hit_rank) AS rn FROM (
        SELECT t.q_id, n.law_id, n.global_order, 0 AS layer, r.hits AS term_rank, n.hit_rank, 1 AS pinned FROM question_terms t JOIN rarity r ON r.term = t.term
          JOIN preferred p ON p.q_id = t.q_id JOIN named n ON n.term = t.term AND n.law_title = p.law_title
        UNION ALL SELECT q_id, law_id, global_order, 1, pos, hit_rank, 0 FROM question_terms JOIN top_laws USING (term)
        UNION ALL SELECT q_id, law_id, global_order, 2, pos, hit_rank, 0 FROM question_terms JOIN top_interp USING (term))) WHERE rn = 1""",
    "question_terms", "rarity", "preferred", "named", "top_laws", "top_interp")


def layered(s, d):
    h, terms, laws = hits(s, d), corpus.question_terms(s, d), L(s, d)
    preferred = se.topic_laws(terms, hint_table(s, d))
    return se.layered_search(terms, h, laws, preferred, se.terms_by_rarity(long_terms(s, d), h), DOMAINS)


query("i8_layered_search", sql("SELECT * FROM layered", "layered"))(layered)


def widened(s, d):
    h, terms, laws = hits(s, d), corpus.question_terms(s, d), L(s, d)
    narrow = se.topk_per_term(terms, se.search(h, laws, 10, ["民法典"], ["修正案", "法律"]).filter("hit_rank <= 2")).select("q_id", "law_id", "global_order")
    wide = se.topk_per_term(terms, se.search(h, laws, 10, None, se.LAW_CATEGORIES + se.INTERPRETATIONS + ["行政法规"])).select("q_id", "law_id", "global_order")
    return se.widen_if_sparse(narrow, wide, corpus.questions(s, d))


cte("narrow", f"""SELECT DISTINCT q_id, law_id, global_order FROM question_terms JOIN (SELECT * FROM (SELECT h.*, row_number() OVER (PARTITION BY term ORDER BY h.law_id, h.global_order) AS hr
    FROM hits h JOIN laws l ON l.id = h.law_id WHERE l.is_current = 1 AND l.legal_domain = '民法典' AND l.category IN ('修正案', '法律')) WHERE hr <= 2) USING (term)""", "question_terms", "hits", "laws")
query("i9_widen_if_sparse", sql(
    """SELECT * FROM narrow WHERE q_id IN (SELECT q_id FROM narrow GROUP BY 1 HAVING count(*) > 3) UNION ALL
       SELECT DISTINCT q_id, law_id, global_order FROM question_terms JOIN top_all USING (term) WHERE q_id NOT IN (SELECT q_id FROM narrow GROUP BY 1 HAVING count(*) > 3)""", "narrow", "question_terms", "top_all"))(widened)
_ORD = "layer, term_rank, hit_rank, law_id, global_order"
cte("context", f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY pinned DESC, {_ORD}) AS place FROM layered) WHERE place <= 20", "layered")
query("f2_context_topk", sql("SELECT q_id, law_id, global_order, place FROM context", "context"))(
    lambda s, d: se.context_topk(layered(s, d)).select("q_id", "law_id", "global_order", "place"))
query("f3_capped", sql(
    f"""SELECT q_id, law_id, global_order, pinned FROM (SELECT *, count(*) OVER (PARTITION BY q_id) AS n, row_number() OVER (PARTITION BY q_id, pinned ORDER BY {_ORD}) AS cr FROM layered)
        WHERE n <= 15 OR cr <= CASE WHEN pinned = 1 THEN 8 ELSE 5 END""", "layered"))(
    lambda s, d: se.capped(layered(s, d), 15, 8, 5).select("q_id", "law_id", "global_order", "pinned"))
query("i18_context_text", sql(
    """SELECT q_id, array_to_string(list_concat(CASE WHEN count(*) FILTER (layer < 2) > 0 THEN ['【法律原文】'] ELSE [] END, coalesce(list(line ORDER BY place) FILTER (layer < 2), []),
         CASE WHEN count(*) FILTER (layer = 2) > 0 THEN [chr(10) || '【司法解释】'] ELSE [] END, coalesce(list(line ORDER BY place) FILTER (layer = 2), [])), chr(10)) AS context FROM (
       SELECT x.*, '《' || l.title || '》' || coalesce(a.article_number, '') || '：' || a.content[1:500] AS line FROM context x
       JOIN articles a ON a.law_id = x.law_id AND a.global_order = x.global_order JOIN laws l ON l.id = x.law_id) GROUP BY 1""", "context", "articles", "laws"))(
    lambda s, d: se.context_text(se.context_topk(layered(s, d)), A(s, d), L(s, d)))
query("i10_validate_terms", sql("SELECT p.source, p.target, h.n AS hits FROM alias_pairs p JOIN (SELECT term, count(*) AS n FROM hits GROUP BY 1) h ON h.term = p.target", "alias_pairs", "hits"))(
    lambda s, d: (lambda t: se.validate_terms(t[0].unionByName(t[1]).unionByName(t[2]), hits(s, d)))(alias_tables(s, d)))
query("i11_validate_hints", sql("SELECT * FROM hints WHERE law_title IN (SELECT title FROM laws WHERE is_current = 1)", "hints", "laws"))(
    lambda s, d: se.validate_hints(hint_table(s, d), L(s, d)))
_GROUP_SQL = ", ".join(f"CASE WHEN {' OR '.join(f'contains(text, {w!r})' for w in ws)} THEN '{g}' END" for g, ws in GROUPS)
query("i12_route_questions", sql(
    f"SELECT q_id, unnest(CASE WHEN len(g) > 0 THEN g ELSE ['{GROUPS[0][0]}', '{GROUPS[1][0]}'] END) AS \"group\" FROM (SELECT q_id, list_filter([{_GROUP_SQL}], lambda x: x IS NOT NULL) AS g FROM questions)", "questions"))(
    lambda s, d: se.route_questions(corpus.questions(s, d), GROUPS))
_FACTS = " UNION ALL ".join(f"SELECT q_id, '{f}' AS field, nullif(regexp_extract(text, '{p}'), '') AS value FROM questions" for f, p in FIELDS)
query("i13_extract_facts", sql(f"SELECT * FROM ({_FACTS}) WHERE value IS NOT NULL", "questions"))(
    lambda s, d: se.extract_facts(corpus.questions(s, d), FIELDS).filter("value IS NOT NULL"))
query("i13_missing_facts", sql(f"SELECT q_id, field FROM ({_FACTS}) WHERE value IS NULL", "questions"))(
    lambda s, d: se.extract_facts(corpus.questions(s, d), FIELDS).filter("value IS NULL").select("q_id", "field"))
query("i14_simple_keywords", sql(
    f"""SELECT q_id, array_to_string(list_filter(k, lambda x, i: list_position(k, x) = i)[1:8], ' ') AS keywords FROM (
        SELECT q_id, list_concat(list_filter({words(corpus.WORDS)}, lambda w: contains(text, w)), regexp_extract_all(text, '[\\x{{4e00}}-\\x{{9fff}}]{{3,6}}')) AS k FROM questions)""", "questions"))(
    lambda s, d: corpus.questions(s, d).select("q_id", F.array_join(se.simple_keywords(c("text"), corpus.WORDS), " ").alias("keywords")))
query("j6_subtree", sql(
    """SELECT h.global_order AS root_order, a.law_id, a.global_order FROM headings h JOIN articles a ON a.law_id = h.law_id AND a.chapter_num = h.chapter_num
       AND (h.type = 'chapter' OR a.section_num = h.section_num) WHERE contains(h.content, '责任') OR contains(h.content, '特别')""", "headings", "articles"))(
    lambda s, d: se.subtree(N(s, d), corpus.headings(s, d).filter(c("content").contains("责任") | c("content").contains("特别"))))


def expert_table(s, d):
    """Experts by statute topic: one per current statute, with its words."""
    return L(s, d).filter("category = '法律'").select("title").distinct().select(
        F.concat(F.expr("substring(title, 8)"), F.lit("专家")).alias("expert"), c("title").alias("law_title"), F.array(F.lit("责任"), F.lit("特别")).alias("words"))


cte("experts", "SELECT DISTINCT title[8:] || '专家' AS expert, title AS law_title FROM laws WHERE category = '法律'", "laws")
cte("chapter_arts", """SELECT * FROM (SELECT expert, law_id, global_order, row_number() OVER (PARTITION BY expert, law_id ORDER BY global_order) AS hit_rank FROM (
      SELECT DISTINCT e.expert, a.law_id, a.global_order FROM experts e JOIN laws l ON l.title = e.law_title AND l.is_current = 1 JOIN headings h ON h.law_id = l.id
      JOIN articles a ON a.law_id = h.law_id AND a.chapter_num = h.chapter_num AND (h.type = 'chapter' OR a.section_num = h.section_num)
      WHERE contains(h.content, '责任') OR contains(h.content, '特别'))) WHERE hit_rank <= 30""", "experts", "laws", "headings", "articles")
query("i15_f7_chapter_articles", sql("SELECT expert, law_id, global_order, hit_rank FROM chapter_arts", "chapter_arts"))(
    lambda s, d: se.chapter_articles(N(s, d), L(s, d), expert_table(s, d), 30))


def expert_terms(s, d):
    pick = F.element_at(F.array(*[F.lit(w) for w in corpus.WORDS]), (F.length("law_title") + 1).cast("int"))
    return expert_table(s, d).select("expert", F.posexplode(F.array(pick, F.lit("损害赔偿"))).alias("pos", "term"))


cte("expert_terms", f"SELECT expert, unnest([0, 1]) AS pos, unnest([{words(corpus.WORDS)}[length(law_title) + 1], '损害赔偿']) AS term FROM experts", "experts")


def expert_hits(s, d):
    return materialize(se.match_terms(A(s, d), se.NODE, "content", expert_terms(s, d), (2, 3)))


cte("ehits", "SELECT t.term, a.law_id, a.global_order FROM (SELECT DISTINCT term FROM expert_terms) t JOIN articles a ON contains(a.content, t.term)", "expert_terms", "articles")


def _retrieved(k_in: int, k_law: int, k_int: int) -> str:
    def best(cats, k, layer):
        return f"""SELECT t.expert AS q_id, x.law_id, x.global_order, {layer} AS layer, t.pos AS term_rank, x.hit_rank, 0 AS pinned FROM expert_terms t JOIN (
          SELECT * FROM (SELECT h.*, row_number() OVER (PARTITION BY term ORDER BY h.law_id, h.global_order) AS hit_rank FROM ehits h JOIN laws l ON l.id = h.law_id
          WHERE l.is_current = 1 AND list_contains({cats}, l.category) AND list_contains({_DOM}, l.legal_domain)) WHERE hit_rank <= {k}) x ON x.term = t.term"""

    return f"""SELECT q_id, law_id, global_order, layer, pinned FROM (SELECT *, row_number() OVER (PARTITION BY q_id, law_id, global_order ORDER BY layer, term_rank, hit_rank) AS rn FROM (
      SELECT expert AS q_id, law_id, global_order, 0 AS layer, 0 AS term_rank, hit_rank, 1 AS pinned FROM chapter_arts
      UNION ALL SELECT t.expert, x.law_id, x.global_order, 1, t.pos, x.hit_rank, 0 FROM expert_terms t JOIN experts e ON e.expert = t.expert JOIN (
        SELECT * FROM (SELECT h.*, l.title, row_number() OVER (PARTITION BY term, l.title ORDER BY h.law_id, h.global_order) AS hit_rank FROM ehits h JOIN laws l ON l.id = h.law_id AND l.is_current = 1) WHERE hit_rank <= {k_in}) x
        ON x.term = t.term AND x.title = e.law_title
      UNION ALL {best(_LAWC, k_law, 2)} UNION ALL {best(words(se.INTERPRETATIONS), k_int, 3)})) WHERE rn = 1"""


_RN = ("chapter_arts", "expert_terms", "experts", "ehits", "laws")
query("i16_retrieve", sql(_retrieved(10, 8, 5), *_RN))(
    lambda s, d: se.retrieve(expert_table(s, d), expert_terms(s, d), N(s, d), L(s, d), expert_hits(s, d), DOMAINS).select("q_id", "law_id", "global_order", "layer", "pinned"))
query("i17_retrieve_chain", sql(_retrieved(5, 10, 8), *_RN))(
    lambda s, d: se.retrieve(expert_table(s, d), expert_terms(s, d), N(s, d), L(s, d), expert_hits(s, d), DOMAINS, 30, 5, 10, 8).select("q_id", "law_id", "global_order", "layer", "pinned"))
query("c16_interpretations_for", sql(
    """SELECT * FROM (SELECT t.title, l.id, l.pub_date, row_number() OVER (PARTITION BY t.title ORDER BY l.pub_date DESC, l.id) AS place FROM (
       SELECT DISTINCT replace(title, '中华人民共和国', '') AS title FROM laws WHERE category = '法律') t JOIN laws l ON l.category = '司法解释' AND l.is_current = 1
       AND length(t.title) >= 1 AND (contains(l.title, t.title[1:6]) OR contains(l.promulgation_info, t.title[1:6]))) WHERE place <= 5""", "laws"))(
    lambda s, d: se.interpretations_for(L(s, d), L(s, d).filter("category = '法律'").select(cit.strip_prc(c("title")).alias("title")).distinct(), 5))


def refs(s, d):
    return T(s, d, "orders").select(F.substring(corpus.short_title(F.expr("o_custkey div 15") * 10), 1, 5).alias("fragment"), F.concat(F.lit("第"), corpus._numeral(c("o_orderkey") % 60 + 1), F.lit("条")).alias("label"))


cte("frag_refs", f"SELECT DISTINCT ({short('o_custkey // 15 * 10')})[1:5] AS fragment, '第' || {num('o_orderkey % 60 + 1')} || '条' AS label FROM orders")
query("c10_find_by_fragment", sql(
    """SELECT fragment, label, law_id, global_order FROM (SELECT r.*, a.law_id, a.global_order, row_number() OVER (PARTITION BY r.fragment, r.label ORDER BY a.law_id, a.global_order) AS rn
       FROM (SELECT f.fragment, l.id FROM (SELECT DISTINCT fragment FROM frag_refs) f JOIN laws l ON l.is_current = 1 AND contains(l.title, f.fragment)) m
       JOIN frag_refs r ON r.fragment = m.fragment JOIN articles a ON a.law_id = m.id AND a.article_number = r.label) WHERE rn = 1""", "frag_refs", "laws", "articles"))(
    lambda s, d: cit.find_by_fragment(refs(s, d), L(s, d), A(s, d)))
_N7 = "[一二三四五六七八九十百千零\\d]+"
_CITED = " UNION ALL ".join(
    f"""SELECT q_id, law_id, global_order, article_number, '{kind}' AS kind, i AS pos, {title} AS fragment, '第' || regexp_extract(m[i], '{pattern}', {group}) || '条' AS label
        FROM (SELECT *, regexp_extract_all(content, '{pattern}') AS m, generate_subscripts(regexp_extract_all(content, '{pattern}'), 1) AS i FROM hit_texts)"""
    for kind, pattern, title, group in [
        ("引用链", f"《([^》]{{4,30}})》第({_N7})条", f"trim(regexp_replace(regexp_extract(m[i], '《([^》]{{4,30}})》第({_N7})条', 1), '\\s+', ' ', 'g'), ' ')", 2),
        ("同法引用", f"(?:本法|依照|适用|参照)第({_N7})条", "title", 1),
    ])
query("j7_expand_hits", sql(
    f""", first5 AS (SELECT q_id, law_id, global_order FROM context WHERE place <= 5),
    hit_texts AS (SELECT f.*, a.content, a.article_number, l.title FROM first5 f JOIN articles a USING (law_id, global_order) JOIN laws l ON l.id = f.law_id),
    cited AS ({_CITED}),
    target AS (SELECT fragment, label, min((a.law_id, a.global_order)) AS hit FROM (SELECT DISTINCT fragment, label FROM cited) JOIN laws l ON l.is_current = 1 AND contains(l.title, fragment)
      JOIN articles a ON a.law_id = l.id AND a.article_number = label GROUP BY 1, 2)
    SELECT q_id, hit[1] AS to_law_id, hit[2] AS to_order, arg_min(kind || ':' || coalesce(article_number, '') || '→' || label, (law_id, global_order, kind, pos)) AS source
    FROM cited JOIN target USING (fragment, label) WHERE (q_id, hit[1], hit[2]) NOT IN (SELECT q_id, law_id, global_order FROM first5) GROUP BY 1, 2, 3""",
    "context", "articles", "laws"))(lambda s, d: cit.expand_hits(materialize(se.context_topk(layered(s, d), 5).select("q_id", "law_id", "global_order")), A(s, d), L(s, d)))


_F1 = corpus.WORDS + corpus.TOPICS


def overlapping(s, d):
    """Dictionary words at their first place in an article."""
    found = F.filter(F.transform(F.array(*[F.lit(w) for w in _F1]), lambda w: F.struct(F.instr("content", w).alias("start"), w.alias("title"))), lambda x: x["start"] > 0)
    return A(s, d).select(F.concat_ws(":", "law_id", "global_order").alias("doc"), F.inline(found))


query("f1_longest_match", sql(
    f"""SELECT doc, start, title FROM (SELECT *, row_number() OVER (PARTITION BY doc, start ORDER BY length(title) DESC, title) AS rn FROM (
        SELECT law_id || ':' || global_order AS doc, CAST(instr(content, w) AS INT) AS start, w AS title FROM articles JOIN (SELECT unnest({words(_F1)}) AS w) ON contains(content, w))) WHERE rn = 1""", "articles"))(
    lambda s, d: cit.longest_per_run(overlapping(s, d)))
query("j4_context_alias", sql(
    "SELECT p_partkey, CASE WHEN p_size > 25 THEN '中华人民共和国合同法' END AS full_title FROM part"))(
    lambda s, d: T(s, d, "part").select("p_partkey", cit.context_alias(
        F.concat(F.when(c("p_size") > 25, F.lit("关于审理商品房买卖合同")).otherwise(F.lit("关于审理")), "p_name"), F.lit("合同法")).alias("full_title")))

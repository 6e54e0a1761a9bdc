"""Text rules, document jobs and structure over the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.functions import numerals as num
from statutelake.functions import text as tx
from statutelake.operators import documents as doc
from statutelake.operators import structure as st
from statutelake.plans import corpus
from statutelake.plans.oracle import NUM, NUMERALS, cte, sql
from statutelake.plans.q_citations import edges
from statutelake.plans.registry import query

L, N, A, D, T = corpus.laws, corpus.nodes, corpus.articles, corpus.cases, corpus.table
c = F.col

query("h1_label_to_int", sql(f"SELECT law_id, global_order, CAST(list_position({NUMERALS}, regexp_extract(article_number, '第(.+)条', 1)) AS INT) AS number FROM articles WHERE article_number IS NOT NULL", "articles"))(
    lambda s, d: A(s, d).filter("article_number IS NOT NULL").select("law_id", "global_order", num.label_to_int(c("article_number")).alias("number")))
query("h2_int_to_numeral", sql(f"SELECT p_partkey, ({NUMERALS})[p_size] AS numeral FROM part"))(
    lambda s, d: T(s, d, "part").select("p_partkey", num.int_to_numeral(c("p_size")).alias("numeral")))
query("h3_year_numeral", sql("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders"))(
    lambda s, d: T(s, d, "orders").select("o_orderkey", num.year_numeral_to_int(F.translate(F.year("o_orderdate").cast("string"), "0123456789", "〇一二三四五六七八九")).alias("year")))
query("h4_normalize_title", sql("SELECT p_partkey, '最高人民法院、最高人民检察院关于合同' || p_name AS title FROM part"))(
    lambda s, d: T(s, d, "part").select("p_partkey", tx.normalize_title(F.concat(F.lit("最高人民法院　最高人民检察院 关于合　同"), "p_name")).alias("title")))
query("h5_title_key", sql("SELECT p_partkey, replace(p_name, ' ', '') || p_brand AS key FROM part"))(
    lambda s, d: T(s, d, "part").select("p_partkey", tx.title_key(F.concat("p_name", F.lit("　"), "p_brand")).alias("key")))
query("h6_clean_text", sql("""SELECT doc_id, md5(trim(regexp_replace(array_to_string(list_transform(string_split(regexp_replace(text, '\\n{2,}', chr(10), 'g'), chr(10)), lambda x: trim(x)), chr(10)), '[ \\t]{2,}', ' ', 'g'), chr(10) || ' ')) AS h FROM documents"""))(
    lambda s, d: T(s, d, "documents").select("doc_id", F.md5(tx.clean_text(c("text"))).alias("h")))
cte("clean", """SELECT law_id, global_order, regexp_replace(regexp_replace(content, '[-－]\\s*PAGE\\s+\\d+\\s*[-－]', ''), 'HYPERLINK\\s*"[^"]*"\\s*', '') AS content FROM articles""", "articles")
query("h7_clean_article", sql("SELECT law_id, global_order, md5(content) AS h FROM clean", "clean"))(
    lambda s, d: A(s, d).select("law_id", "global_order", F.md5(tx.clean_article(c("content"))).alias("h")))
query("h8_stem_parts", sql("SELECT id, pub_date AS day, title FROM laws", "laws"))(
    lambda s, d: L(s, d).select("id", tx.stem_date(c("filename")).alias("day"), tx.stem_title(c("filename")).alias("title")))
query("h9_english_punctuation", sql("""SELECT doc_key, array_to_string(list_transform(string_split(translate(replace(full_text, '、', ', '), '，。；：（）【】《》', ',.;:()[]""'), chr(10)), lambda x: trim(x)), chr(10)) AS text FROM cases""", "cases"))(
    lambda s, d: D(s, d).select("doc_key", tx.english_punctuation(c("full_text")).alias("text")))
query("h10_break_lists", sql("SELECT law_id, global_order, md5(content_en || ' Items:' || chr(10) || '(1) a;' || chr(10) || '(2) b' || chr(10) || '(3) c') AS h FROM articles WHERE content_en IS NOT NULL", "articles"))(
    lambda s, d: A(s, d).filter("content_en IS NOT NULL").select("law_id", "global_order", F.md5(tx.break_lists(F.concat("content_en", F.lit(" Items: (1) a; (2) b; or (3) c")))).alias("h")))
query("h11_issue_parts", sql("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS number, 'a_b_' || o_orderkey AS file FROM orders"))(
    lambda s, d: T(s, d, "orders").withColumn("issue", F.date_format("o_orderdate", "yyyy年第M期")).select(
        "o_orderkey", tx.issue_year(c("issue")).alias("year"), tx.issue_number(c("issue")).alias("number"), tx.file_name(F.concat(F.lit("a/b: "), "o_orderkey")).alias("file")))
query("h12_content_hash", sql("SELECT doc_id, md5(text) AS h FROM documents"))(lambda s, d: T(s, d, "documents").select("doc_id", F.md5("text").alias("h")))
query("h13_cjk_and_ngrams", sql("SELECT law_id, global_order, CAST(length(regexp_replace(content, '[^\\x{4e00}-\\x{9fff}]', '', 'g')) AS INT) AS cjk, CAST(length(content) - 2 AS INT) AS trigrams FROM articles", "articles"))(
    lambda s, d: A(s, d).select("law_id", "global_order", tx.cjk_count(c("content")).alias("cjk"), F.size(tx.ngrams(c("content"), 3)).alias("trigrams")))
query("h14_keyword_list", sql("SELECT doc_key, len(list_filter(string_split(keywords, '、'), lambda x: x <> '')) AS n, CASE WHEN keywords <> '' THEN string_split(keywords, '、')[1] END AS first FROM cases", "cases"))(
    lambda s, d: D(s, d).withColumn("k", tx.keyword_list(c("keywords"))).select("doc_key", F.size("k").cast("bigint").alias("n"), F.get("k", F.lit(0)).alias("first")))
query("h15_path_parts", sql("SELECT page_id, len(list_filter(string_split(url, '/'), lambda x: trim(x) <> '')) AS parts, '../../' AS prefix FROM pages"))(
    lambda s, d: T(s, d, "pages").select("page_id", F.size(tx.path_parts(c("url"))).cast("bigint").alias("parts"), tx.relative_prefix(F.lit("民事"), F.lit("合同")).alias("prefix")))
query("h16_repeal_number", sql("SELECT id, CASE WHEN repealed_by <> '' THEN '法释〔2020〕16号' ELSE '' END AS number FROM laws", "laws"))(
    lambda s, d: L(s, d).select("id", tx.repeal_number(c("repealed_by")).alias("number")))
query("g3_split_inline", sql("SELECT p_partkey, ['第一条　' || p_name, '第二条　' || p_brand || chr(10) || '第九条　' || p_type] AS parts FROM part"))(
    lambda s, d: T(s, d, "part").select("p_partkey", st.split_inline(F.concat(F.lit("第一条　"), "p_name", F.lit("\n　　第二条　"), "p_brand", F.lit("\n第九条　"), "p_type")).alias("parts")))
query("g5_fix_labels", sql(f"SELECT law_id, global_order, md5(regexp_replace(replace(content, '　', ''), '^(第{NUM}条)', '\\1　')) AS h FROM articles", "articles"))(
    lambda s, d: A(s, d).select("law_id", "global_order", F.md5(tx.fix_labels(F.replace("content", F.lit("　"), F.lit("")))).alias("h")))


def heads(s, d):
    text = F.concat_ws("\n", "title", "doc_number", "issuing_org", "promulgation_info", F.lit("第一次修订）"), F.lit("第一条　总则"))
    return L(s, d).select("id", doc.head_lines(text, 45).alias("lines"))


query("g7_promulgation", sql("SELECT id, promulgation_info || ' 第一次修订）' AS promulgation FROM laws", "laws"))(
    lambda s, d: heads(s, d).select("id", doc.promulgation(c("lines")).alias("promulgation")))
query("g8_org_docnum", sql("SELECT id, issuing_org AS org, doc_number FROM laws", "laws"))(
    lambda s, d: heads(s, d).select("id", doc.issuing_body(c("lines")).alias("org"), doc.document_number(c("lines")).alias("doc_number")))
query("g9_effective_date", sql("SELECT id, strftime(CAST(pub_date AS DATE) + 30, '%Y-%m-%d') AS effective_date FROM laws", "laws"))(
    lambda s, d: doc.effective_date(L(s, d), A(s, d)))
query("g10_ruling_gist", sql("SELECT doc_key, regexp_extract(full_text, '【裁判要点】([^。]*。)', 1) AS gist FROM cases", "cases"))(
    lambda s, d: D(s, d).select("doc_key", tx.ruling_gist(c("full_text")).alias("gist")))
query("g11_keywords", sql("SELECT doc_key, regexp_extract(full_text, '【关键词】([^\\n]*)\\n', 1) AS marked FROM cases", "cases"))(
    lambda s, d: D(s, d).select("doc_key", tx.marked_keywords(c("full_text")).alias("marked")))
_GIST = "CASE WHEN ruling_gist <> '' THEN ruling_gist ELSE regexp_extract(full_text, '【裁判要点】([^。]*。)', 1) END"


def _inferred(gist: str) -> str:
    """Dictionary words in order, then dispute names, each once, eight at most."""
    known = "['" + "','".join(tx.KEYWORDS) + "']"
    return f"""SELECT doc_key, array_to_string(list_filter(k, lambda x, i: list_position(k, x) = i)[1:8], '、') AS words FROM (SELECT doc_key,
        list_concat(list_filter({known}, lambda w: contains(title || ' ' || {gist} || ' ' || full_text, w)),
          regexp_extract_all(title, '[一-龥]{{2,10}}(?:纠纷|争议|案件)')) AS k FROM cases)"""


cte("inferred", _inferred(_GIST), "cases")
query("g11_inferred_keywords", sql(_inferred("ruling_gist"), "cases"))(
    lambda s, d: D(s, d).select("doc_key", tx.inferred_keywords(c("title"), c("ruling_gist"), c("full_text")).alias("words")))
query("g12_case_number", sql("SELECT doc_key, nullif(regexp_extract(title, '指导性案例\\d+号'), '') AS number FROM cases", "cases"))(
    lambda s, d: D(s, d).select("doc_key", tx.case_number(c("title")).alias("number")))
query("g13_enrich_docs", sql(
    f"""SELECT c.doc_key, {_GIST} AS ruling_gist, nullif(regexp_extract(title, '指导性案例\\d+号'), '') AS case_number,
       CASE WHEN keywords <> '' THEN keywords ELSE coalesce(nullif(regexp_extract(full_text, '【关键词】([^\\n]*)\\n', 1), ''), i.words) END AS keywords
       FROM cases c JOIN inferred i ON i.doc_key = c.doc_key""", "cases", "inferred"))(
    lambda s, d: doc.enrich_docs(D(s, d)).select("doc_key", "ruling_gist", "case_number", "keywords"))
query("g14_n4_merge_keywords", sql(
    """SELECT doc_key, array_to_string(list_filter(k, lambda x, i: list_position(k, x) = i), '、') AS words FROM (
       SELECT doc_key, list_concat([source, '民事', source], list_filter(string_split(keywords, '、'), lambda x: x <> '')) AS k FROM cases)""", "cases"))(
    lambda s, d: D(s, d).select("doc_key", tx.merged_keywords(F.create_map(F.lit("类型"), F.array("source", F.lit("民事")), F.lit("来源"), F.array("source")), c("keywords")).alias("words")))


def serial(s, d):
    """Each order in two instalments, the second with a repeated header."""
    base = T(s, d, "orders").select("o_orderkey", "o_orderpriority")
    main = base.select(F.concat(F.lit("m/"), "o_orderkey").alias("doc_key"), F.concat(F.lit("正文"), "o_orderpriority", F.lit(" \n")).alias("full_text"))
    cont = base.select(F.concat(F.lit("c/"), "o_orderkey").alias("doc_key"), F.concat(F.lit("一、标题\n法释〔2015〕5号\n（接上期）\n三、"), F.repeat("o_orderpriority", F.lit(9))).alias("full_text"))
    pairs = base.select(F.concat(F.lit("m/"), "o_orderkey").alias("main_key"), F.concat(F.lit("c/"), "o_orderkey").alias("cont_key"))
    return main.unionByName(cont), pairs


query("g15_merge_continuations", sql("SELECT 'm/' || o_orderkey AS main_key, 'c/' || o_orderkey AS cont_key, '正文' || o_orderpriority || chr(10) || chr(10) || '三、' || repeat(o_orderpriority, 9) AS full_text FROM orders"))(
    lambda s, d: doc.merge_continuations(*serial(s, d)))
query("g15_merge_articles", sql(
    """SELECT law_id AS doc, CASE WHEN article_number IS NULL THEN '-' ELSE 'int:' || article_num END AS key, coalesce(article_number, '-') AS article_number, content_en FROM (
       SELECT *, row_number() OVER (PARTITION BY law_id, coalesce(article_number, '-') ORDER BY CASE WHEN chapter_num < 3 THEN 0 ELSE 1 END, global_order) AS rn FROM articles) WHERE rn = 1""", "articles"))(
    lambda s, d: (lambda a: doc.merge_articles(a.filter("chapter_num < 3").drop("chapter_num"), a.filter("chapter_num = 3").drop("chapter_num")))(
        A(s, d).select(c("law_id").alias("doc"), c("global_order").alias("pos"), F.coalesce("article_number", F.lit("-")).alias("article_number"), "content_en", "chapter_num")))

def _greedy(limit: int, sep: int, rows: str, out: str) -> str:
    return f"""WITH RECURSIVE items AS ({rows}), walk AS (
      SELECT doc_id, i, 0 AS grp, size + {sep} AS used, size FROM items WHERE i = 1
      UNION ALL SELECT n.doc_id, n.i, CASE WHEN w.used + n.size + {sep} > {limit} THEN w.grp + 1 ELSE w.grp END,
        CASE WHEN w.used + n.size + {sep} > {limit} THEN n.size + {sep} ELSE w.used + n.size + {sep} END, n.size
      FROM walk w JOIN items n ON n.doc_id = w.doc_id AND n.i = w.i + 1) {out}"""


query("g16_chunk_text", _greedy(
    6000, 1, "SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, length(unnest(string_split(text, chr(10)))) AS size FROM documents",
    "SELECT doc_id, CAST(grp AS INT) AS chunk, CAST(sum(size + 1) - 1 AS INT) AS chars FROM walk GROUP BY 1, 2"))(
    lambda s, d: doc.chunk_text(T(s, d, "documents"), "doc_id", "text").select("doc_id", "chunk", F.length("text").alias("chars")))
query("g17_batch_by_chars", _greedy(
    1000, 0, "SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, length(unnest(string_split(text, chr(10)))) AS size FROM documents",
    "SELECT doc_id, CAST(grp AS INT) AS batch, CAST(count(*) AS INT) AS items, CAST(sum(size) AS INT) AS chars FROM walk GROUP BY 1, 2"))(
    lambda s, d: doc.batch_by_chars(T(s, d, "documents").select("doc_id", F.split("text", "\n").alias("items")), "doc_id", "items", 1000))
query("g18_align_paragraphs", sql(
    """SELECT law_id, global_order, replace(replace(content_en, ' If the', chr(10) || 'If the'), ' See ', chr(10) || 'See ') AS aligned FROM articles
       WHERE contains(content, chr(10)) AND contains(content_en, 'See ')""", "articles"))(
    lambda s, d: A(s, d).select("law_id", "global_order", doc.align_paragraphs(c("content"), c("content_en")).alias("aligned")).filter("aligned IS NOT NULL"))
query("g20_link_text", sql("SELECT p_partkey, '见[甲法第十条](b)和[甲法](a)' || p_name AS linked FROM part"))(
    lambda s, d: T(s, d, "part").select("p_partkey", F.replace(doc.link_text(F.concat(F.lit("见甲法第十条和乙法"), "p_name"), F.array(
        F.struct(F.lit("乙法").alias("raw"), F.lit("[甲法](a)").alias("link")), F.struct(F.lit("甲法第十条").alias("raw"), F.lit("[甲法第十条](b)").alias("link")))), F.lit("\u0000"), F.lit("")).alias("linked")))
query("g21_render_plain", sql(
    """SELECT law_id, global_order, CASE type WHEN 'chapter' THEN '### ' || content WHEN 'section' THEN '#### ' || content ELSE
       '<a id="art-' || article_num || '"></a>' || replace(content, chr(10), '  ' || chr(10)) END AS line FROM nodes""", "nodes"))(
    lambda s, d: doc.node_markdown(N(s, d).withColumn("content_en", F.lit(None).cast("string"))))
query("g22_merge_template", sql(
    """SELECT a.law_id, a.global_order, a.article_number, coalesce(t.e, '') AS content_en FROM articles a LEFT JOIN (
       SELECT law_id, article_number, max(content_en) AS e FROM articles WHERE content_en IS NOT NULL GROUP BY 1, 2) t ON t.law_id = a.law_id AND t.article_number = a.article_number""", "articles"))(
    lambda s, d: doc.merge_template(A(s, d), A(s, d).filter("content_en IS NOT NULL")))
query("g23_number_to_label", sql(f"SELECT p_partkey, '第' || ({NUMERALS})[p_size] || '条　【' || p_name || '】' AS line FROM part"))(
    lambda s, d: T(s, d, "part").select("p_partkey", doc.number_to_label(F.concat("p_size", F.lit(".【"), "p_name", F.lit("】"))).alias("line")))
cte("line_kind", f"""SELECT *, CASE WHEN regexp_matches(text, '^第{NUM}章　') THEN 'chapter' WHEN regexp_matches(text, '^第{NUM}节　') THEN 'section'
    WHEN regexp_matches(text, '^第{NUM}条　') THEN 'article' ELSE 'text' END AS kind FROM law_lines""", "law_lines")
cte("segmented", """SELECT doc, article_line, chapter_line, section_line, string_agg(text, chr(10) ORDER BY line_no) AS content FROM (
      SELECT doc, line_no, text, max(CASE WHEN kind = 'article' THEN line_no END) OVER w AS article_line, max(CASE WHEN kind = 'chapter' THEN line_no END) OVER w AS chapter_line,
        max(CASE WHEN kind = 'section' THEN line_no END) OVER w AS section_line FROM line_kind WINDOW w AS (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING))
    WHERE article_line > section_line AND article_line > chapter_line GROUP BY 1, 2, 3, 4""", "line_kind")
query("g1_segment", sql("SELECT doc, article_line, chapter_line, section_line, regexp_extract(content, '^(第[^条]+条)', 1) AS label, length(regexp_replace(regexp_replace(content, '[-－]\\s*PAGE\\s+\\d+\\s*[-－]', '', 'g'), 'HYPERLINK\\s*\"[^\"]*\"\\s*', '', 'g')) AS chars FROM segmented", "segmented"))(
    lambda s, d: st.segment(corpus.law_lines(s, d), corpus.SEGMENT).select("doc", "article_line", "chapter_line", "section_line", "label", F.length("content").cast("bigint").alias("chars")))
query("e5_number_nodes", sql(
    """SELECT doc, line_no, type, row_number() OVER (PARTITION BY doc ORDER BY line_no) AS global_order, row_number() OVER (PARTITION BY doc, type, parent ORDER BY line_no) AS order_index FROM (
       SELECT doc, article_line AS line_no, 'article' AS type, section_line AS parent FROM segmented
       UNION ALL SELECT DISTINCT doc, section_line, 'section', chapter_line FROM segmented UNION ALL SELECT DISTINCT doc, chapter_line, 'chapter', -1 FROM segmented)""", "segmented"))(
    lambda s, d: st.number_nodes(st.segment(corpus.law_lines(s, d), corpus.SEGMENT), corpus.SEGMENT).select("doc", "line_no", "type", "global_order", "order_index"))
query("e7_drop_toc_headings", sql(
    "SELECT doc_id AS doc, md5(regexp_replace(text, '[ \\t]{2,}', ' ', 'g')) AS h, max(pos) AS line_no FROM doc_lines GROUP BY 1, 2", "doc_lines"))(
    lambda s, d: st.drop_toc_headings(corpus.doc_lines(s, d).select(c("doc_id").alias("doc"), c("pos").alias("line_no"), F.regexp_replace("text", "[ \t]{2,}", " ").alias("text"), F.lit("chapter").alias("kind"))).select("doc", F.md5("text").alias("h"), "line_no"))
query("g6_whole_text_fallback", sql("SELECT doc_id AS doc, min(pos) AS article_line, count(*) AS lines FROM doc_lines GROUP BY 1", "doc_lines"))(
    lambda s, d: (lambda lines: st.whole_text_fallback(lines, st.segment(lines, 1 << 30)).select("doc", c("article_line"), F.size(F.split("content", "\n")).cast("bigint").alias("lines")))(
        corpus.doc_lines(s, d).select(c("doc_id").alias("doc"), c("pos").alias("line_no"), "text")))
query("a5_read_lines", sql("SELECT doc_id, pos, text FROM doc_lines", "doc_lines"))(lambda s, d: corpus.doc_lines(s, d).drop("lang"))
_PLAIN = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g'),
  '(?s)<!--.*?-->', '', 'g'), '(?i)<br\\s*/?>|</?(?:p|div)\\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g')"""
for _name, _char in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&#39;", "''"), ("&amp;", "&")]:
    _PLAIN = f"replace({_PLAIN}, '{_name}', '{_char}')"
query("a8_pages_to_text", sql(
    f"SELECT page_id, array_to_string(list_filter(list_transform(string_split({_PLAIN}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''), chr(10)) AS text FROM pages"))(lambda s, d: T(s, d, "pages").select("page_id", doc.page_text(c("html")).alias("text")))
_LINK = '<a[^>]*\\bhref="([^"]*)"[^>]*>([^<]*)</a>'
query("a9_extract_listing", sql(f"SELECT page_id, regexp_extract(r, '{_LINK}', 1) AS url, trim(regexp_extract(r, '{_LINK}', 2), ' ') AS title FROM (SELECT page_id, unnest(regexp_extract_all(html, '{_LINK}')) AS r FROM pages)"))(
    lambda s, d: doc.extract_listing(T(s, d, "pages")).drop("pos", "issue"))
query("a9_listing_issues", sql(
    """SELECT s_suppkey AS page_id, '/Details/' || s_suppkey || '-' || i || '?a=1&b=2' AS url, s_name || ' ' || i AS title, CASE WHEN (s_suppkey + i) % 3 <> 0 THEN '2020年第' || i || '期' END AS issue
       FROM supplier, (SELECT unnest([1, 2, 3]) AS i)"""))(
    lambda s, d: doc.extract_listing(T(s, d, "supplier").select(c("s_suppkey").alias("page_id"), F.expr(
        """concat('<ul>', array_join(transform(sequence(1, 3), i -> concat('<li><a class="x" href="/Details/', s_suppkey, '-', i, '?a=1&amp;b=2" title="t">\n', s_name, ' <b>', i, '</b> </a>',
           CASE WHEN (s_suppkey + i) % 3 <> 0 THEN concat(' <lable> 2020年第', i, '期\n</lable>') ELSE '' END, '</li>')), ''), '</ul>')""").alias("html"))).drop("pos"))
query("a9_last_page", sql("SELECT page_id, coalesce(list_max(list_transform(regexp_extract_all(url || html, '[?&]page=(\\d+)', 1), lambda x: CAST(x AS INT))), 1) AS last_page FROM pages"))(
    lambda s, d: T(s, d, "pages").select("page_id", doc.last_page(F.concat("url", "html")).alias("last_page")))
query("a10_extract_detail", sql(
    "SELECT id, doc_number, pub_date, strftime(CAST(pub_date AS DATE) + 30, '%Y-%m-%d') AS effective_date, CAST(substr(pub_date, 1, 4) AS INT) AS year, 7 AS issue_num FROM laws", "laws"))(
    lambda s, d: doc.extract_detail(L(s, d).select("id", F.concat("doc_number", F.lit("，"), "promulgation_info", F.lit("，第7期")).alias("text"))).drop("text"))

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from statutelake.functions import rules
from statutelake.operators import citations as cit
from statutelake.operators import classify as cl
from statutelake.operators import identity as ident
from statutelake.operators import relational as rel
from statutelake.operators import search as se
from statutelake.operators.ordered import lag_by_segment, rank_by_segment, top_per_group
from statutelake.sources import readers, sinks

LAW = "id bigint, title string, pub_date string, is_current int"
ART = "law_id bigint, global_order bigint, article_num int, chapter_num int, section_num int, part_num int, article_number string, content string, type string"
PRC = "中华人民共和国"


def corpus(spark):
    laws = spark.createDataFrame([
        (1, PRC + "刑法", "2000-01-01", 1), (2, PRC + "刑法修正案（八）", "2010-01-01", 1), (3, PRC + "民法典", "2020-01-01", 1), (4, PRC + "民法典", "2010-01-01", 0),
    ], LAW)
    arts = spark.createDataFrame([
        (1, 1, 3, None, None, None, "第三条", "第三条　甲", "article"),
        (1, 2, 10, None, None, None, "第十条", "第十条　依照《民法典》第二十条、民法典第二十条和民法典第二十一条。", "article"),
        (2, 1, 1, None, None, None, "一、", "一、本法第三条修改。《刑法》第十条 依照刑法第十条", "article"),
        (3, 5, 20, 1, None, None, "第二十条", "第二十条　本法第九十九条。", "article"),
        (4, 1, 20, 1, None, None, "第二十条", "第二十条　旧", "article"),
    ], ART)
    return laws, arts


def test_citations(spark):
    laws, arts = corpus(spark)
    got = {(r.from_law_id, r.raw_text, r.to_law_id, r.to_article_num, r.ref_type, r.resolved) for r in cit.build_citations(arts, laws).collect()}
    assert got == {
        (1, "《民法典》第二十条", 3, 20, "cross_law", 1),
        (1, "民法典第二十一条", 3, None, "cross_law", 0),
        (2, "《刑法》第十条", 1, 10, "cross_law", 1),
        (2, "本法第三条", 1, 3, "cross_law", 1),
        (3, "本法第九十九条", 3, None, "self_ref", 0),
    }


def test_bare_title_is_not_the_quoted_one(spark):
    laws, _ = corpus(spark)
    df = spark.createDataFrame([(1, "《刑法》第十条 依照刑法第十条")], ["k", "content"])
    assert [r.raw_text for r in cit.cite_short(df, ["k"], cit.short_titles(laws)).collect()] == ["刑法第十条"]


def test_expand_hits(spark):
    laws, arts = corpus(spark)
    laws = laws.unionByName(spark.createDataFrame([(9, PRC + "公司登记法", "2001-01-01", 1)], LAW))
    arts = arts.unionByName(spark.createDataFrame([
        (9, 1, 1, None, None, None, "第一条", "第一条　适用第二条，见《公司登记法》第三条。", "article"), (9, 2, 2, None, None, None, "第二条", "x", "article"), (9, 3, 3, None, None, None, "第三条", "y", "article")], ART))
    hits = spark.createDataFrame([(7, 9, 1)], "q_id bigint, law_id bigint, global_order bigint")
    got = {(r.to_law_id, r.to_order, r.source) for r in cit.expand_hits(hits, arts, laws).collect()}
    assert got == {(9, 2, "同法引用:第一条→第二条"), (9, 3, "引用链:第一条→第三条")}


def test_tiers(spark):
    laws = spark.createDataFrame([(i, str(i), "", 1) for i in range(6)], LAW)
    counts = [50, 20, 10, 5, 1, 0]
    edges = spark.createDataFrame([(i,) for i, n in enumerate(counts) for _ in range(n)], "to_law_id bigint")
    assert [r.tier for r in cit.citation_tiers(laws, edges).orderBy("id").collect()] == ["T0", "T1", "T2", "T3", "T4", "T5"]


def test_segmented_order_equals_window(spark):
    """A hot key: one law holds most rows."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 3001).alias("o"), F.col("id").alias("v"))
    w = Window.partitionBy("k").orderBy("o")
    want = {tuple(r) for r in df.select("k", "o", F.lag("v").over(w)).collect()}
    for span in (10, 500, 100000):
        got = {tuple(r) for r in lag_by_segment(df, ["k"], "o", ["v"], span).select("k", "o", "prev_v").collect()}
        assert got == want
    seg = df.withColumn("s", F.expr("o div 100"))
    ranked = {tuple(r) for r in rank_by_segment(seg, ["k"], [F.col("o")], ["s"], "n").select("k", "o", "n").collect()}
    assert ranked == {tuple(r) for r in df.select("k", "o", F.row_number().over(w)).collect()}


def test_top_per_group_limits_before_the_shuffle(spark):
    plan = top_per_group(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], [F.col("id")], 2)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().toString()


def test_article_gaps(spark):
    rows = [(1, i, n, None, 1, None) for i, n in enumerate([1, 2, 2, 5, 4])] + [(2, i, n, None, ch, None) for i, (n, ch) in enumerate([(1, 1), (2, 1), (1, 2), (2, 2)])]
    df = spark.createDataFrame(rows, "law_id bigint, global_order bigint, article_num int, part_num int, chapter_num int, section_num int")
    got = [(r.law_id, r.issue, r.from_num, r.to_num, r.missing_articles) for r in rel.article_gaps(df, 2).orderBy("law_id", "global_order").collect()]
    assert got == [(1, "duplicate", 2, 2, 0), (1, "gap", 2, 5, 2), (1, "reversal", 5, 4, 0)]


def test_currency(spark):
    df = spark.createDataFrame([(1, "a", "2015-01-01", 1, ""), (2, "a", "2021-01-01", 0, ""), (3, "b", "2020-01-01", 1, ""), (4, "c", "2020-01-01", 1, "x")],
                               "id bigint, title_key string, pub_date string, is_current int, repealed_by string")
    assert {(r.id, r.problem) for r in rel.check_currency(df).collect()} == {(1, "should_not_be_current"), (2, "should_be_current"), (4, "repealed_but_current")}


def test_multiset_match(spark):
    arts = spark.createDataFrame([(1, 1, "一"), (1, 2, "一"), (2, 1, "第一条"), (3, 1, None)], "law_id bigint, global_order bigint, article_number string")
    tr = spark.createDataFrame([(1, "一", "x")] * 3 + [(2, "第1条", "y")] + [(3, "_1", "z")], "law_id bigint, article_number string, content_en string")
    got = {r.law_id: (r.matched, r.en_count, r.status) for r in ident.match_translations(arts, tr).collect()}
    assert got == {1: (2, 3, "partial"), 2: (1, 1, "full"), 3: (1, 1, "full")}


def test_translation_import_levels(spark):
    arts = spark.createDataFrame([(1, 1, "第一条", None), (1, 2, "第二条", "old"), (1, 3, "三、", None), (2, 1, None, None)],
                                 "law_id bigint, global_order bigint, article_number string, content_en string")
    tr = spark.createDataFrame([(1, 0, "第一条", "one"), (1, 1, "第2条", "two"), (1, 2, "第三条", "three"), (2, 0, "_1", "whole")],
                               "law_id bigint, pos int, article_number string, content_en string")
    got = {(r.law_id, r.global_order): r.content_en for r in ident.import_translations(arts, tr).collect()}
    assert got == {(1, 1): "one", (1, 2): "old", (1, 3): "three", (2, 1): "whole"}


def test_ids(spark):
    docs = spark.createDataFrame([("a", "x", "2001"), ("b", "x", "2000"), ("c", "x", "1999")], "filename string, category string, pub_date string")
    index = spark.createDataFrame([("a", "x", 104)], "filename string, category string, id bigint")
    got = {r.filename: r.id for r in ident.assign_ids(docs, index, {"x": (100, 50)}).collect()}
    assert got == {"a": 104, "c": 105, "b": 106}
    try:
        ident.assign_ids(docs, index, {"x": (100, 6)}).collect()
        raise AssertionError("a full range must fail")
    except Exception as error:
        assert "id range is full" in str(error)


def test_domains(spark):
    laws = spark.createDataFrame([(PRC + "刑事诉讼法", "法律"), ("办法", "行政法规"), ("办法", "法律")], ["title", "category"])
    assert [r.domain for r in cl.classify_domain(laws).collect()] == ["诉讼与非诉讼程序法", "行政法", None]
    exact = spark.createDataFrame([(PRC + "刑事诉讼法", "宪法相关法")], ["title", "domain"])
    assert cl.classify_domain(laws, exact).filter("title LIKE '%刑事%'").first()["domain"] == "宪法相关法"
    assert len(rules.DOMAIN_RULES) == 7


def test_hierarchy(spark):
    laws = spark.createDataFrame([
        (1, PRC + "消费者权益保护法", "法律", ""), (2, PRC + "消费者权益保护法实施条例", "行政法规", "")], "id bigint, title string, category string, full_text string")
    row = cl.hierarchy_links(laws).first()
    assert (row.child_id, row.parent, row.relation) == (2, PRC + "消费者权益保护法", "实施依据")


def test_search_forms_agree(spark):
    texts = spark.createDataFrame([(1, "合同解除后的Damage"), (2, "解除合同"), (3, "违约合同解除与合同解除"), (4, "")], ["k", "t"])
    terms = spark.createDataFrame([("合同解除",), ("damage",), ("合同",), ("约",), ("没有的词",)], ["term"])
    want = {(t.term, r.k) for r in texts.collect() for t in terms.collect() if t.term.lower() in r.t.lower()}
    assert {tuple(r) for r in se.match_terms(texts, ["k"], "t", terms, (1, 2, 3)).collect()} == want
    limit = se.BROADCAST_TERMS
    se.BROADCAST_TERMS = 1
    try:
        assert {tuple(r) for r in se.match_terms(texts, ["k"], "t", terms, (1, 2, 3)).collect()} == want
    finally:
        se.BROADCAST_TERMS = limit
    long = terms.filter(F.length("term") >= 3)
    found = se.phrase_match(long, se.build_postings(texts, ["k"], "t"), ["k"])
    assert {tuple(r) for r in found.collect()} == {w for w in want if len(w[0]) >= 3}


def test_widen(spark):
    rows = spark.createDataFrame([(1, i) for i in range(3)] + [(2, i) for i in range(4)], "q_id bigint, law_id bigint")
    wide = spark.createDataFrame([(q, 100) for q in (1, 2, 3)], "q_id bigint, law_id bigint")
    got = {tuple(r) for r in se.widen_if_sparse(rows, wide, wide.select("q_id")).collect()}
    assert got == {(1, 100), (3, 100)} | {(2, i) for i in range(4)}


def test_readers_and_sinks(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    statute = {"law_id": 5, "title": "某法", "parts": [{"title": "第一编　总则", "order_index": 1, "global_order": 1, "chapters": [
        {"title": "_DIRECT_第一编　总则", "order_index": 1, "global_order": 2, "articles": [{"title": "第一条　", "content": "第一条　甲", "order_index": 1, "global_order": 3}]},
        {"title": "第一章　乙", "order_index": 2, "global_order": 4, "sections": [{"title": "第一节　丙", "order_index": 1, "global_order": 5, "articles": [
            {"title": "第二条", "content": "第二条　丁", "order_index": 1, "global_order": 6}]}]}]}]}
    (docs / "某法_20200101.json").write_text(json.dumps(statute, ensure_ascii=False))
    (docs / "plain.json").write_text(json.dumps({"law_id": 6, "title": "通知", "full_text": "全文"}, ensure_ascii=False))
    (docs / "law_index.json").write_text("{}")
    (docs / "broken.json").write_text("{not json")
    read = readers.read_statutes(spark, str(docs))
    assert {r.stem for r in read.select("stem").collect()} == {"某法_20200101", "plain"}
    nodes = {(r.law_id, r.type, r.global_order, r.part_num, r.chapter_num, r.section_num, r.article_num) for r in readers.flatten(read).collect()}
    assert nodes == {
        (5, "part", 1, 1, None, None, None), (5, "article", 3, 1, None, None, 1), (5, "chapter", 4, 1, 2, None, None),
        (5, "section", 5, 1, 2, 1, None), (5, "article", 6, 1, 2, 1, 2), (6, "article", 1, None, None, None, 1)}
    assert readers.law_rows(read).filter("id = 5").first()["version_date"] == "2020-01-01"
    gz = tmp_path / "gz"
    gz.mkdir()
    (gz / "a.json").write_text(json.dumps({"title": "案", "content": "x"}, ensure_ascii=False))
    assert readers.read_gazette(spark, {"al": str(gz)}).first()["doc_key"] == "al/a"
    tr = tmp_path / "tr"
    tr.mkdir()
    (tr / "a.json").write_text(json.dumps({"law_id": 5, "title_en": "T", "articles": [{"article_number": "第一条", "content_en": "One"}], "doc_key": "al/a"}, ensure_ascii=False))
    assert readers.read_translations(spark, str(tr)).first()["content_en"] == "One"
    assert readers.read_gazette_translations(spark, str(tr)).first()["doc_key"] == "al/a"
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "l.txt").write_text("　甲 \n\n乙")
    assert [(r.doc, r.line_no, r.text) for r in readers.read_lines(spark, str(tmp_path / "t")).orderBy("line_no").collect()] == [("l", 0, "甲"), ("l", 2, "乙")]
    lines = spark.createDataFrame([("g", 1, "a"), ("g", 2, "b")], ["menu_group", "global_order", "line"])
    sinks.write_rendered(lines, str(tmp_path / "out"), ["menu_group"], ["global_order"])
    assert {r.value for r in spark.read.text(str(tmp_path / "out")).collect()} == {"a", "b"}


def test_labelled_segments_keep_what_stands_before_a_label(spark):
    from statutelake.operators import citations as cit

    text = "第一条　参照合同甲法第二十条，《乙法》第三条，丙第四条\n又依 合同甲法第五条第六条"
    rows = spark.createDataFrame([(1, text), (2, None), (3, "没有")], "id long, content string")
    found = rows.select("id", F.explode(cit.labelled_segments(F.col("content"), 4)).alias("m")).collect()
    assert [(x["id"], x["m"]) for x in found] == [(1, "照合同甲法第二十条"), (1, "，丙第四条"), (1, " 合同甲法第五条")]
    titles = spark.createDataFrame([("合同甲法", "中华人民共和国合同甲法")], "short string, full string")
    plan = cit.match_short(rows.limit(0).selectExpr("id", "0 AS pos", "content AS raw_text"), ["id"], titles, [4])._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
    short = cit.cite_short(rows, ["id"], titles).collect()
    assert sorted((x["raw_text"], x["to_title"], x["to_label"]) for x in short) == [(f"合同甲法{n}", "中华人民共和国合同甲法", n) for n in ("第二十条", "第五条")]

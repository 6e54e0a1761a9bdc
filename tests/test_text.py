import pytest
from pyspark.sql import functions as F

from statutelake.functions import numerals as num
from statutelake.functions import text as tx
from statutelake.operators import documents as doc
from statutelake.operators import structure as st

X = lambda: F.col("x")


@pytest.mark.parametrize("text,value", [("一百零五", 105), ("十四", 14), ("三百五十", 350), ("二十", 20), ("两百", 200), ("X", None), ("", None), ("一千零五", 1005)])
def test_numeral(one, text, value):
    assert one(num.numeral_to_int(X()), x=text) == value


@pytest.mark.parametrize("text,value", [("第四十四条", 44), ("一、", 1), ("12.", 12), ("第三条_2", 3), ("第7条", 7), ("总则", None)])
def test_label(one, text, value):
    assert one(num.label_to_int(X()), x=text) == value


def test_numeral_round_trip(spark):
    df = spark.range(1, 10000).withColumn("t", num.int_to_numeral(F.col("id")))
    assert df.filter(num.numeral_to_int(F.col("t")) != F.col("id")).count() == 0
    assert [r.t for r in df.filter("id IN (14, 105, 110)").orderBy("id").collect()] == ["十四", "一百零五", "一百一十"]


def test_titles_and_cleanup(one):
    assert one(tx.normalize_title(X()), x="最高人民法院 最高人民检察院关于X") == "最高人民法院、最高人民检察院关于X"
    assert one(tx.stem_date(X()), x="中华人民共和国民法典_20200528") == "2020-05-28"
    assert one(tx.stem_title(X()), x="中华人民共和国民法典_20200528") == "中华人民共和国民法典"
    assert one(tx.clean_article(X()), x="－PAGE  2－") == ""
    assert one(tx.clean_article(X()), x="l月") == "1月"
    assert one(tx.clean_article(X()), x="共l月") == "共l月"
    assert one(tx.english_punctuation(X()), x="（一）、（二）") == "(一), (二)"
    assert one(tx.english_punctuation(X()), x="甲。\n乙；") == "甲.\n乙;"
    assert one(tx.clean_text(X()), x="  a \n\n\n 　b   c\n d") == "a\nb c\nd"
    assert one(tx.break_lists(X()), x="Items: (1) a; (2) b; or (3) c") == "Items:\n(1) a;\n(2) b\n(3) c"
    assert one(tx.fix_labels(X()), x="第二十五 条甲\n第三条增加一款") == "第二十五条　甲\n第三条增加一款"


def test_ngrams(one):
    assert one(tx.ngrams(X(), 3), x="甲乙😀丁") == ["甲乙😀", "乙😀丁"]
    assert one(tx.ngrams(X(), 3), x="甲乙") == []
    assert one(tx.windows(X(), 3), x="abcd") == ["abc", "bcd", "cd", "d"]
    assert one(tx.windows(X(), 3, ["b", "d"]), x="abcd") == ["bcd", "d"]


def test_case_fields(one):
    assert one(tx.marked_keywords(X()), x="【关键词】民事/合同\n…") == "民事/合同"
    assert one(tx.marked_keywords(X()), x="案由\n关键词　民事/合同\n") == "民事、合同"
    assert one(tx.case_number(X()), x="指导性案例212号：…") == "指导性案例212号"
    assert one(tx.ruling_gist(X()), x="【裁判要点】 甲乙\n\n基本案情") == "甲乙"
    assert one(tx.ruling_gist(X()), x="a\n裁判摘要\n甲\n丙\n\n基本案情") == "甲\n丙"


def test_effective_dates(one):
    assert one(tx.arabic_effective_date(X()), x="自2021年1月1日起施行") == "2021-01-01"
    assert one(tx.numeral_effective_date(X()), x="自二〇二一年十二月二十日起施行") == "2021-12-20"
    assert one(tx.since_publication_date(X()), x="2001年2月3日通过，2001年3月4日公布，自公布之日起施行") == "2001-03-04"


def test_own_publication_date(spark):
    docs = spark.createDataFrame([(1, "2001-02-03", "")], "id bigint, pub_date string, promulgation_info string")
    arts = spark.createDataFrame([(1, 5, "本法自公布之日起施行。")], "law_id bigint, global_order bigint, content string")
    assert doc.effective_date(docs, arts).first()["effective_date"] == "2001-02-03"


def test_split_inline(one):
    assert one(st.split_inline(X()), x="第一条　a\n第二条　b") == ["第一条　a", "第二条　b"]
    assert one(st.split_inline(X()), x="第一条　a\n第九条　b") == ["第一条　a\n第九条　b"]


def test_chunks_against_loop(spark):
    lines = ["x" * n for n in (3, 9, 2, 2, 20, 1, 4, 0, 5)]
    rows = doc.chunk_text(spark.createDataFrame([(1, "\n".join(lines))], ["id", "text"]), "id", "text", 10).orderBy("chunk").collect()
    want, current, used = [], [], 0
    for line in lines:
        if current and used + len(line) + 1 > 10:
            want.append("\n".join(current))
            current, used = [], 0
        current.append(line)
        used += len(line) + 1
    want.append("\n".join(current))
    assert [r.text for r in rows] == want


def test_align(one):
    zh, en = F.col("zh"), F.col("en")
    assert one(doc.align_paragraphs(zh, en), zh="第一条　甲\n乙", en="Article 1 One sentence that is quite long enough to stand alone here. Two.") == (
        "Article 1 One sentence that is quite long enough to stand alone here.\nTwo.")
    assert one(doc.align_paragraphs(zh, en), zh="第一条　甲", en="One. Two.") is None


def test_page_text(one):
    html = "<p>A&amp;B</p><script>var x='<p>';</script><div>C<br/>D</div><!-- no -->"
    assert one(doc.page_text(X()), x=html) == "A&B\nC\nD"


def test_segment_tree(spark):
    text = "某法\n目录\n第一章　总则\n第二章　分则\n第一节　甲\n第一章　总则\n第一条　a\n续a\n第二章　分则\n第一节　甲\n第二条　b\n第三条　c".split("\n")
    rows = [(1, i, t) for i, t in enumerate(text)] + [(2, i, t) for i, t in enumerate(["标题", "一、甲", "说明", "二、乙"])] + [(3, 0, "无结构")]
    lines = spark.createDataFrame(rows, "doc bigint, line_no bigint, text string")
    for span in (2, 5, 1000):
        seg = st.segment(lines, span)
        got = [(r.doc, r.label, r.content, r.chapter_line, r.section_line) for r in seg.orderBy("doc", "article_line").collect()]
        assert got == [
            (1, "第一条", "第一条　a\n续a", 5, None), (1, "第二条", "第二条　b", 8, 9), (1, "第三条", "第三条　c", 8, 9),
            (2, "一、", "一、甲\n说明", None, None), (2, "二、", "二、乙", None, None),
        ]
        nodes = st.number_nodes(seg, span).filter("doc = 1").orderBy("line_no").collect()
        assert [(n.type, n.global_order, n.order_index) for n in nodes] == [
            ("chapter", 1, 1), ("article", 2, 1), ("chapter", 3, 2), ("section", 4, 1), ("article", 5, 1), ("article", 6, 2)]
        assert [r.doc for r in st.whole_text_fallback(lines, seg).collect()] == [3]


def test_render(spark):
    nodes = spark.createDataFrame([(1, 1, "chapter", "第一章　总则", None, None), (1, 2, "article", "第一条　依照《甲法》第二条、《甲法》第二条之规定\n乙", "Article 1 Text.", 1)],
                                  "law_id bigint, global_order bigint, type string, content string, content_en string, article_num int")
    laws = spark.createDataFrame([(1, "某法", "法律", "", "国务院", "", "2020-01-01", "", "公布")],
                                 "id bigint, title string, category string, legal_domain string, issuing_org string, doc_number string, pub_date string, effective_date string, promulgation_info string")
    edges = spark.createDataFrame([(1, 2, 9, 2, "cross_law", 1, "《甲法》第二条")],
                                  "from_law_id bigint, from_order bigint, to_law_id bigint, to_article_num int, ref_type string, resolved int, raw_text string")
    lines = [r.line for r in doc.render_laws(nodes, laws, edges).orderBy("global_order").collect()]
    link = "[《甲法》第二条](law-9#art-2)"
    assert lines == [
        "# 某法\n\n**分类**：法律  \n**发布机关**：国务院  \n**公布日期**：2020-01-01\n\n> 公布\n\n---",
        "### 第一章　总则",
        f'<a id="art-1"></a>第一条　依照{link}、{link}之规定  \n乙\n\n**Article 1** Text.',
    ]

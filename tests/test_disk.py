"""What jobs write on the way: shuffles, tables, and the texts in them."""

import re
import time

from statutelake.operators import citations as cit
from statutelake.operators import documents as doc
from statutelake.operators import lineage
from statutelake.operators import quality as qa
from statutelake.operators import structure as st
from statutelake.operators.ordered import lag_by_segment, large_keys
from statutelake.plans import corpus, load_all
from statutelake.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
load_all()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before, setting = _shuffles(spark), spark.conf.get(lineage.CLEANUP, None)
    rows = lineage.materialize(spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").sum("id"))
    for _ in range(50):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffles(spark) - before and rows.count() == 7 and spark.conf.get(lineage.CLEANUP, None) == setting


def test_step_keeps_its_result_only(spark):
    before = lineage.paths()
    out = lineage.step(lambda: lineage.materialize(spark.range(3)).union(lineage.step(lambda: lineage.materialize(spark.range(4)))))
    assert len(lineage.paths() - before) == 1 and out.count() == 7


def test_edges_leave_two_tables_and_the_short_titles(spark):
    before = lineage.paths()
    cit.build_citations(corpus.articles(spark, SF), corpus.laws(spark, SF))
    assert len(lineage.paths() - before) == 3


EDGES = "from_law_id bigint, from_order bigint, to_law_id bigint, to_order bigint, ref_type string, resolved int"


def test_both_ends_from_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [(1, 10, 2, 20, "cross_law", 1), (1, 10, None, None, "cross_law", 0), (3, 30, 1, 11, "cross_law", 1)]

    def read(batches):
        seen.add(1)
        yield from batches

    edges = spark.createDataFrame(rows, EDGES).coalesce(1).mapInArrow(read, EDGES)
    got = sorted(tuple(r) for r in cit.citation_degree(edges).collect())
    assert got == [(1, 2, 1, 1, 50.0), (2, 0, 0, 1, None), (3, 1, 1, 0, 100.0)] and seen.value == 1
    nodes = spark.createDataFrame([(1, 10), (2, 20)], "law_id bigint, global_order bigint")
    lost = sorted(tuple(r) for r in qa.edge_integrity(edges, nodes).collect())
    assert lost == [(1, 11, "to_order"), (3, 30, "from_order")] and seen.value == 2


def test_structure_issues_move_no_text(spark):
    plan = _plan(QUERIES["l2_structure_issues"](spark, SF))
    assert "当事人应当在" not in plan and "总则" not in plan


def test_lag_over_large_and_small_keys(spark):
    rows = spark.range(60).selectExpr("IF(id < 50, id div 25 * 5, IF(id < 55, NULL, id)) AS k", "id * 3 AS o", "id AS v")
    large = large_keys(rows, ["k"], 20)
    assert sorted(x["k"] for x in large.collect()) == [0, 5] and large_keys(rows, ["k"], 50) is None
    got = lag_by_segment(rows, ["k"], "o", ["v"], 7, large=large)
    want = lag_by_segment(rows, ["k"], "o", ["v"], 7)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 60


def test_segment_moves_texts_once(spark):
    plan = st.segment(corpus.law_lines(spark, SF), corpus.SEGMENT)._jdf.queryExecution().executedPlan().toString()
    # By document once; headings besides, by their titles.
    assert len(re.findall(r"Exchange hashpartitioning\(doc#\d+L, \d+\)", plan)) == 1 and not re.search(r"Exchange hashpartitioning\([^)]*(article_line|_seg)", plan)


LINES = {
    1: ["目录", "第一章 总则", "第二章 附则", "第一章 总则", "第一条 甲", "（一）乙", "第一节 丙", "第二条 丁", "一、戊", "第二章 附则", "第三条 己"],
    2: ["前言", "一、甲", "乙", "二、丙", "第一章 丁", "戊", "三、己"],
    3: ["目录", "第一章 甲", "乙", "第一条 丙", "第一章 甲", "第二条 丁"],
}


def test_segment_of_large_and_small_documents(spark):
    rows = [(d, i * 10, t) for d, texts in LINES.items() for i, t in enumerate(texts)]
    lines = spark.createDataFrame(rows, "doc bigint, line_no bigint, text string")
    results = [sorted(tuple(r) for r in st.segment(lines, span, large_rows=n).collect()) for span, n in ((1 << 30, 100), (20, 3), (35, 6))]
    assert results[0] == results[1] == results[2]
    assert [(r[0], r[1], r[5], r[6]) for r in results[0]] == [
        (1, 40, "第一条", "第一条 甲\n（一）乙"), (1, 70, "第二条", "第二条 丁\n一、戊"), (1, 100, "第三条", "第三条 己"),
        (2, 10, "一、", "一、甲\n乙"), (2, 30, "二、", "二、丙"), (2, 60, "三、", "三、己"),
        (3, 30, "第一条", "第一条 丙"), (3, 50, "第二条", "第二条 丁"),
    ]


def test_places_with_several_numbers_get_the_marks_of_their_own(spark):
    laws = corpus.laws(spark, SF).filter("id < 2")
    nodes = corpus.nodes(spark, SF).select("law_id", "type", "article_num", "content", "content_en", "global_order").limit(0).unionByName(
        spark.createDataFrame([(0, "article", 1, "甲", None, 5), (0, "article", 2, "乙", None, 5), (0, "article", 2, "丙", None, 6)],
                              "law_id bigint, type string, article_num int, content string, content_en string, global_order bigint"))
    edges = spark.createDataFrame([(1, 9, 3, 0, 6, 2, "cross_law", 1, "《X》第二条")],
                                  "from_law_id bigint, from_order bigint, from_article_num int, to_law_id bigint, to_order bigint, to_article_num int, ref_type string, resolved int, raw_text string")
    places = spark.createDataFrame([], "id bigint, menu_group string, subgroup string")
    found = doc.render_pages(nodes, laws, edges, places).filter("global_order >= 0")
    lines = sorted(r["line"] for r in found.collect())
    assert [("<sup>[1]</sup>" in x) for x in lines] == [False, True, True] and _plan(found).count("当事人应当在") <= 1

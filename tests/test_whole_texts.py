"""Whole texts are read by default; the old lengths are parameters."""

from pyspark.sql import functions as F

from statutelake.functions import text as tx
from statutelake.operators import classify as cl
from statutelake.operators import documents as doc
from statutelake.operators import relational as rel


def test_links_behind_the_opening(spark):
    rows = [
        (1, "公司法", "法律", "2000-01-01", ""), (2, "某条例", "行政法规", "2000-01-01", "字" * 600 + "《公司法》"),
        (3, "中外合资企业法", "法律", "2000-01-01", ""), (4, "另一条例", "行政法规", "2000-01-01", "字" * 1100 + "《中外合资企业法》"),
    ]
    laws = spark.createDataFrame(rows, "id long, title string, category string, pub_date string, full_text string")
    assert sorted((r["child_id"], r["parent"]) for r in cl.hierarchy_links(laws).collect()) == [(2, "公司法"), (4, "中外合资企业法")]
    assert cl.hierarchy_links(laws, opening=500).count() == 0
    assert [(r["from_id"], r["to_title"]) for r in cl.relations(laws).collect()] == [(4, "中外合资企业法")]
    assert cl.relations(laws, opening=1000).count() == 0


def test_long_gists_and_keywords(spark, one):
    x = F.col("x")
    gist, words = "点" * 700, "、".join(f"词{i}" for i in range(100))
    assert one(tx.ruling_gist(x), x=f"【裁判要点】{gist}\n\n基本案情") == gist
    assert one(tx.ruling_gist(x, 500), x=f"【裁判要点】{gist}\n\n基本案情") == gist[:500]
    for text in (f"【关键词】{words}\n", f"关键词\n{words}\n", f"关键词　{words}\n"):
        assert one(tx.marked_keywords(x), x=text) == words
    assert one(tx.marked_keywords(x, 200), x=f"关键词\n{words}\n") == words[:200]
    late = "字" * 900 + "盗窃"
    assert one(tx.inferred_keywords(F.lit("案"), F.lit(""), x), x=late) == "盗窃"
    assert one(tx.inferred_keywords(F.lit("案"), F.lit(""), x, opening=800), x=late) == ""
    docs = spark.createDataFrame([("k", "案", "", "", late)], "doc_key string, title string, ruling_gist string, keywords string, full_text string")
    assert doc.enrich_docs(docs).first()["keywords"] == "盗窃"


def test_all_latin_fragments(spark):
    nodes = spark.createDataFrame([(1, 1, "第一条", "article", "a b c d e f g")], "law_id long, global_order long, article_number string, type string, content string")
    laws = spark.createDataFrame([(1, "法")], "id long, title string")
    assert rel.latin_fragments(nodes, laws)[1].first()["fragments"] == "a b c d e f g"
    assert rel.latin_fragments(nodes, laws, most=5)[1].first()["fragments"] == "a b c d e"

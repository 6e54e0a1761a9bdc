"""Menu places (F5), citation deltas (L14), pages (G19), layers (I17), file manifests (M1), damaged files (A2)."""

import random
from collections import Counter

from pyspark.sql import functions as F

from statutelake.functions import rules as r
from statutelake.operators import classify as cl
from statutelake.operators import documents as doc
from statutelake.operators import quality as qa
from statutelake.operators import search as se
from statutelake.operators.lineage import new_path
from statutelake.sources import manifest as man
from statutelake.sources import readers, schemas


def test_menu_places_follow_the_lists(spark):
    rows = [("刑事", s) for s in ("无名", "贪污贿赂", "行政法规/丁", "行政法规/金融证券", "行政法规/税务财政", "刑法及修正案", "甲")] + [("未知组", ""), ("民事与商事", "保险"), ("民事与商事", "保险")]
    got = {(x["menu_group"], x["subgroup"]): (x["group_place"], x["place"]) for x in cl.menu_places(spark.createDataFrame(rows, "menu_group string, subgroup string"), cl.order_table(spark)).collect()}
    crime = sorted((p[1], s) for (g, s), p in got.items() if g == "刑事")
    assert [s for _, s in crime] == ["刑法及修正案", "贪污贿赂", "行政法规/税务财政", "行政法规/金融证券", "行政法规/丁", "无名", "甲"]
    assert [got[g][0] for g in (("民事与商事", "保险"), ("刑事", "甲"), ("未知组", ""))] == [1, 2, 3] and len(got) == 9
    assert r.GROUP_ORDER.index("民事与商事") < r.GROUP_ORDER.index("刑事")


def test_edge_deltas_are_differences_of_multisets(spark):
    rng = random.Random(1)

    def run():
        return [(rng.choice("abc"), rng.choice(["x", "y"]), rng.randint(0, 1)) for _ in range(80)]

    before, after = run(), run() + [("new", "x", 1)]
    schema, keys = "raw string, ref_type string, resolved int", ["raw", "ref_type"]
    deltas = qa.edge_deltas(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), keys)
    want = Counter()
    n0, n1 = Counter(e[:2] for e in before), Counter(e[:2] for e in after)
    r0, r1 = Counter(e[:2] for e in before if e[2]), Counter(e[:2] for e in after if e[2])
    for k in n0 | n1:
        for kind, n in (("kept", min(n0[k], n1[k])), ("lost", n0[k] - n1[k]), ("won", n1[k] - n0[k]), ("resolved", r1[k] - r0[k]), ("unresolved", r0[k] - r1[k])):
            want[k[1], kind] += max(n, 0)
    assert {(x["ref_type"], x["kind"]): x["n"] for x in deltas.collect()} == {k: n for k, n in want.items() if n}
    totals = {x["item"]: x["change"] for x in qa.edge_totals(deltas).collect()}
    assert totals["total"] == len(after) - len(before) and totals["resolved"] == sum(e[2] for e in after) - sum(e[2] for e in before)
    for kind in "xy":
        assert totals.get(kind, 0) == sum(e[1] == kind for e in after) - sum(e[1] == kind for e in before)
    none = spark.createDataFrame([], schema)
    assert qa.edge_deltas(none, none, keys).collect() == []


EDGE = "from_law_id long, from_order long, from_article_num int, to_law_id long, to_article_num int, ref_type string, resolved int, raw_text string"
LAW = "id long, title string, category string, legal_domain string, issuing_org string, doc_number string, pub_date string, effective_date string, promulgation_info string"


def test_pages_link_each_other(spark):
    laws = spark.createDataFrame([(1, "甲法", "法律", None, None, None, "2020-01-01", None, "通过"), (2, "乙法", "法律", None, None, None, None, None, "通过"), (3, "丙法", "法律", None, None, None, None, None, "通过")], LAW)
    places = spark.createDataFrame([(1, "刑事", "行政法规/税务"), (2, "其他", "")], "id long, menu_group string, subgroup string")
    edges = spark.createDataFrame([
        (2, 20, 5, 1, 7, "cross_law", 1, "《甲法》第七条"), (3, 30, 1, 1, 7, "cross_law", 1, "甲法第七条"), (2, 21, 6, 1, 7, "cross_law", 1, "《甲法》第七条"),
        (1, 10, 7, 1, 8, "self_ref", 1, "第八条"), (1, 10, 7, 2, 5, "cross_law", 1, "《乙法》第五条"), (2, 22, 8, 1, 9, "cross_law", 0, "无")], EDGE)
    paths = {x["law_id"]: (x["path"], x["up"]) for x in doc.law_paths(laws, places).collect()}
    assert paths == {1: ("刑事/行政法规/税务/甲法.md", "../../../"), 2: ("其他/乙法.md", "../")}
    cited = {(x["law_id"], x["article_num"]): (x["n"], x["marks"]) for x in doc.cited_by(edges, laws, doc.law_paths(laws, places), 2).collect()}
    first = '<sup><a href="../../../其他/乙法.md#art-5" title="被《乙法》第5条引用">[1]</a></sup>'
    assert cited[1, 7][0] == 3 and cited[1, 7][1] == f"&thinsp;{first}&thinsp;" + first.replace("#art-5", "#art-6").replace("第5条", "第6条").replace("[1]", "[2]")
    third = doc.cited_by(edges, laws, doc.law_paths(laws, places)).filter("article_num = 7").first()["marks"]
    assert third.endswith("&thinsp;<sup>[3]</sup>") and set(cited) == {(1, 7), (2, 5)}
    nodes = spark.createDataFrame([
        (1, 9, "chapter", "第一章", None, None), (1, 10, "article", "　依《乙法》第五条和第八条", None, 7), (2, 20, "article", "见《甲法》第七条", "Article 5 See it.", 5)],
        "law_id long, global_order long, type string, content string, content_en string, article_num int")
    lines = {(x["law_id"], x["global_order"]): x["line"] for x in doc.render_pages(nodes, laws, edges, places).collect()}
    assert lines[1, 9] == "### 第一章" and lines[1, 10].startswith('<a id="art-7"></a>依[《乙法》第五条](../../../其他/乙法.md#art-5)和[第八条](#art-8)&thinsp;<sup>')
    assert lines[2, 20] == '<a id="art-5"></a>见[《甲法》第七条](../刑事/行政法规/税务/甲法.md#art-7)&thinsp;<sup><a href="../刑事/行政法规/税务/甲法.md#art-7" title="被《甲法》第7条引用">[1]</a></sup>\n\n**Article 5** See it.'


def test_the_third_layer_looks_where_the_first_one_points(spark):
    laws = spark.createDataFrame([
        (1, "甲乙法", "法律", "民", 1, "2020", ""), (2, "关于适用甲乙法的解释", "司法解释", "他", 1, "2021", ""), (3, "别的解释", "司法解释", "民", 1, "2022", ""), (4, "旧甲乙法解释", "司法解释", "他", 0, "2023", "")],
        "id long, title string, category string, legal_domain string, is_current int, pub_date string, promulgation_info string")
    nodes = spark.createDataFrame([(1, 1, "chapter", "责任", 1, None), (1, 2, "article", "x", 1, None), (1, 3, "article", "x", 2, None), (2, 1, "article", "x", None, None), (3, 1, "article", "x", None, None), (4, 1, "article", "x", None, None)],
                                  "law_id long, global_order long, type string, content string, chapter_num int, section_num int")
    hits = spark.createDataFrame([("t", 1, 2), ("t", 1, 3), ("t", 2, 1), ("t", 3, 1), ("t", 4, 1), ("late", 2, 1)], "term string, law_id long, global_order long")
    primary = spark.createDataFrame([("q", "甲乙法", ["责任"])], "q_id string, law_title string, words array<string>")
    domains = spark.createDataFrame([("q", "民")], "q_id string, legal_domain string")
    terms = spark.createDataFrame([("q", 0, "t"), ("q", 3, "late")], "q_id string, pos int, term string")
    got = {(x["law_id"], x["global_order"]): (x["layer"], x["pinned"]) for x in se.retrieve_chain(primary, domains, terms, nodes, laws, hits).collect()}
    assert got == {(1, 2): (0, 1), (1, 3): (1, 0), (3, 1): (3, 0), (2, 1): (4, 0)}
    # Without the first three terms the third layer is empty.
    assert (2, 1) not in {(x["law_id"], x["global_order"]) for x in se.retrieve_chain(primary, domains, terms.filter("pos = 3"), nodes, laws, hits).collect()}


def test_only_changed_files_are_hashed_again(spark, monkeypatch):
    path = new_path(spark, "files")
    spark.range(6).select(F.col("id").alias("name"), F.concat(F.lit("text "), "id").alias("value")).repartition("name").write.partitionBy("name").text(path)
    kind = man.MANIFEST
    first = man.refresh(spark, path, spark.createDataFrame([], kind), "*.txt").collect()
    assert len(first) == 6 and all(x["md5"] for x in first)
    opened = []
    hash_files = man.hash_files
    monkeypatch.setattr(man, "hash_files", lambda s, paths: opened.extend(x["path"] for x in paths.select("path").collect()) or hash_files(s, paths))
    old = spark.createDataFrame([tuple(x) for x in first if "name=5" not in x["path"]], kind)
    now = man.refresh(spark, path, old, "*.txt").collect()
    assert sorted(map(tuple, now)) == sorted(map(tuple, first)) and len(opened) == 1 and "name=5" in opened[0]
    monkeypatch.setattr(man, "PATHS", 2)
    assert sorted(map(tuple, man.refresh(spark, path, spark.createDataFrame([], kind), "*.txt").collect())) == sorted(map(tuple, first))


def test_damaged_files_are_reported_and_skipped(spark):
    path = new_path(spark, "files")
    texts = {1: '{"law_id": 1, "title": "a"}', 2: '{"law_id": 2, "title": ', 3: "no json", 4: '{"law_id": 4, "title": "d", "year": "text"}', 5: ""}
    spark.createDataFrame(list(texts.items()), "name int, value string").repartition("name").write.partitionBy("name").text(path)
    damaged = readers.read_damaged(spark, path, schemas.GAZETTE, "*.txt").collect()
    assert {x["file"].split("name=")[1][0] for x in damaged} >= {"2", "3"} and not {"1", "4"} & {x["file"].split("name=")[1][0] for x in damaged}
    assert {x["law_id"] for x in readers.read_gazette(spark, {"s": path}, "*.txt").collect()} == {1, 4}

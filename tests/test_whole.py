"""Nothing is cut: long and short titles, odd characters, tables of many files."""

import pytest
from pyspark.sql import functions as F

from statutelake.operators import citations as cit
from statutelake.operators import classify as cl
from statutelake.operators import search as se
from statutelake.operators.lineage import new_path, shared_folder
from statutelake.plans import corpus, load_all
from statutelake.streaming import incremental as inc

load_all()
from statutelake.plans import q_streaming  # noqa: E402

LONG = "关于" + "甲乙丙丁戊己庚辛壬癸" * 6 + "办法"


def test_bare_titles_of_any_length_and_with_any_characters(spark):
    titles = spark.createDataFrame(
        [("刑法", "刑法全称"), ("新刑法", "新刑法全称"), (LONG, "长"), ("甲、乙（试行）条例2019", "标点"), ("A B法", "拉丁")], "short string, full string")
    texts = [
        (1, "依照刑法第十条"), (2, f"根据{LONG}第二条和甲、乙（试行）条例2019第三条"), (3, "《刑法》第十条"), (4, "《新刑法第一条"), (5, "x《刑法第一条"),
        (6, "第一条　参照新刑法第五条"), (7, "A B法第九条"), (8, "无"), (9, None), (10, "法第一条")]
    got = {(r["id"], r["to_title"], r["to_label"]) for r in cit.cite_short(
        spark.createDataFrame(texts, "id long, content string"), ["id"], titles).collect()}
    assert got == {(1, "刑法全称", "第十条"), (2, "长", "第二条"), (2, "标点", "第三条"), (4, "刑法全称", "第一条"), (6, "新刑法全称", "第五条"), (7, "拉丁", "第九条")}


def test_fragments_of_any_length(spark):
    laws = spark.createDataFrame([(1, "中华人民共和国刑法", 1), (2, "刑", 1), (3, LONG, 1), (4, "旧刑法", 0)], "id long, title string, is_current int")
    articles = spark.createDataFrame([(i, "第一条", 10 * i) for i in (1, 2, 3, 4)], "law_id long, article_number string, global_order long")
    refs = spark.createDataFrame([("刑法", "第一条"), ("刑", "第一条"), (LONG, "第一条"), ("", "第一条"), ("无", "第一条")], "fragment string, label string")
    got = {(r["fragment"], r["law_id"]) for r in cit.find_by_fragment(refs, laws, articles).collect()}
    assert got == {("刑法", 1), ("刑", 1), (LONG, 3)}


def test_fragment_keys_are_rare(spark):
    """Full titles with one beginning do not meet on it."""
    titles = spark.createDataFrame([(f"中华人民共和国第{i}号法",) for i in range(300)], "title string")
    lengths = titles.select(F.length("title").alias("size")).distinct()
    keys = cit.substrings(titles, "title", lengths, "key").join(titles.select(F.col("title").alias("key")), "key")
    assert keys.groupBy("key").count().agg(F.max("count")).first()[0] <= 3


def test_interpretations_of_short_titles(spark):
    laws = spark.createDataFrame(
        [(1, "关于适用刑法的解释", "司法解释", 1, "2020-01-01", ""), (2, "关于公司登记的解释", "司法解释", 1, "2021-01-01", "根据公司法制定"), (3, "刑法", "法律", 1, "2019-01-01", "")],
        "id long, title string, category string, is_current int, pub_date string, promulgation_info string")
    titles = spark.createDataFrame([("刑法",), ("公司法",), ("关于适用刑法的其他",)], "title string")
    got = {(r["title"], r["id"]) for r in se.interpretations_for(laws, titles, 5).collect()}
    assert got == {("刑法", 1), ("公司法", 2), ("关于适用刑法的其他", 1)}


def test_exact_domain_without_the_country_prefix(spark):
    laws = spark.createDataFrame([(1, "中华人民共和国甲事法", "法律"), (2, "甲事法", "法律"), (3, "中华人民共和国乙事法", "法律")], "id long, title string, category string")
    exact = spark.createDataFrame([("甲事法", "短"), ("中华人民共和国乙事法", "全"), ("乙事法", "不用")], "title string, domain string")
    got = {r["id"]: r["domain"] for r in cl.classify_domain(laws, exact).collect()}
    assert got == {1: "短", 2: "短", 3: "全"}


@pytest.fixture(scope="module")
def folders(spark):
    """The smallest tables as folders of four files."""
    out = new_path(spark, "folders")
    for name in ("events", "orders", "part"):
        corpus.table(spark, "/root/testdata/sf0.001", name).repartition(4).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize("name", ["m2", "m3_stream", "m4_stream", "m5_stream"])
def test_streams_over_folders_and_many_batches(spark, folders, monkeypatch, name):
    fn = getattr(q_streaming, name)
    want = sorted(map(str, fn(spark, "/root/testdata/sf0.001").collect()))
    plain = inc.read_stream
    monkeypatch.setattr(inc, "read_stream", lambda s, path, schema, files=100: plain(s, path, schema, 1))
    assert sorted(map(str, fn(spark, folders).collect())) == want


def test_ids_over_many_batches(spark, folders, monkeypatch):
    plain = inc.read_stream
    monkeypatch.setattr(inc, "read_stream", lambda s, path, schema, files=100: plain(s, path, schema, 1))
    rows = q_streaming.m6_stream(spark, folders).collect()
    assert len(rows) == len({r["filename"] for r in rows}) == 200
    for category, base in (("a", 0), ("b", 1_000_000_000_000)):
        ids = sorted(r["id"] for r in rows if r["category"] == category)
        assert ids == list(range(base, base + len(ids)))


def test_replayed_batches_change_nothing(spark):
    out = new_path(spark, "replay")
    handle = inc.upsert_handler(out, ["k"], ["v"])
    first = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    second = spark.createDataFrame([(1, "b"), (2, "c"), (3, "d")], "k long, v string")
    for number, batch in ((0, first), (1, second), (1, second), (0, first)):
        handle(batch, number)
    target = spark.createDataFrame([(1, None), (2, ""), (3, "own"), (4, None)], "k long, v string")
    got = {r["k"]: r["v"] for r in inc.filled(target, inc.read_deltas(spark, out, first.schema), ["k"], ["v"]).collect()}
    assert got == {1: "a", 2: "c", 3: "own", 4: None}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_character_references(spark):
    from statutelake.operators import documents as doc

    html = "<p>&#8220;a&#x201d; &ldquo;b&rdquo; &amp;lt; &#38;gt; &#128512; &#x1F600; &#0; &#99999999; x&nbsp;y</p><script>no</script>"
    df = spark.createDataFrame([(1, html), (2, None)], "id long, html string")
    got = {r["id"]: r["t"] for r in df.select("id", doc.page_text(F.col("html")).alias("t")).collect()}
    assert got == {1: "“a” “b” &lt; &gt; 😀 😀  &#99999999; x y", 2: None}


def test_links_with_markup(spark):
    from statutelake.operators import documents as doc

    html = '<ul><a href="/a?x=1&amp;y=2" class="c"><b>One</b> &mdash; two</a><a href="/b"> three </a><abbr href="/c">no</abbr></ul>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [(r["url"], r["title"]) for r in doc.extract_listing(df).orderBy("pos").collect()] == [("/a?x=1&y=2", "One — two"), ("/b", "three")]


def test_menu_groups_all_have_subgroups(spark):
    rows = [
        ("关于办理盗窃案件的解释", "司法解释", "刑法", "侵犯财产"), ("关于适用刑法的解释", "司法解释", "刑法", "刑法及修正案"), ("某批复", "司法解释", "刑法", "检察院"),
        ("某刑法修正案", "修正案", "刑法", "刑法及修正案"), ("教师法", "法律", "行政法", "教育科技"), ("某行政法律", "法律", "行政法", "行政法律"),
        ("国家赔偿解释", "司法解释", "行政法", "国家赔偿"), ("民事诉讼规定", "司法解释", "诉讼与非诉讼程序法", "民事诉讼"), ("某规定", "司法解释", "诉讼与非诉讼程序法", "文书、送达与废止"),
        ("某条例", "行政法规", "刑法", "行政法规/其他")]
    laws = spark.createDataFrame(rows, "title string, category string, legal_domain string, want string")
    assert all(r["subgroup"] == r["want"] for r in cl.menu_path(cl.subject_area(laws)).collect())


def test_latin_words_count_as_written(spark):
    from statutelake.operators import quality as qa

    texts = ["PH值", "pH值", "wifi", "WiFi", "Wi-Fi", "gdp", "于2l月", "于l月", "x5", "ABC"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "law_id long, global_order long, content string")
    got = {texts[r["global_order"]] for r in qa.suspicious_latin(df).collect()}
    assert got == {"PH值", "wifi", "于2l月", "ABC"}


def test_ids_of_one_category_and_one_date(spark):
    """Numbers follow the file name although no window holds the category."""
    from statutelake.operators.identity import assign_ids

    names = [f"{'law' if i % 3 else 'decree of the '}{i * 7919 % 1000:04d}" for i in range(300)]
    docs = spark.createDataFrame([(n, "a", "2020-01-01" if i % 10 else "2019-05-05") for i, n in enumerate(names)], "filename string, category string, pub_date string")
    index = spark.createDataFrame([("old", "a", 104)], "filename string, category string, id long")
    got = {r["filename"]: r["id"] for r in assign_ids(docs, index, {"a": (100, 1000)}).collect()}
    order = sorted(((("2020-01-01" if i % 10 else "2019-05-05"), n) for i, n in enumerate(names)))
    assert [got[n] for _, n in order] == list(range(105, 405))


def test_rows_become_files_in_few_folders_and_are_written_anew(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from statutelake.operators.lineage import new_path
    from statutelake.plans import q_sources

    path = new_path(spark, "files")
    rows = spark.range(1000).selectExpr("id AS name", "concat('甲\n', id) AS text")
    q_sources._files(rows, path)
    q_sources._files(rows.filter("name < 10").selectExpr("name", "concat(text, ' neu') AS text"), path)
    files = [f for f in Path(urlparse(path).path).rglob("*") if f.is_file()]
    assert {f.name: f.read_text() for f in files} == {f"part-{i}.txt": f"甲\n{i}" + (" neu" if i < 10 else "") for i in range(1000)}
    assert len({f.parent for f in files}) <= 256 and spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).count() == 1000

"""Rules as tables: equal to reading each text with each word."""

import random

import pytest
from pyspark.sql import functions as F

from statutelake.functions import rules as r
from statutelake.operators import classify as cl
from statutelake.operators import rule_tables as rt


def test_words_in_text_equal_containment(spark):
    rng = random.Random(1)
    texts = [(i, "".join(rng.choice("甲乙丙丁 a😀") for _ in range(rng.randint(0, 40)))) for i in range(80)] + [(900, None), (901, "")]
    words = {"".join(rng.choice("甲乙丙丁 a😀") for _ in range(rng.randint(1, 6))) for _ in range(200)} | {""}
    got = rt.words_in_text(spark.createDataFrame(texts, "id long, text string"), ["id"], "text", spark.createDataFrame([(w,) for w in words], "word string"))
    assert sorted(map(tuple, got.collect())) == sorted((i, w) for i, t in texts if t for w in words if w and w in t)


def test_classes_by_points_and_order(spark):
    rules = [("first", ["a", "b"]), ("second", ["c", "d", "a"]), ("third", ["xyzw"])]
    table = rt.rule_table(spark, rules, [("q", "third", 5), ("z", "unknown", 9)])
    texts = spark.createDataFrame([(1, "a"), (2, "c d a b"), (3, "c d"), (4, "xyzw a b"), (5, "q a b"), (6, "nothing here? no: e f"), (7, None)], "id long, text string")
    best = {x["id"]: x["target"] for x in rt.best_class(texts, ["id"], "text", table).collect()}
    assert best == {1: "first", 2: "second", 3: "second", 4: "first", 5: "third"}
    first = {x["id"]: x["target"] for x in rt.first_class(texts, ["id"], "text", table).collect()}
    assert first == {1: "first", 2: "first", 3: "second", 4: "first", 5: "first"}
    assert rt.best_class(texts, ["id"], "text", table.limit(0)).collect() == []


def test_tables_equal_literal_rules(spark):
    rng = random.Random(2)
    words = [w for rules in (r.DOMAIN_RULES, r.SUBJECT_RULES, r.TAXONOMY_RULES) for _, ws in rules for w in ws] + [s for s, _, _ in r.STRONG_SIGNALS]
    rows = [(i, "".join(rng.sample(words, rng.randint(0, 4))), rng.choice(["行政法规", "司法解释", "法律", None]), "".join(rng.sample(words, rng.randint(0, 9)))) for i in range(300)]
    laws = spark.createDataFrame(rows, "id long, title string, category string, full_text string")
    defaults = spark.createDataFrame(list(r.DOMAIN_DEFAULTS.items()), "category string, domain string")

    def same(a, b, column):
        return {x["id"]: x[column] for x in a.collect()} == {x["id"]: x[column] for x in b.collect()}

    assert same(rt.classify_domain(laws, rt.rule_table(spark, r.DOMAIN_RULES, r.STRONG_SIGNALS), defaults), cl.classify_domain(laws), "domain")
    assert same(rt.subject_area(laws, rt.rule_table(spark, r.SUBJECT_RULES)), cl.subject_area(laws), "subject_area")
    assert same(rt.taxonomy_domain(laws, rt.rule_table(spark, r.TAXONOMY_RULES)), cl.taxonomy_domain(laws), "taxonomy")


def test_a_million_words_are_joined_by_their_grams(spark):
    words = spark.range(1_000_000).select(F.concat(F.lit("w"), F.conv(F.col("id") * 7919, 10, 36)).alias("word"))
    texts = spark.range(2000).select("id", F.concat(F.lit("see w"), F.conv(F.col("id") * 7919, 10, 36), F.lit(" and more")).alias("text"))
    found = rt.words_in_text(texts, ["id"], "text", words)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    own = found.filter(F.col("word") == F.concat(F.lit("w"), F.conv(F.col("id") * 7919, 10, 36)))
    assert own.count() == 2000


@pytest.mark.parametrize("text", [None, "", "无关", "刑法典与合同", "(a|b) 合同.*"])
def test_any_of_is_containment(one, text):
    words = ["合同", "(a|b)", "\\E"]
    got = one(cl.any_of(F.col("t").cast("string"), words), t=text if text is not None else "\0")
    assert got == any(w in (text or "") for w in words)


def test_words_by_grams_equal_words_one_by_one(spark):
    rng = random.Random(3)
    texts = spark.createDataFrame([(i, "".join(rng.choice("甲乙丙 a") for _ in range(rng.randint(0, 30)))) for i in range(60)], "id long, text string")
    words = spark.createDataFrame([("".join(rng.choice("甲乙丙 a") for _ in range(rng.randint(1, 5))),) for _ in range(90)], "word string")
    one_by_one, by_grams = (rt.words_in_text(texts, ["id"], "text", words, few=few) for few in (1000, 3))
    assert sorted(map(tuple, one_by_one.collect())) == sorted(map(tuple, by_grams.collect()))


def test_exploded_grams_are_not_broadcast(spark, tmp_path):
    """The estimate of a compressed file says nothing about what is derived from it."""
    spark.range(20_000).selectExpr("id", "repeat('xyz ', 50) AS text").write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t"))
    words = spark.range(2_000).select(F.concat(F.lit("word"), "id").alias("word"))
    for found in (rt.words_in_text(texts, ["id"], "text", words), rt.words_in_text(texts, ["id"], "text", words.limit(9))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BuildLeft" not in plan
        assert found.count() == 0

"""Work that must not fall to a few tasks, or be done twice, as tables grow."""

from statutelake.operators import citations as cit
from statutelake.operators import classify as cl
from statutelake.operators import search as se
from statutelake.plans import corpus

SF = "/root/testdata/sf0.001"


def test_laws_use_all_cores(spark):
    assert corpus.laws(spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_equal_classes_are_dropped_after_counting(spark):
    found = cl.classification_diff(cl.classify_domain(corpus.laws(spark, SF)), "legal_domain", "domain")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan[plan.index("Aggregate"):]
    assert all(x["from_domain"] != x["to_domain"] and x["n"] > 0 for x in found.collect())


def test_scores_are_written_once(spark):
    plan = cl.taxonomy_domain(corpus.laws(spark, SF)).select("taxonomy")._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_max(") == 1


def test_best_match_without_points_and_with_equal_points(spark):
    rows = spark.createDataFrame([("x",), ("ab",), ("b",), (None,)], "t string")
    got = [x[0] for x in rows.select(cl.best_match([(n, cl.hits(rows["t"], [n])) for n in ("a", "b")])).collect()]
    assert got == [None, "a", "b", None]


def _joined(df):
    """Rows that the largest join of the finished plan gave."""
    df.collect()
    plan, rows = [df._jdf.queryExecution().executedPlan()], [0]
    while plan:
        node = plan.pop()
        inner = {"AdaptiveSparkPlanExec": "executedPlan", "ShuffleQueryStageExec": "plan", "BroadcastQueryStageExec": "plan"}.get(node.getClass().getSimpleName())
        if inner:
            plan.append(getattr(node, inner)())
        if "Join" in node.getClass().getSimpleName():
            rows.append(node.metrics().apply("numOutputRows").value())
        plan.extend(node.children().apply(i) for i in range(node.children().size()))
    return max(rows)


def test_groups_do_not_repeat_all_hits(spark):
    hits = spark.range(400).selectExpr("'t' AS term", "id AS law_id", "0L AS global_order")
    laws = spark.range(400).selectExpr("id", "1 AS is_current", "'法律' AS category", "'d' AS legal_domain")
    terms = spark.range(300).selectExpr("id AS q_id", "0 AS pos", "'t' AS term")
    found = se.search_by_group(terms, hits, laws, terms.selectExpr("q_id", "'d' AS legal_domain"), 3, ["法律"])
    assert _joined(found) <= 300 * 3 and sorted((x["law_id"], x["hit_rank"]) for x in found.filter("q_id = 7").collect()) == [(0, 1), (1, 2), (2, 3)]


def test_titles_and_interpretations_of_one_beginning_are_not_paired(spark):
    laws = spark.range(1, 401).selectExpr(
        "id", "'司法解释' AS category", "1 AS is_current", "concat('关于适用环境保护甲乙', id) AS title", "'' AS promulgation_info", "cast(2000 + id % 20 AS string) AS pub_date")
    titles = spark.range(300).selectExpr("concat('环境保护甲乙丙', id) AS title")
    found = se.interpretations_for(laws, titles, 2)
    assert _joined(found) <= 2000 and {(x["id"], x["place"]) for x in found.collect()} == {(19, 1), (39, 2)} and found.count() == 600


def test_cutting_texts_shuffles_none(spark):
    texts, lengths = spark.range(50).selectExpr("concat('abcdef', id) AS t"), spark.range(2, 4).selectExpr("cast(id AS int) AS size").distinct()
    plan = cit.substrings(texts, "t", lengths, "gram")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_shuffles_begin_with_more_partitions_than_cores(spark):
    from statutelake.session import ADAPTIVE, ESTIMATED, apply_settings

    apply_settings(spark, ADAPTIVE)
    rows = spark.range(1000).selectExpr("id % 500 AS k").groupBy("k").count()
    before = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in before and ", 400)" in before
    assert len(rows.collect()) == 500 and rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    apply_settings(spark, ESTIMATED)
    assert ", 400)" not in spark.range(1000).selectExpr("id % 500 AS k").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    apply_settings(spark, ADAPTIVE)

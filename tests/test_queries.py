"""Registered queries against their SQL twins on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import rows_of

SF = "/root/testdata/sf0.001"
NAMES = ["base_nodes", "d6_citation_stats", "c4_link_cases", "e2_article_gaps", "g1_segment", "i8_layered_search", "l4_d11_match_translations", "k4_menu_path", "m3_sliding_rate_stream", "m2_unseen_documents"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents pages conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    want = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["e2_article_gaps", "c2_resolve_citations", "i1_phrase_match", "c16_interpretations_for", "c10_find_by_fragment", "l15_edge_integrity"])
def test_no_cross_join_or_python_in_plan(spark, name):
    plan = entry_module.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan

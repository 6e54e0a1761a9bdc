"""Rule tables are whole: titles of areas and domains that the short tables lacked."""

from statutelake.functions import rules as r
from statutelake.operators import classify as cl

LAWS = [
    (1, "中华人民共和国宪法", "宪法", ""), (2, "大气污染防治法", "法律", ""), (3, "铁路法", "法律", ""), (4, "兵役法", "法律", ""),
    (5, "海关稽查条例", "行政法规", ""), (6, "缔结条约管理办法", "行政法规", ""),
]


def test_taxonomy_and_subject_tables_are_whole(spark):
    assert len(r.TAXONOMY_RULES) == 18 and sum(len(w) for _, w in r.TAXONOMY_RULES) == 289
    assert len(r.SUBJECT_RULES) == 20 and sum(len(w) for _, w in r.SUBJECT_RULES) == 518
    laws = spark.createDataFrame(LAWS, "id long, title string, category string, full_text string")
    got = {x["id"]: (x["taxonomy"], x["subject_area"]) for x in cl.subject_area(cl.taxonomy_domain(laws)).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4)] == ["宪法与国家机构", "环境与资源", "交通与基础设施", "国防与军事"]
    assert [got[i][1] for i in (5, 6)] == ["海关进出口", "涉外外资"] and got[1][1] is None

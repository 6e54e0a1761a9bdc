"""Pairs of vectors that meet by their first components only."""

import math

import numpy as np
from statutelake.llm import embedding_links as el


def test_no_link_is_ruled_out_and_far_pairs_are(spark):
    r = np.random.RandomState(3)
    x = r.standard_normal((40, 24))
    x = np.concatenate([x, x + 0.1 * r.standard_normal(x.shape)])
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    rows = spark.createDataFrame([(i, v.tobytes(), "a" if i != 79 else "b") for i, v in enumerate(x)], "item long, vector binary, label string")
    heads = rows.mapInArrow(el._heads, f"item long, label string, {', '.join(f'{h} float' for h in el.HEADS)}, rest double")
    pairs = spark.range(80 * 80).selectExpr("id div 80 AS a", "id % 80 AS b").filter("a < b")
    left = {(p["a"], p["b"]) for p in el.may_link(pairs, heads, math.acos(0.98)).collect()}
    near = {(a, b) for a in range(80) for b in range(a + 1, 79) if x[a] @ x[b] >= 0.98}
    assert near and near <= left and len(left) < 200
    wide = el.may_link(pairs.selectExpr("a", "b", "pi() AS radius"), heads, math.acos(0.98))
    assert wide.count() == 79 * 78 // 2

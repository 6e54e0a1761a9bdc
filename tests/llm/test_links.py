"""Operators 2 and 10, components and the leader join."""

import math
import random
import re

import duckdb
import numpy as np
import pytest

from statutelake.llm import shingle_join
from statutelake.llm.components import components
from statutelake.llm.embedding_links import embedding_links
from statutelake.llm.queries import ORACLES, QUERIES
from statutelake.llm.session import prepare
from statutelake.llm.shingle_join import Blocks, difference_limit, jaccard_join, set_id, shingle_set, size_class


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none", "loops"])
def test_components(spark, shape):
    prepare(spark)
    rng = random.Random(2)
    links = {
        "path": [(i, i + 1) for i in range(40)], "star": [(7, i) for i in range(30) if i != 7],
        "random": [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)], "none": [], "loops": [(3, 3), (5, 5), (5, 6), (6, 5)],
    }[shape]
    df = spark.createDataFrame(links + [(1, None)] if shape == "random" else links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    want = union_find(linked, [(a, b) for a, b in links if a != b])
    assert got == want


def test_difference_limit_is_the_jaccard_bound():
    for r in range(1, 60):
        for s in range(r, 70):
            least = min((u - i for i in range(r + 1) for u in [r + s - i] if 100 * i >= 90 * u), default=None)
            most = max((u - i for i in range(r + 1) for u in [r + s - i] if 100 * i >= 90 * u), default=-1)
            assert most <= difference_limit(r + s, 90) and (least is None or least <= difference_limit(r + s, 90))


def test_size_classes_meet_every_partner():
    for r in range(1, 400):
        low, high = size_class(r, 90)
        following = size_class(high + 1, 90)
        assert low <= r <= high
        for s in range(r, r * 100 // 90 + 1):
            assert s <= following[1]


def test_sketches_never_rule_out_a_link():
    import pyarrow as pa

    rng = np.random.RandomState(4)
    for size in (1, 5, 60, 700, 9000):
        base = np.unique(rng.randint(0, 2**62, size).astype(np.uint64))
        for share in (0, 0.05, 0.1, 0.3, 1):
            keep = rng.random(len(base)) >= share
            other = np.unique(np.concatenate([base[keep], rng.randint(0, 2**62, int(size * share * rng.random())).astype(np.uint64)]))
            if not len(other):
                continue
            common = len(np.intersect1d(base, other))
            linked = 100 * common >= 80 * (len(base) + len(other) - common)
            for test, make in ((shingle_join._near_enough, shingle_join.sketch), (shingle_join._nearer, shingle_join.fine_sketch)):
                batch = pa.RecordBatch.from_arrays([pa.array([v]) for v in (1, 2, len(base), len(other), make(base).tobytes(), make(other).tobytes())], list("abmnxy"))
                kept = sum(out.num_rows for out in test(80)(iter([batch])))
                assert kept or not linked
                assert not kept or share < 1 or size < 60


def test_sets_that_link_share_a_list():
    rng = np.random.RandomState(4)
    blocks = Blocks(90)
    for _ in range(400):
        n = rng.randint(1, 120)
        base = np.unique(rng.randint(0, 2**62, n)).astype(np.uint64)
        other = base.copy()
        for _ in range(rng.randint(0, 8)):
            if rng.rand() < 0.5 and len(other) > 1:
                other = np.delete(other, rng.randint(len(other)))
            else:
                other = np.unique(np.append(other, np.uint64(rng.randint(0, 2**62))))
        common = len(np.intersect1d(base, other))
        if 100 * common >= 90 * (len(base) + len(other) - common) and set_id(base) != set_id(other):
            x, y = (dict(zip(*map(list, blocks.entries(s)))) for s in (base, other))
            assert any(x[k] + y[k] < 2 for k in x.keys() & y.keys())


def plain_set(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def test_hashed_sets_have_the_sizes_of_plain_ones():
    rng = random.Random(8)
    for text in [None, "", " \t", "One", "one TWO", "a b c", "a b c a b c a b c", "É é\x0bx\u00a0y z", "x" * 5000 + " " + "y" * 5000 + " z"] + [
        " ".join(rng.choice("abc") for _ in range(40)) for _ in range(50)
    ]:
        assert len(shingle_set(text)) == len(plain_set(text)), text
    assert set_id(shingle_set("A b C d")) == set_id(shingle_set("a\tB c\nD")) != set_id(shingle_set("a b c e"))


def test_long_texts_are_hashed_in_segments(monkeypatch):
    from statutelake.llm import hashing

    text = ("alpha beta Gamma " * 40 + "w" * 900 + " tail words here").encode()
    whole = hashing.word_hashes(text).tolist()
    monkeypatch.setattr(hashing, "SEGMENT", 64)
    monkeypatch.setattr(hashing, "LONG_WORD", 32)
    hashing._powers.clear()
    short = hashing.word_hashes(text).tolist()
    monkeypatch.undo()
    hashing._powers.clear()
    assert len(whole) == len(short) and whole[:120] == short[:120] and whole[-3:] == short[-3:]


def check_jaccard(rows, got):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(plain_set(t))
    flat = [(i, s) for i, ss in sets.items() if i is not None for s in ss]
    links = [
        (i, j) for x, (i, a) in enumerate(flat) for j, b in flat[:x] if a and b and i != j and 100 * len(a & b) >= 90 * len(a | b)
    ]
    root = union_find({i for i, _ in flat}, links)
    assert sorted(got, key=str) == sorted(((i, len(plain_set(t)), root[i] if i is not None else None) for i, t in rows), key=str)
    return links


def test_join_equals_brute_force(spark, documents):
    prepare(spark)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows, passage = [], [rng.choice(words) for _ in range(60)]
    for g in range(14):
        base = [rng.choice(words) for _ in range(rng.choice([2, 5, 12, 40, 200, 700]))]
        for _ in range(rng.randint(1, 7)):
            text = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text).title() if rng.random() < 0.3 else " ".join(text)))
    rows += [(len(rows) + i, " ".join(passage + [rng.choice(words) for _ in range(12)])) for i in range(25)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "two words"), (None, rows[0][1]), (0, rows[0][1])]
    got = [tuple(r) for r in jaccard_join(documents(rows)).collect()]
    assert len(check_jaccard(rows, got)) > 30


def test_a_large_group_of_near_copies(spark, documents):
    """Each copy differs from the others; two groups lie just beyond the threshold of each other."""
    prepare(spark)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    far = base[:170] + [f"f{i}" for i in range(30)]
    rows = []
    for source in (base, far):
        for _ in range(60):
            text = list(source)
            text[rng.randrange(200)] = f"x{len(rows)}"
            rows.append((len(rows), " ".join(text)))
    check_jaccard(rows, [tuple(r) for r in jaccard_join(documents(rows)).collect()])


def test_links_between_classes_are_found(spark, documents):
    """Chains: neighbours link, leaders do not."""
    prepare(spark)
    rows = []
    for c in range(3):
        text = [f"c{c}w{i}" for i in range(120)]
        for step in range(12):
            text = text[3:] + [f"c{c}s{step}e{i}" for i in range(3)]
            rows.append((len(rows), " ".join(text)))
    random.Random(1).shuffle(rows)
    check_jaccard(rows, [tuple(r) for r in jaccard_join(documents(rows)).collect()])


def test_empty_tables(spark, documents):
    prepare(spark)
    assert jaccard_join(documents([])).count() == 0
    assert embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vector_links_equal_brute_force(spark):
    prepare(spark)
    rng = np.random.RandomState(3)
    rows, centre = [], rng.standard_normal((6, 16))
    for i in range(150):
        v = centre[i % 6] + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.12, 0.2])
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    odd = [
        (200, None, 1), (201, [0.0] * 16, 1), (202, [1.0, None] + [0.0] * 14, 1), (203, [math.nan] * 16, 1), (204, [math.inf] * 16, 0),
        (205, rows[0][1], None), (206, [], 0), (207, [2 * x for x in rows[0][1]], 0), (208, rows[0][1][:5], 0), (0, rows[0][1], 0), (None, rows[0][1], 0),
    ]
    rows += odd
    df = spark.createDataFrame([(*r, "k", 1.5) for r in rows], "vec_id long, embedding array<float>, label int, item string, weight double")
    got = sorted((tuple(r) for r in embedding_links(df.repartition(4)).collect()), key=str)

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64)
        return x / math.sqrt(x @ x)

    units = [unit(v) for _, v, _ in rows]
    linked = [
        (p, q) for p in range(len(rows)) for q in range(p)
        if units[p] is not None and units[q] is not None and len(units[p]) == len(units[q]) and rows[p][2] == rows[q][2]
        and rows[p][2] is not None and rows[p][0] is not None and rows[q][0] is not None and units[p] @ units[q] >= 0.98
    ]
    root = union_find({r[0] for r in rows if r[0] is not None}, [(rows[p][0], rows[q][0]) for p, q in linked])
    degree = [sum(p in pair for pair in linked) for p in range(len(rows))]
    want = [(r[0], degree[p], None if r[0] is None else root[r[0]], r[0] is None or root[r[0]] == r[0]) for p, r in enumerate(rows)]
    assert got == sorted(want, key=str)
    assert max(degree) > 5


def test_large_classes_are_counted_in_blocks(spark):
    prepare(spark)
    rng = np.random.RandomState(1)
    rows = [(i, [float(x) for x in np.ones(8) + rng.standard_normal(8) * 0.03], 1) for i in range(70)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    small = sorted(tuple(r) for r in embedding_links(df, block=16).collect())
    assert small == sorted(tuple(r) for r in embedding_links(df, block=512).collect())
    assert sum(r[1] for r in small) > 1000


@pytest.mark.parametrize("name", ["op2_embedding_links", "op10_jaccard_join"])
def test_queries_equal_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(rel.fetchall())


def test_seen_sets_are_bounded(monkeypatch, spark, documents):
    prepare(spark)
    monkeypatch.setattr(shingle_join, "SEEN", 1)
    rows = [(i, f"same words in this text {i % 3} " * 3) for i in range(12)]
    check_jaccard(rows, [tuple(r) for r in jaccard_join(documents(rows)).collect()])


def list_rows(sets, key=7):
    """Rows of one list whose items are all of different classes."""
    import pyarrow as pa

    n = len(sets)
    columns = [[key] * n, [0] * n, [0] * n, [0] * n, list(range(n)), [0] * n, list(range(n)), [len(s) for s in sets], [shingle_join.sketch(s).tobytes() for s in sets]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "p", "q", "side", "item", "kind", "class", "size", "sketch"])


def near_the_threshold(n, rng, size=300):
    """Sets of which some pairs link at 80 percent and others just do not."""
    base = np.unique(rng.randint(0, 2**62, size).astype(np.uint64))
    out = []
    for _ in range(n):
        keep = rng.random(len(base)) >= rng.choice([0.02, 0.1, 0.12])
        out.append(np.unique(np.concatenate([base[keep], rng.randint(0, 2**62, int((~keep).sum())).astype(np.uint64)])))
    return out


def test_a_list_gives_fewer_rows_than_it_has_items():
    rng = np.random.RandomState(5)
    near, far = near_the_threshold(200, rng), [np.unique(rng.randint(0, 2**62, 4000).astype(np.uint64)) for _ in range(50)]
    rows, none = (
        [tuple(r.values()) for b in shingle_join._list_groups(80)(iter([list_rows(s)])) for r in b.to_pylist()] for s in (near, far)
    )
    assert 150 < len(rows) < 200
    # Large sets that have nothing in common are told apart where the lists are.
    assert not none
    root = union_find(range(200), rows)
    sets = [set(s.tolist()) for s in near]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            assert root[i] == root[j] or 100 * len(a & b) < 80 * len(a | b)


def test_a_group_gives_links_that_join_what_all_links_join(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(shingle_join, "COLUMNS", 37)
    sets = near_the_threshold(60, np.random.RandomState(6))
    linked = [(i, j) for i in range(60) for j in range(i) if 100 * len(c := np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - len(c))]
    rows = [(1, p, q, int(q != p and i % 2 == 1), i, i, sets[i].tobytes()) for p, q in ((0, 0), (0, 1), (1, 1)) for i in range(60) if p != q or i % 2 == p]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at : at + 25])], list("gpqsics")) for at in range(0, len(rows), 25)]
    got = [tuple(r.values()) for b in shingle_join._group_links(80)(iter(batches)) for r in b.to_pylist()]
    assert set(got) <= {(j, i) for i, j in linked} and len(got) < 120 < len(linked)
    assert union_find(range(60), got) == union_find(range(60), linked)

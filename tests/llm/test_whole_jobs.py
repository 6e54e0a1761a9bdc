"""Whole jobs: what the operators and the pipeline left out before."""

import random

from statutelake.llm import decontamination, license_scan
from statutelake.llm.session import prepare
from tests.llm.test_links import union_find


# --- near copies of the pipeline -----------------------------------------------------------------


def five_words(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_near_copies_are_those_of_five_words_and_80_percent(spark, documents, sf):
    import corpus_pipeline

    prepare(spark)
    rng = random.Random(12)
    rows = []
    for g in range(8):
        base = [f"g{g}w{i}" for i in range(200)]
        rows.append((len(rows), " ".join(base)))
        rows.append((len(rows), " ".join(base + [f"g{g}new{i}" for i in range(40)])))  # 0.831
        for n in (2, 4, 5, 9):
            text = list(base)
            for i in range(n):
                text[10 + i * 20] = f"g{g}n{n}x{i}"
            rows.append((len(rows), " ".join(text)))
        base = [rng.choice("abcdefghij") + str(g) for _ in range(rng.choice([3, 5, 9, 30]))]
        rows += [(len(rows) + i, " ".join(base + ["tail"] * i)) for i in range(3)]
    sets = {i: five_words(t) for i, t in rows}
    links = [(i, j) for i in sets for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = union_find(set(sets), links)
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, documents(rows), sf).collect())
    assert got == sorted(i for i in sets if root[i] == i)
    assert 1 not in got and 3 not in got and 5 in got


# --- licences ------------------------------------------------------------------------------------


def test_short_templates_are_retrieved_whatever_stands_beside_them(spark, documents):
    prepare(spark)
    rng = random.Random(31)
    rows = []
    for n in range(5_000):
        words = [f"w{rng.randrange(10**6)}" for _ in range(4)]
        at = rng.randint(0, 3)
        rows.append((n, " ".join(words[:at] + ["released under the mit license"] + words[at:])))
    got = license_scan.scan(documents(rows, parts=8)).filter("template = 'MIT-line'").select("doc_id").collect()
    assert len(got) == len(rows)


def test_windows_without_an_anchor_hold_too_little():
    split = [license_scan.words_of(t) for _, t in license_scan.TEMPLATES] + [list("abcdefghijk"), list("aaaaabaaaaac")]
    for percent in (1, 50, 80, 99, 100):
        chosen = set(license_scan.anchors(split, percent))
        for words in split:
            runs = license_scan.runs_of(words)
            assert sum(not set(r) & chosen for r in runs) < license_scan.least_held(len(runs), percent)
    assert not {"any", "that", "use", "will"} & set(license_scan.anchors(split[:-2]))


def test_bands_follow_from_the_lowest_likeness():
    for fewest, most, window in ((1, 2, 9), (3, 5, 13), (6, 10, 21), (40, 44, 72)):
        count, full = license_scan.bands(fewest, most, window), window - 4
        for n in range(fewest, most + 1):
            held = license_scan.least_held(n)
            assert (1 - held / (n + full - held)) ** count <= 1.001e-7


def test_a_window_shares_its_smallest_hash_as_often_as_its_likeness(spark):
    """Over many windows of the shortest class: every band is an order of its own."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    rows = [(i, [f"r{rng.randrange(10**9)}" for _ in range(4)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, others array<string>")
    goal = F.array(F.lit("released under the mit license"))
    window = F.concat(goal, "others")
    same = F.size(F.filter(F.arrays_zip(license_scan._smallest(window, 73).alias("x"), license_scan._smallest(goal, 73).alias("y")), lambda p: p["x"]["value"] == p["y"]["value"]))
    got = [r[0] for r in df.select(same).collect()]
    assert min(got) >= 1 and abs(sum(got) / len(got) / 73 - 0.2) < 0.1  # 73 draws of one template


# --- decontamination -----------------------------------------------------------------------------


def test_clean_takes_a_benchmark_of_any_size(spark, documents):
    prepare(spark)
    rng = random.Random(3)
    items = [(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100))) for i in range(41_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontamination.slices(bench)[1] > 1
    rows = [(i, f"before {t} behind") for i, t in (items[0], items[-1])] + [(7, "clean"), (7, "clean"), (8, None), (9, ""), (None, "no id"), (None, items[-1][1])]
    docs = documents(rows)
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(7, "clean"), (7, "clean"), (8, None), (9, ""), (None, "no id")], key=str)


# --- the pipeline's tables -----------------------------------------------------------------------


def test_a_stage_leaves_nothing_but_its_rows(spark, sf, monkeypatch):
    """What a stage writes on the way, and what it has read, goes when its rows are written."""
    import os

    import corpus_pipeline
    from statutelake.llm.session import table, written
    from statutelake.operators.lineage import shared_folder

    def stage(spark, docs, sf_dir):
        return written(docs.filter("doc_id % 2 = 0"), "way")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", stage), ("second", stage), ("third", stage)])
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, sf)
    assert [n.split("-")[1] for n in set(os.listdir(folder)) - before] == ["third"]
    assert got.count() == table(spark, sf, "documents").filter("doc_id % 2 = 0").count() > 0

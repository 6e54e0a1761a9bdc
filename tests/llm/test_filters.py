"""Operators 4, 5, 6, 8 and 9, and the pipeline."""

import random
import re
import zlib

import duckdb
import pytest

from statutelake.llm import decontamination, license_scan, rule_ensemble, sharding, url_rules
from statutelake.llm.queries import ORACLES, QUERIES
from statutelake.llm.session import prepare, shared_path, table


# --- sharding ------------------------------------------------------------------------------------


def test_shards_and_slots(spark, documents):
    prepare(spark)
    rows = [(i, f"text {i % 7} é") for i in range(300)] + [(5, "again"), (5, "again"), (None, None), (400, ""), (401, None)]
    got = sharding.assign(documents(rows)).collect()
    assert len(got) == len(rows)
    for shard in {r["shard"] for r in got}:
        mine = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in mine] == list(range(len(mine)))
        keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in mine]
        assert keys == sorted(keys)
    assert all(r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24 for r in got)
    assert 0 < sum(r["grown_shard"] == 24 for r in got) < 40
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    assert all((r["size"], r["text_crc32"]) in texts[r["doc_id"]] and r["law"] == "key" for r in got)
    again = {(r["doc_id"], r["shard"]) for r in sharding.assign(documents(rows[::-1], parts=5)).collect()}
    assert again == {(r["doc_id"], r["shard"]) for r in got}


def test_weights_decide_shares(spark):
    weights = [1.0, 3.0, 0.0, 4.0]
    rows = spark.range(8000).select(sharding.shard_of(spark.range(1).id if False else __import__("pyspark").sql.functions.col("id"), weights).alias("s"))
    counts = {r["s"]: r["count"] for r in rows.groupBy("s").count().collect()}
    assert 2 not in counts
    for i, w in enumerate(weights):
        assert abs(counts.get(i, 0) - 1000 * w) < 200


def test_shard_files(spark, documents):
    prepare(spark)
    path = shared_path(spark, "test-shards")
    rows = [(i, f"t{i}") for i in range(60)] + [(None, None)]
    sharding.write_shards(documents(rows), path, shards=5)
    back = spark.read.parquet(path)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted(rows, key=str)
    want = {(r["doc_id"], r["shard"]) for r in sharding.assign(documents(rows), shards=5).collect()}
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == want
    assert sharding.assign(documents([])).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(None, [0.0])


# --- decontamination -----------------------------------------------------------------------------


def edit_distance_in(pattern, text):
    """Smallest distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_myers_equals_the_matrix():
    rng = random.Random(1)
    for _ in range(150):
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        hit = decontamination.Myers(pattern).best(text, len(pattern))
        want = edit_distance_in(pattern, text)
        assert (hit[0] if hit else len(pattern)) == want


def test_leaks_equal_brute_force(spark, documents):
    prepare(spark)
    rng = random.Random(2)
    words = ["theory", "of", "cats", "and", "large", "numbers", "in", "practice", "é", "x9"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(4, 30)))) for i in range(12)] + [(20, "short"), (21, None), (None, "no id for this item at all"), (3, "a second text of item three here")]
    rows = []
    for n in range(60):
        text = " ".join(rng.choice(words) for _ in range(30))
        if n % 3 == 0:
            item = rng.choice(items[:12])[1].upper() if n % 2 else rng.choice(items[:12])[1]
            chars = list(item)
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(chars))
                chars[at : at + 1] = rng.choice([[], ["q"], [chars[at], "z"]])
            text = text[:50] + " \n " + "".join(chars).replace(" ", "  ") + text[50:]
        rows.append((n, text))
    rows += [(100, None), (101, ""), (None, items[0][1]), (102, items[0][1]), (102, items[0][1])]
    rows += [(103, "a Short\n answer"), (104, "shorts"), (105, "ashort short"), (106, "short"), (107, "so: What is two plus two"), (108, "what is two plusone")]
    items.append((30, "What is two plus"))
    bench = spark.createDataFrame([(*i, "extra") for i in items], "item_id long, text string, doc_id string")
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in decontamination.leaks(documents(rows), bench).collect()), key=str)
    want = []
    for doc, text in rows:
        for item, goal in items:
            goal = decontamination.normal(goal or "")
            if item is None or not goal or not text:
                continue
            if len(goal) < 20:
                if re.search(rf"(?<!\w){re.escape(goal)}(?!\w)", decontamination.normal(text)):
                    want.append((doc, item, 0))
                continue
            distance = edit_distance_in(goal, decontamination.normal(text))
            if distance <= len(goal) * 5 // 100:
                want.append((doc, item, distance))
    assert got == sorted(want, key=str) and len(want) > 10
    kept = sorted((r["doc_id"] for r in decontamination.clean(documents(rows), bench).collect()), key=str)
    dirty = {d for d, _, _ in want}
    assert kept == sorted((d for d, t in rows if d not in dirty), key=str)


def test_leaks_in_giant_texts_and_slices(spark, documents, monkeypatch):
    prepare(spark)
    item = "the quick brown fox jumps over the lazy dog again and again"
    other = "a wholly different question about rivers and mountains"
    bench = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    parts, count = decontamination.slices(bench, most=70)
    assert count == 2 and sorted(r["item_id"] for r in parts.collect()) == [1, 2] and {r["slice"] for r in parts.collect()} <= {0, 1}
    searcher = decontamination.Searcher([(1, item)], 5)
    monkeypatch.setattr(decontamination, "PIECE", 50)
    text = "filler words " * 9 + item + " more filler" * 9
    found = [hit for at, part in decontamination._parts(text, searcher.margin) for hit in searcher.search(part)]
    assert found
    none = decontamination.leaks(documents([(1, "x")]), bench.limit(0))
    assert none.count() == 0 and decontamination.leaks(documents([]), bench).count() == 0


def test_short_items_at_the_borders_of_parts(monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE", 10)
    searcher = decontamination.Searcher([(1, "cat"), (2, "a dog"), (3, "\u732b")], 5)
    rng = random.Random(7)
    for _ in range(300):
        text = " ".join(rng.choice(["cat", "cats", "a", "dog", "tomcat", "xx", "\u9ed1\u732b\u732b"]) for _ in range(rng.randint(0, 15)))
        found = set()
        for at, part in decontamination._parts(text, searcher.margin):
            found |= set(searcher.search(part, at == 0, at + len(part) == len(text)))
        want = {i for i, t in enumerate(("cat", "a dog")) if re.search(rf"(?<!\w){t}(?!\w)", text)} | ({2} if "\u732b" in text else set())
        assert found == want, text


def test_one_automaton_for_each_slice(spark, monkeypatch):
    """However many documents a task has and however slices alternate, a slice is built once in a row."""
    from types import SimpleNamespace

    import pyarrow as pa

    built = []
    monkeypatch.setattr(decontamination, "Searcher", lambda items, percent, least: built.append(1) or SimpleNamespace(margin=5, texts=[], search=lambda *a: {}))
    decontamination._built.clear()
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(50)), "text": ["some text"] * 50})
    for name in ("first", "second"):
        list(decontamination._finder(name, SimpleNamespace(value=[]), 5, 20)(iter([batch] * 4)))
    assert len(built) == 2
    decontamination._built.clear()


# --- urls ----------------------------------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [
        (h + p, kind) for kind, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits, key=lambda f: len(f[0])) if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/1?x=/en/", "https://example.org/en/12#top", "https://myexample.org/es/1",
    "http://x.com/fr/9", "http://x.com/de/9?utm_source=feed", "http://com/de/", "http://x.com/DE/1", "http://org", "http://org/", "http://a.org?x=1/",
    "ftp://x.net/a://b.org/c", "://example.org/en/1", "http://ÉX.org/é", "http://x.org\n/es/1", "http://example.org/en/1", "http://example.org/en/1",
]


def test_explicit_rules(spark):
    prepare(spark)
    pages = spark.createDataFrame([(i, u, "<p>", "r") for i, u in enumerate(URLS)], "page_id long, url string, html string, rule string")
    labelled = url_rules.label_urls(pages, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = {r["page_id"]: r for r in url_rules.judge(pages, labelled).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = plain_parts(u)
        rule, kind = plain_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, kind or "allow"), u


def test_mined_rules_block(spark):
    prepare(spark)
    rng = random.Random(4)
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        name = "casino" if bad and rng.random() < 0.9 else rng.choice(["news", "blog"])
        rows.append((i, f"https://{name}.example.net/{rng.choice(['en', 'it'])}/{i}?ref=x", 0 if bad else 1))
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    rules = [(set(r["antecedent"]), r["confidence"]) for r in url_rules.mine(url_rules.label_urls(pages, labels)).collect()]
    assert rules and all(c >= 0.5 for _, c in rules)
    assert not any(a < b and c >= d for a, c in rules for b, d in rules)
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, url_rules.label_urls(pages, labels)).collect()}
    assert all((got[i] == "block") == ("casino" in u) for i, u, _ in rows)


# --- licences ------------------------------------------------------------------------------------


def plain_scan(rows, templates=license_scan.TEMPLATES, percent=80):
    split = {name: license_scan.words_of(text) for name, text in templates}
    classes = license_scan.size_classes([len(w) for w in split.values()])
    out = {}
    for doc, text in rows:
        words = license_scan.words_of(text or "")
        for name, goal in split.items():
            runs = {tuple(goal[i : i + 5]) for i in range(len(goal) - 4)}
            if not runs:
                continue
            _, _, size, stride = next(c for c in classes if c[0] <= len(goal) <= c[1])
            for start in range(0, len(words), stride):
                window = words[start : start + size]
                share = len(runs & {tuple(window[i : i + 5]) for i in range(len(window) - 4)}) / len(runs)
                if share * 100 >= percent - 1e-9:
                    out.setdefault((doc, name), []).append((-share, start))
    return {k: (-min(v)[0], min(v)[1]) for k, v in out.items()}


def test_scan_equals_brute_force(spark, documents):
    prepare(spark)
    rng = random.Random(5)
    filler = "the of and license software free work under with terms in any public a general copy".split()
    rows = []
    for n in range(40):
        words = [rng.choice(filler) for _ in range(rng.randint(0, 120))]
        name, text = license_scan.TEMPLATES[n % len(license_scan.TEMPLATES)]
        notice = text.split()
        if n % 4 == 1 and len(notice) > 12:
            notice[rng.randrange(len(notice))] = "changed"
        at = rng.randint(0, len(words))
        rows.append((n, " ".join(words[:at] + ([] if n % 5 == 0 else notice) + words[at:]).upper() if n % 2 else " ".join(words[:at] + notice + words[at:])))
    rows += [(100, None), (101, ""), (102, "Released under the MIT License." * 3), (None, "Licensed under CC BY-NC 4.0."), (103, "-" * 50 + "license")]
    got = {(r["doc_id"], r["template"]): (r["containment"], r["start_word"]) for r in license_scan.scan(documents(rows)).collect()}
    assert got == plain_scan(rows)
    assert license_scan.scan(documents([])).count() == 0 and license_scan.scan(documents(rows), templates=(("t", "too short"),)).count() == 0


# --- quality -------------------------------------------------------------------------------------


def test_paths_of_a_tree():
    text = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 1.0
"""
    a, b, c, d = (3, False, 0.5), (1, False, 2.0), (1, True, 2.0), (3, True, 0.5)
    assert rule_ensemble._paths(text) == [(a,), (a, b), (a, c), (d,)]


def test_held_out_rows_are_predicted(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op9_rule_ensemble"](spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    assert len(rows) == table(spark, sf, "documents").count()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(labels[i], r["predicted"]) for i, r in rows.items() if r["held_out"] and i in labels]
    good = [p for q, p in held if q == 1]
    bad = [p for q, p in held if q == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_scores_of_odd_rows(spark, documents):
    prepare(spark)
    rows = [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "no id"), (4, "x" * 5000), (5, " \n\t ")]
    model = rule_ensemble.Model(0.5, ((((0, True, 1.0),), -1.0), (((1, False, 1.0), (2, True, 0.5)), 0.25)))
    out = rule_ensemble.judge(documents(rows), model)
    got = out.collect()
    assert len(got) == len(rows) and all(0 < r["score"] < 1 for r in got)
    assert out.columns[-3:] == ["held_out", "score", "predicted"] and len(set(out.columns)) == len(out.columns)
    kept = rule_ensemble.accepted(documents(rows), model, threshold=0.0)
    assert kept.columns == documents(rows).columns and kept.count() == len(rows)
    assert rule_ensemble.judge(documents([]), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rule_ensemble.train(documents(rows), none).rules == ()


# --- all -----------------------------------------------------------------------------------------


def test_pipeline_equals_its_parts(spark, sf):
    import corpus_pipeline
    from statutelake.llm.shingle_join import jaccard_join
    from tests.llm.test_links import plain_set

    prepare(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "decontamination", "sentencepieces"]
    docs = table(spark, sf, "documents")
    model = rule_ensemble.train(docs, table(spark, sf, "labels"))
    good = [r["doc_id"] for r in rule_ensemble.judge(docs, model).filter("predicted = 1").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {i: plain_set(texts[i], 5) for i in good}
    left = [i for i in good if jaccard_first(i, good, sets)]
    items = [decontamination.normal(r["text"]) for r in table(spark, sf, "benchmark").collect()]
    left = [i for i in left if not any(t in decontamination.normal(texts[i]) for t in items)]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(left)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    assert jaccard_join is not None


def jaccard_first(i, ids, sets):
    """Whether no smaller id is reachable from ``i`` by links."""
    seen, todo = {i}, [i]
    while todo:
        a = sets[todo.pop()]
        for j in ids:
            if j not in seen and a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                seen.add(j)
                todo.append(j)
    return min(seen) == i


def test_stages_keep_the_columns(spark, documents, sf):
    import corpus_pipeline

    prepare(spark)
    rows = [(1, "good words in a row " * 9), (2, "good words in a row " * 9), (2, "another text"), (3, None), (4, ""), (None, "no id"), (None, "no id"), (None, "other")]
    docs = documents(rows)
    kept = corpus_pipeline.near_copies(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, 3, 4, None, None]
    for stage in (corpus_pipeline.quality, corpus_pipeline.decontaminate):
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, documents([]), sf).count() == 0


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n not in ("op2_embedding_links", "op10_jaccard_join")))
def test_queries_equal_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.execute(ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, rel.fetchall()))

"""Operators 11, 12 and 13 against plain versions."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from statutelake.llm import centroid_clusters, collocations, order_minhash
from statutelake.llm.queries import ORACLES, QUERIES
from statutelake.llm.session import prepare

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, least, longest, top):
    words, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = []
    for (lang, p), a in counts.items():
        if len(p) < 2 or a < least:
            continue
        n = words[lang]
        score, k = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        found.append((lang, p, a, counts[lang, p[:k]], counts[lang, p[k:]], n, score))
    gone = set()
    for lang, p, a, *_ in found:
        for m in range(2, len(p)):
            gone |= {(lang, p[s : s + m]) for s in range(len(p) - m + 1) if 100 * a >= 100 * counts[lang, p[s : s + m]]}
    out = []
    kept = sorted((f for f in found if f[:2] not in gone), key=lambda f: (f[0], -f[6], -f[2], " ".join(f[1]).encode()))
    for lang, group in itertools.groupby(kept, key=lambda f: f[0]):
        out += [(lang, i, " ".join(p), *rest) for i, (_, p, *rest) in enumerate(list(group)[:top], 1)]
    return sorted(out)


def some_texts(seed, n=160):
    rng = random.Random(seed)
    words = ["the", "The", "of", "état", "new", "york", "a", "x" * 50, "zwölf", "b c", "w0", "w1", "w2"]
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "; ", "\r\n", "\u000b", "!"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.choice([3, 6, 13])]) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "en", "fr", None, "und"]), text + rng.choice(["", " new york state of mind", "New York", " the the the the the the"])))
    return [*out, ("en", None), (None, None), ("en", ""), ("fr", " .\t. "), *[("en", "again and again and again and again")] * 40]


@pytest.mark.parametrize(("least", "longest", "top"), [(5, 5, 2000), (12, 5, 7), (20, 3, 2000), (30, 2, 3)])
def test_collocations_equal_counting(spark, least, longest, top):
    prepare(spark)
    rows = some_texts(least)
    df = spark.createDataFrame([(lang, text, "x", 1, 2) for lang, text in rows], "lang string, text string, TEXT string, n long, gram long").repartition(5)
    got = collocations.collocations(df, least, longest, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations(rows, least, longest, top)
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_collocations_with_split_stripes_small_tables_and_long_texts(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(collocations, "HOT", 10**9)  # every stripe is split
    rng = random.Random(3)
    giant = " ".join(rng.choice("abcdefgh") for _ in range(400_000))
    rows = [("en", giant), ("en", "z" * 3_000_000 + " a b c"), ("fr", giant[:9999].replace(" ", "\t"))]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), 400, 4, 500)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 400, 4, 500)


def test_collocations_of_nothing(spark):
    prepare(spark)
    for rows in ([], [(None, None)], [("en", "one two three")]):
        df = spark.createDataFrame(rows, "lang string, text string")
        assert collocations.collocations(df).collect() == []


def test_bits_may_err_to_one_side_only():
    rng = np.random.RandomState(1)
    grams = rng.randint(1, 2**62, 2000).astype(np.uint64)
    table = np.zeros(1 << 10, np.uint64)
    at = (grams >> np.uint64(8)) & np.uint64((1 << 16) - 1)
    np.bitwise_or.at(table, (at >> np.uint64(6)).astype(int), np.uint64(1) << (at & np.uint64(63)))
    bits = collocations.Bits(table.tobytes())
    assert bits.has(grams).all() and bits.has(rng.randint(1, 2**62, 5000).astype(np.uint64)).mean() < 0.1
    assert not bits.has(np.zeros(3, np.uint64)).any()


# Fingerprints.


def plain_sketch(text, k, length, rows):
    """The definition, run by run, on Python integers."""
    full = (1 << 64) - 1

    def mix(h):
        h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & full
        h = (h ^ (h >> 27)) * 0x94D049BB133111EB & full
        return h ^ (h >> 31)

    codes = [ord(c) for c in text]
    parts = [codes[i : i + k] for i in range(max(len(codes) - k, 0) + 1)] if codes else []
    hashes = []
    for p in parts:
        total = 0
        for c in p:
            total = (total * 0x9E3779B97F4A7C15 + c) & full
        hashes.append(mix((total + len(p)) & full))
    seen, numbered = Counter(), []
    for h in hashes:
        numbered.append(mix((h + seen[h] * 0xD6E8FEB86659FD93) & full) >> 32)
        seen[h] += 1
    if not parts:
        return [0] * rows
    out = []
    for factor in order_minhash._scratch(rows)[0][:, 0].tolist():
        least = sorted(range(len(numbered)), key=lambda i: (numbered[i] * factor & 0xFFFFFFFF, i))[:length]
        total = length
        for i in sorted(least):
            total = mix((total * 0x9FB21C651E98DF25 + hashes[i]) & full)
        out.append(total >> 48)
    return out


def test_sketch_equals_the_definition(monkeypatch):
    rng = random.Random(5)
    texts = ["", "a", "ab", "abcdefg", "abcdefgh", "aaaaaaaaaaaaaaaaaaaaaaaaa", "ünïcödé 漢字 😀 text", "ab" * 60]
    texts += ["".join(rng.choice("abc \n") for _ in range(rng.randint(1, 400))) for _ in range(30)]
    for chunk in (4096, 16):
        monkeypatch.setattr(order_minhash, "CHUNK", chunk)
        order_minhash._scratch.cache_clear()
        for text in texts:
            for k, length, rows in ((8, 2, 32), (3, 3, 16), (1, 1, 8)):
                assert order_minhash.sketch(text, k, length, rows).tolist() == plain_sketch(text, k, length, rows)
    monkeypatch.undo()
    order_minhash._scratch.cache_clear()


def test_sketch_follows_edits_and_order():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    text = [rng.choice(words) for _ in range(600)]
    whole = order_minhash.sketch(" ".join(text))
    near = [float((order_minhash.sketch(" ".join(w if rng.random() > share else rng.choice(words) for w in text)) == whole).mean()) for share in (0, 0.02, 0.1, 0.4)]
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3]
    # Shuffled blocks keep nearly all runs, but not their order.
    blocks = [text[i : i + 20] for i in range(0, 600, 20)]
    rng.shuffle(blocks)
    moved = float((order_minhash.sketch(" ".join(w for b in blocks for w in b)) == whole).mean())
    plain = float((order_minhash.sketch(" ".join(w for b in blocks for w in b), length=1) == order_minhash.sketch(" ".join(text), length=1)).mean())
    assert moved < 0.7 < 0.8 < plain


def plain_edits(rows):
    """rows in the operator's order -> expected values."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        a, b, c = (order_minhash.sketch(t) for t in (text, edited, after))
        out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), order_minhash.as_hex(a), order_minhash.as_hex(b), float((a == b).mean()), float((a == c).mean())))
    return out


def in_key_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


@pytest.mark.parametrize("seed", [1, 2])
def test_edit_likeness_equals_the_plain_version(spark, documents, seed):
    prepare(spark)
    rng = random.Random(seed)
    ids = rng.sample(range(-5000, 5000), 150)
    rows = [(i, rng.choice([None, "", "é" * rng.randint(1, 9), "".join(rng.choice("abcd e😀") for _ in range(rng.randint(0, 300)))])) for i in ids]
    rows[3] = (rows[3][0], "long text " * 30_000)
    got = {r["doc_id"]: tuple(r) for r in order_minhash.edit_likeness(documents(rows, 7)).collect()}
    assert got == {r[0]: r for r in plain_edits(in_key_order(rows))}


def test_edit_likeness_of_few_equal_and_null_ids(spark, documents):
    prepare(spark)
    assert order_minhash.edit_likeness(documents([])).collect() == []
    assert [tuple(r) for r in order_minhash.edit_likeness(documents([(4, "abcdef")])).collect()] == plain_edits([(4, "abcdef")])
    rows = [(None, "no id"), (None, "nor this"), (7, "same id"), (7, "other text"), (7, "same id"), (1, "one"), (9, "nine nine")]
    got = order_minhash.edit_likeness(documents(rows)).collect()
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter((i, order_minhash.as_hex(order_minhash.sketch(t))) for i, t in rows)
    # 9 comes first and its next one has the id 7; the last one is followed by it.
    assert [r["edited_sha256"] for r in got if r["doc_id"] == 9][0] in {hashlib.sha256(("nine " + t[:4]).encode()).hexdigest() for _, t in rows if _ == 7}
    last = [r for r in got if r["doc_id"] is None]
    assert {hashlib.sha256((t[: len(t) - len(t) // 2] + "nine nine"[: len(t) // 2]).encode()).hexdigest() for t in ("no id", "nor this")} & {r["edited_sha256"] for r in last}


def test_fingerprints_and_likeness(spark, documents):
    prepare(spark)
    rows = [(1, "some text that repeats"), (2, "some text that repeats"), (3, None), (4, ""), (5, "some text that repeat")]
    df = order_minhash.fingerprints(documents(rows))
    got = {r["doc_id"]: r["fingerprint"] for r in df.collect()}
    assert got[1] == got[2] != got[5] and got[3] == got[4] == "0" * 512
    x, y = df.alias("x"), df.alias("y")
    near = {(r[0], r[1]): r[2] for r in x.crossJoin(y).select("x.doc_id", "y.doc_id", order_minhash.likeness(F.col("x.fingerprint"), F.col("y.fingerprint"))).collect()}
    assert near[1, 2] == near[3, 4] == 1 and near[1, 3] < 0.1
    assert near[1, 5] == (order_minhash.sketch(rows[0][1]) == order_minhash.sketch(rows[4][1])).mean()


# Clusters.


def plain_clusters(rows, k=8, rounds=10, size=64):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))[::-1]

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[0], []).append(v)
        centroids = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = Counter()
    for _, c, d in found:
        total[c] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, total[c], sum(total.values()), names[c]) for i, c, d in found), key=repr)


def vectors(seed, n, size=64):
    rng = np.random.RandomState(seed)
    centres = rng.standard_normal((5, size))
    rows = [(int(i), [float(x) for x in np.float32(centres[rng.randint(5)] * 0.2 + rng.standard_normal(size) * 0.05)]) for i in rng.permutation(n)]
    bad = [None, [], rows[0][1][:63], [*rows[0][1], 0.0], [None, *rows[0][1][1:]], [math.nan, *rows[0][1][1:]], [math.inf, *rows[0][1][1:]]]
    rows += [(n + i, v) for i, v in enumerate(bad)]
    return rows + [(n + 50, [0.0] * size), (None, rows[1][1]), (3, rows[2][1]), (3, rows[4][1])] + [(n + 100 + i, rows[3][1]) for i in range(n // 2)]


@pytest.mark.parametrize(("width", "chunk"), [(4, 1 << 14), (7, 5), (1, 64), (64, 3)])
def test_clusters_equal_the_plain_version(spark, width, chunk):
    prepare(spark)
    rows = vectors(width, 60)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, VEC_ID string").repartition(3)
    got = sorted((tuple(r) for r in centroid_clusters.clusters(df, width=width, chunk=chunk).collect()), key=repr)
    assert got == plain_clusters(rows)


def test_clusters_of_few_large_and_no_vectors(spark):
    prepare(spark)
    schema = "vec_id long, embedding array<double>"
    assert centroid_clusters.clusters(spark.createDataFrame([(1, None), (2, [1.0])], schema)).collect() == []
    few = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.25] * 64)]
    got = sorted(tuple(r) for r in centroid_clusters.clusters(spark.createDataFrame(few, schema)).collect())
    assert got == plain_clusters(few)
    large = [(i, [s * 1.7e308] * 64) for i, s in enumerate((1, -1, 1, -1))] + [(9, [0.0] * 64)]
    held = {r["vec_id"]: r for r in centroid_clusters.clusters(spark.createDataFrame(large, schema), k=1).collect()}
    assert all(0 <= r["distance"] <= centroid_clusters.MOST and r["inertia"] <= centroid_clusters.MOST for r in held.values()) and len(held) == 5


def test_dictionaries_lose_nothing():
    rng = np.random.RandomState(4)
    x = rng.randint(-3, 3, (200, 10))
    codes, entries = centroid_clusters.encode_chunk(x, 3)
    assert np.array_equal(np.concatenate([e[c] for c, e in zip(codes, entries)], 1), x)
    assert max(map(len, entries)) < 200


@pytest.mark.parametrize("name", ["op11_collocations", "op13_centroid_clusters"])
def test_queries_equal_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    cols = [d[0] for d in found.description]
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, found.fetchall()))


def test_op12_equals_the_plain_version(spark, sf):
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    got = sorted(tuple(r) for r in QUERIES["op12_order_minhash"](spark, sf).collect())
    assert got == sorted(plain_edits(in_key_order(rows)))


def test_tasks_send_stripes_and_counts_in_small_batches(monkeypatch):
    """What a task gathers is bounded inside a batch of texts too, and goes out in slices."""
    import numpy as np
    import pyarrow as pa

    from statutelake.llm import collocations as c

    class Frequent:
        value = np.full(1 << 10, -1, np.int64).tobytes()

    texts = [" ".join(f"t{i}w{j}" for j in range(50)) for i in range(6)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 6), pa.array(texts)], ["lang", "text"])
    monkeypatch.setattr(c, "PAIRS", 40)
    monkeypatch.setattr(c, "WORDS", 40)
    monkeypatch.setattr(c, "ROWS", 16)
    stripes = list(c._fill_stripes(c._text_sequences, 1, Frequent, [])(iter([batch])))
    assert max(b.num_rows for b in stripes) <= 16
    assert sum(sum(map(sum, b.column(3).to_pylist())) for b in stripes) == 300
    words = list(c._count_words(iter([batch])))
    assert max(b.num_rows for b in words) <= 16
    rows = [r for b in words for r in b.to_pylist()]
    assert sum(r["n"] for r in rows if r["gram"]) == sum(r["n"] for r in rows if not r["gram"]) == 300
    assert {r["word"] for r in rows if r["gram"]} == {w for t in texts for w in t.split()}

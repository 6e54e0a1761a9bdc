"""Stateful streams: rates with late rows (M3), unseen documents (M2), progress logs (M4)."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from statutelake.operators.lineage import new_path
from statutelake.streaming import incremental as inc
from statutelake.streaming import progress as pro
from statutelake.streaming import rates

START = datetime(2024, 1, 1)


def feed(spark, batches, schema):
    path = new_path(spark, "feed")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_rates_drop_late_rows_and_keep_a_bounded_state(spark):
    rng = random.Random(1)
    batches = []
    for b in range(8):
        rows = [(START + timedelta(minutes=20 * b, seconds=rng.randint(0, 1199)), rng.choice("xy")) for _ in range(60)]
        if b >= 3:
            rows.append((START + timedelta(minutes=20 * b - 50), "late"))
            rows.append((START + timedelta(minutes=20 * b - 2), "x"))  # within the delay
        batches.append(rows)
    schema, out = "ts timestamp, event_type string", new_path(spark, "run")
    progress = rates.append_rates(feed(spark, batches, schema), f"{out}/rates", f"{out}/state")
    kind = "start timestamp, event_type string, n bigint, per_minute double"
    got = sorted(map(tuple, spark.read.schema(kind).parquet(f"{out}/rates").collect()))
    assert not any(r[1] == "late" for r in got)
    state = [p["stateOperators"][0] for p in progress]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) >= 5 * 2
    # Three types; a batch spans 20 minutes, what is open reaches delay and width further back, for the late one and the batch before too.
    assert max(s["numRowsTotal"] for s in state) <= 3 * (20 * 2 + 5 + 2 + 1) and state[-1]["numRowsTotal"] <= 3 * 8
    numbered = spark.createDataFrame([(b, *r) for b, rows in enumerate(batches) for r in rows], f"b int, {schema}")
    assert got == sorted(map(tuple, rates.closed_rates(numbered, "b").collect()))
    # Rows within the delay: the same counts as over all rows at once, but for windows that are still open.
    limit = max(r[0] for rows in batches for r in rows) - timedelta(minutes=5)
    whole = inc.sliding_rate(numbered.filter("event_type != 'late'").drop("b"))
    assert got == sorted(tuple(r) for r in whole.collect() if r["start"] + timedelta(minutes=2) <= limit)


def test_first_documents_survive_a_restart(spark):
    schema, out = "key string", new_path(spark, "run")
    path = new_path(spark, "feed")

    def add(rows):
        spark.createDataFrame([(r,) for r in rows], schema).coalesce(1).write.mode("append").parquet(path)
        with inc.keyed_state(spark):
            return inc.run_append(inc.first_documents(spark.readStream.schema(schema).parquet(path), "key"), f"{out}/rows", f"{out}/state")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    add(["a", "b", "a"])
    add(["b", "c", None])
    add(["a", "c", None, "d"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    got = [r[0] for r in spark.read.schema(schema).parquet(f"{out}/rows").collect()]
    assert sorted(got, key=str) == [None, "a", "b", "c", "d"]


def test_unseen_keys_by_bucket_are_safe_to_replay(spark):
    folder = new_path(spark, "unseen")
    schema = spark.createDataFrame([], "key string, note string").schema
    handle = inc.unseen_handler(folder, "key", schema, buckets=8)
    batches = [[(f"k{i}", "first") for i in range(30)], [(f"k{i}", "second") for i in range(20, 50)], [("k0", "third"), ("k70", "third"), ("k70", "third")]]
    for n, rows in enumerate(batches):
        handle(spark.createDataFrame(rows, schema), n)
        handle(spark.createDataFrame(rows, schema), n)  # the same batch again
    got = {(r["key"], r["note"]) for r in inc.read_deltas(spark, folder, schema).select("key", "note").collect()}
    assert got == {(f"k{i}", "first") for i in range(30)} | {(f"k{i}", "second") for i in range(30, 50)} | {("k70", "third")}
    keys = spark.read.parquet(f"{folder}-keys")
    assert keys.count() == 51 and keys.select("bucket").distinct().count() == 8


LINES = [
    "待翻译标题：{a} 个", "标题：{a}/{b}", "待翻译法律：{a} 部", "待翻译法律：未知", "[{a}/{b}] 中华人民共和国 某法{a} （{b} 条待翻译，其余略）", "引用 {a} 部法律，{b} 个术语注入",
    "批次 {a}/{b} 完成（{a}s，{b}条）", "已写回 f{a}.json", "批次 {a}/{b} 失败（已重试{a}次）", "请求重试 {a}", "别的", "标题：1/2 待翻译法律：9 部",
]


def random_lines(seed, n=400):
    rng = random.Random(seed)
    out, at = [], {}
    for _ in range(n):
        source = rng.choice(["p", "p", "p", "q", "r"])
        at[source] = at.get(source, -1) + rng.choice([1, 1, 1, 5])
        group = LINES[:3] if at[source] // 40 % 2 else LINES
        out.append((source, at[source], START + timedelta(seconds=len(out)), rng.choice(group).format(a=rng.randint(0, 30), b=rng.randint(0, 50))))
    return out


def plain_state(lines):
    states = {}
    for source, seq, _, text in sorted(lines, key=lambda r: (r[0], r[1])):
        s = states.setdefault(source, {"lines": 0, "errors": 0})
        s["lines"] += 1
        s["last_seq"] = seq
        for pattern, names, phase in pro.LOG_RULES:
            if m := re.search(pattern, text):
                s.update({n: v.strip() for n, v in zip(names, m.groups())})
                s.update({"phase": phase} if phase else {})
        if "已写回" in text:
            s["last_completed"] = s.get("current_law", "")
        s["errors"] += bool(re.search(pro.ERROR, text) or ("重试" in text and "批次" not in text))
    return states


def check_state(rows, lines):
    want = plain_state(lines)
    assert {r["source"] for r in rows} == set(want)
    for r in rows:
        w = want[r["source"]]
        for name, value in r.asDict().items():
            if name in ("source", "article_pending_laws", "current_batch"):
                continue
            expected = w.get(name)
            assert value == (int(expected) if isinstance(value, int) else expected), name
        total, done = int(w.get("article_total_laws", 0)), int(w.get("article_done", 0))
        assert r["article_pending_laws"] == (total - done if total and done else None)
        assert r["current_batch"] == (f"{w['batch_number']}/{w['batch_total']}" if "batch_number" in w else None)


def cut(lines, n):
    size = -(-len(lines) // n)
    return [lines[i : i + size] for i in range(0, len(lines), size)]


SCHEMA = "source string, seq bigint, ts timestamp, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_progress_state_is_the_same_for_one_and_many_batches(spark, seed):
    lines = random_lines(seed)
    check_state(pro.log_state(spark.createDataFrame(lines, SCHEMA)).collect(), lines)
    parts = [spark.createDataFrame(p, SCHEMA) for p in cut(lines, 8)]
    values, counts = pro.log_values(parts[0]), pro.log_counts(parts[0])
    for p in parts[1:]:
        values, counts = values.unionByName(pro.log_values(p)), counts.unionByName(pro.log_counts(p))
    check_state(pro.progress_state(pro.fold_values(values), pro.fold_counts(counts)).collect(), lines)


def plain_runs(lines):
    runs = []
    for source, seq, ts, text in sorted(lines, key=lambda r: (r[0], r[1])):
        phase = None
        for pattern, _, name in pro.LOG_RULES:
            phase = name if name and re.search(pattern, text) else phase
        if phase is None:
            continue
        if runs and runs[-1][:2] == [source, phase]:
            runs[-1][3], runs[-1][5], runs[-1][6] = seq, ts, runs[-1][6] + 1
        else:
            runs.append([source, phase, seq, seq, ts, ts, 1])
    return sorted(map(tuple, runs))


@pytest.mark.parametrize("span", [1, 7, 100_000])
def test_phase_runs_equal_reading_line_by_line(spark, span):
    lines = random_lines(3)
    assert sorted(map(tuple, pro.phase_runs(spark.createDataFrame(lines, SCHEMA), span).collect())) == plain_runs(lines)


@pytest.mark.parametrize("batches", [1, 2, 50])
def test_phase_runs_of_a_stream_equal_reading_line_by_line(spark, batches):
    lines, out = random_lines(4), new_path(spark, "run")
    parts = cut(lines, batches)
    rows = [pro.phase_runs(spark.createDataFrame(p, SCHEMA), 9).withColumn("batch", F.lit(i)) for i, p in enumerate(parts)]
    if batches == 2:  # through the file stream
        inc.run_batches(feed(spark, parts, SCHEMA), f"{out}/state", inc.delta_handler(f"{out}/runs", pro.phase_runs))
        runs = spark.read.schema(pro.RUNS + ", batch bigint").parquet(f"{out}/runs")
    else:
        pieces = [tuple(r) for df in rows for r in df.collect()]
        runs = spark.createDataFrame(pieces, "source string, phase string, start bigint, end bigint, start_ts timestamp, end_ts timestamp, n bigint, batch int")
    names = ["source", "phase", "start", "end", "start_ts", "end_ts", "n"]
    assert sorted(map(tuple, pro.fold_runs(runs, "batch").select(*names).collect())) == plain_runs(lines)


def test_errors_and_recent_lines(spark):
    lines = random_lines(5) + [("q", 10_000, START, "x" * 100 + "请求重试")]
    df = spark.createDataFrame(lines, SCHEMA)
    errors = {(r["source"], r["seq"]): r["error"] for r in pro.log_errors(df).collect()}
    assert errors == {(s, q): t[-80:] for s, q, _, t in lines if re.search(pro.ERROR, t) or ("重试" in t and "批次" not in t)}
    recent = sorted((r["source"], r["place"], r["seq"]) for r in pro.recent_lines(df, 5).collect())
    want = []
    for source in {r[0] for r in lines}:
        want += [(source, i, q) for i, q in enumerate(sorted((r[1] for r in lines if r[0] == source), reverse=True)[:5], 1)]
    assert recent == sorted(want)


def test_empty_logs(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pro.log_state(df).collect() == pro.phase_runs(df).collect() == pro.log_errors(df).collect() == []

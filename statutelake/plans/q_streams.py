"""Queries of stateful streams: rates, unseen documents, progress logs (M2-M4).

The events are fed as a folder to which batch after batch is appended in the
order of their times, so that streams meet several batches on any table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statutelake.operators.lineage import new_path
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, sql
from statutelake.plans.registry import query
from statutelake.streaming import incremental as inc
from statutelake.streaming import progress as pro
from statutelake.streaming import rates

T, c = corpus.table, F.col
BATCHES, LATE = 5, 2
DELAY = "5 minutes"

cte("numbered", f"""SELECT *, least({BATCHES - 1}, (epoch_us(ts) - lo) * {BATCHES} // (hi - lo + 1)) AS early,
      least({BATCHES - 1}, (epoch_us(ts) - lo) * {BATCHES} // (hi - lo + 1) + CASE WHEN event_id % 50 = 7 THEN {LATE} ELSE 0 END) AS b
    FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)""")


def _numbered(s, d) -> DataFrame:
    """Events with the batch of their time, and one where every 50th comes two batches late."""
    events = T(s, d, "events").withColumn("ts", c("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    if lo is None:
        lo = hi = 0
    early = F.expr(f"(unix_micros(ts) - {lo}L) * {BATCHES} div {hi - lo + 1}L")
    late = F.when(c("event_id") % 50 == 7, LATE).otherwise(0)
    return events.withColumn("early", early).withColumn("b", F.least(F.lit(BATCHES - 1), early + late)).drop("props")


def _feed(s, rows: DataFrame, batch: str) -> DataFrame:
    """A stream of ``rows`` in files appended batch by batch, one batch at a time."""
    path = new_path(s, "feed")
    for i in range(BATCHES):
        rows.filter(c(batch) == i).coalesce(1).write.mode("append").parquet(path)
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _minute(rows: DataFrame) -> DataFrame:
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", "per_minute")


cte("latest", "SELECT b, max(date_trunc('milliseconds', ts)) AS latest FROM numbered GROUP BY 1", "numbered")
_RATES = sql(
    """SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, count(*) / 2.0 AS per_minute FROM (
         SELECT event_type, b, unnest([date_trunc('minute', ts) - INTERVAL 1 MINUTE, date_trunc('minute', ts)]) AS w FROM numbered) e
       LEFT JOIN (SELECT x.b, max(y.latest) - INTERVAL 5 MINUTE AS bound FROM latest x JOIN latest y ON y.b <= x.b - 2 GROUP BY 1) l ON l.b = e.b
       WHERE (bound IS NULL OR w + INTERVAL 2 MINUTE > bound) AND w + INTERVAL 2 MINUTE <= (SELECT max(latest) - INTERVAL 5 MINUTE FROM latest)
       GROUP BY 1, 2""", "numbered", "latest")


@query("m3_sliding_rate_append", _RATES)
def m3_append(s, d):
    out = new_path(s, "run")
    rates.append_rates(_feed(s, _numbered(s, d), "b"), f"{out}/rates", f"{out}/state", DELAY)
    return _minute(s.read.schema("start timestamp, event_type string, n bigint, per_minute double").parquet(f"{out}/rates"))


@query("m3_closed_rates", _RATES)
def m3_closed(s, d):
    return _minute(rates.closed_rates(_numbered(s, d), "b", DELAY))


@query("m2_first_documents", sql("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1"))
def m2_first(s, d):
    out = new_path(s, "run")
    with inc.keyed_state(s):
        inc.run_append(inc.first_documents(_feed(s, _numbered(s, d), "early").select("user_id"), "user_id"), f"{out}/rows", f"{out}/state")
    return s.read.schema("user_id bigint").parquet(f"{out}/rows").groupBy("user_id").agg(F.count("*").alias("n"))


@query("m2_unseen_within_delay", sql("SELECT event_id, 1 AS n FROM events"))
def m2_within(s, d):
    """Every event comes again with the next batch, as documents do that are fetched twice."""
    rows, out = _numbered(s, d).select("event_id", "ts", "early"), new_path(s, "run")
    again = rows.withColumn("early", c("early") + 1).filter(c("early") < BATCHES)
    unseen = inc.unseen_documents(_feed(s, rows.unionByName(again), "early"), "event_id", "ts", "60 days")
    inc.run_append(unseen, f"{out}/rows", f"{out}/state")
    return s.read.schema("event_id bigint").parquet(f"{out}/rows").groupBy("event_id").agg(F.count("*").cast("int").alias("n"))


cte("kinds", "SELECT *, CASE WHEN event_id // 40 % 3 = 0 THEN event_id % 2 ELSE 2 + event_id % 7 END AS kind FROM events")


def _lines(s, d) -> DataFrame:
    """The events as lines of progress logs, one log for each type of event."""
    rows = _numbered(s, d).withColumn("kind", F.expr("CASE WHEN event_id div 40 % 3 = 0 THEN event_id % 2 ELSE 2 + event_id % 7 END"))
    text = F.expr(
        """CASE kind WHEN 0 THEN concat('待翻译标题：', user_id, ' 个') WHEN 1 THEN concat('标题：', user_id, '/752') WHEN 2 THEN concat('待翻译法律：', user_id, ' 部')
           WHEN 3 THEN concat('[', user_id % 13, '/13] 法律', user_id, '（', event_id % 9 + 1, ' 条待翻译）') WHEN 4 THEN concat('引用 ', user_id, ' 部法律，', event_id % 5, ' 个术语注入')
           WHEN 5 THEN concat('批次 1/3 完成（', event_id % 60, 's，30条）') WHEN 6 THEN concat('已写回 f', event_id, '.json') WHEN 7 THEN '批次 2/3 失败（已重试3次）'
           ELSE concat('请求重试 ', event_id) END""")
    return rows.select(c("event_type").alias("source"), c("event_id").alias("seq"), "ts", text.alias("text"), "early")


def _last(value: str, *kinds: int) -> str:
    return f"arg_max({value}, event_id) FILTER (kind IN ({', '.join(map(str, kinds))}))"


_STATE = sql(
    f"""SELECT *, nullif(article_total_laws, 0) - nullif(article_done, 0) AS article_pending_laws FROM (
        SELECT event_type AS source, count(*) AS lines, count(*) FILTER (kind IN (7, 8)) AS errors, max(event_id) AS last_seq,
          {_last("CASE WHEN kind < 2 THEN 'titles' ELSE 'articles' END", 0, 1, 2, 3)} AS phase, {_last("CASE kind WHEN 0 THEN user_id ELSE 752 END", 0, 1)} AS title_total,
          {_last("user_id", 1)} AS title_done, {_last("CASE kind WHEN 2 THEN user_id ELSE 13 END", 2, 3)} AS article_total_laws, {_last("user_id % 13", 3)} AS article_done,
          {_last("'法律' || user_id", 3)} AS current_law, {_last("event_id % 9 + 1", 3)} AS current_articles, {_last("user_id", 4)} AS ref_laws, {_last("event_id % 5", 4)} AS glossary_terms,
          {_last("event_id % 60", 5)} AS batch_seconds, {_last("30::BIGINT", 5)} AS batch_articles, {_last("'1/3'", 5)} AS current_batch, {_last("coalesce(law, '')", 6)} AS last_completed
        FROM (SELECT *, last_value(CASE WHEN kind = 3 THEN '法律' || user_id END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id) AS law FROM kinds) GROUP BY 1)""", "kinds")


@query("m4_progress_state", _STATE)
def m4_state(s, d):
    return pro.log_state(_lines(s, d))


@query("m4_progress_state_stream", _STATE)
def m4_state_stream(s, d):
    """Each batch leaves its values and counts; reading folds them."""
    lines, out = _feed(s, _lines(s, d), "early"), new_path(s, "run")

    def handle(batch: DataFrame, number: int) -> None:
        pro.log_values(batch).write.mode("overwrite").parquet(f"{out}/values/batch={number}")
        pro.log_counts(batch).write.mode("overwrite").parquet(f"{out}/counts/batch={number}")

    inc.run_batches(lines, f"{out}/state", handle)
    values = s.read.schema(pro.VALUES).parquet(f"{out}/values")
    return pro.progress_state(pro.fold_values(values), pro.fold_counts(s.read.schema("source string, lines bigint, errors bigint, last_seq bigint").parquet(f"{out}/counts")))


_RUNS = sql(
    """SELECT source, phase, min(seq) AS start, max(seq) AS "end", count(*) AS n FROM (
         SELECT *, sum(CASE WHEN phase = before THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY seq) AS run FROM (
           SELECT *, lag(phase) OVER (PARTITION BY source ORDER BY seq) AS before FROM (
             SELECT event_type AS source, event_id AS seq, CASE WHEN kind < 2 THEN 'titles' ELSE 'articles' END AS phase FROM kinds WHERE kind < 4)))
       GROUP BY source, phase, run""", "kinds")


@query("m4_phase_runs", _RUNS)
def m4_runs(s, d):
    return pro.phase_runs(_lines(s, d), 500).drop("start_ts", "end_ts")


@query("m4_phase_runs_stream", _RUNS)
def m4_runs_stream(s, d):
    out = new_path(s, "run")
    inc.run_batches(_feed(s, _lines(s, d), "early"), f"{out}/state", inc.delta_handler(f"{out}/runs", pro.phase_runs))
    runs = s.read.schema(pro.RUNS + ", batch bigint").parquet(f"{out}/runs")
    return pro.fold_runs(runs, "batch").select("source", "phase", "start", "end", "n")


@query("m4_log_errors", sql("SELECT event_type AS source, event_id AS seq, CASE kind WHEN 7 THEN '批次 2/3 失败（已重试3次）' ELSE '请求重试 ' || event_id END AS error FROM kinds WHERE kind >= 7", "kinds"))
def m4_errors(s, d):
    return pro.log_errors(_lines(s, d))


@query("m4_recent_lines", sql("SELECT event_type AS source, event_id AS seq, rn AS place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 20"))
def m4_recent(s, d):
    return pro.recent_lines(_lines(s, d)).select("source", "seq", "place")

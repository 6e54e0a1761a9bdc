"""Streaming and source queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statutelake.operators import classify as cl
from statutelake.operators import documents as doc
from statutelake.operators.lineage import new_path
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, sql
from statutelake.plans.registry import query
from statutelake.sources import readers, sinks
from statutelake.streaming import incremental as inc

L, N, A, D, T = corpus.laws, corpus.nodes, corpus.articles, corpus.cases, corpus.table
c = F.col


def _folder(spark) -> str:
    return new_path(spark, "run")


def _stream(s, d, name: str, files: int = inc.FILES_PER_BATCH):
    return inc.read_stream(s, f"{d.rstrip('/')}/{name}.parquet", T(s, d, name).schema, files)


def _events(s, d):
    return _stream(s, d, "events").withColumn("ts", c("ts").cast("timestamp"))


def _deltas(stream, s, work):
    """Run a stream over all its input; the deltas that ``work`` makes of its batches."""
    out = _folder(s)
    schema = work(s.createDataFrame([], stream.schema)).schema
    inc.run_batches(stream, f"{out}/state", inc.delta_handler(f"{out}/data", work))
    return inc.read_deltas(s, f"{out}/data", schema)


@query("m2_unseen_documents", sql("SELECT DISTINCT user_id FROM events"))
def m2(s, d):
    out, stream = _folder(s), _events(s, d).select("user_id")
    inc.run_batches(stream, f"{out}/state", inc.unseen_handler(f"{out}/data", "user_id", stream.schema))
    return inc.read_deltas(s, f"{out}/data", stream.schema).select("user_id")


@query("m3_sliding_rate", sql(
    """SELECT to_timestamp(m * 60) AT TIME ZONE 'UTC' AS start, event_type, count(*) AS n, count(*) / 2.0 AS per_minute FROM (
       SELECT event_type, unnest([CAST(floor(epoch(ts) / 60) AS BIGINT) - 1, CAST(floor(epoch(ts) / 60) AS BIGINT)]) AS m FROM events) GROUP BY 1, 2"""))
def m3(s, d):
    return inc.sliding_rate(T(s, d, "events"))


@query("m3_sliding_rate_stream", sql(
    """SELECT strftime(to_timestamp(m * 60) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM (
       SELECT event_type, unnest([CAST(floor(epoch(ts) / 60) AS BIGINT) - 1, CAST(floor(epoch(ts) / 60) AS BIGINT)]) AS m FROM events) GROUP BY 1, 2"""))
def m3_stream(s, d):
    return inc.fold_rates(_deltas(_events(s, d), s, inc.sliding_rate)).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


_LOG = "SELECT event_type AS source, ts, event_id AS seq, CASE WHEN event_type = 'error' THEN 'ERROR' WHEN user_id < 20 THEN 'phase=p' || user_id ELSE 'done=' || user_id END AS text FROM events"


def _log(events):
    text = F.when(c("event_type") == "error", F.concat(F.lit("ERROR"))).when(c("user_id") < 20, F.concat(F.lit("phase=p"), "user_id")).otherwise(F.concat(F.lit("done="), "user_id"))
    return events.select(c("event_type").alias("source"), "ts", c("event_id").alias("seq"), text.alias("text"))


_STATE = f"""SELECT source, arg_max(CASE WHEN text LIKE 'done=%' THEN CAST(text[6:] AS BIGINT) END, (ts, seq)) FILTER (text LIKE 'done=%') AS done,
  arg_max(text[7:], (ts, seq)) FILTER (text LIKE 'phase=%') AS phase, count(*) FILTER (text LIKE '%ERROR%') AS errors, count(*) AS lines FROM ({_LOG}) GROUP BY 1"""


@query("m4_log_state", sql(_STATE))
def m4(s, d):
    return inc.log_state(_log(T(s, d, "events"))).drop("last_ts")


@query("m4_log_state_stream", sql(_STATE))
def m4_stream(s, d):
    return inc.fold_log_state(_deltas(_log(_events(s, d)), s, inc.log_delta)).drop("last_ts")


@query("m5_upsert_stream", sql("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE o_orderstatus END AS note FROM orders"))
def m5_stream(s, d):
    target = T(s, d, "orders").select("o_orderkey", F.when(c("o_orderkey") % 2 == 0, c("o_orderpriority")).otherwise("").alias("note"))
    updates = _stream(s, d, "orders").select("o_orderkey", c("o_orderstatus").alias("note"))
    out = _folder(s)
    inc.run_batches(updates, f"{out}/state", inc.upsert_handler(f"{out}/data", ["o_orderkey"], ["note"]))
    return inc.filled(target, inc.read_deltas(s, f"{out}/data", updates.schema), ["o_orderkey"], ["note"])


@query("m6_ids_stream", sql("SELECT 'f' || p_partkey AS filename, CASE WHEN p_size < 25 THEN 'a' ELSE 'b' END AS category, CASE WHEN p_size < 25 THEN 0 ELSE 1000000000000 END + row_number() OVER (PARTITION BY p_size < 25 ORDER BY p_type, 'f' || p_partkey) - 1 AS id FROM part"))
def m6_stream(s, d):
    base = s.createDataFrame([], "filename string, category string, id bigint")
    docs = _stream(s, d, "part").select(
        F.concat(F.lit("f"), "p_partkey").alias("filename"), F.when(c("p_size") < 25, "a").otherwise("b").alias("category"), c("p_type").alias("pub_date"))
    out = _folder(s)
    inc.run_batches(docs, f"{out}/state", inc.id_handler(f"{out}/data", base, {"a": (0, 1_000_000_000_000), "b": (1_000_000_000_000, 1_000_000_000_000)}))
    return inc.read_deltas(s, f"{out}/data", base.schema).select(*base.columns)


@query("a6_prefer_source", sql("SELECT doc_id, 'text' AS kind FROM documents WHERE lang = 'en' UNION ALL SELECT page_id, 'page' FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')"))
def a6(s, d):
    return readers.prefer_source(T(s, d, "documents").filter("lang = 'en'").select("doc_id", F.lit("text").alias("kind")), T(s, d, "pages").select(c("page_id").alias("doc_id"), F.lit("page").alias("kind")), "doc_id")


@query("a7_load_catalog", sql(
    """SELECT l.id, x.effective_date AS catalog_effective, x.category AS catalog_category FROM laws l LEFT JOIN (
       SELECT title, pub_date, arg_min(effective_date, id) AS effective_date, arg_min(category, id) AS category FROM laws WHERE source = 'flk' GROUP BY 1, 2) x USING (title, pub_date)""", "laws"))
def a7(s, d):
    catalog = L(s, d).filter("source = 'flk'").select("title", "pub_date", "effective_date", "category", "id")
    return readers.load_catalog(L(s, d).select("id", "title", "pub_date"), catalog, "id").select("id", "catalog_effective", "catalog_category")


cte("nested_ids", "SELECT DISTINCT l_partkey AS law_id FROM lineitem")


def _statute_files(s, d):
    """Statutes as nested JSON documents: one chapter per part row."""
    out = _folder(s)
    article = F.struct(F.lit("第一条　").alias("title"), F.concat(F.lit("第一条　"), "p_name").alias("content"), F.lit(1).alias("order_index"), F.lit(2).alias("global_order"))
    chapter = F.struct(F.lit("第一章　总则").alias("title"), F.lit(1).alias("order_index"), F.lit(1).alias("global_order"), F.array(article).alias("articles"))
    T(s, d, "part").select(c("p_partkey").alias("law_id"), c("p_name").alias("title"), F.array(chapter).alias("chapters")).write.json(f"{out}/docs")
    return out


@query("a1_g4_flatten", sql(
    """SELECT p_partkey AS law_id, 'chapter' AS type, '第一章　总则' AS content, 1 AS global_order, 1 AS chapter_num, CAST(NULL AS INT) AS article_num FROM part
       UNION ALL SELECT p_partkey, 'article', '第一条　' || p_name, 2, 1, 1 FROM part"""))
def a1_g4(s, d):
    from statutelake.sources import schemas

    docs = s.read.schema(schemas.STATUTE).json(f"{_statute_files(s, d)}/docs")
    return readers.flatten(docs).select("law_id", "type", "content", "global_order", "chapter_num", "article_num")


@query("a11_write_corpus", sql("SELECT category, count(*) AS n FROM laws GROUP BY 1", "laws"))
def a11(s, d):
    out = _folder(s)
    sinks.write_corpus({"laws": L(s, d)}, out, {"laws": ["category"]})
    return s.read.parquet(f"{out}/laws").groupBy("category").agg(F.count("*").alias("n"))


@query("a12_write_menu", sql("SELECT menu_group, replace(CASE WHEN subgroup = '' THEN '_' ELSE subgroup END, '/', '-') AS subgroup, count(*) AS n FROM menu WHERE is_current = 1 GROUP BY 1, 2", "menu"))
def a12(s, d):
    out = _folder(s)
    sinks.write_menu(cl.menu_path(cl.subject_area(L(s, d).filter("is_current = 1"))).select("menu_group", "subgroup", "id", "title"), out)
    return s.read.schema("id bigint, title string, menu_group string, subgroup string").json(out).groupBy("menu_group", "subgroup").agg(F.count("*").alias("n"))


@query("a13_write_rendered", sql("SELECT type, count(*) AS n FROM nodes WHERE type <> 'article' GROUP BY 1", "nodes"))
def a13(s, d):
    out = _folder(s)
    lines = doc.node_markdown(N(s, d).withColumn("content", F.replace("content", F.lit("\n"), F.lit(" ")))).join(
        N(s, d).select("law_id", "global_order", "type"), ["law_id", "global_order"])
    sinks.write_rendered(lines, out, ["type"], ["law_id", "global_order"])
    text = s.read.schema("value string, type string").text(out)
    return text.filter("type <> 'article'").groupBy("type").agg(F.count("*").alias("n"))

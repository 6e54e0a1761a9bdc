"""Queries that write, damage, change and read files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statutelake.operators import identity as ident
from statutelake.operators import structure as st
from statutelake.operators.lineage import new_path
from statutelake.plans import corpus
from statutelake.plans.oracle import cte, sql
from statutelake.plans.registry import query
from statutelake.sources import manifest as man
from statutelake.sources import readers, schemas
from statutelake.sources.sinks import write_texts

T, c = corpus.table, F.col


def _files(rows: DataFrame, path: str) -> str:
    """One file for each row (name, text), ``part-<name>.txt`` in one of 256 folders; a file that is there is written anew."""
    folder = F.concat(F.lit("folder="), F.crc32(c("name").cast("string")) % 256)
    cut = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "name")
    write_texts(cut.select(F.concat(folder, F.lit("/part-"), "name", F.lit(".txt")).alias("path"), "text"), path)
    return path


def _documents(rows: DataFrame, path: str, damaged: str) -> str:
    """Documents (name, document) as JSON files; where ``damaged`` holds a file breaks off before its end."""
    text = rows.select("name", F.to_json("document").alias("text"))
    return _files(text.withColumn("text", F.expr(f"CASE WHEN {damaged} THEN substring(text, 1, length(text) - 3) ELSE text END")), path)


TXT = "*.txt"
SUPPLIER = ["s_suppkey AS name", "s_suppkey AS k", "s_name AS title", "concat(s_name, ' text') AS body"]


def _suppliers(s, d) -> DataFrame:
    return T(s, d, "supplier").selectExpr(*SUPPLIER)


# A2: two folders; every 5th document has no key of its own, every 7th file is damaged.
_KEY = "CASE WHEN k % 5 <> 0 THEN concat('own/', k) END"


def _gazette(s, d) -> dict[str, str]:
    out, rows = new_path(s, "files"), _suppliers(s, d)
    document = rows.select("name", "k", F.struct(
        "title", c("body").alias("content"), F.expr(_KEY).alias("doc_key"), F.lit(2020).alias("year"), F.expr("CASE WHEN k % 2 = 0 THEN 'n' END").alias("case_number")).alias("document"))
    return {source: _documents(document.filter(c("k") % 2 == i), f"{out}/{source}", "name % 7 = 0") for i, source in enumerate(("al", "sfwj"))}


@query("a2_read_gazette", sql(
    """SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'al' ELSE 'sfwj' END AS source, s_name AS title, (s_name || ' text') AS content, 2020 AS year, CASE WHEN s_suppkey % 2 = 0 THEN 'n' END AS case_number,
       CASE WHEN s_suppkey % 5 <> 0 THEN 'own/' || s_suppkey WHEN s_suppkey % 2 = 0 THEN 'al/part' ELSE 'sfwj/part' END AS doc_key FROM supplier WHERE s_suppkey % 7 <> 0"""))
def a2(s, d):
    docs = readers.read_gazette(s, _gazette(s, d), TXT)
    # A key made of a file's name ends in what the file is numbered by.
    return docs.select("source", "title", "content", "year", "case_number", F.regexp_replace("doc_key", "/part-.*$", "/part").alias("doc_key"))


@query("a2_damaged_files", sql("SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'al' ELSE 'sfwj' END AS source, s_suppkey AS name FROM supplier WHERE s_suppkey % 7 = 0"))
def a2_damaged(s, d):
    out = None
    for source, path in _gazette(s, d).items():
        part = readers.read_damaged(s, path, schemas.GAZETTE, TXT).select(F.lit(source).alias("source"), F.regexp_extract("file", "/part-([0-9]+)", 1).cast("bigint").alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


@query("a3_read_translations", sql(
    """SELECT s_suppkey AS law_id, s_name AS title_en, i - 1 AS pos, 'Article ' || i AS article_number, CASE WHEN i <> 2 THEN (s_name || ' text') || i END AS content_en FROM (
         SELECT *, unnest(range(1, 1 + s_suppkey % 4)) AS i FROM supplier) WHERE s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0
       UNION ALL SELECT s_suppkey, s_name, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 4 = 0 AND s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0"""))
def a3(s, d):
    """Every 7th file is damaged, every 11th has no law; every 4th law has no articles."""
    article = "struct(concat('Article ', i) AS article_number, CASE WHEN i <> 2 THEN concat(body, i) END AS content_en)"
    articles = F.expr(f"CASE WHEN k % 4 = 0 THEN array() ELSE transform(sequence(1, cast(k % 4 AS int)), i -> {article}) END")
    rows = _suppliers(s, d).select("name", F.struct(F.expr("CASE WHEN k % 11 <> 0 THEN k END").alias("law_id"), c("title").alias("title_en"), articles.alias("articles")).alias("document"))
    found = readers.read_translations(s, _documents(rows, new_path(s, "files"), "name % 7 = 0"), TXT)
    return found.select("law_id", "title_en", "pos", "article_number", "content_en")


@query("a4_read_gazette_translations", sql(
    """SELECT 'own/' || s_suppkey AS doc_key, s_name AS title_en, (s_name || ' text') AS full_text_en, CASE WHEN s_suppkey % 3 <> 0 THEN 'gist' END AS ruling_gist_en FROM supplier
       WHERE s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0"""))
def a4(s, d):
    """Every 7th file is damaged, every 5th document has no key; every 3rd gist is empty."""
    rows = _suppliers(s, d).select("name", F.struct(
        F.expr(_KEY).alias("doc_key"), c("title").alias("title_en"), c("body").alias("full_text_en"), F.expr("CASE WHEN k % 3 <> 0 THEN 'gist' ELSE '' END").alias("ruling_gist_en")).alias("document"))
    found = readers.read_gazette_translations(s, _documents(rows, new_path(s, "files"), "name % 7 = 0"), TXT)
    return found.select("doc_key", "title_en", "full_text_en", "ruling_gist_en")


@query("a5_read_text_files", sql(
    """SELECT CAST(i AS BIGINT) - 1 AS line_no, trim(l) AS text FROM (SELECT unnest(s) AS l, generate_subscripts(s, 1) AS i FROM (
         SELECT string_split('No. ' || item_id || chr(10) || ' ' || chr(10) || replace(text, '. ', ' .' || chr(10)), chr(10)) AS s FROM benchmark)) WHERE trim(l) <> ''"""))
def a5(s, d):
    rows = T(s, d, "benchmark").select(c("item_id").alias("name"), F.concat(F.lit("No. "), "item_id", F.lit("\n \n"), F.replace("text", F.lit(". "), F.lit(" .\n"))).alias("text"))
    return readers.read_lines(s, _files(rows, new_path(s, "files"))).select("line_no", "text")


# Statutes of all shapes: chapters with sections, parts with chapters and direct articles, chapters alone, text alone, nothing.
def _statutes(s, d) -> DataFrame:
    def article(i: str, g: str) -> str:
        return f"struct('第一条　' AS title, concat(title, '-', {g}) AS content, {i} AS order_index, {g} AS global_order)"

    section = f"struct(concat('第', j, '节') AS title, j AS order_index, i * 100 + j * 10 AS global_order, array({article('1', 'i * 100 + j * 10 + 1')}, {article('2', 'i * 100 + j * 10 + 2')}) AS articles)"
    deep = f"transform(sequence(1, 2), i -> struct(concat(' 第', i, '章 ') AS title, i AS order_index, i * 100 AS global_order, transform(sequence(1, 2), j -> {section}) AS sections, array() AS articles))"
    flat = f"transform(sequence(1, 3), i -> struct(concat('第', i, '章') AS title, i AS order_index, i * 100 AS global_order, array({article('1', 'i * 100 + 1')}) AS articles))"
    inner = f"struct('第1章' AS title, 1 AS order_index, p * 1000 + 100 AS global_order, array({article('2', 'p * 1000 + 101')}) AS articles)"
    direct = f"struct('_DIRECT_' AS title, 0 AS order_index, p * 1000 + 50 AS global_order, array({article('1', 'p * 1000 + 51')}) AS articles)"
    parts = f"transform(sequence(1, 2), p -> struct(concat('第', p, '编') AS title, p AS order_index, p * 1000 AS global_order, array({direct}, {inner}) AS chapters))"
    text = "to_json(struct(k AS law_id, title, {}))"
    return _suppliers(s, d).select("name", F.expr(
        f"""CASE k % 5 WHEN 0 THEN {text.format(deep + ' AS chapters')} WHEN 1 THEN {text.format(parts + ' AS parts')} WHEN 2 THEN {text.format(flat + ' AS chapters')}
            WHEN 3 THEN {text.format("concat(' ', body, ' ') AS full_text")} ELSE {text.format("'  ' AS full_text")} END""").alias("text"))


_NODE = "SELECT s_suppkey AS law_id, '{}' AS type, {} AS content, {} AS global_order, {} AS part_num, {} AS chapter_num, {} AS section_num, {} AS article_num FROM {} WHERE s_suppkey % 5 = {}"
_IJ = "(SELECT *, unnest([1, 1, 2, 2]) AS i, unnest([1, 2, 1, 2]) AS j FROM supplier)"
_I3, _P = "(SELECT *, unnest([1, 2, 3]) AS i FROM supplier)", "(SELECT *, unnest([1, 2]) AS p FROM supplier)"
_I2 = "(SELECT *, unnest([1, 2]) AS i FROM supplier)"


@query("g4_flatten_all_shapes", sql("SELECT law_id, type, content, CAST(global_order AS INT) AS global_order, CAST(part_num AS INT) AS part_num, CAST(chapter_num AS INT) AS chapter_num, CAST(section_num AS INT) AS section_num, CAST(article_num AS INT) AS article_num FROM (" + " UNION ALL ".join([
    _NODE.format("chapter", "'第' || i || '章'", "i * 100", "NULL", "i", "NULL", "NULL", _I2, 0),
    _NODE.format("section", "'第' || j || '节'", "i * 100 + j * 10", "NULL", "i", "j", "NULL", _IJ, 0),
    _NODE.format("article", "s_name || '-' || (i * 100 + j * 10 + 1)", "i * 100 + j * 10 + 1", "NULL", "i", "j", "1", _IJ, 0),
    _NODE.format("article", "s_name || '-' || (i * 100 + j * 10 + 2)", "i * 100 + j * 10 + 2", "NULL", "i", "j", "1", _IJ, 0),
    _NODE.format("part", "'第' || p || '编'", "p * 1000", "p", "NULL", "NULL", "NULL", _P, 1),
    _NODE.format("article", "s_name || '-' || (p * 1000 + 51)", "p * 1000 + 51", "p", "NULL", "NULL", "1", _P, 1),
    _NODE.format("chapter", "'第1章'", "p * 1000 + 100", "p", "1", "NULL", "NULL", _P, 1),
    _NODE.format("article", "s_name || '-' || (p * 1000 + 101)", "p * 1000 + 101", "p", "1", "NULL", "1", _P, 1),
    _NODE.format("chapter", "'第' || i || '章'", "i * 100", "NULL", "i", "NULL", "NULL", _I3, 2),
    _NODE.format("article", "s_name || '-' || (i * 100 + 1)", "i * 100 + 1", "NULL", "i", "NULL", "1", _I3, 2),
    _NODE.format("article", "trim((s_name || ' text'))", "1", "NULL", "NULL", "NULL", "1", "supplier", 3),
]) + ")"))
def g4_all(s, d):
    nodes = readers.flatten(readers.read_statutes(s, _files(_statutes(s, d), new_path(s, "files")), TXT))
    return nodes.select("law_id", "type", "content", "global_order", "part_num", "chapter_num", "section_num", "article_num")


# A contents block whose headings come again, one whose headings are the only ones, and texts without a block.
_LINES = {
    0: ["标题", "目　录", "第一章　总则", "第二章　分则", "第一章　总则", "第一条　甲", "第二章　分则", "第二条　乙"],
    1: ["标题", "目录", "前言", "第一章　总则", "第一节　一般", "说明", "第一条　甲", "第二条　乙"],
    2: ["标题", "第一章　总则", "第一条　甲"],
    3: ["目录", "说明", "后文"],
}
_KEPT = {0: [0, 4, 5, 6, 7], 1: [0, 3, 4, 6, 7], 2: [0, 1, 2], 3: [1, 2]}


@query("g2_drop_contents_block", sql(" UNION ALL ".join(
    f"SELECT s_suppkey AS doc, {i}::BIGINT AS line_no, '{_LINES[k][i]}' AS text FROM supplier WHERE s_suppkey % 4 = {k}" for k, kept in _KEPT.items() for i in kept)))
def g2(s, d):
    lines = F.expr("CASE k % 4 " + " ".join(f"WHEN {k} THEN array({', '.join(repr(x) for x in v)})" for k, v in _LINES.items()) + " END")
    rows = _suppliers(s, d).select(c("k").alias("doc"), F.posexplode(lines).alias("line_no", "text")).withColumn("line_no", c("line_no").cast("bigint"))
    return st.drop_toc_block(st.classify_lines(rows)).select("doc", "line_no", "text")


@query("m1_file_manifest", sql(
    """SELECT s_suppkey AS path, CASE WHEN s_suppkey % 7 = 0 THEN 'new' WHEN s_suppkey % 5 = 0 THEN 'modified' ELSE 'no_output' END AS change FROM supplier
       WHERE s_suppkey % 7 = 0 OR s_suppkey % 5 = 0 OR s_suppkey % 3 = 0 UNION ALL SELECT -1 - n_nationkey, 'removed' FROM nation"""))
def m1_files(s, d):
    """Files are written and listed; some are written anew with another text, some are new, and the old list knows files that are gone."""
    path, rows = new_path(s, "files"), _suppliers(s, d).select("name", c("body").alias("text"))
    _files(rows.filter(c("name") % 7 != 0), path)
    name = F.regexp_extract("path", "/part-(-?[0-9]+)", 1).cast("bigint")
    first = man.refresh(s, path, s.createDataFrame([], man.MANIFEST), TXT)
    gone = T(s, d, "nation").select(F.concat(F.lit("/part-"), -1 - c("n_nationkey")).alias("path"), F.lit(1).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified"), F.lit("x").alias("md5"))
    out = new_path(s, "manifest")
    first.unionByName(gone).write.parquet(out)
    old = s.read.schema(man.MANIFEST).parquet(out)
    _files(rows.filter(c("name") % 7 == 0), path)
    _files(rows.filter((c("name") % 5 == 0) & (c("name") % 7 != 0)).withColumn("text", F.concat("text", F.lit(" changed"))), path)
    now = man.refresh(s, path, old, TXT)
    outputs = rows.filter(c("name") % 3 != 0).select(c("name").alias("path"))
    return ident.changed_files(man.by_name(old, name), man.by_name(now, name), outputs)

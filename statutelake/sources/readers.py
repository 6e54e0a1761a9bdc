"""Readers of nested documents, text lines and catalogues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statutelake.functions.text import clean_article, stem_date, strip
from statutelake.operators.ordered import top_per_group
from statutelake.functions.numerals import numeral_to_int
from statutelake.sources import schemas


def _stem() -> Column:
    return F.regexp_replace(F.url_decode(F.col("_metadata.file_name")), r"\.[^.]+$", "")


def _json(spark: SparkSession, path: str, schema: str, glob: str) -> DataFrame:
    """One document per file; an unreadable file is skipped, not fatal.

    A file that parses but has a value of another type keeps its other fields.
    """
    raw = (
        spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).json(path)
    )
    readable = F.col("_corrupt_record").isNull() | F.coalesce(*[F.col(c).cast("string") for c in ("title", "title_en", "doc_key", "law_id") if c in raw.columns]).isNotNull()
    return raw.withColumn("stem", _stem()).filter(readable).drop("_corrupt_record")


def read_damaged(spark: SparkSession, path: str, schema: str, glob: str = "*.json") -> DataFrame:
    """(file, record) of the files that are no JSON document of the schema; the readers of documents skip them."""
    names = [f.split()[0] for f in ("title", "title_en", "doc_key", "law_id") if f"{f} " in schema]
    raw = (
        spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).json(path)
    )
    empty = F.coalesce(*[F.col(c).cast("string") for c in names]).isNull()
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_corrupt_record").alias("record"), empty.alias("empty")).filter(
        F.col("record").isNotNull() & F.col("empty")).select("file", "record")


def read_statutes(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """A1: nested statutes with their file stem; index files are skipped."""
    return _json(spark, path, schemas.STATUTE, glob).filter(~F.contains("stem", F.lit("index")))


def read_gazette(spark: SparkSession, folders: dict[str, str], glob: str = "*.json") -> DataFrame:
    """A2: court documents of several sources with a stable key."""
    tables = [
        _json(spark, path, schemas.GAZETTE, glob).withColumn("source", F.lit(source)).withColumn("doc_key", F.coalesce("doc_key", F.concat_ws("/", F.lit(source), "stem")))
        for source, path in folders.items()
    ]
    return reduce(DataFrame.unionByName, tables)


def read_translations(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """A3: one row per translated article, in file order."""
    docs = _json(spark, path, schemas.TRANSLATION, glob).filter(F.col("law_id").isNotNull())
    exploded = docs.select("law_id", "title_en", "stem", F.posexplode_outer("articles").alias("pos", "article"))
    return exploded.select("law_id", "title_en", "stem", "pos", "article.article_number", "article.content_en")


def read_gazette_translations(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """A4: translations of court documents that carry a key."""
    docs = _json(spark, path, schemas.GAZETTE_TRANSLATION, glob).filter(F.coalesce("doc_key", F.lit("")) != "").drop("stem")
    return docs.select("doc_key", *[F.nullif(c, F.lit("")).alias(c) for c in docs.columns if c != "doc_key"])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A5: text files as numbered, trimmed, non-empty lines."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    lines = whole.select(_stem().alias("doc"), F.posexplode(F.split("value", "\r\n|[\n\r]")).alias("line_no", "raw"))
    return lines.select("doc", F.col("line_no").cast("bigint").alias("line_no"), strip(F.col("raw")).alias("text")).filter(F.col("text") != "")


def prefer_source(preferred: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """A document of the preferred source replaces its twin."""
    return preferred.unionByName(other.join(preferred.select(key), key, "left_anti"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATALOG).option("header", True).csv(path)


def load_catalog(docs: DataFrame, catalog: DataFrame, order: str) -> DataFrame:
    """Effective date and category by title and date; the first catalogue
    row of a key counts."""
    first = top_per_group(catalog, ["title", "pub_date"], [F.col(order)], 1).select(
        "title", "pub_date", F.col("effective_date").alias("catalog_effective"), F.col("category").alias("catalog_category"))
    return docs.join(first, ["title", "pub_date"], "left")


def flatten(statutes: DataFrame) -> DataFrame:
    """Nested statutes to node rows with coordinates.

    A chapter named _DIRECT_ only holds articles that belong to the part, and
    gives no node. A statute without any tree is one article of its full text.
    """
    law = F.col("law_id")
    none = F.lit(None).cast("int")
    in_parts = statutes.filter(F.col("parts").isNotNull()).select(law.alias("law_id"), F.explode("parts").alias("p"))
    part_rows = in_parts.select("law_id", F.lit("part").alias("type"), F.trim("p.title").alias("title"), F.trim("p.title").alias("content"),
                                "p.order_index", "p.global_order", F.col("p.order_index").alias("part_num"), none.alias("chapter_num"), none.alias("section_num"))
    chapters = in_parts.select("law_id", F.col("p.order_index").alias("part_num"), F.explode("p.chapters").alias("c")).unionByName(
        statutes.filter(F.col("parts").isNull()).select("law_id", none.alias("part_num"), F.explode("chapters").alias("c")))
    direct = F.startswith("c.title", F.lit("_DIRECT_"))
    chapters = chapters.withColumn("chapter_num", F.when(~direct, F.col("c.order_index"))).withColumn("direct", direct)
    chapter_rows = chapters.filter(~F.col("direct")).select(
        "law_id", F.lit("chapter").alias("type"), F.trim("c.title").alias("title"), F.trim("c.title").alias("content"), "c.order_index", "c.global_order", "part_num", "chapter_num", none.alias("section_num"))
    sections = chapters.filter(~F.col("direct")).select("law_id", "part_num", "chapter_num", F.explode("c.sections").alias("s"))
    section_rows = sections.select("law_id", F.lit("section").alias("type"), F.trim("s.title").alias("title"), F.trim("s.title").alias("content"),
                                   "s.order_index", "s.global_order", "part_num", "chapter_num", F.col("s.order_index").alias("section_num"))
    arts = chapters.select("law_id", "part_num", "chapter_num", none.alias("section_num"), F.explode("c.articles").alias("a")).unionByName(
        sections.select("law_id", "part_num", "chapter_num", F.col("s.order_index").alias("section_num"), F.explode("s.articles").alias("a")))
    article_rows = arts.select("law_id", F.lit("article").alias("type"), F.trim("a.title").alias("title"), F.col("a.content").alias("content"),
                               "a.order_index", "a.global_order", "part_num", "chapter_num", "section_num")
    bare = (F.size(F.coalesce("chapters", F.array())) <= 0) & F.col("parts").isNull() & (F.trim(F.coalesce("full_text", F.lit(""))) != "")
    whole_rows = statutes.filter(bare).select(
        "law_id", F.lit("article").alias("type"), F.lit("").alias("title"), clean_article(F.trim("full_text")).alias("content"), F.lit(1).alias("order_index"),
        F.lit(1).alias("global_order"), none.alias("part_num"), none.alias("chapter_num"), none.alias("section_num"))
    nodes = reduce(DataFrame.unionByName, [part_rows, chapter_rows, section_rows, article_rows, whole_rows])
    label = F.regexp_replace("title", "[　 ]+$", "")
    number = numeral_to_int(F.nullif(F.regexp_extract(label, "^第([零一二三四五六七八九十百千]+)条", 1), F.lit("")))
    is_article = F.col("type") == "article"
    return nodes.withColumn("article_number", F.when(is_article, label)).withColumn("article_num", F.when(is_article, F.coalesce(number, "order_index")))


def law_rows(statutes: DataFrame) -> DataFrame:
    """Law attributes of the nested documents; a missing flag means current."""
    return statutes.select(
        F.col("law_id").alias("id"), "title", F.col("stem").alias("filename"), "category", "legal_domain", "pub_date", "effective_date", "promulgation_info",
        "issuing_org", "doc_number", "total_articles", "full_text", stem_date(F.col("stem")).alias("version_date"),
        F.when(F.coalesce(F.trim("repealed_by"), F.lit("")) != "", 0).otherwise(F.coalesce("is_current", F.lit(1))).alias("is_current"))

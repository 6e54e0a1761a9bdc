"""Filters, joins, aggregates, windows, top-k and set jobs (B, C, D, E, F, N).

Statute tables are large on both sides, so no side is broadcast by hand: Spark
broadcasts what its size statistics allow and splits skewed keys otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statutelake.operators.ordered import lag_by_segment, large_keys, rank_by_segment, top_per_group

STATUTE_DOMAINS = ["宪法相关法", "民法典", "民法商法", "行政法", "经济法", "社会法", "刑法", "诉讼与非诉讼程序法"]


def missing(col: Column) -> Column:
    """NULL and blank both mean 'no value'."""
    return F.coalesce(F.trim(col), F.lit("")) == ""


def filled(col: str) -> Column:
    return ~missing(F.col(col))


# B: filters


def current_laws(laws: DataFrame) -> DataFrame:
    """B1: current laws; the second source only if it has a domain."""
    return laws.filter((F.col("is_current") == 1) & ((F.col("source") == "flk") | ((F.col("source") == "gazette") & (F.col("legal_domain") != ""))))


def article_range(nodes: DataFrame, law: int, lo: int, hi: int) -> DataFrame:
    """B2: articles lo..hi of one law."""
    return nodes.filter((F.col("law_id") == law) & (F.col("type") == "article") & F.col("article_num").between(lo, hi))


def reading_order(nodes: DataFrame) -> DataFrame:
    """Nodes in reading order (range-partitioned sort)."""
    return nodes.orderBy("law_id", "global_order")


def find_laws(laws: DataFrame, term: str) -> DataFrame:
    """Title or alias contains a fragment."""
    return laws.filter(F.col("title").contains(term) | F.col("aliases").contains(term))


def laws_by_org(laws: DataFrame, org: str, category: str) -> DataFrame:
    """Issuing body and category, newest first."""
    return laws.filter((F.col("issuing_org") == org) & (F.col("category") == category)).orderBy(F.desc("pub_date"), "id")


def title_contains(laws: DataFrame, keyword: str) -> DataFrame:
    """Title keyword subset."""
    return laws.filter(F.col("title").contains(keyword))


def latin_articles(nodes: DataFrame) -> DataFrame:
    """Articles with Latin letters."""
    return nodes.filter((F.col("type") == "article") & F.col("content").rlike("[A-Za-z]"))


def apply_blocklist(laws: DataFrame, blocklist: DataFrame, key: str = "id") -> DataFrame:
    """Drop listed ids."""
    return laws.join(blocklist.select(key), key, "left_anti")


def multi_paragraph(nodes: DataFrame, breaks: int) -> DataFrame:
    """Articles with at least ``breaks`` line breaks."""
    return nodes.filter((F.col("type") == "article") & (F.length("content") - F.length(F.replace("content", F.lit("\n"), F.lit(""))) >= breaks))


def outline(nodes: DataFrame) -> DataFrame:
    """Headings without articles, in order."""
    return nodes.filter(F.col("type").isin("part", "chapter", "section")).orderBy("law_id", "global_order")


# C: joins


def articles_with_law(nodes: DataFrame, laws: DataFrame) -> DataFrame:
    """Articles with title, category and currency of their law."""
    attributes = laws.select(F.col("id").alias("law_id"), F.col("title").alias("law_title"), "category", "is_current")
    return nodes.filter(F.col("type") == "article").join(attributes, "law_id")


def translated_per_law(nodes: DataFrame) -> DataFrame:
    return (
        nodes.filter(F.col("type") == "article")
        .groupBy("law_id")
        .agg(F.count("*").alias("articles"), F.count_if(filled("content_en")).alias("translated"))
    )


def coverage_by_domain(laws: DataFrame, nodes: DataFrame, domains: list[str] = STATUTE_DOMAINS) -> DataFrame:
    """Laws and translated laws per domain, in a fixed domain order.

    Articles are folded to one row per law first; the distinct counts of the
    outer grouping are then plain counts.
    """
    per_law = translated_per_law(nodes).select(F.col("law_id").alias("id"), "translated")
    current = laws.filter((F.col("is_current") == 1) & F.col("legal_domain").isin(domains))
    order = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("legal_domain"))
    return (
        current.select("id", "legal_domain")
        .join(per_law, "id", "left")
        .groupBy("legal_domain")
        .agg(F.count("*").alias("laws"), F.count_if(F.col("translated") > 0).alias("translated_laws"))
        .withColumn("domain_order", order.cast("int"))
    )


def untranslated_laws(laws: DataFrame, nodes: DataFrame) -> DataFrame:
    """Current laws without any translated article."""
    done = nodes.filter((F.col("type") == "article") & filled("content_en")).select(F.col("law_id").alias("id")).distinct()
    return laws.filter(F.col("is_current") == 1).join(done, "id", "left_anti")


def nodes_of_current(nodes: DataFrame, laws: DataFrame) -> DataFrame:
    """Nodes of current laws."""
    keep = laws.filter(F.col("is_current") == 1).select(F.col("id").alias("law_id"))
    return nodes.join(keep, "law_id", "left_semi")


def diff_snapshots(before: DataFrame, after: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Added, removed and changed keys between two snapshots."""
    old = before.select(key, F.struct(*cols).alias("old"))
    new = after.select(key, F.struct(*cols).alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return (
        old.join(new, key, "full").withColumn("change", change).filter(F.col("change").isNotNull())
        .select(key, "change", *[F.col(f"old.{c}").alias(f"old_{c}") for c in cols], *[F.col(f"new.{c}").alias(f"new_{c}") for c in cols])
    )


def match_versions(a: DataFrame, b: DataFrame, days: int = 90, bulk_date: str = "2020-12-29", bulk_floor: str = "2020-01-01") -> DataFrame:
    """C11: is the version of source b the same as that of source a?

    Same document number, or both without one and at most ``days`` apart (or no
    usable date). Texts older than the floor never match the bulk amendment.
    Source a counts with one version per title, the one of the highest id, so
    a title with many versions does not pair them all.
    """
    last = a.groupBy("title_key").agg(F.max_by(F.struct(F.col("id").alias("a_id"), F.col("doc_number").alias("a_doc"), F.col("pub_date").alias("a_pub")), "id").alias("p"))
    left = last.select("title_key", "p.*")
    right = b.select("title_key", F.col("id").alias("b_id"), F.col("doc_number").alias("b_doc"), F.col("pub_date").alias("b_pub"))
    pair = left.join(right, "title_key")
    a_day, b_day = F.try_to_date("a_pub"), F.try_to_date("b_pub")
    near = F.coalesce(F.abs(F.datediff(a_day, b_day)) <= days, F.lit(True))
    old = (F.col("a_pub") == bulk_date) & F.coalesce(b_day < F.lit(bulk_floor).cast("date"), F.lit(False))
    a_has, b_has = ~missing(F.col("a_doc")), ~missing(F.col("b_doc"))
    same = F.when(a_has & b_has, F.col("a_doc") == F.col("b_doc")).when(~a_has & ~b_has, near).otherwise(F.lit(False))
    return pair.withColumn("same_version", (same & ~old).cast("int"))


def apply_headings(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """Fill heading translations by the stable key (law, type, order)."""
    keys = ["law_id", "type", "order_index"]
    keyed = nodes.withColumn("order_index", F.coalesce("order_index", F.lit(0)))
    filled_in = keyed.join(names.select(*keys, F.col("name_en")), keys, "left")
    return filled_in.withColumn("content_en", F.when(missing(F.col("content_en")), F.col("name_en")).otherwise(F.col("content_en"))).drop("name_en")


def backfill_headings(headings: DataFrame, laws: DataFrame, constants: dict[str, str]) -> DataFrame:
    """C14: a heading that equals the law title, or a constant, takes its English."""
    titles = laws.filter(filled("title_en")).select(F.col("id").alias("law_id"), F.col("title").alias("law_title"), "title_en")
    constant = F.lit(None).cast("string")
    for zh, en in constants.items():
        constant = F.when(F.col("content") == zh, en).otherwise(constant)
    joined = headings.join(titles, "law_id", "left")
    value = F.when(F.col("content") == F.col("law_title"), F.col("title_en")).otherwise(constant)
    return joined.withColumn("content_en", F.when(missing(F.col("content_en")), value).otherwise(F.col("content_en"))).drop("law_title", "title_en")


def match_repeals(marks: DataFrame, laws: DataFrame) -> DataFrame:
    """Rows that a repeal mark names, by document number and title key,
    or by title key alone when the mark has no number. Equal marks count once."""
    marks = marks.select("title_key", "doc_number", "mark").distinct()
    marks = marks.withColumn("mark_number", F.coalesce("doc_number", F.lit("")))
    numbered = marks.filter(filled("doc_number")).join(laws, ["title_key", "doc_number"])
    bare = marks.filter(missing(F.col("doc_number"))).drop("doc_number").join(laws, "title_key")
    return numbered.unionByName(bare)


# D: aggregates


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def column_coverage(df: DataFrame, cols: list[str], by: str) -> DataFrame:
    """Fill rate of each column, overall ('ALL') and per source."""
    counts = df.rollup(by).agg(F.count("*").alias("total"), *[F.count_if(filled(c)).alias(c) for c in cols])
    long = counts.unpivot([by, "total"], cols, "column_name", "filled")
    return long.select(
        F.coalesce(by, F.lit("ALL")).alias(by), "column_name", "total", "filled",
        F.round(F.col("filled") * 100.0 / F.col("total"), 1).alias("rate"),
    )


def node_coverage(nodes: DataFrame, laws: DataFrame, threshold: float = 95.0) -> DataFrame:
    """D3: translated share per node type in current laws, with a pass flag."""
    rate = F.round(F.col("translated") * 100.0 / F.col("total"), 1)
    return (
        nodes_of_current(nodes, laws).groupBy("type")
        .agg(F.count("*").alias("total"), F.count_if(filled("content_en")).alias("translated"))
        .withColumn("rate", rate).withColumn("ok", (F.col("rate") >= threshold).cast("int"))
    )


def short_laws(laws: DataFrame, nodes: DataFrame, limit: int = 100) -> DataFrame:
    """Current laws with 1..limit articles and none translated."""
    per_law = translated_per_law(nodes).filter((F.col("translated") == 0) & F.col("articles").between(1, limit))
    return laws.filter(F.col("is_current") == 1).select("id", "title").join(per_law.select(F.col("law_id").alias("id"), "articles"), "id")


def version_history(laws: DataFrame, key: str = "title") -> DataFrame:
    """Titles with more than one version: count, earliest, latest."""
    return (
        laws.groupBy(key).agg(F.count("*").alias("version_count"), F.min("pub_date").alias("earliest"), F.max("pub_date").alias("latest"))
        .filter(F.col("version_count") > 1)
    )


def version_rows(laws: DataFrame, key: str = "title") -> DataFrame:
    """The versions themselves in date order, as rows of the groups."""
    groups = version_history(laws, key).select(key)
    return laws.join(groups, key, "left_semi").select(key, "pub_date", "id", "category")


def latest_version(laws: DataFrame, key: str = "title") -> DataFrame:
    """Newest version per title, the lowest id of equal dates."""
    return laws.groupBy(key).agg(F.max_by("id", F.struct("pub_date", -F.col("id"))).alias("id"), F.max("pub_date").alias("pub_date"))


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issue counts over severity and rule, with all subtotals."""
    return issues.cube("severity", "rule").agg(F.count("*").alias("n"), F.count_distinct("law_id").alias("laws"))


def laws_covered(nodes: DataFrame) -> DataFrame:
    """Laws with any translation."""
    return nodes.filter((F.col("type") == "article") & filled("content_en")).agg(F.count_distinct("law_id").alias("laws"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def menu_counts(menu: DataFrame) -> DataFrame:
    """Laws per group and subgroup with totals."""
    return menu.rollup("menu_group", "subgroup").agg(F.count("*").alias("n"))


def max_id_per_range(index: DataFrame, ranges: list[tuple[str, int, int]]) -> DataFrame:
    """Highest used id per (category, base, cap) range.

    The ranges are a handful of constants, so the lookup is an expression and
    the aggregation has one partial row per range and task.
    """
    name = F.lit(None).cast("string")
    for category, base, cap in reversed(ranges):
        name = F.when(F.col("id").between(base, base + cap - 1), category).otherwise(name)
    return index.withColumn("range", name).filter(F.col("range").isNotNull()).groupBy("range").agg(F.max("id").alias("max_id"))


def corpus_overview(laws: DataFrame) -> DataFrame:
    """Laws, current laws and date span per category, with a total."""
    return laws.rollup("category").agg(
        F.count("*").alias("laws"), F.count_if(F.col("is_current") == 1).alias("current_laws"),
        F.min("pub_date").alias("earliest"), F.max("pub_date").alias("latest"),
    )


def translation_progress(nodes: DataFrame) -> DataFrame:
    """Files total and complete, articles total and done."""
    per_law = translated_per_law(nodes)
    return per_law.agg(
        F.count("*").alias("files"), F.count_if(F.col("articles") == F.col("translated")).alias("files_complete"),
        F.sum("articles").alias("articles"), F.sum("translated").alias("articles_done"),
    )


def latin_fragments(nodes: DataFrame, laws: DataFrame, samples: int = 3, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Articles with Latin fragments per law, and the first samples with
    all fragments of an article, or the first ``most``."""
    fragments = F.regexp_extract_all("content", F.lit("[A-Za-z][A-Za-z\\d\\-]*"), F.lit(0))
    found = latin_articles(nodes).select(
        "law_id", "global_order", "article_number", (fragments if most is None else F.slice(fragments, 1, most)).alias("fragments"),
    )
    titles = laws.select(F.col("id").alias("law_id"), "title")
    counts = found.groupBy("law_id").agg(F.count("*").alias("n")).join(titles, "law_id")
    first = top_per_group(found, ["law_id"], [F.col("global_order")], samples, rank="sample")
    return counts, first.select("law_id", "sample", "article_number", F.array_join("fragments", " ").alias("fragments"))


def pending_work(laws: DataFrame, nodes: DataFrame) -> DataFrame:
    """Titles, laws and articles of current laws not yet translated."""
    per_law = translated_per_law(nodes).select(F.col("law_id").alias("id"), "articles", "translated")
    left = laws.filter(F.col("is_current") == 1).join(per_law, "id", "left").na.fill(0, ["articles", "translated"])
    return left.agg(
        F.count_if(missing(F.col("title_en"))).alias("titles"),
        F.count_if(F.col("articles") > F.col("translated")).alias("laws"),
        F.sum(F.col("articles") - F.col("translated")).alias("articles"),
    )


def pending_documents(docs: DataFrame) -> DataFrame:
    """Untranslated documents per source and their characters."""
    todo = docs.filter(missing(F.col("full_text_en")))
    return todo.groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.length("full_text")).alias("chars"))


# E: windows


def article_gaps(articles: DataFrame, span: int) -> DataFrame:
    """Duplicate, gap and reversal of article numbers under one parent."""
    return gaps_of(articles, span, large_keys(articles, ["law_id"]))


def gaps_of(articles: DataFrame, span: int, large: DataFrame | None) -> DataFrame:
    """``article_gaps`` with the laws that are to be cut into segments."""
    parent = ["part_num", "chapter_num", "section_num"]
    rows = articles.filter(F.col("article_num") > 0).select("law_id", "global_order", "article_num", *parent)
    prev = lag_by_segment(rows, ["law_id"], "global_order", ["article_num", *parent], span, large=large)
    same_parent = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"prev_{c}")) for c in parent])
    now, was = F.col("article_num"), F.col("prev_article_num")
    issue = F.when(now == was, "duplicate").when(now > was + 1, "gap").when(now < was, "reversal")
    return (
        prev.filter(same_parent).withColumn("issue", issue).filter(F.col("issue").isNotNull())
        .select("law_id", "global_order", "issue", was.alias("from_num"), now.alias("to_num"),
                F.when(F.col("issue") == "gap", now - was - 1).otherwise(0).alias("missing_articles"))
    )


def empty_headings(nodes: DataFrame, span: int) -> DataFrame:
    """Two headings of one type with no article between them."""
    return empty_headings_of(nodes, span, large_keys(nodes, ["law_id"]))


def empty_headings_of(nodes: DataFrame, span: int, large: DataFrame | None) -> DataFrame:
    """``empty_headings`` with the laws that are to be cut into segments. Texts of articles are not moved."""
    rows = nodes.select("law_id", "global_order", "type", F.when(F.col("type") != "article", F.col("content")).alias("content"))
    prev = lag_by_segment(rows, ["law_id"], "global_order", ["type", "content"], span, large=large)
    return prev.filter((F.col("type") != "article") & (F.col("prev_type") == F.col("type"))).select(
        "law_id", "global_order", "type", F.col("prev_content").alias("heading"), F.col("content").alias("next_heading")
    )


def order_violations(nodes: DataFrame, span: int, start: int | None = None) -> DataFrame:
    """Reading order that does not rise from one row to the next.

    Rows are compared in document order ``doc_order``.
    """
    rows = nodes.select("law_id", "doc_order", "global_order")
    prev = lag_by_segment(rows, ["law_id"], "doc_order", ["global_order"], span, large=large_keys(rows, ["law_id"]))
    rises = F.col("global_order") > F.col("prev_global_order")
    bad = F.when(F.col("prev_global_order").isNull(), F.lit(False) if start is None else F.col("global_order") != start).otherwise(~rises)
    return prev.filter(bad)


def unique_labels(articles: DataFrame, span: int) -> DataFrame:
    """Repeated labels get _2, _3; a missing label becomes _n by position.

    Positions come from segment counts, so a law with very many articles is
    not numbered in one task.
    """
    rows = articles.select("law_id", "global_order", "article_number").withColumn("_seg", F.expr(f"global_order div {span}"))
    placed = rank_by_segment(rows, ["law_id"], [F.col("global_order")], ["_seg"], "position")
    named = placed.withColumn("base", F.when(missing(F.col("article_number")), F.concat(F.lit("_"), "position")).otherwise(F.trim("article_number")))
    counted = rank_by_segment(named, ["law_id", "base"], [F.col("global_order")], ["_seg"], "copy")
    label = F.when(F.col("copy") > 1, F.concat("base", F.lit("_"), "copy")).otherwise(F.col("base"))
    return counted.select("law_id", "global_order", label.alias("label"))


def check_currency(laws: DataFrame) -> DataFrame:
    """Stored against expected currency per normalised title.

    Repealed rows must be 0; a single live version must be 1; of several the
    newest must be 1 and the rest 0; equal newest dates need a review. Group
    facts come from one aggregate that is joined back.
    """
    live = laws.filter(missing(F.col("repealed_by")))
    per_date = live.groupBy("title_key", "pub_date").agg(F.count("*").alias("at_date"))
    newest = per_date.groupBy("title_key").agg(
        F.sum("at_date").alias("versions"), F.max("pub_date").alias("max_pub"), F.max_by("at_date", "pub_date").alias("at_max")
    )
    facts = laws.join(newest, "title_key", "left")
    expected = (
        F.when(~missing(F.col("repealed_by")), 0).when(F.col("versions") == 1, 1)
        .when(F.col("at_max") > 1, -1).when(F.col("pub_date") == F.col("max_pub"), 1).otherwise(0)
    )
    problem = (
        F.when((F.col("expected") == -1), "several_newest").when(F.col("expected") != F.col("is_current"), F.when(
            ~missing(F.col("repealed_by")), "repealed_but_current").when(F.col("expected") == 1, "should_be_current").otherwise("should_not_be_current"))
    )
    return facts.withColumn("expected", expected).withColumn("problem", problem).filter(F.col("problem").isNotNull()).select(
        "id", "title_key", "pub_date", "is_current", "problem"
    )


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key."""
    return top_per_group(df, keys, order, 1)


# F: ordering


def most_revised(laws: DataFrame, n: int = 15) -> DataFrame:
    """titles with most versions (the limit is the report)."""
    return version_history(laws).orderBy(F.desc("version_count"), "title").limit(n)


# N: set jobs


def union_sources(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """Rows of both sources; the first source wins an id."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def append_new(index: DataFrame, entries: DataFrame, key: str = "id") -> DataFrame:
    """Index entries stay, unseen entries are appended."""
    return index.unionByName(entries.join(index.select(key), key, "left_anti"))


def key_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys that came or went between two runs."""
    old, new = before.select(key).distinct(), after.select(key).distinct()
    came = new.join(old, key, "left_anti").withColumn("change", F.lit("added"))
    went = old.join(new, key, "left_anti").withColumn("change", F.lit("removed"))
    return came.unionByName(went)


def apply_document_translations(docs: DataFrame, translated: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Translated columns by document key; empty values count as missing."""
    new = translated.select(key, *[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns])
    return docs.join(new, key, "left")


def enrich_domain(laws: DataFrame, other: DataFrame) -> DataFrame:
    """An empty legal domain filled from a second source (id, domain)."""
    named = other.select("id", F.col("domain").alias("_other"))
    filled_in = F.when(missing(F.col("legal_domain")), F.coalesce("_other", F.lit(""))).otherwise(F.col("legal_domain"))
    return laws.join(named, "id", "left").withColumn("legal_domain", filled_in).drop("_other")

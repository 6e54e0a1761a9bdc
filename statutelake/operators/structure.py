"""Text lines to a part / chapter / section / article tree.

Lines are ``(doc, line_no, text)`` with rising ``line_no``. The state that a
line-by-line parser would carry is expressed with per-document aggregates and
a segmented carry of the last heading; no document is handled as one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statutelake.functions.numerals import numeral_to_int
from statutelake.functions.text import clean_article, strip
from statutelake.operators.lineage import materialize
from statutelake.operators.ordered import LARGE, few, large_keys, rank_by_segment, with_segment

# The heading grammar.
GRAMMAR = {
    "part": "^第[一二三四五六七八九十]+编(?U:[　\\s])",
    "chapter": "^第[一二三四五六七八九十百千]+章(?U:[　\\s])",
    "section": "^第[一二三四五六七八九十百千]+节(?U:[　\\s])",
    "article": "^第[零一二三四五六七八九十百千]+条(?U:[　\\s])",
    "numbered": "^[一二三四五六七八九十百]+(?:十[一二三四五六七八九]?)?、(?U:\\s*\\S)",
    "toc": "^(?:目(?U:\\s*)录|附(?U:\\s*)录|附(?U:\\s*)件)$",
}
ARTICLE_LABEL = "^(第[零一二三四五六七八九十百千]+条(?U:[　\\s])?)"


def heading_title(text: Column) -> Column:
    """Heading text without breaks and doubled blanks."""
    out = F.regexp_replace(strip(text), "[\r\n]+", "")
    out = F.regexp_replace(out, "[ \t]{2,}", " ")
    return F.regexp_replace(out, "(?<=[一-鿿])　{2,}(?=[一-鿿])", "")


def classify_lines(lines: DataFrame, grammar: dict[str, str] = GRAMMAR) -> DataFrame:
    kind = F.lit("text")
    for name in ["numbered", "article", "section", "chapter", "part", "toc"]:
        kind = F.when(F.col("text").rlike(grammar[name]), name).otherwise(kind)
    return lines.withColumn("kind", kind)


def drop_toc_headings(lines: DataFrame) -> DataFrame:
    """Of equal part and chapter headings of a document keep the last."""
    title = heading_title(F.col("text"))
    marked = lines.withColumn("title", F.when(F.col("kind").isin("part", "chapter"), title))
    last = (
        marked.filter(F.col("title").isNotNull()).groupBy("doc", "kind", "title").agg(F.max("line_no").alias("keep_line"))
    )
    joined = marked.join(last, ["doc", "kind", "title"], "left")
    return joined.filter(F.col("title").isNull() | (F.col("line_no") == F.col("keep_line"))).select(*lines.columns)


def drop_toc_block(lines: DataFrame) -> DataFrame:
    """Remove the table of contents.

    If a part or chapter heading of the block repeats before the first article,
    the body starts there and the block goes; otherwise the block's chapter and
    section lines are the real headings and stay. Lines are only moved if more
    documents than can be broadcast have such a table.
    """
    toc = few(lines.filter(F.col("kind") == "toc").groupBy("doc").agg(F.min("line_no").alias("toc_line")))
    if toc is None:
        return lines
    after = lines.join(toc, "doc").filter(F.col("line_no") > F.col("toc_line"))
    heads = after.filter(F.col("kind").isin("part", "chapter", "numbered")).withColumn("title", heading_title(F.col("text")))
    first = heads.groupBy("doc", "kind", "title").agg(F.min("line_no").alias("first_line"))
    repeat = (
        heads.join(first, ["doc", "kind", "title"]).filter(F.col("line_no") > F.col("first_line"))
        .groupBy("doc").agg(F.min("line_no").alias("repeat_line"))
    )
    article = after.filter(F.col("kind") == "article").groupBy("doc").agg(F.min("line_no").alias("article_line"))
    facts = few(toc.join(repeat, "doc", "left").join(article, "doc", "left"))
    joined = lines.join(facts, "doc", "left")
    far = F.lit((1 << 63) - 1)
    repeated = F.coalesce("repeat_line", far) < F.coalesce("article_line", far)
    end = F.when(repeated, F.col("repeat_line")).otherwise(F.coalesce("article_line", F.col("toc_line") + 1))
    inside = (F.col("line_no") >= F.col("toc_line")) & (F.col("line_no") < end)
    heading = ~repeated & F.col("kind").isin("chapter", "section")
    return joined.filter(F.col("toc_line").isNull() | ~inside | heading).select(*lines.columns)


def carry_by_segment(df: DataFrame, keys: list[str], order: str, cols: list[str], span: int, large: DataFrame | None) -> DataFrame:
    """Last non-NULL value of each column up to the row, within keys.

    The ``large`` keys are handled per (key, segment); one row per segment
    carries values onward.
    """
    kept = [c for c in df.columns if c not in cols]
    if large is None:
        here = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(*kept, *[F.last(c, ignorenulls=True).over(here).alias(c) for c in cols])
    cut = with_segment(df, keys, order, span, large)
    here = Window.partitionBy(*keys, "_seg").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select(*cut.columns, *[F.last(c, ignorenulls=True).over(here).alias(f"_in_{c}") for c in cols])
    ends = cut.filter("_large").groupBy(*keys, "_seg").agg(*[F.max(c).alias(f"_end_{c}") for c in cols])
    past = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select(*keys, "_seg", *[F.last(f"_end_{c}", ignorenulls=True).over(past).alias(f"_from_{c}") for c in cols])
    joined = local.join(base, [*keys, "_seg"], "left")
    return joined.select(*kept, *[F.coalesce(f"_in_{c}", f"_from_{c}").alias(c) for c in cols])


def segment(lines: DataFrame, span: int, grammar: dict[str, str] = GRAMMAR, large_rows: int = LARGE) -> DataFrame:
    """G1: articles with the lines of their headings.

    Columns: doc, article_line, label, content, part_line, chapter_line,
    section_line. The carried values are line numbers, which rise, so the end
    of a segment is a plain maximum. The classified lines are written once: the
    steps that look for headings then scan only the few lines of their kind.
    Texts move once, by document, both to carry and to gather; those of
    documents of more than ``large_rows`` lines move once more.
    """
    marked = materialize(classify_lines(lines, grammar).filter(F.col("doc").isNotNull()))
    large = large_keys(marked, ["doc"], large_rows)
    block = drop_toc_block(marked)
    heads = drop_toc_headings(block.filter(F.col("kind").isin("part", "chapter")))
    body = block.filter(~F.col("kind").isin("part", "chapter", "numbered")).unionByName(heads).withColumn("labelled", F.col("kind") == "article")
    # Numbered lines are articles in documents that have no others.
    numbered = block.filter(F.col("kind") == "numbered")
    asked = few(numbered.select("doc").distinct())
    if asked is not None:
        known = few(marked.filter(F.col("kind") == "article").join(asked, "doc", "left_semi").select("doc", F.lit("text").alias("as_kind")).distinct())
        numbered = numbered.withColumn("as_kind", F.lit(None).cast("string")) if known is None else numbered.join(known, "doc", "left")
        as_kind = F.coalesce("as_kind", F.lit("article"))
        body = body.unionByName(numbered.withColumn("kind", as_kind).drop("as_kind").withColumn("labelled", F.lit(False)))
    at = {
        "part_line": F.when(F.col("kind") == "part", F.col("line_no")),
        "chapter_line": F.when(F.col("kind") == "chapter", F.col("line_no")),
        "section_line": F.when(F.col("kind") == "section", F.col("line_no")),
        "article_line": F.when(F.col("kind") == "article", F.col("line_no")),
    }
    carried = carry_by_segment(
        body.select("doc", "line_no", "text", "labelled", *[c.alias(n) for n, c in at.items()]), ["doc"], "line_no", list(at), span, large
    )
    low = F.lit(-1)
    part, chapter = F.coalesce("part_line", low), F.coalesce("chapter_line", low)
    section, article = F.coalesce("section_line", low), F.coalesce("article_line", low)
    valid = carried.withColumn("c_line", F.when(chapter > part, chapter)).withColumn(
        "s_line", F.when((section > chapter) & (section > part), section)
    ).filter((article > part) & (article > chapter) & (article > section))
    grouped = valid.groupBy("doc", "article_line").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("rows"),
        F.max("part_line").alias("part_line"), F.max("c_line").alias("chapter_line"), F.max("s_line").alias("section_line"),
        F.max("labelled").alias("labelled"),
    )
    first = F.col("rows")[0]["text"]
    label = F.when(F.col("labelled"), F.regexp_extract(first, ARTICLE_LABEL, 1)).otherwise(F.regexp_extract(first, "^(.*?、)", 1))
    return grouped.select(
        "doc", "article_line", "part_line", "chapter_line", "section_line",
        strip(label).alias("label"),
        clean_article(F.array_join(F.transform("rows", lambda r: r["text"]), "\n")).alias("content"),
    )


def whole_text_fallback(lines: DataFrame, articles: DataFrame) -> DataFrame:
    """A document without any recognised article is one article."""
    rest = lines.join(articles.select("doc").distinct(), "doc", "left_anti")
    texts = rest.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("rows"))
    return texts.select(
        "doc", F.col("rows")[0]["line_no"].alias("article_line"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("part_line", "chapter_line", "section_line")],
        F.lit("").alias("label"), clean_article(F.array_join(F.transform("rows", lambda r: r["text"]), "\n")).alias("content"),
    )


def number_nodes(articles: DataFrame, span: int) -> DataFrame:
    """E5: sibling order and depth-first order of articles and their headings."""
    seg = F.expr(f"line_no div {span}")
    rows = materialize(articles.select(
        "doc", F.col("article_line").alias("line_no"), F.lit("article").alias("type"), "part_line", "chapter_line", "section_line"
    ))
    none = F.lit(None).cast("bigint")
    chapters = rows.filter("chapter_line IS NOT NULL").select("doc", "part_line", "chapter_line").distinct().select(
        "doc", F.col("chapter_line").alias("line_no"), F.lit("chapter").alias("type"), "part_line", none.alias("chapter_line"), none.alias("section_line"))
    sections = rows.filter("section_line IS NOT NULL").select("doc", "part_line", "chapter_line", "section_line").distinct().select(
        "doc", F.col("section_line").alias("line_no"), F.lit("section").alias("type"), "part_line", "chapter_line", none.alias("section_line"))
    parts = rows.filter("part_line IS NOT NULL").select("doc", "part_line").distinct().select(
        "doc", F.col("part_line").alias("line_no"), F.lit("part").alias("type"), none.alias("part_line"), none.alias("chapter_line"), none.alias("section_line"))
    nodes = rows.unionByName(parts).unionByName(chapters).unionByName(sections).withColumn("_seg", seg)
    ordered = rank_by_segment(nodes, ["doc"], [F.col("line_no")], ["_seg"], "global_order")
    parent = F.coalesce("section_line", "chapter_line", "part_line", F.lit(-1))
    keyed = ordered.withColumn("parent_line", parent)
    return rank_by_segment(keyed, ["doc", "type", "parent_line"], [F.col("line_no")], ["_seg"], "order_index").drop("_seg")


def split_inline(paragraph: Column) -> Column:
    """A paragraph with several articles on lines of their own is split,
    but only where the numbers are consecutive."""
    numeral = "[零一二三四五六七八九十百千]+"
    pieces = F.split(paragraph, f"\n[　\\s]*(?=第{numeral}条(?U:[　\\s]))")

    def number(text: Column) -> Column:
        return numeral_to_int(F.nullif(F.regexp_extract(text, f"^第({numeral})条", 1), F.lit("")))

    def step(done: Column, piece: Column) -> Column:
        last = F.element_at(done, -1)
        follows = number(piece) == number(last) + 1
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(last, F.lit("\n"), piece)))
        return F.when(F.coalesce(follows, F.lit(False)), F.concat(done, F.array(piece))).otherwise(joined)

    start = F.slice(pieces, 1, 1)
    rest = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(F.aggregate(rest, start, step), strip)

"""Document-level jobs.

Folds over paragraphs run inside the row of their document, so they need no
shuffle and are bounded by the size of one record.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statutelake.functions import text as tx
from statutelake.functions.numerals import int_to_numeral, label_to_int
from statutelake.operators.ordered import top_per_group
from statutelake.operators.relational import missing

PUBLISHING = "通过|公布|发布|施行|颁布|批准"
# The issuing bodies that are recognised on a line of their own.
KNOWN_BODIES = [
    "最高人民法院", "最高人民检察院", "国务院", "全国人民代表大会常务委员会", "全国人民代表大会", "中央军事委员会",
    "海关总署", "国家外汇管理局", "中国人民银行", "外交部", "商务部", "对外经济贸易部",
]
DOC_NUMBER = "[（(]?[一-鿿]{1,8}[〔\\[]\\d{4}[〕\\]]\\d+号[）)]?"


def head_lines(text: Column, n: int) -> Column:
    """The first n trimmed, non-empty lines; the rule only looks at these."""
    lines = F.filter(F.transform(F.split(text, "\n"), tx.strip), lambda x: x != "")
    return F.slice(lines, 1, n)


def promulgation(lines: Column) -> Column:
    """From the first of 30 lines with a publishing verb to the closing
    bracket, at most 15 lines."""
    first = F.array_position(F.transform(F.slice(lines, 1, 30), lambda x: x.rlike(PUBLISHING)), True)
    block = F.slice(lines, first.cast("int"), 15)
    rest = F.slice(block, 2, F.greatest(F.size(block) - 1, F.lit(0)))
    stop = F.array_position(F.transform(rest, lambda x: F.endswith(x, F.lit("）")) | F.endswith(x, F.lit(")"))), True)
    keep = F.when(stop > 0, stop.cast("int") + 1).otherwise(F.size(block))
    return F.when(first > 0, F.array_join(F.slice(block, 1, keep), " ")).otherwise("")


def issuing_body(lines: Column) -> Column:
    """A line that is exactly a known issuing body, within 15 lines."""
    hits = F.filter(F.slice(lines, 1, 15), lambda x: x.isin(*KNOWN_BODIES))
    return F.when(F.size(hits) > 0, hits[0]).otherwise("")


def document_number(lines: Column) -> Column:
    """Document number on a short line of its own, within 15 lines."""
    hits = F.filter(F.slice(lines, 1, 15), lambda x: x.rlike(DOC_NUMBER) & (F.length(x) < 30))
    found = F.when(F.size(hits) > 0, F.regexp_extract(hits[0], f"({DOC_NUMBER})", 1)).otherwise("")
    return F.regexp_replace(found, "^[（()）]+|[（()）]+$", "")


def effective_date(docs: DataFrame, articles: DataFrame) -> DataFrame:
    """Date cascade over the promulgation text and all articles.

    Each step takes the first text that has such a date, in reading order. The
    texts are folded to one row per document by aggregates over short dates.
    """
    texts = docs.select("id", F.lit(-1).cast("bigint").alias("pos"), F.col("promulgation_info").alias("text")).unionByName(
        articles.select(F.col("law_id").alias("id"), F.col("global_order").alias("pos"), F.col("content").alias("text"))
    )
    steps = {"arabic": tx.arabic_effective_date, "numeral": tx.numeral_effective_date, "since": tx.since_publication_date}
    hits = texts.select(
        "id", "pos", *[fn(F.col("text")).alias(n) for n, fn in steps.items()], F.col("text").contains("自公布之日起施行").alias("own")
    ).filter("arabic IS NOT NULL OR numeral IS NOT NULL OR since IS NOT NULL OR own")
    found = hits.groupBy("id").agg(
        *[F.min_by(n, F.when(F.col(n).isNotNull(), F.col("pos"))).alias(n) for n in steps], F.bool_or("own").alias("own")
    )
    joined = docs.select("id", "pub_date").join(found, "id", "left")
    return joined.select(
        "id",
        F.coalesce("arabic", "numeral", "since", F.when(F.col("own") & ~missing(F.col("pub_date")), F.col("pub_date"))).alias("effective_date"),
    )


def enrich_docs(docs: DataFrame) -> DataFrame:
    """Gist, keywords and case number, filled only where empty."""
    gist = F.when(missing(F.col("ruling_gist")), tx.ruling_gist(F.col("full_text"))).otherwise(F.col("ruling_gist"))
    with_gist = docs.withColumn("ruling_gist", gist)
    marked = F.nullif(tx.marked_keywords(F.col("full_text")), F.lit(""))
    inferred = tx.inferred_keywords(F.col("title"), F.col("ruling_gist"), F.col("full_text"))
    words = F.when(missing(F.col("keywords")), F.coalesce(marked, inferred)).otherwise(F.col("keywords"))
    return with_gist.withColumn("keywords", words).withColumn("case_number", tx.case_number(F.col("title")))


def continuation_body(text: Column) -> Column:
    """A continuation without its repeated header.

    The body starts at the first heading mark behind the document number; if
    less than a third of the text would remain, the text is kept whole.
    """
    mark = "\\n?(?U:\\s*)(?:[一二三四五六七八九十]+、|第[一二三四五六七八九十百千]+[章部分])"
    number_end = F.locate("号", text) + 1
    tail = F.substr(text, F.greatest(number_end + 0, F.lit(1)).cast("int"))
    at = F.regexp_instr(tail, F.lit(mark))
    body = F.regexp_replace(F.substr(tail, at), "^\\n+", "")
    return F.when((at > 0) & (F.length(body) * 3 >= F.length(text)), body).otherwise(text)


def merge_continuations(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Append the body of the continuation to its main document."""
    main = docs.select(F.col("doc_key").alias("main_key"), F.col("full_text").alias("main_text"))
    cont = docs.select(F.col("doc_key").alias("cont_key"), F.col("full_text").alias("cont_text"))
    joined = pairs.join(main, "main_key").join(cont, "cont_key")
    merged = F.concat(F.regexp_replace("main_text", r"(?U)\s+$", ""), F.lit("\n\n"), continuation_body(F.col("cont_text")))
    return joined.select("main_key", "cont_key", merged.alias("full_text"))


def merge_articles(main: DataFrame, cont: DataFrame) -> DataFrame:
    """Union of article lists by number; the main document wins."""
    both = main.withColumn("part", F.lit(0)).unionByName(cont.withColumn("part", F.lit(1)))
    number = label_to_int(F.col("article_number"))
    keyed = both.withColumn("key", F.when(number.isNull(), F.trim("article_number")).otherwise(F.concat(F.lit("int:"), number)))
    rest = F.struct("article_number", "content_en")
    return keyed.groupBy("doc", "key").agg(F.min_by(rest, F.struct("part", "pos")).alias("a")).select("doc", "key", "a.article_number", "a.content_en")


def fold_starts(lengths: Column, budget: int, separator: int) -> Column:
    """1-based start positions of greedy groups of at most ``budget``.

    Only the starts are kept in the fold, so its state grows with the groups.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("used"), F.array().cast("array<int>").alias("starts"))

    def step(acc: Column, size: Column) -> Column:
        fresh = (acc["at"] == 0) | (acc["used"] + size + separator > budget)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(fresh, size.cast("bigint") + separator).otherwise(acc["used"] + size + separator).alias("used"),
            F.when(fresh, F.concat(acc["starts"], F.array(acc["at"] + 1))).otherwise(acc["starts"]).alias("starts"),
        )

    return F.aggregate(lengths, start, step, lambda acc: acc["starts"])


def grouped(items: Column, starts: Column) -> Column:
    """Slices of ``items`` between consecutive starts."""
    return F.transform(
        starts,
        lambda s, i: F.slice(items, s, F.coalesce(F.get(starts, i + 1), F.size(items) + 1) - s),
    )


def chunk_text(docs: DataFrame, key: str, text: str, limit: int = 6000) -> DataFrame:
    """Chunks of at most ``limit`` characters at line breaks."""
    cut = docs.select(key, F.split(text, "\n").alias("lines"))
    starts = cut.withColumn("starts", fold_starts(F.transform("lines", F.length), limit, 1))
    chunks = grouped(F.col("lines"), F.col("starts"))
    return starts.select(key, F.posexplode(F.transform(chunks, lambda c: F.array_join(c, "\n"))).alias("chunk", "text"))


def batch_by_chars(docs: DataFrame, key: str, items: str, limit: int) -> DataFrame:
    """Greedy batches of a document's items by character budget."""
    starts = docs.withColumn("starts", fold_starts(F.transform(items, F.length), limit, 0))
    batches = grouped(F.transform(items, F.length), F.col("starts"))
    return starts.select(key, F.posexplode(batches).alias("batch", "sizes")).select(
        key, "batch", F.size("sizes").alias("items"), F.aggregate("sizes", F.lit(0), lambda a, x: a + x).alias("chars")
    )


def align_paragraphs(zh: Column, en: Column) -> Column:
    """Break the translation at sentence ends to the paragraphs of the
    source, merging short sentences; NULL where it cannot or need not be done."""
    body = F.regexp_replace(zh, "^第[一二三四五六七八九十百千零\\d]+条[　\\s]*", "")
    target = F.size(F.filter(F.split(body, "\n"), lambda p: tx.strip(p) != ""))
    prefix = F.regexp_extract(en, "^(Article \\d+)", 1)
    plain = F.trim(F.regexp_replace(en, "^Article \\d+\\s*", ""))
    sentences = F.filter(F.transform(F.split(plain, "(?<=\\.)\\s+(?=[A-Z])"), lambda x: F.trim(x)), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("open"))

    def step(acc: Column, sentence: Column) -> Column:
        last = F.element_at(acc["out"], -1)
        kept = F.slice(acc["out"], 1, F.size(acc["out"]) - 1)
        return F.when(
            acc["open"],
            F.struct(F.concat(kept, F.array(F.concat_ws(" ", last, sentence))).alias("out"), F.lit(False).alias("open")),
        ).otherwise(F.struct(F.concat(acc["out"], F.array(sentence)).alias("out"), (F.length(sentence) < 50).alias("open")))

    merged = F.aggregate(sentences, start, step, lambda acc: acc["out"])
    chosen = F.when(F.size(sentences) == target, sentences).when((F.size(sentences) > target) & (F.size(merged) == target), merged)
    joined = F.array_join(chosen, "\n")
    result = F.when(prefix != "", F.concat(prefix, F.lit(" "), joined)).otherwise(joined)
    return F.when(~missing(en) & ~en.contains("\n") & (target > 1) & chosen.isNotNull(), result)


def link_text(text: Column, links: Column) -> Column:
    """Replace citation texts by links, longest first."""
    ordered = F.array_sort(
        links, lambda a, b: F.when(F.length(a["raw"]) > F.length(b["raw"]), -1).when(F.length(a["raw"]) < F.length(b["raw"]), 1).otherwise(0)
    )
    return F.aggregate(ordered, text, lambda acc, link: F.replace(acc, link["raw"], link["link"]))


def node_markdown(nodes: DataFrame) -> DataFrame:
    """Markdown lines of the nodes, keyed by reading order.

    Lines stay rows: a law of any size is a sorted run of rows and never one
    value; the sink writes them in order.
    """
    english = F.col("content_en")
    label = F.regexp_extract(english, "^(Article \\d+)", 1)
    body = F.trim(F.regexp_replace(english, "^Article \\d+", ""))
    translated = F.when(
        ~missing(english),
        F.concat(F.lit("\n\n**"), F.when(label != "", label).otherwise(F.concat(F.lit("Article "), F.col("article_num"))), F.lit("** "),
                 F.replace(F.when(label != "", body).otherwise(english), F.lit("\n"), F.lit("  \n"))),
    ).otherwise("")
    text = F.when(F.col("type") == "article", F.trim("content")).otherwise(F.col("content"))
    line = (
        F.when(F.col("type") == "part", F.concat(F.lit("## "), text)).when(F.col("type") == "chapter", F.concat(F.lit("### "), text))
        .when(F.col("type") == "section", F.concat(F.lit("#### "), text))
        .otherwise(F.concat(F.lit('<a id="art-'), F.col("article_num"), F.lit('"></a>'), F.replace(text, F.lit("\n"), F.lit("  \n")), translated))
    )
    return nodes.select("law_id", "global_order", line.alias("line"))


def law_header(laws: DataFrame) -> DataFrame:
    """Title and metadata block of a law."""
    fields = [("分类", "category"), ("法律部门", "legal_domain"), ("发布机关", "issuing_org"), ("发文字号", "doc_number"), ("公布日期", "pub_date"), ("生效日期", "effective_date")]
    meta = F.concat_ws("  \n", *[F.when(~missing(F.col(c)), F.concat(F.lit(f"**{n}**："), F.col(c))) for n, c in fields])
    return laws.select(
        F.col("id").alias("law_id"), F.lit(-1).cast("bigint").alias("global_order"),
        F.concat(F.lit("# "), "title", F.lit("\n\n"), meta, F.lit("\n\n> "), "promulgation_info", F.lit("\n\n---")).alias("line"),
    )


def render_laws(nodes: DataFrame, laws: DataFrame, edges: DataFrame) -> DataFrame:
    """Header and node lines of every law with linked citations.

    Links are gathered per article, where their number is bounded by the text.
    """
    links = edges.filter((F.col("resolved") == 1) & ~missing(F.col("raw_text"))).select(
        F.col("from_law_id").alias("law_id"), F.col("from_order").alias("global_order"),
        F.struct(F.col("raw_text").alias("raw"), F.concat(
            F.lit("["), "raw_text", F.lit("]("), F.when(F.col("ref_type") == "self_ref", "").otherwise(F.concat(F.lit("law-"), "to_law_id")),
            F.lit("#art-"), "to_article_num", F.lit(")")).alias("link")).alias("link"),
    )
    per_article = links.groupBy("law_id", "global_order").agg(F.array_sort(F.collect_set("link")).alias("links"))
    linked = nodes.join(per_article, ["law_id", "global_order"], "left").withColumn(
        "content", F.when(F.col("links").isNotNull(), link_text(F.col("content"), F.col("links"))).otherwise(F.col("content"))
    )
    return law_header(laws).unionByName(node_markdown(linked))


def law_paths(laws: DataFrame, places: DataFrame) -> DataFrame:
    """(law_id, path, up): where a law's page lies below the root by its menu place, and the way from there to the root."""
    placed = laws.select(F.col("id").alias("law_id"), "title").join(places.select(F.col("id").alias("law_id"), "menu_group", "subgroup"), "law_id")
    folders = F.transform(tx.path_parts(F.concat_ws("/", "menu_group", "subgroup")), lambda p: F.concat(p, F.lit("/")))
    return placed.select(
        "law_id", F.concat(F.array_join(folders, ""), "title", F.lit(".md")).alias("path"), tx.relative_prefix(F.col("menu_group"), F.col("subgroup")).alias("up"))


def cited_by(edges: DataFrame, laws: DataFrame, paths: DataFrame, most: int = 50) -> DataFrame:
    """(law_id, article_num, n, marks) of every article that other laws cite.

    ``n`` counts the resolved citations; ``marks`` are numbered links to the
    first ``most`` of them by (law, article, place in the text), so that a very
    often cited article is never one long list. Articles and laws without a place
    in the menu get a number without a link.
    """
    found = edges.filter((F.col("resolved") == 1) & (F.col("ref_type") == "cross_law") & F.col("to_article_num").isNotNull()).select(
        F.col("to_law_id").alias("law_id"), F.col("to_article_num").alias("article_num"), "from_law_id", "from_order", F.col("from_article_num").alias("from_num"), "raw_text")
    counts = found.groupBy("law_id", "article_num").agg(F.count("*").alias("n"))
    first = top_per_group(found, ["law_id", "article_num"], [F.col("from_law_id"), F.col("from_order"), F.col("raw_text")], most, rank="i")
    first = (
        first.join(laws.select(F.col("id").alias("from_law_id"), "title"), "from_law_id")
        .join(paths.select(F.col("law_id").alias("from_law_id"), "path"), "from_law_id", "left").join(paths.select("law_id", "up"), "law_id", "left")
    )
    number = F.coalesce(F.col("from_num").cast("string"), F.lit(""))
    label = F.when(F.col("from_num").isNotNull(), F.concat(F.lit("第"), number, F.lit("条"))).otherwise("")
    href = F.concat(F.coalesce("up", F.lit("")), "path", F.lit("#art-"), number)
    mark = F.when(F.col("path").isNull(), F.concat(F.lit("<sup>["), "i", F.lit("]</sup>"))).otherwise(F.concat(
        F.lit('<sup><a href="'), href, F.lit('" title="被《'), "title", F.lit("》"), label, F.lit('引用">['), "i", F.lit("]</a></sup>")))
    marks = first.groupBy("law_id", "article_num").agg(F.array_sort(F.collect_list(F.struct("i", mark.alias("mark")))).alias("marks"))
    text = F.concat(F.lit("&thinsp;"), F.array_join(F.transform("marks", lambda m: m["mark"]), "&thinsp;"))
    return counts.join(marks, ["law_id", "article_num"]).select("law_id", "article_num", "n", text.alias("marks"))


def page_links(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """(law_id, global_order, raw, link) of resolved citations, relative to the citing law's page."""
    own = paths.select(F.col("law_id").alias("from_law_id"), "up")
    target = paths.select(F.col("law_id").alias("to_law_id"), "path")
    rows = edges.filter((F.col("resolved") == 1) & ~missing(F.col("raw_text"))).join(own, "from_law_id", "left").join(target, "to_law_id", "left")
    anchor = F.concat(F.lit("#art-"), "to_article_num")
    place = F.when(F.col("ref_type") == "self_ref", anchor).otherwise(F.concat(F.coalesce("up", F.lit("")), "path", anchor))
    return rows.filter(place.isNotNull()).select(
        F.col("from_law_id").alias("law_id"), F.col("from_order").alias("global_order"), F.col("raw_text").alias("raw"),
        F.concat(F.lit("["), "raw_text", F.lit("]("), place, F.lit(")")).alias("link")).distinct()


def render_pages(nodes: DataFrame, laws: DataFrame, edges: DataFrame, places: DataFrame, most: int = 50) -> DataFrame:
    """``render_laws`` for pages at their menu places: relative links and cited-by marks behind the articles.

    Marks find the places of their articles by numbers; with the links of a
    place they are one row, so texts are shuffled once. ``edges`` are used
    several times: they should be written.
    """
    paths = law_paths(laws, places)
    keys = ["law_id", "global_order"]
    no_link, no_mark = F.lit(None).cast("struct<raw:string,link:string>"), F.lit(None).cast("struct<num:int,marks:string>")
    links = page_links(edges, paths).select(*keys, F.struct("raw", "link").alias("link"), no_mark.alias("mark"))
    numbers = nodes.filter((F.col("type") == "article") & F.col("article_num").isNotNull()).select(*keys, "article_num")
    marks = numbers.join(cited_by(edges, laws, paths, most), ["law_id", "article_num"]).select(
        *keys, no_link.alias("link"), F.struct(F.col("article_num").alias("num"), "marks").alias("mark"))
    added = links.unionByName(marks).groupBy(*keys).agg(
        F.array_sort(F.collect_list("link")).alias("links"), F.collect_list("mark").alias("all_marks"))
    marked = nodes.join(added, keys, "left")
    # Nodes of one place may have several numbers.
    own = F.when(F.col("type") == "article", F.get(F.filter("all_marks", lambda m: m["num"] == F.col("article_num")), F.lit(0))["marks"])
    whole = tx.strip(F.col("content"))
    text = F.when(F.size("links") > 0, link_text(whole, F.col("links"))).otherwise(whole)
    return law_header(laws).unionByName(node_markdown(marked.withColumn("content", F.when(own.isNotNull(), F.concat(text, own)).otherwise(text))))


def merge_template(articles: DataFrame, translated: DataFrame) -> DataFrame:
    """Keep existing translations, empty placeholders for the rest."""
    done = translated.groupBy("law_id", "article_number").agg(F.max("content_en").alias("content_en"))
    return articles.select("law_id", "global_order", "article_number").join(done, ["law_id", "article_number"], "left").withColumn(
        "content_en", F.coalesce("content_en", F.lit(""))
    )


def number_to_label(line: Column) -> Column:
    """A line 'N.【…】text' becomes an article with a numeral label."""
    p = "^(\\d+)\\s*[.．、]\\s*(【.*)$"
    number = F.regexp_extract(line, p, 1)
    return F.when(line.rlike(p), F.concat(F.lit("第"), int_to_numeral(number), F.lit("条　"), F.regexp_extract(line, p, 2))).otherwise(line)


# Web pages

# Named character references of HTML 4; the no-break space counts as a space.
ENTITIES = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}
REFERENCE = r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,8});"


def _character(number: Column) -> Column:
    """The character of a code point, from its UTF-32 bytes; nothing for a number beyond Unicode."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("")


def decode_entities(text: Column) -> Column:
    """Numeric (decimal and hexadecimal) and named character references as characters.

    A text is cut in front of its references, and each is looked up where it
    stands, so an escaped reference is not decoded twice. Unknown names stay.
    """
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def decoded(part: Column) -> Column:
        found = F.regexp_extract(part, f"^{REFERENCE}", 0)
        name = F.regexp_extract(found, "^&(.*);$", 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10).cast("bigint")).otherwise(F.substring(name, 2, 7).try_cast("bigint"))
        char = F.when(F.startswith(name, F.lit("#")), _character(number)).otherwise(names[name])
        return F.when((found != "") & char.isNotNull(), F.concat(char, F.substring(part, F.length(found) + 1, F.length(part)))).otherwise(part)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, f"(?={REFERENCE})"), decoded), "")).otherwise(text)


def page_text(html: Column) -> Column:
    """Paragraph text of a page: scripts and styles out, breaks at block
    tags, entities decoded, blank lines dropped."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</?(?:p|div)\b[^>]*>", "\n")
    out = decode_entities(F.regexp_replace(out, r"<[^>]*>", ""))
    lines = F.filter(F.transform(F.split(out, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(lines, "\n")


def extract_listing(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Links of a list page as rows (url, title, issue), markup inside a title dropped and entities decoded.

    ``issue`` is the label that stands right behind a link, null if there is none.
    """
    p = r'(?s)<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>(?:\s*<lable>([^<]+)</lable>)?'
    found = pages.select(key, F.posexplode(F.regexp_extract_all("html", F.lit(p), F.lit(0))).alias("pos", "raw"))
    title = tx.strip(decode_entities(F.regexp_replace(F.regexp_extract("raw", p, 2), "<[^>]*>", "")))
    issue = F.nullif(tx.strip(decode_entities(F.regexp_extract("raw", p, 3))), F.lit(""))
    return found.select(key, "pos", decode_entities(F.regexp_extract("raw", p, 1)).alias("url"), title.alias("title"), issue.alias("issue"))


def last_page(html: Column) -> Column:
    """Highest page number linked from a list page."""
    numbers = F.transform(F.regexp_extract_all(html, F.lit(r"[?&]page=(\d+)"), F.lit(1)), lambda x: x.try_cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(1))


def extract_detail(docs: DataFrame, text: str = "text") -> DataFrame:
    """A10: document number, first date, effective date, year and issue."""
    t = F.col(text)
    date = r"(\d{4})年(\d{1,2})月(\d{1,2})日"
    first = F.when(t.rlike(date), F.concat_ws("-", F.regexp_extract(t, date, 1), F.lpad(F.regexp_extract(t, date, 2), 2, "0"), F.lpad(F.regexp_extract(t, date, 3), 2, "0")))
    return docs.withColumn("doc_number", F.regexp_extract(t, "([一-龥]{1,6}〔\\d{4}〕\\d+号)", 1)).withColumn("pub_date", first).withColumn(
        "effective_date", tx.arabic_effective_date(t)
    ).withColumn("year", tx.issue_year(t)).withColumn("issue_num", tx.issue_number(t))

"""Citation extraction, resolution and edge tables.

Articles are ``(law_id, global_order, type, part_num, chapter_num, section_num,
article_num, article_number, content)``; laws carry ``id, title, pub_date,
is_current``. Extraction only touches ``content`` and runs before any shuffle,
so the text itself is never shuffled: what moves are the short citation rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statutelake.functions.numerals import NUMERAL, NUMERAL_ANY, numeral_to_int
from statutelake.operators.lineage import materialize, step
from statutelake.operators.ordered import top_per_group

PRC = "中华人民共和国"
CJK = "\\u4e00-\\u9fff"

# The four quoted-citation patterns (Q14) and the self citation.
QUOTED = f"[《〈]([^》〉]{{2,40}})[》〉]第({NUMERAL})条"
QUOTED_CASE = f"《([^》]{{2,30}})》第({NUMERAL_ANY})条"
QUOTED_EXPAND = "《([^》]{4,30})》第([一二三四五六七八九十百千零\\d]+)条"
SELF = f"(?:本法|本条例|本规定|本办法|本规则|本决定|本解释)[^第]{{0,10}}第({NUMERAL})条"
SELF_EXPAND = "(?:本法|依照|适用|参照)第([一二三四五六七八九十百千零\\d]+)条"
ISSUERS = ["最高人民法院", "最高人民检察院", "国务院", "公安部", "司法部", "全国人民代表大会", "中央军事委员会"]
# An ambiguous short name, the title it occurs in, and its meaning.
CONTEXT_ALIASES = [
    ("内地与香港特别行政区相互执行仲裁裁决的补充安排", "安排", "最高人民法院关于内地与香港特别行政区相互执行仲裁裁决的安排"),
    ("国有土地上房屋征收补偿决定案件", "条例", "国有土地上房屋征收与补偿条例"),
    ("在审理经济纠纷案件中涉及经济犯罪嫌疑若干问题的规定", "规定", "最高人民法院关于在审理经济纠纷案件中涉及经济犯罪嫌疑若干问题的规定"),
    ("商品房买卖合同", "合同法", "中华人民共和国合同法"),
    ("全民所有制工业企业分立", "条例", "全民所有制工业企业转换经营机制条例"),
    ("全民所有制工业企业分立", "企业法", "中华人民共和国全民所有制工业企业法"),
    ("香港特别行政区基本法》第十三条", "基本法", "中华人民共和国香港特别行政区基本法"),
]
CRIMINAL_LAW = "中华人民共和国刑法"


def strip_prc(title: Column) -> Column:
    return F.trim(F.replace(title, F.lit(PRC), F.lit("")))


def _found(content: str, pattern: str) -> Column:
    return F.posexplode(F.regexp_extract_all(F.col(content), F.lit(pattern), F.lit(0)))


def extract(df: DataFrame, keys: list[str], content: str, pattern: str, title_group: int | None, number_group: int) -> DataFrame:
    """One row per match: keys, ``pos``, ``raw_text``, ``to_title``, ``to_label``."""
    return _split_match(df.select(*keys, _found(content, pattern).alias("pos", "raw_text")), keys, pattern, title_group, number_group)


def cite_quoted(nodes: DataFrame, keys: list[str], pattern: str = QUOTED, content: str = "content") -> DataFrame:
    """Quoted title followed by an article number."""
    return extract(nodes, keys, content, pattern, 1, 2)


def cite_self(nodes: DataFrame, keys: list[str], pattern: str = SELF, content: str = "content") -> DataFrame:
    """J3: 'this law' citations; the caller supplies the title they mean."""
    return extract(nodes, keys, content, pattern, None, 1)


def short_titles(laws: DataFrame) -> DataFrame:
    """Q4: short titles that exactly one current law has, as (short, full)."""
    return (
        laws.filter(F.col("is_current") == 1)
        .select(strip_prc(F.col("title")).alias("short"), "title")
        .groupBy("short")
        .agg(F.count("*").alias("n"), F.max("title").alias("full"))
        .filter((F.col("n") == 1) & (F.length("short") >= 2))
        .select("short", "full")
    )


# The text between two article labels, and the later label's number. Matches
# follow one another (\\G), so the text behind the last label is not retried.
SEGMENT = f"\\G((?s:.*?))第({NUMERAL})条"
BROADCAST_ENDINGS = 100_000


def _before(segment: str) -> Column:
    """What stands before the label that ends a segment; a label has one 第, its first character."""
    return F.expr(f"left({segment}, length({segment}) - length(substring_index({segment}, '第', -1)) - 1)")


def title_lengths(titles: DataFrame) -> list[int]:
    """The lengths that short titles have: a few numbers, however many titles there are."""
    return sorted(r[0] for r in titles.select(F.length("short")).distinct().collect())


def labelled_segments(content: Column, longest: int) -> Column:
    """What stands before each article label, as far as the longest title and one character more, with the label."""
    matches = F.regexp_extract_all(content, F.lit(SEGMENT), F.lit(0))

    def cut(m: Column) -> Column:
        label = F.length(F.substring_index(m, "第", -1)) + 1
        return F.right(m, F.least(F.length(m), label + F.lit(longest + 1)))

    def keep(m: Column) -> Column:
        size = F.length(m) - F.length(F.substring_index(m, "第", -1)) - 1
        return (size >= 2) & ~F.substr(m, size, F.lit(1)).isin("《", "》", "〈", "〉")

    return F.filter(F.transform(matches, cut), keep)


def match_short(matches: DataFrame, keys: list[str], titles: DataFrame, lengths: list[int]) -> DataFrame:
    """Longest known title that ends the text before each label (F1).

    A title may hold any characters and have any length; it may not stand
    directly behind a quotation mark. Texts whose last two characters end no
    title are left out first; of the others the distinct ones are matched once.
    """
    endings = titles.select(F.right("short", F.lit(2)).alias("ending")).distinct()
    if endings.limit(BROADCAST_ENDINGS + 1).count() <= BROADCAST_ENDINGS:
        endings = F.broadcast(endings)
    found = (
        matches.select(*keys, "pos", _before("raw_text").alias("run"), F.expr("rtrim('条', substring_index(raw_text, '第', -1))").alias("number"))
        .withColumn("ending", F.right("run", F.lit(2)))
        .join(endings, "ending", "left_semi")
        .drop("ending")
    )
    runs = found.select("run").distinct()
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("run"))
    suffixes = runs.select("run", F.explode(sizes).alias("size")).filter(
        ~F.expr("substring(run, length(run) - size, IF(length(run) > size, 1, 0))").isin("《", "》", "〈", "〉")
    )
    longest = (
        suffixes.withColumn("short", F.expr("right(run, size)"))
        .join(titles, "short")
        .groupBy("run")
        .agg(F.max_by(F.struct("short", "full"), "size").alias("hit"))
    )
    return found.join(longest, "run").select(
        *keys,
        "pos",
        F.concat("hit.short", F.lit("第"), "number", F.lit("条")).alias("raw_text"),
        F.col("hit.full").alias("to_title"),
        F.concat(F.lit("第"), "number", F.lit("条")).alias("to_label"),
    )


def cite_short(nodes: DataFrame, keys: list[str], titles: DataFrame, content: str = "content") -> DataFrame:
    """Bare short titles before an article number, longest title first."""
    titles = materialize(titles)
    lengths = title_lengths(titles)
    segments = labelled_segments(F.col(content), max(lengths, default=0))
    runs = nodes.select(*keys, F.posexplode(segments).alias("pos", "raw_text"))
    return match_short(materialize(runs), keys, titles, lengths)


def context_alias(law_title: Column, short: Column) -> Column:
    """Full title that a short name stands for inside certain laws."""
    alias = F.lit(None).cast("string")
    for context, name, full in reversed(CONTEXT_ALIASES):
        alias = F.when((short == name) & law_title.contains(context), full).otherwise(alias)
    return alias


def title_ids(laws: DataFrame) -> DataFrame:
    """Q5: title to the id of its newest current version."""
    return (
        laws.filter(F.col("is_current") == 1)
        .groupBy("title")
        .agg(F.max_by("id", F.struct("pub_date", "id")).alias("preferred_id"))
    )


LOCATION = ["article_num", "chapter_num", "section_num", "part_num"]


def located_labels(articles: DataFrame) -> DataFrame:
    """(law_id, label) to the location of its first article in reading order.

    Each coordinate is its own ``min_by`` over a number: the buffers are then of
    fixed width and the aggregation hashes, combines on the map side and never
    sorts.
    """
    label = F.regexp_extract("article_number", f"^(第{NUMERAL}条)", 1)
    return (
        articles.select("law_id", "global_order", "article_num", "chapter_num", "section_num", "part_num", label.alias("label"))
        .filter(F.col("label") != "")
        .groupBy("law_id", "label")
        .agg(*[F.min_by(c, "global_order").alias(f"loc_{c}") for c in LOCATION])
    )


def title_keys(laws: DataFrame) -> DataFrame:
    """(key, law_id, newest): the full and short title of every law; ``newest`` marks the preferred version of its title."""
    titled = laws.select(F.col("id").alias("law_id"), "title").join(title_ids(laws), "title", "left")
    return titled.select(
        F.explode(F.array_distinct(F.array(F.trim("title"), strip_prc(F.col("title"))))).alias("key"),
        "law_id",
        F.coalesce(F.col("law_id") == F.col("preferred_id"), F.lit(False)).alias("newest"),
    )


def title_variants(title: Column) -> Column:
    """The ordered spellings under which a cited title is looked up."""
    blank = r"(?U)\s+"
    tight = F.regexp_replace(title, blank, "")
    issuers = "|".join(ISSUERS)
    joint = F.regexp_replace(F.regexp_replace(title, f"{blank}(?={issuers})", "、"), blank, "")
    first = F.regexp_replace(title, r"(?U)^(\S*)\s+", "$1、")
    forms = [form for base in (title, tight, joint, first) for form in (base, strip_prc(base))]
    return F.array_distinct(F.array(*forms))


#: Marks targets whose title is taken as it is: that of the citing law.
OWN_TITLE = "-"


def law_contexts(law_title: Column) -> Column:
    """Which of the fixed contexts occur in a law's title, as text; hardly any law has one."""
    return F.concat_ws("", *[F.when(law_title.contains(context), f"{i};") for i, (context, _, _) in enumerate(CONTEXT_ALIASES)])


def _alias_of(contexts: Column, short: Column) -> Column:
    """``context_alias`` from the contexts of a title in place of the title."""
    alias = F.lit(None).cast("string")
    for i, (_, name, full) in reversed(list(enumerate(CONTEXT_ALIASES))):
        alias = F.when((short == name) & contexts.contains(f"{i};"), full).otherwise(alias)
    return alias


def resolve_targets(targets: DataFrame, shorts: DataFrame, articles: DataFrame, laws: DataFrame) -> DataFrame:
    """The location of each distinct target (to_title, contexts, to_label); Q6 order.

    Spellings are worked out once for each title, and only the laws that have a
    spelling meet the articles, by numbers. Of the laws that have the article
    the first spelling wins, then the preferred version, then the lowest id. An
    alias is tried after the title; if it is used, or nothing is found, it
    becomes the cited title (``final_title``).
    """
    numbered = materialize(targets.withColumn("target", F.monotonically_increasing_id()))
    named = numbered.select("to_title", "contexts").distinct().withColumn("short", strip_prc(F.col("to_title")))
    named = named.join(shorts.withColumnRenamed("full", "short_full"), "short", "left")
    title = F.when(F.col("contexts") == OWN_TITLE, F.col("to_title")).otherwise(F.coalesce("short_full", "to_title"))
    named = named.select("to_title", "contexts", title.alias("title")).withColumn(
        "alias_title", F.coalesce(_alias_of(F.col("contexts"), F.col("title")), F.lit(""))
    )
    named = materialize(named)
    variants = F.concat(
        F.transform(title_variants(F.col("title")), lambda v: F.struct(F.lit(0).alias("step"), v.alias("key"))),
        F.when(
            F.col("alias_title") != "",
            F.transform(title_variants(F.col("alias_title")), lambda v: F.struct(F.lit(1).alias("step"), v.alias("key"))),
        ).otherwise(F.expr("array()").cast("array<struct<step:int,key:string>>")),
    )
    tried = named.select("to_title", "contexts", F.posexplode(variants).alias("pos", "variant")).select(
        "to_title", "contexts", "pos", F.col("variant.step").alias("step"), F.col("variant.key").alias("key")
    )
    laws_of = tried.join(title_keys(laws), "key").groupBy("to_title", "contexts", "law_id").agg(
        F.min("pos").alias("pos"), F.min("step").alias("step"), F.max("newest").alias("newest")
    )
    # One number for the order of the candidates: spelling, newest version, id.
    level = (F.col("pos") * 2 + F.when(F.col("newest"), 0).otherwise(1)).cast("decimal(4,0)")
    place = level * F.lit(Decimal(1 << 64)) + F.col("law_id").cast("decimal(20,0)")
    candidates = numbered.join(laws_of.withColumn("place", place), ["to_title", "contexts"]).select(
        "target", F.col("to_label").alias("label"), "law_id", "step", "place"
    )
    names = ["loc_law_id", *[f"loc_{c}" for c in LOCATION]]
    hits = (
        candidates.join(located_labels(articles), ["law_id", "label"])
        .withColumnRenamed("law_id", "loc_law_id")
        .groupBy("target")
        .agg(*[F.min_by(n, "place").alias(n) for n in ["step", *names]])
    )
    by_title = named.join(title_ids(laws).withColumnRenamed("preferred_id", "title_id"), "title", "left").join(
        title_ids(laws).select(F.col("title").alias("alias_title"), F.col("preferred_id").alias("alias_id")), "alias_title", "left"
    )
    use_alias = (F.col("alias_title") != "") & (F.coalesce("step", F.lit(1)) == 1)
    return numbered.join(hits, "target", "left").join(by_title, ["to_title", "contexts"]).select(
        "to_title", "contexts", "to_label",
        F.when(use_alias, F.col("alias_title")).otherwise(F.col("title")).alias("final_title"),
        F.when(use_alias, F.col("alias_id")).otherwise(F.col("title_id")).alias("preferred_id"),
        *names,
    )


def first_citation(cites: DataFrame, source: list[str], target: list[str], order: list[str]) -> DataFrame:
    """The first citation of each target per source, by aggregate."""
    rest = [c for c in cites.columns if c not in source + target]
    picked = cites.groupBy(*source, *target).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("pick"))
    return picked.select(*source, *target, *[F.col(f"pick.{c}").alias(c) for c in rest])


SOURCE_KEYS = ["law_id", "global_order", "article_num", "chapter_num", "section_num", "part_num"]


def citation_matches(articles: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """All three kinds of match of an article in one scan of its text; ``longest`` is the length of the longest short title."""

    def tagged(matches: Column, number: int) -> Column:
        return F.transform(matches, lambda m, i: F.struct(F.lit(number).alias("pass"), i.alias("pos"), m.alias("raw_text")))

    text = F.col("content")
    none = F.array().cast("array<string>")

    def matches(starts: list[str], pattern: str) -> Column:
        """The pattern is only tried on texts that have one of its first characters."""
        likely = F.contains(text, F.lit(starts[0]))
        for start in starts[1:]:
            likely = likely | F.contains(text, F.lit(start))
        return F.when(likely, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)

    found = F.concat(
        tagged(matches(["《", "〈"], QUOTED), 1),
        tagged(labelled_segments(text, longest), 2),
        tagged(matches(["本"], SELF), 3),
    )
    return articles.select(*keys, F.inline(found))


def _split_match(found: DataFrame, keys: list[str], pattern: str, title_group: int | None, number_group: int) -> DataFrame:
    title = F.regexp_extract("raw_text", pattern, title_group) if title_group else F.lit(None).cast("string")
    return found.select(
        *keys,
        "pos",
        "raw_text",
        F.trim(F.regexp_replace(title, r"(?U)\s+", " ")).alias("to_title"),
        F.concat(F.lit("第"), F.regexp_extract("raw_text", pattern, number_group), F.lit("条")).alias("to_label"),
    )


def _passes(articles: DataFrame, laws: DataFrame, shorts: DataFrame) -> DataFrame:
    """The three passes over articles of current laws, with titles as they are cited.

    The matches are written once: the text is scanned a single time although
    the later steps use them several times. A bare title is known under its full
    one, a law's own title is taken as it is (``contexts`` says so).
    """
    keys = SOURCE_KEYS
    lengths = title_lengths(shorts)
    current = laws.filter(F.col("is_current") == 1).select(F.col("id").alias("law_id"), F.col("title").alias("law_title"))
    found = materialize(citation_matches(articles, keys, max(lengths, default=0)))
    quoted = _split_match(found.filter("pass = 1"), keys, QUOTED, 1, 2).withColumn("pass", F.lit(1))
    bare = match_short(found.filter("pass = 2"), keys, shorts, lengths).withColumn("pass", F.lit(2))
    own = _split_match(found.filter("pass = 3"), keys, SELF, None, 1).withColumn("pass", F.lit(3))
    cites = quoted.unionByName(bare).unionByName(own).join(current, "law_id")
    amendment = F.col("law_title").startswith(CRIMINAL_LAW + "修正案")
    same = (F.col("to_title") == F.col("law_title")) | (F.col("to_title") == strip_prc(F.col("law_title")))
    return cites.filter((F.col("pass") != 2) | ~same).select(
        *keys,
        "law_title",
        "pass",
        "pos",
        "raw_text",
        "to_label",
        F.when((F.col("pass") == 3) & ~amendment, "self_ref").otherwise("cross_law").alias("ref_type"),
        F.when(F.col("pass") == 3, F.when(amendment, CRIMINAL_LAW).otherwise(F.col("law_title"))).otherwise(F.col("to_title")).alias("to_title"),
        F.when(F.col("pass") == 1, law_contexts(F.col("law_title"))).when(F.col("pass") == 2, "").otherwise(OWN_TITLE).alias("contexts"),
    )


def citation_passes(articles: DataFrame, laws: DataFrame) -> DataFrame:
    """The three passes over articles of current laws, before resolution."""
    shorts = materialize(short_titles(laws))
    cites = _passes(articles, laws, shorts).withColumn("short", F.when(F.col("pass") == 1, strip_prc(F.col("to_title"))))
    cites = cites.join(shorts.withColumnRenamed("full", "short_full"), "short", "left").withColumn("to_title", F.coalesce("short_full", "to_title"))
    return cites.select(
        *SOURCE_KEYS, "law_title", "pass", "pos", "raw_text", "to_label", "ref_type", "to_title",
        F.when(F.col("pass") == 1, context_alias(F.col("law_title"), F.col("to_title"))).alias("alias_title"),
    )


def resolved_citations(articles: DataFrame, laws: DataFrame) -> DataFrame:
    """Passes, resolution, first occurrence per article, target law id.

    The citations are written once: their distinct targets and they themselves
    are used. Distinct targets are resolved once, so a target that is cited a
    billion times is one row in the joins. Citations are dealt out by the
    article number that ``bind_edges`` joins them by, so they move once for both.
    """
    shorts = materialize(short_titles(laws))
    cites = step(lambda: _passes(articles, laws, shorts).drop("law_title"))
    targets = step(lambda: resolve_targets(cites.select("to_title", "contexts", "to_label").distinct(), shorts, articles, laws))
    joined = cites.join(targets, ["to_title", "contexts", "to_label"], "left")
    self_id = F.when(F.col("ref_type") == "self_ref", F.col("law_id"))
    found = joined.select(
        *SOURCE_KEYS, "pass", "pos", "raw_text", "to_label", "ref_type",
        F.col("final_title").alias("to_title"),
        F.col("loc_law_id").isNotNull().alias("resolved"),
        "loc_law_id", "loc_article_num", "loc_chapter_num", "loc_section_num", "loc_part_num",
        F.coalesce("loc_law_id", self_id, "preferred_id", F.when(F.col("pass") == 3, F.col("law_id"))).alias("to_law_id"),
    )
    return first_citation(found.repartition("law_id", "article_num"), SOURCE_KEYS, ["to_title", "to_label"], ["pass", "pos"])


def article_nodes(articles: DataFrame) -> DataFrame:
    """Q7: the last node of each (law, article number)."""
    return (
        articles.filter(F.col("article_num").isNotNull())
        .groupBy("law_id", "article_num")
        .agg(F.max("global_order").alias("node_order"))
    )


def bind_edges(cites: DataFrame, articles: DataFrame) -> DataFrame:
    """Attach nodes of both ends; drop edges without a source node and
    cross-law edges whose numbered target has no node."""
    index = article_nodes(articles)
    source = index.select("law_id", "article_num", F.col("node_order").alias("from_order"))
    target = index.select(
        F.col("law_id").alias("to_law_id"), F.col("article_num").alias("loc_article_num"), F.col("node_order").alias("to_order")
    )
    bound = cites.join(source, ["law_id", "article_num"]).join(target, ["to_law_id", "loc_article_num"], "left")
    dangling = (
        (F.col("ref_type") == "cross_law")
        & F.col("to_law_id").isNotNull()
        & F.col("loc_article_num").isNotNull()
        & F.col("to_order").isNull()
    )
    return bound.filter(~dangling).select(
        F.col("law_id").alias("from_law_id"),
        "from_order",
        F.col("article_num").alias("from_article_num"),
        "to_law_id",
        "to_order",
        F.col("loc_article_num").alias("to_article_num"),
        F.col("loc_chapter_num").alias("to_chapter_num"),
        F.col("loc_section_num").alias("to_section_num"),
        "ref_type",
        F.col("resolved").cast("int").alias("resolved"),
        "raw_text",
    )


def build_citations(articles: DataFrame, laws: DataFrame) -> DataFrame:
    """The whole edge table."""
    return bind_edges(resolved_citations(articles, laws), articles)


def link_cases(docs: DataFrame, laws: DataFrame, articles: DataFrame) -> DataFrame:
    """C4: case document to law to article, first mention of each target."""
    current = laws.filter(F.col("is_current") == 1)
    full = current.groupBy(F.col("title").alias("key")).agg(F.max("id").alias("law_id"), F.lit(0).alias("step"))
    short = current.groupBy(F.replace("title", F.lit(PRC), F.lit("")).alias("key")).agg(
        F.min("id").alias("law_id"), F.lit(1).alias("step")
    )
    lookup = full.unionByName(short).groupBy("key").agg(F.min_by("law_id", "step").alias("law_id"))
    cites = cite_quoted(docs, ["doc_key"], QUOTED_CASE, "full_text").withColumn(
        "article_num", numeral_to_int(F.regexp_extract("to_label", "^第(.+)条$", 1))
    ).filter(F.col("article_num").isNotNull())
    names = cites.select("to_title").distinct()
    tried = names.select(
        "to_title", F.posexplode(F.array(F.col("to_title"), F.replace("to_title", F.lit(PRC), F.lit("")))).alias("step", "key")
    )
    found = tried.join(lookup, "key").groupBy("to_title").agg(F.min_by("law_id", "step").alias("law_id"))
    linked = first_citation(cites.join(found, "to_title").drop("to_label"), ["doc_key"], ["law_id", "article_num"], ["pos"])
    return linked.join(article_nodes(articles), ["law_id", "article_num"], "left").select(
        "doc_key", "law_id", "node_order", "article_num", F.col("raw_text").alias("raw_ref"), F.col("to_title").alias("ref_law_title")
    )


def citation_stats(edges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals by kind and the share that is resolved."""
    total = F.count("*")
    resolved = F.count_if(F.col("resolved") == 1)
    return edges.groupBy(*(by or [])).agg(
        total.alias("total"),
        F.count_if(F.col("ref_type") == "cross_law").alias("cross_law"),
        F.count_if(F.col("ref_type") == "self_ref").alias("self_ref"),
        resolved.alias("resolved"),
        F.round(resolved * 100.0 / total, 1).alias("rate"),
    )


def citation_tiers(laws: DataFrame, edges: DataFrame) -> DataFrame:
    """In-degree per law and its tier."""
    degree = edges.groupBy(F.col("to_law_id").alias("id")).agg(F.count("*").alias("cited"))
    cited = F.coalesce("cited", F.lit(0))
    tier = F.lit("T5")
    for bound, name in [(1, "T4"), (5, "T3"), (10, "T2"), (20, "T1"), (50, "T0")]:
        tier = F.when(F.col("cited") >= bound, name).otherwise(tier)
    return laws.select("id", "title").join(degree, "id", "left").withColumn("cited", cited).withColumn("tier", tier)


def citation_degree(edges: DataFrame) -> DataFrame:
    """Out- and in-degree and resolution rate per law.

    An edge gives one row for each of its ends, so the edges are worked out once.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def end(law: str, cites: Column, resolved: Column, cited: Column) -> Column:
        return F.struct(F.col(law).alias("law_id"), cites.alias("cites"), resolved.alias("cites_resolved"), cited.alias("cited"))

    source = end("from_law_id", one, F.when(F.col("resolved") == 1, one).otherwise(none), none)
    target = end("to_law_id", none, none, one)
    ends = edges.select(F.inline(F.array(source, target))).filter((F.col("cited") == 0) | F.col("law_id").isNotNull())
    both = ends.groupBy("law_id").agg(*[F.sum(n).alias(n) for n in ("cites", "cites_resolved", "cited")])
    return both.withColumn("rate", F.when(F.col("cites") > 0, F.round(F.col("cites_resolved") * 100.0 / F.col("cites"), 1)))


def cited_laws(edges: DataFrame) -> DataFrame:
    """Distinct laws that a law cites."""
    return edges.filter((F.col("ref_type") == "cross_law") & F.col("to_law_id").isNotNull()).select("from_law_id", "to_law_id").distinct()


def cited_by(edges: DataFrame, laws: DataFrame) -> DataFrame:
    """Who cites an article, one row per citing article.

    The citing rows of a popular article stay rows; a list per article would
    put an unbounded group into one value.
    """
    sources = laws.select(F.col("id").alias("from_law_id"), F.col("title").alias("from_title"))
    return (
        edges.filter((F.col("resolved") == 1) & (F.col("ref_type") == "cross_law") & F.col("to_article_num").isNotNull())
        .select("to_law_id", "to_article_num", "from_law_id", "from_article_num")
        .join(sources, "from_law_id")
    )


def substrings(df: DataFrame, text: str, lengths: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` once for each distinct substring of ``text`` that has one of the ``lengths`` (column ``size``).

    The lengths are few numbers, however many rows they come from: they are broadcast, and no text is shuffled.
    """
    sized = df.filter(F.length(text) >= 1).withColumn("size", F.explode(F.sequence(F.lit(1), F.length(text)))).join(F.broadcast(lengths), "size")
    cut = F.expr(f"transform(sequence(1, length(`{text}`) - size + 1), i -> substring(`{text}`, i, size))")
    return sized.select(*df.columns, F.explode(F.array_distinct(cut)).alias(name))


def find_by_fragment(refs: DataFrame, laws: DataFrame, articles: DataFrame) -> DataFrame:
    """Article whose label is equal and whose law title contains the
    fragment; first in (law_id, global_order).

    Each title gives its substrings of the lengths that fragments have, and
    those are joined to the whole fragments: a key is as rare as the fragment.
    """
    wanted = refs.select("fragment", "label").distinct()
    frags = wanted.select("fragment").distinct().filter(F.length("fragment") >= 1)
    titles = laws.filter(F.col("is_current") == 1).select("title").distinct()
    lengths = frags.select(F.length("fragment").alias("size")).distinct()
    matches = frags.join(substrings(titles, "title", lengths, "fragment"), "fragment").select("fragment", "title").distinct()
    current = laws.filter(F.col("is_current") == 1).select(F.col("id").alias("law_id"), "title")
    labelled = articles.filter(F.col("article_number").isNotNull()).groupBy("law_id", F.col("article_number").alias("label")).agg(
        F.min("global_order").alias("global_order")
    )
    return (
        wanted.join(matches, "fragment")
        .join(current, "title")
        .join(labelled, ["law_id", "label"])
        .groupBy("fragment", "label")
        .agg(F.min(F.struct("law_id", "global_order")).alias("hit"))
        .select("fragment", "label", F.col("hit.law_id").alias("law_id"), F.col("hit.global_order").alias("global_order"))
    )


def expand_hits(hits: DataFrame, articles: DataFrame, laws: DataFrame) -> DataFrame:
    """Articles cited by the hits and not among them, with provenance.

    ``hits`` is (q_id, law_id, global_order). Returns the added rows.
    """
    keys = ["q_id", "law_id", "global_order"]
    texts = hits.join(articles.select("law_id", "global_order", "article_number", "content"), ["law_id", "global_order"])
    named = texts.join(laws.select(F.col("id").alias("law_id"), F.col("title").alias("law_title")), "law_id")
    keys = keys + ["article_number", "law_title"]
    quoted = cite_quoted(named, keys, QUOTED_EXPAND).withColumn("kind", F.lit("引用链"))
    own = cite_self(named, keys, SELF_EXPAND).withColumn("to_title", F.col("law_title")).withColumn("kind", F.lit("同法引用"))
    refs = quoted.unionByName(own).withColumnRenamed("to_title", "fragment").withColumnRenamed("to_label", "label")
    found = find_by_fragment(refs, laws, articles).select(
        "fragment", "label", F.col("law_id").alias("new_law_id"), F.col("global_order").alias("new_order")
    )
    added = refs.join(found, ["fragment", "label"]).withColumn(
        "source", F.concat("kind", F.lit(":"), F.coalesce("article_number", F.lit("")), F.lit("→"), "label")
    )
    old = hits.select("q_id", F.col("law_id").alias("new_law_id"), F.col("global_order").alias("new_order"))
    fresh = added.join(old, ["q_id", "new_law_id", "new_order"], "left_anti")
    return (
        fresh.groupBy("q_id", F.col("new_law_id").alias("to_law_id"), F.col("new_order").alias("to_order"))
        .agg(F.min_by("source", F.struct("law_id", "global_order", "kind", "pos")).alias("source"))
    )


def cases_for_article(links: DataFrame, docs: DataFrame, laws: DataFrame) -> DataFrame:
    """Cases that cite an article, with the law's title."""
    return (
        links.join(docs.select("doc_key", F.col("title").alias("case_title"), "pub_date"), "doc_key")
        .join(laws.select(F.col("id").alias("law_id"), F.col("title").alias("law_title")), "law_id")
        .select("law_title", "article_num", "doc_key", "case_title", "pub_date")
    )


def longest_per_run(cands: DataFrame) -> DataFrame:
    """of the overlapping titles at one start keep the longest."""
    return top_per_group(cands, ["doc", "start"], [F.length("title").desc(), F.col("title")], 1)

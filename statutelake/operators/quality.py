"""Data-quality suites (L1-L15). Each returns issues as rows.

Rules on one text are column expressions that yield an array of findings, so
any number of rules costs one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statutelake.functions.text import repeal_number
from statutelake.operators import relational as rel
from statutelake.operators.ordered import large_keys, top_per_group
from statutelake.operators.search import search_docs

Findings = list[tuple[str, str, Column]]

# Patterns of the text-noise and style rules.
PAGE_FIELD = r"(?U)[-－]\s*PAGE\s+\d+\s*[-－]"
L_BEFORE_UNIT = r"(?U)(?<!\w)l(?=月|年|日|万|千|百|元|％|%|位|个|项|条|款)"
LEGAL_WORDS = ["pH", "P2P", "DNA", "RNA", "GDP", "CPI", "GPS", "HIV", "ATM", "IT", "TV", "PC", "APP", "Wi-Fi", "WiFi", "IP", "QQ", "AI"]
UNTRANSLATED_TERMS = ["人民法院", "人民检察院", "最高人民法院", "最高人民检察院", "国务院"]
# Repealing decision and the day it took effect.
REPEAL_DATES = {
    "法发〔1994〕16号": "1994-07-27", "法发〔1996〕34号": "1996-12-31", "法释〔2000〕20号": "2000-07-25", "法释〔2001〕32号": "2001-12-28",
    "法释〔2002〕6号": "2002-03-10", "法释〔2002〕13号": "2002-05-29", "法释〔2008〕15号": "2008-12-24", "法释〔2012〕13号": "2012-09-29",
    "法释〔2013〕2号": "2013-01-18", "法释〔2015〕2号": "2015-01-19", "法释〔2015〕12号": "2015-07-06", "法释〔2017〕17号": "2017-10-01",
    "法释〔2019〕11号": "2019-07-20", "法释〔2020〕16号": "2021-01-01",
}


def run_rules(df: DataFrame, keys: list[str], rules: Findings) -> DataFrame:
    """(keys, severity, rule) for every rule that a row breaks."""
    found = F.array(*[F.when(test, F.struct(F.lit(sev).alias("severity"), F.lit(name).alias("rule"))) for sev, name, test in rules])
    return df.select(*keys, F.inline(F.filter(found, lambda x: x.isNotNull())))


def noise(articles: DataFrame) -> DataFrame:
    """Page fields, hyperlinks, scripts, and the letter l read as 1."""
    t = F.col("content")
    return run_rules(articles, ["law_id", "global_order"], [
        ("high", "page_field", t.rlike(PAGE_FIELD)),
        ("high", "hyperlink", t.contains("HYPERLINK")),
        ("high", "javascript", t.rlike("(?i)javascript:")),
        ("medium", "l_before_unit", t.rlike(L_BEFORE_UNIT)),
        ("medium", "l_before_digit", t.rlike(r"(?U)(?<!\w)l(?=\d)")),
        ("medium", "l_after_digit", t.rlike(r"(?U)(?<=\d)l(?!\w)")),
        ("medium", "l_in_formula", t.rlike("[(（]l－|－l[)）]")),
    ])


def suspicious_latin(articles: DataFrame) -> DataFrame:
    """Latin fragments that are neither allowed words nor model names.

    A word is allowed as written, or if its upper form is listed. A single
    letter counts only between a digit and a unit, or before a digit.
    """
    frags = articles.select(
        "law_id", "global_order", "content",
        F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit("[A-Za-z][A-Za-z\\d\\-]*"), F.lit(0)))).alias("fragment"))
    legal = (
        F.col("fragment").isin(*LEGAL_WORDS) | F.upper("fragment").isin(*LEGAL_WORDS)
        | F.col("fragment").rlike("[A-Za-z]+\\d*[-－]\\d+|\\d+[A-Za-z]+|[a-zA-Z]+\\d+[a-zA-Z]*|P2P|pH值?")
    )
    around = F.expr("substring(content, greatest(instr(content, fragment) - 4, 1), instr(content, fragment) + 5 - greatest(instr(content, fragment) - 4, 1))")
    letter = F.rlike(around, F.concat(F.lit("\\d"), "fragment", F.lit("[月年日万]"))) | F.rlike(around, F.concat("fragment", F.lit("\\d")))
    return frags.filter(~legal & ((F.length("fragment") > 1) | letter)).drop("content")


# Signs, the pattern of an English law name, and the names with one spelling.
CHINESE_PUNCTUATION = ["，", "。", "；", "：", "、", "（", "）", "！", "？", '"']
LAW_NAME = r"(?:the\s+)?([A-Z][A-Za-z\s]+(?:Law|Code|Regulation))"
LAW_NAMES = ["Criminal Law", "Civil Code"]


def _other_name(name: Column) -> Column:
    """A spelling of a common law's name that differs in case from the agreed one."""
    name = F.trim(name)
    return F.lower(name).isin(*[n.lower() for n in LAW_NAMES]) & ~name.isin(*LAW_NAMES)


def translation_style(articles: DataFrame) -> DataFrame:
    """Five rule families over the translation."""
    t = F.col("content_en")
    low = F.lower(t)
    modal = low.contains("shall") | low.contains("may") | low.contains("must")
    return run_rules(articles.filter(rel.filled("content_en")), ["law_id", "global_order"], [
        ("high", "untranslated_term", F.exists(F.array(*[F.lit(w) for w in UNTRANSLATED_TERMS]), lambda w: F.contains(t, w))),
        ("medium", "court_possessive", t.rlike("(?i)people court")),
        ("medium", "procuratorate_possessive", t.rlike("(?i)people procuratorate")),
        ("medium", "long_code_name", t.rlike("(?i)Civil Code of the People's Republic of China")),
        ("high", "untranslated_title_mark", t.rlike("[《》]")),
        ("low", "no_modal_verb", (F.length(t) > 100) & ~modal),
        ("medium", "will_or_would", t.rlike("(?i)\\b(?:will|would)\\b")),
        ("high", "untranslated_article", t.rlike("第[一二三四五六七八九十百千\\d]+条")),
        ("high", "untranslated_paragraph", t.rlike("第[一二三四五六七八九十\\d]+[款项]")),
        ("low", "lower_case_article", t.rlike("\\barticle\\s+\\d+")),
        *[("high", f"chinese_punctuation {sign}", t.contains(sign)) for sign in CHINESE_PUNCTUATION],
        ("medium", "full_width_blank", t.contains("\u3000")),
        ("low", "law_name", F.exists(F.regexp_extract_all(t, F.lit(LAW_NAME), F.lit(1)), _other_name)),
        ("low", "double_blank", t.rlike(" {2,}")),
    ])


def structure_issues(nodes: DataFrame, span: int) -> DataFrame:
    """L2: article numbering and empty headings in one issues table. No text is moved: a heading's is not asked for."""
    large = large_keys(nodes, ["law_id"])
    gaps = rel.gaps_of(nodes.filter(F.col("type") == "article"), span, large).select("law_id", "global_order", F.col("issue").alias("rule"))
    empty = rel.empty_headings_of(nodes.withColumn("content", F.lit(None).cast("string")), span, large).select("law_id", "global_order", F.lit("empty_heading").alias("rule"))
    return gaps.unionByName(empty)


def source_against_table(source: DataFrame, loaded: DataFrame, samples: int = 5) -> DataFrame:
    """L1: node-by-node comparison, first differences per law.

    Both sides are (law_id, global_order, type, content); contents are compared
    by hash, so texts are not shuffled.
    """
    side = lambda df, name: df.select("law_id", "global_order", F.struct("type", F.md5("content").alias("h")).alias(name))
    both = side(source, "a").join(side(loaded, "b"), ["law_id", "global_order"], "full")
    rule = F.when(F.col("a").isNull(), "not_in_source").when(F.col("b").isNull(), "not_loaded").when(F.col("a.type") != F.col("b.type"), "type").when(
        ~F.col("a.h").eqNullSafe(F.col("b.h")), "content")
    diff = both.withColumn("rule", rule).filter(F.col("rule").isNotNull()).select("law_id", "global_order", "rule")
    return top_per_group(diff, ["law_id"], [F.col("global_order")], samples, rank="sample")


def case_suite(docs: DataFrame, links: DataFrame) -> DataFrame:
    """L3: checks on the court documents as (check, value)."""
    facts = docs.agg(
        F.count("*").alias("docs"), F.count_if(rel.missing(F.col("full_text"))).alias("empty_text"),
        F.count_if(~rel.missing(F.col("keywords"))).alias("with_keywords"), F.count_if(~rel.missing(F.col("ruling_gist"))).alias("with_gist"))
    linked = links.agg(F.count("*").alias("links"), F.count("node_order").alias("resolved_links"), F.count_distinct("doc_key").alias("linked_docs"))
    return facts.unpivot([], facts.columns, "check", "value").unionByName(linked.unpivot([], linked.columns, "check", "value"))


def case_probes(docs: DataFrame, terms: DataFrame, columns: list[str]) -> DataFrame:
    """L3: (term, docs, found) of every probe term: in how many court documents the search finds it, and whether in any."""
    hits = search_docs(docs, "doc_key", columns, terms).select("term", "doc_key").distinct()
    counts = hits.groupBy("term").agg(F.count("*").alias("docs"))
    return terms.select("term").distinct().join(counts, "term", "left").select(
        "term", F.coalesce("docs", F.lit(0)).alias("docs"), F.col("docs").isNotNull().alias("found"))


def translation_keys(docs: DataFrame, translations: DataFrame) -> DataFrame:
    """L3: translated documents against the table, as (check, value): all, with a known key, of these with a title, without a known key,
    and documents of the table that have a title and no translation."""
    known = docs.select("doc_key", F.col("title_en").alias("own_title"), F.lit(1).alias("known"))
    both = translations.select("doc_key", F.lit(1).alias("translated")).distinct().join(known, "doc_key", "full")
    titled = ~rel.missing(F.col("own_title"))
    facts = both.agg(
        F.count("translated").alias("translations"), F.count_if(F.col("known").isNotNull() & F.col("translated").isNotNull()).alias("known_keys"),
        F.count_if(titled & F.col("translated").isNotNull()).alias("known_with_title"), F.count_if(F.col("known").isNull()).alias("unknown_keys"),
        F.count_if(titled & F.col("translated").isNull()).alias("title_without_translation"))
    return facts.unpivot([], facts.columns, "check", "value")


def currency_suite(laws: DataFrame) -> DataFrame:
    """Currency within each source, and of the second source against the
    current version of the first."""
    own = rel.check_currency(laws.filter(F.col("source") == "flk")).select("id", F.col("problem").alias("rule"))
    live = laws.filter((F.col("source") == "gazette") & rel.missing(F.col("repealed_by")))
    current = laws.filter((F.col("source") == "flk") & (F.col("is_current") == 1))
    pairs = rel.match_versions(current, live).join(live.select(F.col("id").alias("b_id"), "is_current"), "b_id")
    cross = pairs.withColumn("rule", F.when((F.col("same_version") == 1) & (F.col("is_current") != 1), "same_version_not_current").when(
        (F.col("same_version") == 0) & (F.col("is_current") == 1), "other_version_current")).filter(F.col("rule").isNotNull()).select(F.col("b_id").alias("id"), "rule")
    alone = rel.check_currency(laws.filter(F.col("source") == "gazette").join(current.select("title_key"), "title_key", "left_anti")).select("id", F.col("problem").alias("rule"))
    return own.unionByName(cross).unionByName(alone)


def repeal_suite(marks: DataFrame, laws: DataFrame) -> DataFrame:
    """Marks without effect, rows newer than the repeal, zeros that no
    mark explains. ``marks`` is (title_key, doc_number, mark)."""
    rows = rel.match_repeals(marks, laws.select("title_key", "doc_number", "id", "pub_date", "is_current"))
    effective = F.create_map(*[F.lit(x) for kv in REPEAL_DATES.items() for x in kv])[repeal_number(F.col("mark"))]
    kept = rows.filter(F.col("is_current") != 0).select("id", F.lit("mark_not_applied").alias("rule"))
    newer = rows.filter(F.col("pub_date") > effective).select("id", F.lit("newer_than_repeal").alias("rule"))
    zeros = laws.filter(F.col("is_current") == 0).join(rows.select("id").distinct(), "id", "left_anti").select("id", F.lit("unexplained_zero").alias("rule"))
    return kept.unionByName(newer).unionByName(zeros).distinct()


def enhancement_suite(pairs: DataFrame, hits: DataFrame, hints: DataFrame, laws: DataFrame) -> DataFrame:
    """Blanks, duplicates, zero or stale hits in alias tables and hints
    on titles that are not current. ``pairs`` is (source, target, hits)."""
    blank = pairs.filter(rel.missing(F.col("source")) | rel.missing(F.col("target"))).select(F.col("target").alias("item"), F.lit("blank").alias("rule"))
    twice = rel.duplicates(pairs, ["source", "target"]).select(F.col("target").alias("item"), F.lit("duplicate").alias("rule"))
    now = hits.groupBy(F.col("term").alias("target")).agg(F.count("*").alias("now"))
    counted = pairs.join(now, "target", "left").na.fill(0, ["now"])
    zero = counted.filter(F.col("now") == 0).select(F.col("target").alias("item"), F.lit("no_hits").alias("rule"))
    stale = counted.filter((F.col("now") > 0) & (F.col("now") != F.col("hits"))).select(F.col("target").alias("item"), F.lit("stale_hits").alias("rule"))
    current = laws.filter(F.col("is_current") == 1).select(F.col("title").alias("law_title"))
    lost = hints.join(current, "law_title", "left_anti").select(F.col("law_title").alias("item"), F.lit("title_not_current").alias("rule"))
    return blank.unionByName(twice).unionByName(zero).unionByName(stale).unionByName(lost)


def id_consistency(index: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents whose embedded id differs from the index."""
    return documents.join(index.select("filename", F.col("id").alias("index_id")), "filename").filter(~F.col("id").eqNullSafe(F.col("index_id")))


def without_output(sources: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Sources that have no output."""
    return sources.join(outputs.select(key), key, "left_anti")


def run_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Added per domain, removed, and currency changes between runs."""
    added = after.join(before.select("id"), "id", "left_anti").groupBy(F.concat(F.lit("added "), "legal_domain").alias("item")).agg(F.count("*").alias("n"))
    removed = before.join(after.select("id"), "id", "left_anti").agg(F.count("*").alias("n")).select(F.lit("removed").alias("item"), "n")
    flips = before.select("id", F.col("is_current").alias("was")).join(after.select("id", "is_current"), "id").filter(F.col("was") != F.col("is_current"))
    changes = flips.groupBy(F.concat(F.lit("currency "), "was", F.lit(" to "), "is_current").alias("item")).agg(F.count("*").alias("n"))
    return added.unionByName(removed).unionByName(changes)


def edge_deltas(before: DataFrame, after: DataFrame, keys: list[str], resolved: str = "resolved") -> DataFrame:
    """What became of the citations between two runs, as (ref_type, kind, n).

    Edge tables are multisets: equal edges, by ``keys`` (``ref_type`` among them),
    are told apart by their number only. Kinds: ``kept`` is in both runs, ``lost``
    only in the first, ``won`` only in the second one; ``resolved`` and
    ``unresolved`` are how many more or fewer of an edge have a target now, those
    of lost and won edges included. So won - lost is the change of the number of
    edges, and resolved - unresolved that of resolved ones.
    """
    count = [F.count("*").alias("n"), F.count_if(F.col(resolved) == 1).alias("r")]
    x = before.groupBy(*keys).agg(*count).select(*keys, F.col("n").alias("n0"), F.col("r").alias("r0"), F.lit(0).cast("bigint").alias("n1"), F.lit(0).cast("bigint").alias("r1"))
    y = after.groupBy(*keys).agg(*count).select(*keys, F.lit(0).cast("bigint").alias("n0"), F.lit(0).cast("bigint").alias("r0"), F.col("n").alias("n1"), F.col("r").alias("r1"))
    both = x.unionByName(y).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n0", "r0", "n1", "r1")])
    n0, r0, n1, r1 = (F.col(c) for c in ("n0", "r0", "n1", "r1"))
    zero = F.lit(0)
    kinds = both.select(
        "ref_type", F.least(n0, n1).alias("kept"), F.greatest(n0 - n1, zero).alias("lost"), F.greatest(n1 - n0, zero).alias("won"),
        F.greatest(r1 - r0, zero).alias("resolved"), F.greatest(r0 - r1, zero).alias("unresolved"),
    )
    names = ["kept", "lost", "won", "resolved", "unresolved"]
    totals = kinds.groupBy("ref_type").agg(*[F.sum(c).alias(c) for c in names])
    return totals.unpivot(["ref_type"], names, "kind", "n").filter("n > 0")


def edge_totals(deltas: DataFrame) -> DataFrame:
    """Change of all edges, of resolved ones and of each type, as (item, change)."""
    sign = F.when(F.col("kind").isin("won", "resolved"), F.col("n")).when(F.col("kind").isin("lost", "unresolved"), -F.col("n")).otherwise(0)
    number = F.col("kind").isin("won", "lost")
    signed = deltas.withColumn("change", sign)
    whole = signed.agg(F.sum(F.when(number, F.col("change")).otherwise(0)).alias("total"), F.sum(F.when(number, 0).otherwise(F.col("change"))).alias("resolved"))
    by_type = signed.filter(number).groupBy(F.col("ref_type").alias("item")).agg(F.sum("change").alias("change"))
    return whole.na.fill(0).unpivot([], ["total", "resolved"], "item", "change").unionByName(by_type)


def edge_integrity(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edge ends that are not in the node table. Both ends of an edge come from one pass over the edges."""

    def end(law: str, order: str) -> Column:
        return F.struct(F.col(law).alias("law_id"), F.col(order).alias("global_order"), F.lit(order).alias("side"))

    ends = edges.select(F.inline(F.array(end("from_law_id", "from_order"), end("to_law_id", "to_order")))).filter(F.col("global_order").isNotNull())
    return ends.join(nodes.select("law_id", "global_order"), ["law_id", "global_order"], "left_anti")


def changed_ids(files: DataFrame, index: DataFrame) -> DataFrame:
    """Ids embedded in files (filename, old_id) that the index does not know or has under another number."""
    joined = files.join(index.select("filename", F.col("id").alias("new_id")), "filename", "left")
    wrong = joined.filter(F.col("new_id").isNull() | (F.col("new_id") != F.col("old_id")))
    return wrong.select("old_id", "new_id", F.when(F.col("new_id").isNull(), "orphan").otherwise("changed").alias("rule"))

"""Text search and layered retrieval.

Questions come as a table. Work on text is done once per distinct term and
only the few best rows of a term are joined to the questions that use it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statutelake.functions.text import cjk_count, ngrams, windows
from statutelake.operators.citations import strip_prc, substrings
from statutelake.operators.ordered import top_per_group

BROADCAST_TERMS = 100_000
MAX_INITIALS = 2_000  # first characters of terms; bounded by the alphabet
LAW_CATEGORIES = ["法律", "宪法", "修正案", "法律解释", "监察法规"]
INTERPRETATIONS = ["司法解释"]
NODE = ["law_id", "global_order"]


def build_postings(texts: DataFrame, keys: list[str], text: str, n: int = 3) -> DataFrame:
    """(gram, keys, pos) of the folded text."""
    return texts.select(*keys, F.posexplode(ngrams(F.lower(text), n)).alias("pos", "gram"))


def phrase_match(terms: DataFrame, postings: DataFrame, keys: list[str]) -> DataFrame:
    """Documents that contain the consecutive grams of a term, from a
    stored postings table. Returns (term, keys).

    The terms' grams are counted: at most ``BROADCAST_TERMS`` are broadcast, so
    that postings of other grams are never shuffled; more are joined by shuffle.
    """
    grams = terms.select("term", F.posexplode(ngrams(F.lower("term"), 3)).alias("offset", "gram"))
    if grams.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        grams = F.broadcast(grams)
    sizes = terms.select("term", (F.length("term") - 2).alias("size"))
    runs = (
        postings.join(grams, "gram").groupBy("term", *keys, (F.col("pos") - F.col("offset")).alias("start")).agg(F.count("*").alias("found"))
    )
    return runs.join(sizes, "term").filter(F.col("found") == F.col("size")).select("term", *keys).distinct()


def match_terms(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, sizes: tuple[int, ...] = (3,)) -> DataFrame:
    """(term, keys) for every text that contains a term.

    Each text position gives one short window, as long as the longest term; it
    meets the terms by an equi join on its first characters and is verified
    against the whole term. Whole texts are covered, yet no text is copied or
    shuffled. Positions that no term starts with are skipped inside the regular
    expression. Terms are counted first: only a table of at most
    ``BROADCAST_TERMS`` rows is broadcast, a larger one is joined by shuffle.
    """
    anchored = terms.select("term").distinct().withColumn("size", F.least(F.length("term"), F.lit(3))).filter(
        F.col("size").isin(*sizes)
    ).withColumn("folded", F.lower("term")).withColumn("gram", F.expr("substring(folded, 1, size)"))
    facts = anchored.agg(F.count("*").alias("n"), F.max(F.length("folded")).alias("longest"), F.collect_set(F.substring("folded", 1, 1)).alias("initials")).first()
    width = facts["longest"] or 1
    initials = sorted(facts["initials"]) if 0 < len(facts["initials"]) <= MAX_INITIALS else None
    cut = texts.select(*keys, F.explode(windows(F.lower(text), width, initials)).alias("window"))
    grams = [F.when(F.length("window") >= n, F.substring("window", 1, n)) for n in sizes]
    keyed = cut.select(*keys, "window", grams[0].alias("gram")) if len(sizes) == 1 else cut.select(
        *keys, "window", F.explode(F.array(*grams)).alias("gram"))
    small = facts["n"] <= BROADCAST_TERMS
    joined = keyed.join(F.broadcast(anchored) if small else anchored, "gram")
    return joined.filter(F.startswith("window", F.col("folded"))).select("term", *keys).distinct()


def search_docs(docs: DataFrame, key: str, columns: list[str], terms: DataFrame, sizes: tuple[int, ...] = (2, 3)) -> DataFrame:
    """(term, key, field) over several text columns in one scan."""
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("body")) for c in columns]))
    long = docs.select(key, fields.alias("f")).select(key, "f.field", "f.body").filter(F.col("body").isNotNull())
    return match_terms(long, [key, "field"], "body", terms, sizes)


def term_hits(terms: DataFrame, hits: DataFrame) -> DataFrame:
    """Number of articles per term, 0 if there is none."""
    counts = hits.groupBy("term").agg(F.count("*").alias("hits"))
    return terms.select("term").distinct().join(counts, "term", "left").na.fill(0, ["hits"])


def terms_by_rarity(terms: DataFrame, hits: DataFrame) -> DataFrame:
    """terms of three or more ideographs, rare ones first."""
    return term_hits(terms.filter(cjk_count(F.col("term")) >= 3), hits).orderBy("hits", "term")


def search(hits: DataFrame, laws: DataFrame, k: int, domains: list[str] | None, categories: list[str]) -> DataFrame:
    """First k hits per term in current laws of the given domains and
    categories, in node order (Q3)."""
    keep = (F.col("is_current") == 1) & F.col("category").isin(categories)
    if domains is not None:
        keep = keep & F.col("legal_domain").isin(domains)
    allowed = laws.filter(keep).select(F.col("id").alias("law_id"), F.col("title").alias("law_title"), "category")
    return top_per_group(hits.join(allowed, "law_id"), ["term"], [F.col("law_id"), F.col("global_order")], k, rank="hit_rank")


def search_in_laws(hits: DataFrame, laws: DataFrame, titles: DataFrame, k: int) -> DataFrame:
    """First k hits per term and named law."""
    named = laws.filter(F.col("is_current") == 1).select(F.col("id").alias("law_id"), F.col("title").alias("law_title"), "category").join(
        titles.select(F.col("title").alias("law_title")).distinct(), "law_title", "left_semi"
    )
    return top_per_group(hits.join(named, "law_id"), ["term", "law_title"], [F.col("law_id"), F.col("global_order")], k, rank="hit_rank")


def first_seen(rows: DataFrame, order: list[str]) -> DataFrame:
    """Each article once per question, at its earliest place."""
    rest = [c for c in rows.columns if c not in ("q_id", *NODE)]
    picked = rows.groupBy("q_id", *NODE).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("p"))
    return picked.select("q_id", *NODE, *[F.col(f"p.{c}").alias(c) for c in rest])


def topk_per_term(question_terms: DataFrame, found: DataFrame) -> DataFrame:
    """The hits of a question's terms, first-seen across terms."""
    joined = question_terms.join(found, "term")
    return first_seen(joined.select("q_id", *NODE, "pos", "hit_rank", "term"), ["pos", "hit_rank"])


def expand_terms(question_terms: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Terms of a question followed by their aliases, table by table, most
    frequent first, without repeats. Tables are (source, target, hits)."""
    own = question_terms.select(
        "q_id", "term", F.lit(0).alias("stage"), "pos", F.lit(0).alias("table_rank"), F.lit(0).cast("bigint").alias("neg_hits"))
    stages = [
        t.withColumn("table_rank", F.lit(i + 1)) for i, t in enumerate(tables)
    ]
    aliases = stages[0]
    for stage in stages[1:]:
        aliases = aliases.unionByName(stage)
    added = question_terms.join(aliases, question_terms["term"] == aliases["source"]).select(
        "q_id", F.col("target").alias("term"), F.lit(1).alias("stage"), "pos", "table_rank", (-F.col("hits")).cast("bigint").alias("neg_hits"))
    order = F.struct("stage", "pos", "table_rank", "neg_hits", "term")
    first = own.unionByName(added).groupBy("q_id", "term").agg(F.min(order).alias("at"))
    place = F.row_number().over(Window.partitionBy("q_id").orderBy("at"))
    return first.select("q_id", (place - 1).alias("pos"), "term")


def topic_laws(question_terms: DataFrame, hints: DataFrame) -> DataFrame:
    """Preferred laws of a question by priority."""
    found = question_terms.join(hints, question_terms["term"] == hints["topic"])
    return found.groupBy("q_id", "law_title").agg(F.min(F.struct("pos", "priority")).alias("at")).select(
        "q_id", "law_title", F.col("at.priority").alias("priority"), F.col("at.pos").alias("pos"))


def layered_search(question_terms: DataFrame, hits: DataFrame, laws: DataFrame, preferred: DataFrame, rarity: DataFrame,
                   domains: list[str] | None, k: int = 10) -> DataFrame:
    """I8: preferred laws (pinned, rare terms first), statutes, interpretations."""
    own = search_in_laws(hits, laws, preferred.select(F.col("law_title").alias("title")), k)
    rare = question_terms.join(rarity, "term").join(preferred.select("q_id", "law_title"), "q_id")
    pinned = rare.join(own, ["term", "law_title"]).select(
        "q_id", *NODE, F.lit(0).alias("layer"), F.col("hits").alias("term_rank"), "hit_rank", F.lit(1).alias("pinned"))
    layers = [pinned]
    for number, categories in ((1, LAW_CATEGORIES), (2, INTERPRETATIONS)):
        found = search(hits, laws, k, domains, categories)
        layers.append(question_terms.join(found, "term").select(
            "q_id", *NODE, F.lit(number).alias("layer"), F.col("pos").cast("bigint").alias("term_rank"), "hit_rank", F.lit(0).alias("pinned")))
    every = layers[0].unionByName(layers[1]).unionByName(layers[2])
    return first_seen(every, ["layer", "term_rank", "hit_rank"])


def widen_if_sparse(found: DataFrame, everywhere: DataFrame, questions: DataFrame, limit: int = 3) -> DataFrame:
    """Questions with at most ``limit`` results take those of all domains."""
    counts = questions.select("q_id").join(found.groupBy("q_id").agg(F.count("*").alias("n")), "q_id", "left").na.fill(0, ["n"])
    sparse = counts.filter(F.col("n") <= limit).select("q_id")
    return found.join(sparse, "q_id", "left_anti").unionByName(everywhere.join(sparse, "q_id", "left_semi"))


def context_topk(found: DataFrame, n: int = 20) -> DataFrame:
    """pinned articles first, then retrieval order, n per question."""
    order = [F.desc("pinned"), F.col("layer"), F.col("term_rank"), F.col("hit_rank"), F.col("law_id"), F.col("global_order")]
    return top_per_group(found, ["q_id"], order, n, rank="place")


def capped(found: DataFrame, limit: int = 40, pinned: int = 30, others: int = 10) -> DataFrame:
    """when a question has more than ``limit`` articles, keep the first
    pinned and other ones."""
    counts = found.groupBy("q_id").agg(F.count("*").alias("n"))
    order = [F.col("layer"), F.col("term_rank"), F.col("hit_rank"), F.col("law_id"), F.col("global_order")]
    ranked = found.withColumn("class_rank", F.row_number().over(Window.partitionBy("q_id", "pinned").orderBy(*order)))
    keep = (F.col("n") <= limit) | (F.col("class_rank") <= F.when(F.col("pinned") == 1, pinned).otherwise(others))
    return ranked.join(counts, "q_id").filter(keep).drop("n", "class_rank")


def context_text(context: DataFrame, articles: DataFrame, laws: DataFrame, limit: int = 500) -> DataFrame:
    """Statutes then interpretations, ``limit`` characters each.

    A question has a bounded number of context rows (F2), so its list is too.
    """
    texts = context.join(articles.select(*NODE, "article_number", "content"), NODE).join(
        laws.select(F.col("id").alias("law_id"), F.col("title").alias("law_title")), "law_id")
    line = F.concat(F.lit("《"), "law_title", F.lit("》"), F.coalesce("article_number", F.lit("")), F.lit("："), F.substring("content", 1, limit))
    rows = texts.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct((F.col("layer") == 2).alias("interp"), "place", line.alias("line")))).alias("r"))

    def part(title: str, interp: bool) -> Column:
        lines = F.transform(F.filter("r", lambda x: x["interp"] == F.lit(interp)), lambda x: x["line"])
        return F.when(F.size(lines) > 0, F.concat(F.array(F.lit(title)), lines)).otherwise(F.array().cast("array<string>"))

    return rows.select("q_id", F.array_join(F.concat(part("【法律原文】", False), part("\n【司法解释】", True)), "\n").alias("context"))


def validate_terms(pairs: DataFrame, hits: DataFrame) -> DataFrame:
    """Alias pairs whose target occurs, with its count."""
    counts = hits.groupBy(F.col("term").alias("target")).agg(F.count("*").alias("hits"))
    return pairs.select("source", "target").join(counts, "target")


def validate_hints(hints: DataFrame, laws: DataFrame) -> DataFrame:
    """Hints whose law title is current."""
    titles = laws.filter(F.col("is_current") == 1).select(F.col("title").alias("law_title"))
    return hints.join(titles, "law_title", "left_semi")


def route_questions(questions: DataFrame, groups: list[tuple[str, list[str]]]) -> DataFrame:
    """Groups with a routing word in the question, else the first two."""
    names = [F.when(F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.col("text"), w)), name) for name, words in groups]
    matched = F.filter(F.array(*names), lambda n: n.isNotNull())
    default = F.array(*[F.lit(name) for name, _ in groups[:2]])
    return questions.select("q_id", F.explode(F.when(F.size(matched) > 0, matched).otherwise(default)).alias("group"))


def extract_facts(questions: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """The part of the question that each field's pattern finds; a field
    without a match has no value and is to be asked for."""
    pairs = F.array(*[F.struct(F.lit(name).alias("field"), F.nullif(F.regexp_extract("text", f"({pattern})", 1), F.lit("")).alias("value")) for name, pattern in fields])
    return questions.select("q_id", F.inline(pairs))


def simple_keywords(text: Column, words: list[str], limit: int = 8) -> Column:
    """Dictionary words in the text, then ideograph runs of 3 to 6."""
    known = F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))
    runs = F.regexp_extract_all(text, F.lit("[一-鿿]{3,6}"), F.lit(0))
    return F.slice(F.array_distinct(F.concat(known, runs)), 1, limit)


def subtree(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Articles under a chapter or section, by coordinates.

    Chapter and section roots are joined on (law, chapter[, section]); a join
    on law alone with a filter would pair all roots and articles of a law.
    """
    arts = nodes.filter(F.col("type") == "article").select(*NODE, "chapter_num", "section_num")
    chapter = roots.filter(F.col("type") == "chapter").select("law_id", "chapter_num", F.col("global_order").alias("root_order"))
    section = roots.filter(F.col("type") == "section").select("law_id", "chapter_num", "section_num", F.col("global_order").alias("root_order"))
    return (
        arts.join(chapter, ["law_id", "chapter_num"]).select("root_order", *NODE)
        .unionByName(arts.join(section, ["law_id", "chapter_num", "section_num"]).select("root_order", *NODE))
    )


def chapter_articles(headings_and_articles: DataFrame, laws: DataFrame, experts: DataFrame, cap: int = 30) -> DataFrame:
    """Articles of the chapters of an expert's laws whose heading has
    a word of the expert's domain, at most ``cap`` per law in reading order.

    ``experts`` is (expert, law_title, words array).
    """
    own = laws.filter(F.col("is_current") == 1).select(F.col("id").alias("law_id"), F.col("title").alias("law_title")).join(experts, "law_title")
    heads = headings_and_articles.filter(F.col("type").isin("chapter", "section")).join(own, "law_id")
    roots = heads.filter(F.exists("words", lambda w: F.contains(F.col("content"), w)))
    arts = subtree(headings_and_articles, roots.select("law_id", "type", "chapter_num", "section_num", "global_order").distinct()).select(*NODE).distinct()
    per_expert = arts.join(roots.select("law_id", "expert").distinct(), "law_id")
    return top_per_group(per_expert, ["expert", "law_id"], [F.col("global_order")], cap, rank="hit_rank")


def retrieve(experts: DataFrame, expert_terms: DataFrame, nodes: DataFrame, laws: DataFrame, hits: DataFrame, domains: list[str],
             chapter_cap: int = 30, per_law: int = 10, statutes: int = 8, interpretations: int = 5) -> DataFrame:
    """Chapters (pinned), search in the expert's laws, statutes,
    interpretations; first-seen per expert. ``expert_terms`` is (expert, pos,
    term); the result is keyed by ``q_id`` = expert."""
    chapters = chapter_articles(nodes, laws, experts, chapter_cap).select(
        F.col("expert").alias("q_id"), *NODE, F.lit(0).alias("layer"), F.lit(0).alias("term_rank"), "hit_rank", F.lit(1).alias("pinned"))
    titles = experts.select("expert", "law_title")
    inside = expert_terms.join(titles, "expert").join(
        search_in_laws(hits, laws, titles.select(F.col("law_title").alias("title")), per_law), ["term", "law_title"]
    ).select(F.col("expert").alias("q_id"), *NODE, F.lit(1).alias("layer"), F.col("pos").alias("term_rank"), "hit_rank", F.lit(0).alias("pinned"))
    out = chapters.unionByName(inside)
    for number, categories, k in ((2, LAW_CATEGORIES, statutes), (3, INTERPRETATIONS, interpretations)):
        found = expert_terms.join(search(hits, laws, k, domains, categories), "term")
        out = out.unionByName(found.select(
            F.col("expert").alias("q_id"), *NODE, F.lit(number).alias("layer"), F.col("pos").alias("term_rank"), "hit_rank", F.lit(0).alias("pinned")))
    return first_seen(out, ["layer", "term_rank", "hit_rank"])


def search_by_group(group_terms: DataFrame, hits: DataFrame, laws: DataFrame, domains: DataFrame, k: int, categories: list[str]) -> DataFrame:
    """First k hits per group and term in current laws of the group's own domains, in node order.

    ``group_terms`` is (q_id, pos, term), ``domains`` (q_id, legal_domain).

    A domain keeps its first k hits per term before it meets the groups, so that
    a frequent term's hits are not repeated for every group that asks for them.
    """
    allowed = laws.filter((F.col("is_current") == 1) & F.col("category").isin(categories)).select(F.col("id").alias("law_id"), "legal_domain")
    order = [F.col("law_id"), F.col("global_order")]
    best = top_per_group(hits.join(allowed, "law_id"), ["term", "legal_domain"], order, k)
    scope = group_terms.join(domains.distinct(), "q_id").join(best, ["term", "legal_domain"])
    return top_per_group(scope, ["q_id", "term"], order, k, rank="hit_rank")


def retrieve_chain(
    primary: DataFrame, domains: DataFrame, group_terms: DataFrame, nodes: DataFrame, laws: DataFrame, hits: DataFrame,
    chapter_cap: int = 25, per_law: int = 10, statutes: int = 10, interpretations: int = 8, per_interpretation: int = 5, core_terms: int = 3, newest: int = 5,
) -> DataFrame:
    """Three layers per group of law, each article once, where it is found first.

    ``primary`` is (q_id, law_title, words): the main laws of a group. Layer 1
    has the articles of their chapters that have a word in the heading, at most
    ``chapter_cap`` per law (pinned), and the hits of the terms inside these laws.
    Layer 2 searches statutes and interpretations of the group's domains. Layer 3
    takes the newest interpretations that name a main law (what layer 1 asks for
    decides where it looks) and searches the first ``core_terms`` terms in them.
    """
    experts = primary.select(F.col("q_id").alias("expert"), "law_title", "words")
    titles = primary.select("q_id", "law_title").distinct()
    empty = F.lit(0)
    chapters = chapter_articles(nodes, laws, experts, chapter_cap).select(
        F.col("expert").alias("q_id"), *NODE, F.lit(0).alias("layer"), empty.alias("term_rank"), "hit_rank", F.lit(1).alias("pinned"))

    def rows(found: DataFrame, layer: int) -> DataFrame:
        return found.select("q_id", *NODE, F.lit(layer).alias("layer"), F.col("pos").alias("term_rank"), "hit_rank", F.lit(0).alias("pinned"))

    inside = search_in_laws(hits, laws, titles.select(F.col("law_title").alias("title")), per_law)
    out = chapters.unionByName(rows(group_terms.join(titles, "q_id").join(inside, ["term", "law_title"]), 1))
    out = out.unionByName(rows(search_by_group(group_terms, hits, laws, domains, statutes, LAW_CATEGORIES), 2))
    out = out.unionByName(rows(search_by_group(group_terms, hits, laws, domains, interpretations, INTERPRETATIONS), 3))
    short = titles.select("q_id", strip_prc(F.col("law_title")).alias("title"))
    named = interpretations_for(laws, short.select("title").distinct(), newest).select("title", "id", F.col("place").alias("newest"))
    scope = short.join(named, "title").groupBy("q_id", "id").agg(F.min("newest").alias("newest"))
    core = group_terms.filter(F.col("pos") < core_terms).join(scope, "q_id")
    # Each interpretation is searched once per term, however many groups come to it.
    inner = hits.withColumnRenamed("law_id", "id").join(scope.select("id").distinct(), "id", "left_semi")
    deep = core.join(top_per_group(inner, ["term", "id"], [F.col("global_order")], per_interpretation), ["term", "id"])
    deep = top_per_group(deep, ["q_id", "term", "id"], [F.col("global_order")], per_interpretation, rank="hit_rank")
    out = out.unionByName(rows(deep.withColumnRenamed("id", "law_id"), 4))
    return first_seen(out, ["layer", "term_rank", "hit_rank"])


def interpretations_for(laws: DataFrame, titles: DataFrame, n: int) -> DataFrame:
    """Current interpretations whose title or promulgation text has the
    first six characters of a law's short title (the whole of a shorter one);
    newest n per title.

    Both texts give their substrings of the lengths that occur, which are joined
    to the probes by equality. A text keeps its newest n before it is cut, and a
    beginning its newest n before it meets the titles that share it: many titles
    and many interpretations of one beginning are never paired.
    """
    newest = [F.desc("pub_date"), F.col("id")]
    probe = titles.select("title", F.substring("title", 1, 6).alias("gram")).filter(F.length("gram") >= 1).distinct()
    grams = probe.select("gram").distinct()
    lengths = grams.select(F.length("gram").alias("size")).distinct()
    interp = laws.filter((F.col("category") == "司法解释") & (F.col("is_current") == 1))
    texts = interp.select("id", "pub_date", F.explode(F.array("title", "promulgation_info")).alias("text"))
    kept = top_per_group(texts.filter(F.col("text").isNotNull()).distinct(), ["text"], newest, n)
    found = substrings(kept, "text", lengths, "gram").join(grams, "gram").select("gram", "id", "pub_date").distinct()
    return top_per_group(found, ["gram"], newest, n, rank="place").join(probe, "gram").select("title", "id", "pub_date", "place")

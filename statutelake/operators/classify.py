"""Classification by rule tables and the knowledge graph (K, J9-J11, D17, F5).

Rule tables are short and fixed, so a rule set is one column expression over
the title: no join, no shuffle, no broadcast. Tables of unknown size (exact
titles, aliases) are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statutelake.functions import rules as r
from statutelake.functions.text import normalize_title, title_key
from statutelake.operators.citations import PRC

Rules = list[tuple[str, list[str]]]


def any_of(text: Column, words: list[str]) -> Column:
    """True if the text holds one of the words: one pattern, not one search for each word."""
    quoted = ["\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in words]
    return text.rlike("|".join(quoted))


def hits(text: Column, words: list[str]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w)))


def first_match(text: Column, rules: Rules, default: str | None) -> Column:
    """K3, K4: the first rule with a word in the text."""
    out = F.lit(default).cast("string")
    for target, words in reversed(rules):
        out = F.when(any_of(text, words), target).otherwise(out)
    return out


def best_match(scores: list[tuple[str, Column]]) -> Column:
    """The highest positive score; the earlier rule wins a tie (Q8).

    A nameless score of 0 ranks before all others of 0, so that the scores are
    written, and worked out, only once.
    """
    ranked = [F.struct(s.alias("score"), F.lit(-i).alias("order"), F.lit(n).alias("name")) for i, (n, s) in enumerate(scores)]
    none = F.struct(F.lit(0).alias("score"), F.lit(1).alias("order"), F.lit(None).cast("string").alias("name"))
    return F.array_max(F.array(*ranked, none))["name"]


def map_value(key: Column, table: dict[str, str]) -> Column:
    """Fixed code map."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def domain_score(title: Column, rules: Rules = r.DOMAIN_RULES) -> Column:
    """K1: keyword hits plus strong signals, best domain or NULL."""
    scores = []
    for domain, words in rules:
        score = hits(title, words)
        for signal, target, bonus in r.STRONG_SIGNALS:
            if target == domain:
                score = score + F.when(F.contains(title, F.lit(signal)), bonus).otherwise(0)
        scores.append((domain, score))
    return best_match(scores)


def classify_domain(laws: DataFrame, exact: DataFrame | None = None) -> DataFrame:
    """K1: exact title (as it is, else without the country prefix), else score, else the category's default."""
    out = laws.withColumn("_key", title_key(F.col("title"))).withColumn("_bare", title_key(F.replace("title", F.lit(PRC), F.lit(""))))
    if exact is not None:
        known = exact.select(title_key(F.col("title")).alias("_key"), "domain").groupBy("_key").agg(F.max("domain").alias("_full"))
        out = out.join(known, "_key", "left").join(known.select(F.col("_key").alias("_bare"), F.col("_full").alias("_short")), "_bare", "left")
        out = out.withColumn("exact_domain", F.coalesce("_full", "_short")).drop("_full", "_short")
    else:
        out = out.withColumn("exact_domain", F.lit(None).cast("string"))
    default = map_value(F.col("category"), r.DOMAIN_DEFAULTS)
    return out.withColumn("domain", F.coalesce("exact_domain", domain_score(F.col("title")), default)).drop("_key", "_bare", "exact_domain")


def reclassify(laws: DataFrame, source: str) -> DataFrame:
    """K2: new domain for one source under normalised titles."""
    target = laws.withColumn("title", normalize_title(F.col("title")))
    new = classify_domain(target).withColumn("domain", F.when(F.col("source") == source, F.coalesce("domain", F.lit(""))).otherwise(F.col("legal_domain")))
    return new


def classification_diff(laws: DataFrame, old: str, new: str) -> DataFrame:
    """K7: from - to counts of two classifications.

    Equal pairs are dropped after counting: a filter before it would be pushed
    down to the scan, with the whole classification worked out there once more.
    """
    differs = ~F.col(old).eqNullSafe(F.col(new))
    return laws.groupBy(F.col(old).alias("from_domain"), F.col(new).alias("to_domain")).agg(F.count_if(differs).alias("n")).filter("n > 0")


def subject_area(laws: DataFrame, rules: Rules = r.SUBJECT_RULES) -> DataFrame:
    """K3: only administrative regulations have a subject area."""
    return laws.withColumn("subject_area", F.when(F.col("category") == "行政法规", first_match(F.col("title"), rules, "其他")))


def menu_path(laws: DataFrame, subgroups: dict[str, tuple[Rules, str]] = r.SUBGROUP_RULES, criminal: Rules = r.CRIMINAL_RULES,
              administrative: Rules = r.ADMIN_LAW_RULES) -> DataFrame:
    """K4: menu group and subgroup."""
    title, category, group_name = F.col("title"), F.col("category"), F.col("menu_group")
    group = F.coalesce(map_value(F.col("legal_domain"), r.DOMAIN_GROUPS), map_value(category, r.CATEGORY_GROUPS), F.lit("其他"))
    regulation = F.concat_ws("/", F.lit("行政法规"), F.nullif(F.col("subject_area"), F.lit("")))
    state = F.when(category == "宪法", "宪法").when(category.isin("司法解释", "法律解释"), "司法解释").otherwise("法律及决定")
    code = category.isin("法律", "修正案", "法律解释") | any_of(title, r.CRIMINAL_CODE_WORDS)
    crime = F.when(code, r.CRIMINAL_CODE).otherwise(first_match(title, criminal, "检察院"))
    public = (
        F.when(category == "法律", first_match(title, administrative, "行政法律"))
        .when(any_of(title, ["国家赔偿", "行政赔偿"]), "国家赔偿").otherwise("行政法律")
    )
    sub = F.when(group_name == "宪法与国家机构", state).when(group_name == "刑事", crime).when(group_name == "行政与公法", public)
    for name, (rules, default) in subgroups.items():
        sub = sub.when(group_name == name, first_match(title, rules, default))
    civil_code = (group_name == "民事与商事") & ((F.col("legal_domain") == "民法典") | F.contains("title", F.lit("民法典")))
    return laws.withColumn("menu_group", group).withColumn(
        "subgroup",
        F.when(civil_code, "民法典").when((category == "行政法规") & (group_name != "其他"), regulation).otherwise(F.coalesce(sub, F.lit(""))),
    )


def menu_order(menu: DataFrame, order: list[str] = r.GROUP_ORDER) -> DataFrame:
    """groups by the fixed list, the rest and the subgroups by name."""
    position = F.array_position(F.array(*[F.lit(g) for g in order]), F.col("menu_group"))
    placed = menu.withColumn("group_pos", F.when(position > 0, position).otherwise(len(order) + 1).cast("int"))
    return placed.orderBy("group_pos", "menu_group", "subgroup")


def order_table(spark: SparkSession, groups: list[str] = r.GROUP_ORDER, subgroups: dict[str, list[str]] = r.SUBGROUP_ORDER,
                subjects: list[str] = r.SUBJECT_ORDER, below: str = "行政法规/") -> DataFrame:
    """Order lists as one table (level, menu_group, name, pos): level 0 has the groups, 1 the subgroups of
    a group, 2 the subjects, which stand behind ``below`` in the subgroups of any group (no group)."""
    rows = [(0, "", g, i) for i, g in enumerate(groups, 1)]
    rows += [(1, g, name, i) for g, names in subgroups.items() for i, name in enumerate(names, 1)]
    rows += [(2, "", below + name, i) for i, name in enumerate(subjects, 1)]
    return spark.createDataFrame(rows, "level int, menu_group string, name string, pos int")


def name_table(spark: SparkSession, names: dict[str, dict[str, str]] = r.ENGLISH_NAMES) -> DataFrame:
    """Names of codes as a table (kind, name, name_en)."""
    return spark.createDataFrame([(kind, *pair) for kind, table in names.items() for pair in table.items()], "kind string, name string, name_en string")


def english_names(menu: DataFrame, names: DataFrame, below: str = "行政法规/", below_en: str = "Administrative Regulations: ") -> DataFrame:
    """category_en, domain_en, body_en, group_en and subgroup_en.

    A code without a name keeps its own, a null code stays null. A subgroup below
    administrative regulations is named by its subject.
    """
    out = menu.withColumn("_subject", F.when(F.startswith("subgroup", F.lit(below)), F.expr(f"substring(subgroup, {len(below) + 1})")))
    kinds = [("category", "category"), ("domain", "legal_domain"), ("body", "issuing_org"), ("group", "menu_group"), ("subgroup", "subgroup"), ("subject", "_subject")]
    for kind, column in kinds:
        own = names.filter(F.col("kind") == kind).select(F.col("name").alias(column), F.col("name_en").alias("_name"))
        out = out.join(own, column, "left").withColumn(f"{kind}_en", F.coalesce("_name", column)).drop("_name")
    subgroup = F.when(F.col("_subject").isNotNull(), F.concat(F.lit(below_en), "subject_en")).otherwise(F.col("subgroup_en"))
    return out.withColumn("subgroup_en", subgroup).drop("_subject", "subject_en")


def menu_places(menu: DataFrame, order: DataFrame, below: str = "行政法规/") -> DataFrame:
    """every (menu_group, subgroup) with ``group_place`` and, inside its group, ``place``.

    Groups come by their list, then by name. In a group its listed subgroups come
    first, then those below administrative regulations by the list of subjects
    and by name, then all others by name.
    """
    pairs = menu.select("menu_group", "subgroup").distinct()
    groups = order.filter("level = 0").select(F.col("name").alias("menu_group"), F.col("pos").alias("group_pos"))
    own = order.filter("level = 1").select("menu_group", F.col("name").alias("subgroup"), F.col("pos").alias("own_pos"))
    subjects = order.filter("level = 2").select(F.col("name").alias("subgroup"), F.col("pos").alias("subject_pos"))
    known = pairs.join(groups, "menu_group", "left").join(own, ["menu_group", "subgroup"], "left").join(subjects, "subgroup", "left")
    tier = F.when(F.col("own_pos").isNotNull(), 0).when(F.startswith("subgroup", F.lit(below)), 1).otherwise(2)
    pos = F.when(tier == 0, F.col("own_pos")).when(tier == 1, F.col("subject_pos"))
    names = known.select("menu_group", "group_pos").distinct()
    # One row for each group, and one for each subgroup of a group.
    ranked = names.select("menu_group", F.row_number().over(Window.orderBy(F.col("group_pos").asc_nulls_last(), "menu_group")).alias("group_place"))
    inside = Window.partitionBy("menu_group").orderBy(tier, pos.asc_nulls_last(), "subgroup")
    return known.withColumn("place", F.row_number().over(inside)).join(ranked, "menu_group").select("menu_group", "subgroup", "group_place", "place")


def taxonomy_domain(laws: DataFrame, rules: Rules = r.TAXONOMY_RULES, opening: int | None = None) -> DataFrame:
    """K5: most keywords in title and text; ``opening`` looks at so many characters of the text only."""
    text = F.col("full_text") if opening is None else F.substring("full_text", 1, opening)
    opening = F.concat(F.col("title"), F.lit(" "), F.coalesce(text, F.lit("")))
    scores = [(name, hits(opening, words)) for name, words in rules]
    return laws.withColumn("taxonomy", F.coalesce(best_match(scores), F.lit("其他")))


def taxonomy(laws: DataFrame) -> DataFrame:
    """Newest version of each title in its taxonomy domain, as rows.

    Members stay rows: a domain may hold most of the corpus.
    """
    tagged = taxonomy_domain(laws).withColumn("key", title_key(F.col("title")))
    domain = tagged.groupBy("key").agg(
        F.max_by("taxonomy", "id").alias("taxonomy"),
        F.max_by(F.struct("id", "title", "category"), F.struct("pub_date", -F.col("id"))).alias("latest"),
        F.max("pub_date").alias("latest_pub_date"),
    )
    return domain.select("taxonomy", "latest.id", "latest.title", "latest.category", "latest_pub_date")


def law_aliases(laws: DataFrame, table: DataFrame) -> DataFrame:
    """K6: aliases by exact title."""
    return laws.join(table.select("title", F.col("aliases").alias("known_aliases")), "title", "left")


def statute_keys(laws: DataFrame) -> DataFrame:
    return laws.filter(F.col("category").isin("法律", "宪法")).select(title_key(F.col("title")).alias("parent")).distinct()


def hierarchy_links(laws: DataFrame, opening: int | None = None) -> DataFrame:
    """Superior laws quoted in the title or text, or named by 'X法实施条例';
    ``opening`` looks at so many characters of the text only."""
    text = F.col("full_text") if opening is None else F.substring("full_text", 1, opening)
    opening = F.concat(F.col("title"), F.lit(" "), text)
    key = title_key(F.col("title"))
    quoted = F.transform(F.regexp_extract_all(opening, F.lit("《([^》]+)》"), F.lit(1)), title_key)
    named = F.regexp_extract(key, "(.{4,30}法)实施(条例|细则|办法|规定)", 1)
    cands = laws.select(
        F.col("id").alias("child_id"), F.col("title").alias("child"), F.col("category").alias("child_category"), key.alias("own"),
        F.explode(F.array_distinct(F.concat(quoted, F.filter(F.array(named), lambda x: x != "")))).alias("parent"),
    )
    linked = cands.filter(F.col("parent") != F.col("own")).join(statute_keys(laws), "parent")
    relation = F.when(F.col("child_category") == "行政法规", "实施依据").otherwise("解释依据")
    return linked.select("child_id", "child", "child_category", "parent", relation.alias("relation"))


def rank_levels(laws: DataFrame) -> DataFrame:
    """Rank 1 (constitution) to 5 (judicial interpretation)."""
    level = (
        F.when(F.col("category") == "宪法", 1).when(title_key(F.col("title")).isin(r.BASIC_LAWS), 2).when(F.col("category") == "法律", 3)
        .when(F.col("category").isin("行政法规", "监察法规"), 4).when(F.col("category") == "司法解释", 5).otherwise(3)
    )
    return laws.withColumn("level", level)


def relations(laws: DataFrame, opening: int | None = None) -> DataFrame:
    """Quoted titles of other laws in title and text, with the taxonomy
    domain of both ends; ``opening`` looks at so many characters of the text only."""
    tagged = taxonomy_domain(laws).withColumn("key", title_key(F.col("title")))
    domains = tagged.groupBy("key").agg(F.max_by("taxonomy", "id").alias("domain"))
    text = F.col("full_text") if opening is None else F.substring("full_text", 1, opening)
    opening = F.concat(F.col("title"), F.lit(" "), text)
    cited = laws.select(
        F.col("id").alias("from_id"), title_key(F.col("title")).alias("from_key"),
        F.explode(F.array_distinct(F.transform(F.regexp_extract_all(opening, F.lit("《([^》]{4,40})》"), F.lit(1)), title_key))).alias("to_key"),
    ).filter(F.col("from_key") != F.col("to_key"))
    ends = cited.join(domains.select(F.col("key").alias("to_key"), F.col("domain").alias("to_domain")), "to_key")
    return ends.join(domains.select(F.col("key").alias("from_key"), F.col("domain").alias("from_domain")), "from_key").select(
        "from_id", F.col("to_key").alias("to_title"), "from_domain", "to_domain"
    )


def terms_in_text(texts: DataFrame, terms: list[str], text: str) -> DataFrame:
    """Terms of a fixed dictionary that occur in a text, one row each."""
    found = F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.col(text), t))
    return texts.select(*[c for c in texts.columns if c != text], F.explode(found).alias("term"))

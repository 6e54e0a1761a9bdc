"""Ids, translation import and incremental merges (E1, C17, C18, C20, D11, M1, M5, N)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statutelake.functions.numerals import label_to_int
from statutelake.functions.text import strip
from statutelake.operators.ordered import rank_by_levels
from statutelake.operators.relational import missing


def assign_ids(docs: DataFrame, index: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Existing ids stay; new documents of a category are numbered by date
    after the highest id of its range; a full range fails.

    ``docs`` is (filename, category, pub_date). Numbers are counted per date and
    per beginning of the file name, so neither a category nor a date is sorted
    in one task.
    """
    base = F.lit(None).cast("bigint")
    cap = F.lit(None).cast("bigint")
    for category, (start, size) in ranges.items():
        base = F.when(F.col("category") == category, start).otherwise(base)
        cap = F.when(F.col("category") == category, size).otherwise(cap)
    top = index.groupBy("category").agg(F.max("id").alias("top"))
    known = docs.join(index.select("filename", "id"), "filename")
    fresh = docs.join(index.select("filename"), "filename", "left_anti").filter(base.isNotNull())
    # Dates, then longer and longer beginnings of the file name.
    steps = {f"_p{n}": F.substring("filename", 1, n) for n in (2, 4, 8, 16)}
    ranked = rank_by_levels(fresh.withColumns(steps), ["category"], ["pub_date", *steps], [F.col("filename")], "n").drop(*steps)
    numbered = ranked.join(top, "category", "left").withColumn("id", F.coalesce("top", base - 1) + F.col("n"))
    guarded = numbered.withColumn(
        "id", F.when(F.col("id") < base + cap, F.col("id")).otherwise(F.raise_error(F.concat(F.lit("id range is full: "), "category")).cast("bigint")))
    columns = ["filename", "category", "pub_date", "id"]
    return known.select(*columns).unionByName(guarded.select(*columns))


def resolve_ids(files: DataFrame, blocklist: DataFrame, index: DataFrame) -> DataFrame:
    """C20: id by blocklisted file name, else the embedded id if indexed."""
    listed = blocklist.select("filename", F.col("id").alias("listed_id"))
    known = index.select(F.col("id").alias("embedded_id"), F.lit(True).alias("known"))
    out = files.join(listed, "filename", "left").join(known, "embedded_id", "left")
    resolved = F.coalesce("listed_id", F.when(F.col("known"), F.col("embedded_id")))
    status = F.when(F.col("listed_id").isNotNull(), "blocklist").when(F.col("known"), "embedded").otherwise("orphan")
    return out.select("filename", resolved.alias("id"), status.alias("status"))


def import_translations(articles: DataFrame, translated: DataFrame) -> DataFrame:
    """C17: translation of each article, filled only where it has none.

    Per translation the first level that finds an article counts: equal label,
    equal number, bare numeral label, then the article without a label. All
    articles of the found label take it; of several translations the last wins.
    ``translated`` is (law_id, pos, article_number, content_en).
    """
    label = strip(F.col("article_number"))
    arts = articles.select("law_id", "global_order", "content_en", F.coalesce(F.nullif(label, F.lit("")), F.lit("")).alias("key")).withColumn(
        "number", label_to_int(F.col("key")))
    tr = translated.filter(~missing(F.col("content_en")) & ~missing(F.col("article_number"))).select(
        "law_id", "pos", strip(F.col("article_number")).alias("tr_key"), F.col("content_en").alias("tr_en")).withColumn("tr_number", label_to_int(F.col("tr_key")))
    labels = arts.groupBy("law_id", "key", "number").agg(F.min("global_order").alias("first_at"))
    exact = tr.join(labels.select("law_id", F.col("key").alias("tr_key"), F.lit(0).alias("level"), F.col("key").alias("to_key")), ["law_id", "tr_key"])
    by_number = tr.join(
        labels.filter(F.col("number").isNotNull()).groupBy("law_id", F.col("number").alias("tr_number")).agg(F.min_by("key", "first_at").alias("to_key"))
        .withColumn("level", F.lit(1)), ["law_id", "tr_number"])
    bare = tr.join(labels.filter(F.col("key") == "").select("law_id", F.lit(2).alias("level"), F.col("key").alias("to_key")), "law_id")
    columns = ["law_id", "pos", "tr_en", "level", "to_key"]
    every = exact.select(*columns).unionByName(by_number.select(*columns)).unionByName(bare.select(*columns))
    best = every.groupBy("law_id", "pos").agg(F.min_by(F.struct("to_key", "tr_en"), "level").alias("b"))
    chosen = best.groupBy("law_id", F.col("b.to_key").alias("key")).agg(F.max_by("b.tr_en", "pos").alias("new_en"))
    joined = arts.join(chosen, ["law_id", "key"], "left")
    return joined.select("law_id", "global_order", F.when(missing(F.col("content_en")), F.col("new_en")).otherwise(F.col("content_en")).alias("content_en"))


def import_by_number(articles: DataFrame, laws: DataFrame, translated: DataFrame) -> DataFrame:
    """Translation by (file, category) to the integer article number."""
    ids = laws.select(F.col("id").alias("law_id"), "filename", "category")
    tr = translated.join(ids, ["filename", "category"]).select("law_id", F.col("number").alias("article_num"), F.col("content_en").alias("new_en"))
    one = tr.groupBy("law_id", "article_num").agg(F.max("new_en").alias("new_en"))
    return articles.select("law_id", "global_order", "article_num").join(one, ["law_id", "article_num"]).select("law_id", "global_order", "new_en")


def match_translations(articles: DataFrame, translated: DataFrame) -> DataFrame:
    """Multiset match of labels per law and its status.

    A translation label that the law has consumes its own copies only. Other
    labels are matched by number against the copies that are left over.
    """
    own = articles.filter(~missing(F.col("article_number"))).groupBy("law_id", F.trim("article_number").alias("label")).agg(F.count("*").alias("have"))
    theirs = translated.filter(~missing(F.col("content_en")) & ~missing(F.col("article_number"))).groupBy(
        "law_id", F.trim("article_number").alias("label")).agg(F.count("*").alias("want"))
    both = own.join(theirs, ["law_id", "label"], "full").na.fill(0, ["have", "want"])
    exact = both.withColumn("used", F.least("have", "want"))
    number = label_to_int(F.col("label"))
    spare = exact.withColumn("number", number).filter(F.col("number").isNotNull()).groupBy("law_id", "number").agg(
        F.sum(F.col("have") - F.col("used")).alias("spare"), F.sum(F.when(F.col("have") == 0, F.col("want")).otherwise(0)).alias("open"))
    more = spare.groupBy("law_id").agg(F.sum(F.least("spare", "open")).alias("by_number"))
    per_law = exact.groupBy("law_id").agg(F.sum("have").alias("db_count"), F.sum("used").alias("exact"))
    totals = translated.groupBy("law_id").agg(F.count("*").alias("en_count"), F.count_if(~missing(F.col("content_en"))).alias("with_text"))
    unnamed = articles.groupBy("law_id").agg(F.count_if(missing(F.col("article_number"))).alias("unnamed"))
    out = totals.join(per_law, "law_id", "left").join(more, "law_id", "left").join(unnamed, "law_id", "left").na.fill(0)
    whole = (F.col("db_count") == 0) & (F.col("unnamed") > 0) & (F.col("with_text") > 0)
    matched = F.when(whole, F.col("en_count")).otherwise(F.col("exact") + F.col("by_number"))
    status = (
        F.when(F.col("with_text") == 0, "no_translation").when(whole, "full").when(F.col("db_count") == 0, "missing_db_articles")
        .when(matched == 0, "no_match").when(matched < F.col("en_count"), "partial").otherwise("full")
    )
    return out.select("law_id", "db_count", "en_count", matched.alias("matched"), status.alias("status"))


def changed_files(manifest: DataFrame, files: DataFrame, outputs: DataFrame) -> DataFrame:
    """M1: new, modified and output-less sources by content hash."""
    old = manifest.select("path", F.col("md5").alias("old_md5"))
    done = outputs.select("path", F.lit(True).alias("done"))
    joined = files.select("path", "md5").join(old, "path", "full").join(done, "path", "left")
    change = (
        F.when(F.col("md5").isNull(), "removed").when(F.col("old_md5").isNull(), "new").when(F.col("md5") != F.col("old_md5"), "modified")
        .when(F.col("done").isNull(), "no_output")
    )
    return joined.withColumn("change", change).filter(F.col("change").isNotNull()).select("path", "change")


def fill_empty(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """M5: take update values only where the target is empty; running the same
    batch again changes nothing."""
    new = updates.groupBy(*keys).agg(*[F.max(c).alias(f"new_{c}") for c in columns])
    joined = target.join(new, keys, "left")

    def pick(name: str) -> Column:
        return F.when(missing(F.col(name)), F.col(f"new_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[pick(c) if c in columns else F.col(c) for c in target.columns])

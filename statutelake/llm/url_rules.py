"""URL filters: explicit rules first, then association rules mined from labelled URLs.

FP-growth finds token combinations that occur often with the label ``block``;
those with enough support and confidence become rules. Rules are matched through
an inverted index: a rule is filed under its rarest token, and only the rules
filed under a URL's tokens are compared with it. Only DataFrame functions and
Spark's own FP-growth are used.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .session import written

#: (verdict, host, path) as agreed.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCK = "label=block"
#: Least share and number of labelled URLs that hold a combination with the label, and least share of blocked ones among those that hold it.
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE = 0.0005, 20, 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both null if none does.

    A rule fits its host and all subdomains if the path begins with the rule's.
    Of equally long rules the first in alphabetical order wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host, host labels, path words, file ending, query keys and pairs, scheme; no bare numbers."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(_rest(url), r"\?([^#]*)", 1)
    words = F.filter(F.split(F.translate(path, _UPPER, _LOWER), r"[^a-z0-9]+"), lambda w: (w != "") & ~w.rlike("^[0-9]+$"))
    pairs = F.filter(F.split(query, "&"), lambda w: (w != "") & ~w.rlike("=[0-9]+$"))
    keys = F.filter(F.transform(F.split(query, "&"), lambda w: F.split(w, "=")[0]), lambda w: w != "")
    labels = F.filter(F.split(host, r"\."), lambda w: w != "")

    def tagged(tag: str, values: Column) -> Column:
        return F.transform(values, lambda w: F.concat(F.lit(tag), w))

    every = F.concat(
        F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))), F.concat(F.lit("host="), host)),
        tagged("name=", labels), tagged("path=", words), tagged("pair=", pairs), tagged("key=", keys),
    )
    return F.when(_rest(url).isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def mine(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_rows: int = MIN_ROWS, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """(antecedent array, confidence, first_token) of the rules that block.

    ``labelled`` has (tokens array, block boolean); rows with nulls are left out.
    A rule is dropped if a part of it is a rule with at least its confidence.
    ``first_token`` is the rule's rarest token in the labelled URLs.
    """
    empty = "antecedent array<string>, confidence double, first_token string"
    baskets = labelled.filter("tokens is not null and block is not null").select(
        F.concat("tokens", F.when(F.col("block"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))).alias("items")
    ).filter(F.size("items") > 0)
    baskets = written(baskets, "baskets")
    n = baskets.count()
    if n == 0:
        return labelled.sparkSession.createDataFrame([], empty)
    model = FPGrowth(minSupport=min(1.0, max(min_support, min_rows / n)), minConfidence=min_confidence, itemsCol="items").fit(baskets)
    found = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCK))).select(
        F.array_sort("antecedent").alias("antecedent"), "confidence"
    )
    found = written(found, "mined")
    a, b = found.select("antecedent", "confidence", F.explode("antecedent").alias("token")), found
    # Rules that hold a smaller rule: joined on one token of the smaller one.
    smaller = b.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"), F.col("antecedent")[0].alias("token"))
    covered = (
        a.join(smaller, "token")
        .filter((F.size("part") < F.size("antecedent")) & (F.col("part_confidence") >= F.col("confidence")))
        .filter(F.size(F.array_except("part", "antecedent")) == 0)
        .select("antecedent").distinct()
    )
    kept = found.join(covered, "antecedent", "left_anti")
    rarity = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    first = kept.select("antecedent", F.explode("antecedent").alias("token")).join(rarity, "token").groupBy("antecedent").agg(
        F.min(F.struct("freq", "token")).alias("rare")
    )
    return written(kept.join(first, "antecedent").select("antecedent", "confidence", F.col("rare.token").alias("first_token")), "rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` that hold all tokens of some rule."""
    each = urls.select("url").filter("url is not null").distinct().withColumn("tokens", tokens(F.col("url")))
    each = each.select("url", "tokens", F.explode("tokens").alias("first_token"))
    return each.join(rules, "first_token").filter(F.size(F.array_except("antecedent", "tokens")) == 0).select("url").distinct()


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, **thresholds) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per input row.

    The longest explicit rule decides; where none fits, a mined rule blocks and
    all else is allowed. Null URLs and those without ``://`` have an empty host
    and path, no tokens, and are allowed. Repeated rows stay repeated; other
    columns are dropped; without labelled URLs nothing is mined.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = slim.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = explicit(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", rule.alias("rule"), verdict.alias("explicit"))
    blocked = matched(ruled.filter("explicit is null"), mine(labelled, **thresholds)).withColumn("hit", F.lit(True))
    return ruled.join(blocked, "url", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("explicit", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"),
    )


def label_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, block) of the pages whose URL names a labelled document.

    The last number in the path names the document that the page shows. A page
    is a blocking example if that document is of low quality or toxic.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1)
    named = pages.select(F.col("url").cast("string").alias("url")).filter("url is not null").select(
        tokens(F.col("url")).alias("tokens"), F.when(number != "", number).cast("long").alias("doc_id")
    )
    bad = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    return named.join(bad, "doc_id").select("tokens", "block")

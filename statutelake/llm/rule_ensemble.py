"""Quality classifier: rules taken from trees, weighted by lasso logistic regression.

``text_statistics`` appends statistics of each whole text. ``fit`` grows shallow
trees over them on a bounded sample of labelled rows, takes every path from a
root as a conjunctive rule, and fits logistic weights with an L1 penalty, which
leaves few rules. ``score`` is that model as one Spark column expression over
the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .hashing import word_hashes

#: Labelled rows that a fit uses at most: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "letters", "marks", "stops", "shouts", "symbols", "bars",
    "high_bytes", "line_words", "distinct", "twice", "top_word", "distinct_tail",
]
PREFIX = "stat_"


@dataclass(frozen=True)
class Model:
    """Rules as (statistic index, is-greater, threshold) conjunctions with their weights."""

    intercept: float
    rules: tuple[tuple[tuple[tuple[int, bool, float], ...], float], ...]


def statistics(text: bytes) -> list[float]:
    """The statistics of one text; an empty one gives zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    count = np.bincount(data, minlength=256)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    words = word_hashes(text)
    m = max(1, len(words))
    _, times = np.unique(words, return_counts=True)
    tail = words[len(words) // 2 :]
    at = lambda chars: int(count[list(chars)].sum())
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), n / m, upper / max(1, upper + lower), count[48:58].sum() / n,
        (upper + lower) / n, at(b".,;:?'\"()-") / m, at(b".") / m, at(b"!") / m, at(b"#$%&*@^~_+=<>{}[]\\/") / m,
        at(b"|") / m, count[128:].sum() / n, m / (1 + int(count[10])), len(times) / m,
        float((words[1:] == words[:-1]).sum()) / m, float(times.max(initial=0)) / m, len(np.unique(tail)) / max(1, len(tail)),
    ]


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns stat_*: doubles, never null. Null and empty texts give zeros.

    Input columns of these names are replaced; the others stay as they are, in
    order, and rows stay one to one.
    """
    names = [PREFIX + s for s in STATISTICS]
    df = df.drop(*names)
    inner = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = df.columns.index(text)
    schema = StructType(list(inner.schema.fields))
    for name in names:
        schema = schema.add(name, "double", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics((v.as_py() or "").encode("utf-8", "surrogatepass")) for v in batch.column(at)]
            values = np.array(rows, np.float64).reshape(len(rows), len(names))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(values[:, i]) for i in range(len(names)))], [*batch.schema.names, *names]
            )

    return inner.mapInArrow(run, schema).toDF(*df.columns, *names)


def training_sample(labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label) of the rows to learn from: at most ``rows``, taken by the hash of the id.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out. Null ids and null
    labels are left out; of a repeated id the smaller label counts.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0) & ~held_out(F.col("doc_id"))
    )
    return usable.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _paths(text: str) -> list[tuple[tuple[int, bool, float], ...]]:
    """Every path from a root (not empty) in a tree ensemble's printed form."""
    found, stack = [], []
    for line in text.splitlines():
        if re.match(r"\s+Tree \d+", line):
            stack = []
        elif m := re.match(r"(\s+)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(m[1])
            stack = [x for x in stack if x[0] < depth] + [(depth, (int(m[2]), m[3] == ">", float(m[4])))]
            found.append(tuple(c for _, c in stack))
    return list(dict.fromkeys(found))


def _holds(rule, names: list[str]) -> Column:
    out = F.lit(True)
    for feature, greater, threshold in rule:
        c = F.col(names[feature])
        out = out & ((c > F.lit(threshold)) if greater else (c <= F.lit(threshold)))
    return out


def fit(sample: DataFrame, trees: int = 8, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> Model:
    """Model from a sample that has ``label`` (0.0 or 1.0) and the stat_* columns.

    Both classes weigh the same. An empty sample, or one with a single class,
    gives a model without rules: the score is then the smoothed share of label 1.
    """
    names = [PREFIX + s for s in STATISTICS]
    sample = sample.select("label", *names).cache()
    try:
        counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        n, ones = sum(counts.values()), counts.get(1.0, 0)
        if min(counts.get(0.0, 0), ones) < 10:
            share = (ones + 1) / (n + 2)
            return Model(float(np.log(share / (1 - share))), ())
        weighted = sample.withColumn("weight", F.when(F.col("label") == 1.0, n / (2 * ones)).otherwise(n / (2 * (n - ones))))
        vectors = VectorAssembler(inputCols=names, outputCol="features").transform(weighted)
        forest = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7, featureSubsetStrategy="0.5", weightCol="weight"
        ).fit(vectors)
        rules = _paths(forest.toDebugString)
        ruled = weighted.select("label", "weight", *[_holds(r, names).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
        vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(ruled)
        lasso = LogisticRegression(
            elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60, weightCol="weight"
        ).fit(vectors.select("label", "weight", "features"))
        weights = [float(w) for w in lasso.coefficients.toArray()]
        return Model(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights) if abs(w) > 1e-6))
    finally:
        sample.unpersist()


def score(model: Model) -> Column:
    """Chance of label 1, between 0 and 1, as an expression over the stat_* columns."""
    names = [PREFIX + s for s in STATISTICS]
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        total = total + F.when(_holds(rule, names), F.lit(weight)).otherwise(F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-total))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled documents of the bounded sample; only their texts are read into statistics."""
    ids = F.broadcast(training_sample(labels, label, rows))  # at most ``rows`` short rows
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return fit(text_statistics(texts.join(ids, "doc_id").select("label", "text")))


def _judged(df: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The columns of ``df`` as c0, c1, ..., then held_out, score and predicted: no name can clash."""
    names = [PREFIX + s for s in STATISTICS]
    stats = text_statistics(df.toDF(*[f"c{i}" for i in range(len(df.columns))]), f"c{df.columns.index('text')}")
    own = [F.col(f"c{i}") for i in range(len(df.columns))]
    judged = stats.select(*own, held_out(own[df.columns.index("doc_id")]).alias("held_out"), score(model).alias("score"), *names)
    return judged.select(*own, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def judge(df: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``df`` with held_out, score and predicted (1 if score >= threshold, else 0) behind its other columns.

    The score depends on the text alone. Null and empty texts are scored by
    their zeros; a null ``doc_id`` is not held out. Input columns of the three
    names are replaced; repeated rows stay repeated.
    """
    df = df.drop("held_out", "score", "predicted")
    return _judged(df, model, threshold).toDF(*df.columns, "held_out", "score", "predicted")


def accepted(df: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``df`` that the model predicts as 1, with all their columns."""
    out = _judged(df, model, threshold).filter("predicted = 1")
    return out.select(*[f"c{i}" for i in range(len(df.columns))]).toDF(*df.columns)

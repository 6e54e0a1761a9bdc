"""The corpus pipeline: good documents, one of each group of near copies, no benchmark items, as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read back as the next one's docs. All but the last return the
columns of ``documents``. The stages' rules for nulls, empty and repeated rows
are those of their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statutelake.llm import decontamination, rule_ensemble, sentencepieces, shingle_join
from statutelake.llm.session import prepare, table, written
from statutelake.llm.vocabularies import vocabulary
from statutelake.operators import lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learnt from the labelled ones predict as good."""
    model = rule_ensemble.train(docs, table(prepare(spark), sf_dir, "labels"))
    return rule_ensemble.accepted(docs, model)


#: Near copies share so many hundredths of their runs of so many words; the query op10 has its own rule.
NEAR_PERCENT, NEAR_WIDTH = 80, 5


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group that links connect.

    Two documents link if the intersection of their sets of five-word runs is at
    least 80 hundredths of the union. Every row counts by itself: rows without an
    id, which come last in their group, and rows of a repeated id are compared
    like all others. Documents without words are kept.
    """
    prepare(spark)
    names = docs.columns
    places = [f"column{i}" for i in range(len(names))]
    doc_id, text = (F.col(places[names.index(n)]) for n in ("doc_id", "text"))
    # The numbers are written, so that all later steps see the same ones.
    rows = written(docs.toDF(*places).withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = shingle_join.jaccard_join(rows.select(F.col("row").alias("doc_id"), text.alias("text")), percent=NEAR_PERCENT, width=NEAR_WIDTH)
    several = groups.filter("doc_id != component_id").select("component_id").distinct()
    members = groups.select(F.col("doc_id").alias("row"), "component_id").join(several, "component_id").join(rows.select("row", doc_id.alias("id")), "row")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first"))
    gone = members.join(first, "component_id").filter(F.col("row") != F.col("first.row")).select("row")
    return rows.join(gone, "row", "left_anti").select(*places).toDF(*names)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(prepare(spark), sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, part, ids, n_tokens, text_bytes, text_crc32) of each document's parts."""
    prepare(spark)
    model = vocabulary("piece_bpe_32k.model")
    return sentencepieces.digest(sentencepieces.encode(docs, model), model)


STAGES = [("quality_classifier", quality), ("ngram_jaccard_join", near_copies), ("decontamination", decontaminate), ("sentencepieces", encode)]

#: SQL cannot express the classifier or the encoder; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    Once a stage's rows are written, what it wrote on the way and what it has read go.
    """
    docs, read = table(prepare(spark), sf_dir, "documents"), set()
    for name, stage in STAGES:
        before = lineage.paths()
        result = stage(spark, docs, sf_dir)
        way = lineage.paths() - before
        docs = written(result, name)
        lineage.release(way | read)
        read = lineage.paths() - before
    return docs

"""Query of the quality classifier (9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import rule_ensemble
from .registry import query
from .session import table


@query("op9_rule_ensemble")
def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from rules learnt on the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rule_ensemble.train(docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.judge(docs, model).select("doc_id", "held_out", "score", "predicted")

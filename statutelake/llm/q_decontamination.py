"""Query of benchmark decontamination (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontamination
from .registry import query
from .session import table


@query("op5_benchmark_leaks")
def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item that a document holds, whole or with a few edits."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

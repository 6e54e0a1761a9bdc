"""Query of sharding (4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import sharding
from .registry import query
from .session import table


@query("op4_rendezvous_shards")
def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards and slots of all documents under the law ``key``."""
    return sharding.assign(table(spark, sf_dir, "documents"))

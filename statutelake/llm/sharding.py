"""Sharding by weighted rendezvous hashing of stable record keys.

Each shard draws a number for each key; a record goes to the shard whose draw,
scaled by the shard's weight, is best. Keys and shard names alone decide, so one
more shard takes records from the others and moves none between them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import written

SHARDS = 24


def draw(key: Column, shard: int) -> Column:
    """Uniform number in (0, 1) from the key's text and the shard: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"#{shard}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def shard_of(key: Column, weights: list[float]) -> Column:
    """Shard of a key: shard i gets a share of weights[i] / sum(weights). The smaller shard wins a tie.

    A null key goes to the first shard that has a weight.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a weight")
    if any(w < 0 or not math.isfinite(w) for w in weights):
        raise ValueError("weights are finite and not negative")
    key = F.coalesce(key.cast("string"), F.lit(""))
    # -log(draw) / weight is exponentially distributed: the smallest of them falls to a shard in proportion to its weight.
    costs = [F.struct((-F.log(draw(key, i)) / F.lit(float(w))).alias("cost"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    return (costs[0] if len(costs) == 1 else F.least(*costs))["shard"]


def assign(
    df: DataFrame, shards: int = SHARDS, weights: list[float] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    ``size`` is the UTF-8 bytes of the text (none if null) plus 8, ``text_crc32``
    the unsigned checksum of those bytes (0 for null and empty texts). The law is
    ``key``. ``slot`` numbers the rows of a shard from 0 without gaps, by key;
    repeated keys get neighbouring slots in the order of their sizes and
    checksums. Null keys come first. ``grown_shard`` is the shard if one more of
    weight 1 is added (of the mean weight if weights are given).

    The rows are dealt out by ranges of (shard, key). A slot is the row's number
    in its range plus the rows of its shard in the ranges before: no task holds
    a whole shard, and only one row for each range and shard is put in order.
    """
    weights = weights or [1.0] * shards
    grown = [*weights, sum(weights) / len(weights)]
    value = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "utf-8")
    slim = df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        (F.length(value) + 8).cast("long").alias("size"),
        F.crc32(value).alias("text_crc32"),
        shard_of(F.col(f"`{key}`"), weights).alias("shard"),
        shard_of(F.col(f"`{key}`"), grown).alias("grown_shard"),
    )
    slim = written(slim, "shards")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = written(
        slim.repartitionByRange(parts, "shard", "doc_id", "size", "text_crc32").withColumn("part", F.spark_partition_id()), "ranges"
    )
    counts = ranges.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part", "shard").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    return ranges.join(counts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("base") + F.row_number().over(inside) - 1).cast("long").alias("slot"), "grown_shard",
    )


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, weights: list[float] | None = None, key: str = "doc_id") -> None:
    """Write the rows of ``df`` to one folder per shard (``shard=i``), with all their columns.

    The rows are dealt out by shard and a hash of the key, so that several tasks
    write one shard.
    """
    if "shard" in {c.lower() for c in df.columns}:
        df = df.drop(*[c for c in df.columns if c.lower() == "shard"])
    weights = weights or [1.0] * shards
    dealt = df.withColumn("shard", shard_of(F.col(f"`{key}`"), weights))
    split = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(8))
    dealt.repartition("shard", split).write.partitionBy("shard").parquet(path)

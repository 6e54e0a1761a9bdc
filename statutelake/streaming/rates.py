"""Event rates over sliding windows with a watermark and a state store (M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statutelake.streaming.incremental import sliding_rate


def append_rates(stream: DataFrame, out: str, checkpoint: str, delay: str = "5 minutes", width: str = "2 minutes", slide: str = "1 minute") -> list[dict]:
    """M3: write the count of every window that is closed to ``out`` and return the progress of each batch.

    A window stays in the state store until the latest event time seen before
    the batch, less ``delay``, has reached its end; it is then written once and
    forgotten. A row that comes for a window which the batch before has closed is
    dropped, and counted in the progress (``numRowsDroppedByWatermark``). So the
    state holds no more windows of a group than (delay + width) / slide, and those
    that one batch spans. Windows that are not closed at the end of the input are
    kept in the checkpoint for the next run.
    """
    query = (
        sliding_rate(stream, delay, width, slide).writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return list(query.recentProgress)


def closed_rates(batches: DataFrame, batch: str, delay: str = "5 minutes", width: str = "2 minutes", slide: str = "1 minute") -> DataFrame:
    """M3 in batch form: what ``append_rates`` writes for rows that came in numbered batches.

    A row counts in a window unless the window ends at or before the limit of its
    batch: the latest event time of all batches but the last one before it, less
    ``delay``. Windows count once they end at or before the limit behind all.
    """
    span = F.expr(f"INTERVAL {delay}")
    latest = batches.groupBy(F.col(batch).alias("b")).agg(F.max(F.date_trunc("millisecond", "ts")).alias("latest"))
    # One row for each batch: the limit that its rows meet.
    pairs = latest.alias("x").join(latest.alias("y"), F.col("y.b") <= F.col("x.b") - 2, "left")
    limits = pairs.groupBy(F.col("x.b").alias(batch)).agg((F.max("y.latest") - span).alias("limit"))
    final = latest.agg((F.max("latest") - span).alias("final"))
    rows = batches.join(limits, batch).select("event_type", "limit", F.window("ts", width, slide).alias("w"))
    kept = rows.filter(F.col("limit").isNull() | (F.col("w.end") > F.col("limit"))).join(final, F.col("w.end") <= F.col("final"))
    minutes = (F.unix_timestamp("w.end") - F.unix_timestamp("w.start")) / 60
    return kept.groupBy("w", "event_type").agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("start"), "event_type", "n", (F.col("n") / minutes).alias("per_minute")
    )

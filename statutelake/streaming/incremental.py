"""Incremental intake with Structured Streaming (M2-M6).

Each micro-batch appends its own small result as a delta; nothing that is
already written is read whole or written again, and no state grows in memory.
A delta is a folder named after its batch, so a replayed batch overwrites its
own delta and changes nothing else. Reading folds the deltas.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from statutelake.operators.identity import assign_ids
from statutelake.operators.relational import missing

FILES_PER_BATCH = 100


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream a parquet table that is one file or a folder of files."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    status = target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if status.isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", target.getName()).parquet(target.getParent().toString())


def unseen_documents(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """M2: each document once within ``delay``; its key is remembered that long."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def first_documents(stream: DataFrame, key: str) -> DataFrame:
    """M2: each document once, however late it comes again.

    The keys lie in the state store, partitioned by their hashes; a batch looks
    up and writes its own keys only. Start the query inside ``keyed_state``, so
    that they lie on disk and not on the heap.
    """
    return stream.dropDuplicates([key])


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the state store on disk that Spark has for many keys."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_append(stream: DataFrame, out: str, checkpoint: str) -> list[dict]:
    """Append the rows of a stateful stream to ``out`` until the input ends; returns the progress of each batch."""
    query = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    return list(query.recentProgress)


def sliding_rate(events: DataFrame, delay: str = "5 minutes", width: str = "2 minutes", slide: str = "1 minute") -> DataFrame:
    """M3: events per minute over a sliding window, batch or stream."""
    marked = events.withWatermark("ts", delay) if events.isStreaming else events
    counts = marked.groupBy(F.window("ts", width, slide).alias("w"), "event_type").agg(F.count("*").alias("n"))
    minutes = (F.unix_timestamp("w.end") - F.unix_timestamp("w.start")) / 60
    return counts.select(F.col("w.start").alias("start"), "event_type", "n", (F.col("n") / minutes).alias("per_minute"))


def _parsed(lines: DataFrame) -> DataFrame:
    done = F.regexp_extract("text", r"done=(\d+)", 1).try_cast("bigint")
    phase = F.nullif(F.regexp_extract("text", r"phase=(\w+)", 1), F.lit(""))
    return lines.withColumn("done", done).withColumn("phase", phase).withColumn("at", F.struct("ts", "seq"))


def log_state(lines: DataFrame) -> DataFrame:
    """M4: per source the last value of each field of a progress log.

    ``lines`` is (source, ts, seq, text). Only maxima are kept, so it runs as a
    streaming aggregate as well as in batch.
    """
    return fold_log_state(log_delta(lines))


def log_delta(lines: DataFrame) -> DataFrame:
    """The state of one batch of lines, with the places of the last values."""
    parsed = _parsed(lines)
    done_at = F.when(F.col("done").isNotNull(), F.col("at"))
    phase_at = F.when(F.col("phase").isNotNull(), F.col("at"))
    return parsed.groupBy("source").agg(
        F.max_by("done", done_at).alias("done"), F.max(done_at).alias("done_at"),
        F.max_by("phase", phase_at).alias("phase"), F.max(phase_at).alias("phase_at"),
        F.count_if(F.col("text").rlike("(?i)error")).alias("errors"), F.count("*").alias("lines"), F.max("ts").alias("last_ts"),
    )


def fold_log_state(deltas: DataFrame) -> DataFrame:
    """States of several batches as one."""
    return deltas.groupBy("source").agg(
        F.max_by("done", "done_at").alias("done"), F.max_by("phase", "phase_at").alias("phase"),
        F.sum("errors").alias("errors"), F.sum("lines").alias("lines"), F.max("last_ts").alias("last_ts"),
    )


def fold_rates(deltas: DataFrame) -> DataFrame:
    """M3 over a stream: window counts of several batches as one, late rows included."""
    return deltas.groupBy("start", "event_type").agg(F.sum("n").alias("n"), F.sum("per_minute").alias("per_minute"))


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Process all available input batch by batch and return."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def delta_handler(folder: str, work: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Append ``work(batch)`` as the batch's delta."""

    def handle(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return handle


def read_deltas(spark: SparkSession, folder: str, schema, before: int | None = None) -> DataFrame:
    """The deltas with their number as ``batch``; those before a batch, or all. No delta gives no rows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if before == 0 or not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("bigint"))
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(folder)
    return rows if before is None else rows.filter(F.col("batch") < before)


def upsert_handler(folder: str, keys: list[str], columns: list[str]) -> Callable[[DataFrame, int], None]:
    """M5: the update values of each batch; of several in a batch the largest counts."""

    def work(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(*[F.max(F.when(~missing(F.col(c)), F.col(c))).alias(c) for c in columns])

    return delta_handler(folder, work)


def filled(target: DataFrame, deltas: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """M5: ``target`` with empty values filled from the first batch that has one."""
    first = deltas.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("batch"))).alias(f"new_{c}") for c in columns]
    )
    joined = target.join(first, keys, "left")

    def pick(name: str) -> Column:
        return F.when(missing(F.col(name)), F.coalesce(f"new_{name}", name)).otherwise(F.col(name)).alias(name)

    return joined.select(*[pick(c) if c in columns else F.col(c) for c in target.columns])


def id_handler(folder: str, base: DataFrame, ranges: dict[str, tuple[int, int]]) -> Callable[[DataFrame, int], None]:
    """M6: ids for the new documents of each batch; only the new index rows are written.

    ``base`` is the index (filename, category, id) before the first batch.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        index = base.unionByName(read_deltas(spark, folder, base.schema, number).select(*base.columns))
        fresh = batch.select("filename", "category", "pub_date").dropDuplicates(["filename"]).join(index.select("filename"), "filename", "left_anti")
        assign_ids(fresh, index, ranges).select(*base.columns).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return handle


def unseen_handler(folder: str, key: str, schema, buckets: int = 256) -> Callable[[DataFrame, int], None]:
    """M2: the rows of each batch whose key no earlier batch had, one per key.

    The keys lie in files by hash bucket, not in memory, and are never forgotten.
    A batch opens only the buckets that its own keys fall into. A replayed batch
    overwrites its own rows and keys.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark, index = batch.sparkSession, f"{folder}-keys"
        target = spark._jvm.org.apache.hadoop.fs.Path(index)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        rows = batch.dropDuplicates([key]).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        own = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
        paths = [f"{index}/bucket={b}" for b in own if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{index}/bucket={b}"))]
        if paths:
            kind = StructType([schema[key], StructField("bucket", IntegerType()), StructField("batch", LongType())])
            seen = spark.read.schema(kind).option("basePath", index).parquet(*paths).filter(F.col("batch") < number)
            rows = rows.join(seen.select("bucket", key), ["bucket", key], "left_anti")
        rows.select(*schema.names).write.mode("overwrite").parquet(f"{folder}/batch={number}")
        fresh = spark.read.schema(schema).parquet(f"{folder}/batch={number}").select(key)
        keyed = fresh.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).withColumn("batch", F.lit(number).cast("bigint"))
        # One file for each bucket: rows of a bucket come together.
        keyed.repartition("bucket").write.partitionBy("bucket", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(index)

    return handle

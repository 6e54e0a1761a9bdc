"""Session settings the jobs are written for (all are Spark's own switches)."""

from __future__ import annotations

from pyspark.sql import SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot law or title is split by AQE even if that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side is broadcast by its measured size only. Estimates start from the size of compressed
    # files and know neither derived texts nor exploded rows, which may be a thousand times larger.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    # A task's share stays small when tables grow: shuffles begin with many partitions, which are merged by measured size.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Folders are listed by a few tasks for each core; Spark's 10,000 cost more than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.session.timeZone": "UTC",
    # Longer generated methods are not compiled by the JVM's JIT.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# The training-data operators join small tables to large ones in many short steps, which Spark plans by its estimates.
# Their partition counts and sizes stay with the cluster.
ESTIMATED: dict[str, str | None] = ADAPTIVE | {
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": None,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": None,
}


def apply_settings(spark: SparkSession, settings: dict[str, str | None] = ADAPTIVE) -> SparkSession:
    """Set the runtime options; one without a value is the session's own again."""
    for key, value in settings.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, memory: str = "16g", checkpoint: str | None = None) -> SparkSession:
    """Single-JVM session for tests and the benchmark; ``checkpoint`` is its shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("statutelake")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

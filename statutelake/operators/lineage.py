"""Cutting lineage: write an intermediate result once, read it many times."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Without it a local session gets a temporary folder of its own, as all its
    tasks run on this machine; a cluster raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="statutelake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by then
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)


#: Paths that were given out and not released, with their sessions.
_paths: dict[str, SparkSession] = {}
#: The paths that each open ``step`` of this thread has seen.
_open = threading.local()


def new_path(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder whose files go when the driver ends, or when ``release`` is told so."""
    path = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _paths[path] = spark
    for way in getattr(_open, "steps", []):
        way.add(path)
    atexit.register(_remove, spark, path)
    return path


def paths() -> set[str]:
    """All paths whose files are still there."""
    return set(_paths)


def release(gone: set[str]) -> None:
    """Remove the files of paths that nothing reads any more."""
    for path in gone & set(_paths):
        _remove(_paths.pop(path), path)


#: Spark's own switch: shuffle files go when their query ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str) -> None:
    """Write ``df`` as parquet; the shuffle files of this go with its end, so steps do not add up on the disks."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back.

    The result survives lost executors, and later uses scan only the columns
    they need in place of repeating the work behind ``df``.
    """
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, "table")
    write(df, path)
    return spark.read.schema(schema).parquet(path)


def step(make: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` what ``make`` gives; the tables that it wrote on the way go."""
    outer, way = getattr(_open, "steps", []), set()
    _open.steps = [*outer, way]
    try:
        df = make()
    finally:
        _open.steps = outer
    out = materialize(df)
    release(way)
    return out

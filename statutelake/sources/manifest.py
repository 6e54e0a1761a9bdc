"""Change detection over files by path, size, time and content hash (M1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "path string, length bigint, modified timestamp, md5 string"
#: Paths that one read is given; more make more reads.
PATHS = 10_000


def _files(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) of all files; no content is read."""
    return _files(spark, path, glob).select("path", "length", F.col("modificationTime").alias("modified"))


def hash_files(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """(path, md5) of the named files, a bounded number of names at a time."""
    out, names = None, []

    def read(some: list[str]) -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(some).select("path", F.md5("content").alias("md5"))

    for row in paths.select("path").toLocalIterator():
        names.append(row["path"])
        if len(names) == PATHS:
            out, names = read(names) if out is None else out.unionByName(read(names)), []
    if names:
        out = read(names) if out is None else out.unionByName(read(names))
    return spark.createDataFrame([], "path string, md5 string") if out is None else out


def refresh(spark: SparkSession, path: str, manifest: DataFrame, glob: str = "*") -> DataFrame:
    """The manifest (path, length, modified, md5) of the files as they are now.

    A file of the size and time that the old manifest has keeps its hash; only
    the others are opened.
    """
    found = list_files(spark, path, glob)
    old = manifest.select("path", "length", "modified", F.col("md5").alias("old_md5"))
    known = found.join(old, ["path", "length", "modified"], "left")
    fresh = hash_files(spark, known.filter("old_md5 IS NULL"))
    return known.join(fresh, "path", "left").select("path", "length", "modified", F.coalesce("old_md5", "md5").alias("md5"))


def by_name(manifest: DataFrame, name: Column) -> DataFrame:
    """(path, md5) under names that stay when a file is written anew; several files of a name count by all their hashes."""
    return manifest.groupBy(name.alias("path")).agg(F.array_join(F.array_sort(F.collect_list("md5")), " ").alias("md5"))

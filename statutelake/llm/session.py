"""Settings and helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statutelake.operators.lineage import new_path, write

#: Rows and bytes of one Arrow batch: texts are long, so batches are short.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if getattr(context, "_statutelake_shipped", False):
        return
    root = Path(__file__).parent.parent
    archive = Path(tempfile.mkdtemp()) / "statutelake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"statutelake/{file.relative_to(root)}")
    context.addPyFile(str(archive))
    context._statutelake_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options that the operators are written for, and ship the package."""
    ship(spark)
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``).

    What is written there goes when the driver ends.
    """
    return new_path(spark, f"llm-{name}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    The table outlives lost executors, and later uses do not repeat the work.
    """
    spark, schema = df.sparkSession, df.schema
    path = shared_path(spark, name)
    write(df, path)
    return spark.read.schema(schema).parquet(path)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, found by place: others whose names differ in case only do not get in the way.

    A name is looked up as written first and without regard to case after that;
    of several columns of one name the first counts.
    """
    folded = [c.lower() for c in df.columns]
    places = [df.columns.index(n) if n in df.columns else folded.index(n.lower()) for n in names]
    numbered = df.toDF(*[f"column{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"column{i}").alias(n) for i, n in zip(places, names)])


def long_or_null(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a long; columns whose names differ in case only are left alone."""
    return F.col(f"`{name}`").cast("long")

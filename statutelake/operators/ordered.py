"""Order-dependent jobs that stay bounded when one key is hot.

A plain window puts a whole key into one task. The helpers here cut the order
of a key into segments: rows are handled per (key, segment), and only one
small summary row per segment is handled per key. Where the hot keys are known
(``large_keys``), only these are cut: all others would give as many summary
rows as they have rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statutelake.operators.lineage import materialize


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first k rows of each group.

    Spark turns ``row_number() <= k`` into a group limit on both sides of the
    shuffle, so at most k rows per group leave a task.
    """
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= k)
    return out if rank else out.drop(name)


#: A key of more rows is cut into segments; one of fewer is one group of a window, which Spark spills if need be.
LARGE = 100_000


def large_keys(df: DataFrame, keys: list[str], rows: int = LARGE) -> DataFrame | None:
    """The keys with more than ``rows`` rows, or None if there are none; they are few, as each has so many rows.

    Rows without a key stay one group: segments are joined by their keys.
    """
    large = materialize(df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > rows).select(*keys))
    return None if large.isEmpty() else large


#: A written table of so many rows is broadcast.
BROADCAST_ROWS = 100_000


def few(df: DataFrame) -> DataFrame | None:
    """``df`` written, as the side of a join that is broadcast if it has few rows; None if it has none."""
    out = materialize(df)
    size = out.count()
    return None if size == 0 else F.broadcast(out) if size <= BROADCAST_ROWS else out


def with_segment(df: DataFrame, keys: list[str], order: str, span: int, large: DataFrame) -> DataFrame:
    """``_large`` marks the rows of large keys; ``_seg`` cuts these along ``order`` and is 0 for all others."""
    marked = df.join(F.broadcast(large.withColumn("_large", F.lit(True))), keys, "left")
    return marked.withColumn("_seg", F.when(F.col("_large"), F.expr(f"`{order}` div {span}")).otherwise(0))


def lag_by_segment(
    df: DataFrame, keys: list[str], order: str, cols: list[str], span: int, prefix: str = "prev_", large: DataFrame | None = None,
) -> DataFrame:
    """Previous row's columns within keys, ordered by ``order``. Rows move once; ``large`` are the keys to cut into segments."""
    row = F.struct(F.lit(1).alias("has"), *cols)
    if large is None:
        prev = F.lag(row).over(Window.partitionBy(*keys).orderBy(order))
        return df.withColumn("_prev", prev).select(*df.columns, *[F.col("_prev")[c].alias(prefix + c) for c in cols])
    cut = with_segment(df, keys, order, span, large)
    inside = Window.partitionBy(*keys, "_seg").orderBy(order)
    local = cut.withColumn("_prev", F.lag(row).over(inside))
    last = cut.filter("_large").groupBy(*keys, "_seg").agg(F.max_by(row, order).alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_seg")
    carry = last.withColumn("_carry", F.lag("_last").over(across)).select(*keys, "_seg", "_carry")
    joined = local.join(carry, [*keys, "_seg"], "left")
    prev = F.coalesce("_prev", "_carry")
    return joined.select(*df.columns, *[prev[c].alias(prefix + c) for c in cols])


def rank_by_segment(df: DataFrame, keys: list[str], order: list[Column], segment: list[str], name: str) -> DataFrame:
    """Row number within keys. ``segment`` are columns that lead the order, so
    that a row's number is the rows of earlier segments plus its own rank."""
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, *segment).orderBy(*order)))
    sizes = df.groupBy(*keys, *segment).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*keys).orderBy(*segment).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    joined = local.join(base, [*keys, *segment])
    return joined.withColumn(name, F.col("_base") + F.col("_local")).select(*df.columns, name)


def rank_by_levels(df: DataFrame, keys: list[str], levels: list[str], order: list[Column], name: str) -> DataFrame:
    """Row number within keys, counted down a ladder of nested segments.

    ``levels`` are columns that lead the order, each finer than the one before.
    A row's number is its rank in its finest segment plus the rows of earlier
    segments, which are summed level by level: each window sees only the
    segments inside one segment of the level above, never a whole key.
    """
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys, *levels).orderBy(*order)))
    sizes = df.groupBy(*keys, *levels).agg(F.count("*").alias("_size"))
    for depth in range(len(levels), 0, -1):
        outer, inner = [*keys, *levels[: depth - 1]], levels[depth - 1]
        before = Window.partitionBy(*outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
        base = sizes.select(*outer, inner, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
        out = out.join(base, [*outer, inner]).withColumn(name, F.col(name) + F.col("_base")).drop("_base")
        sizes = sizes.groupBy(*outer).agg(F.sum("_size").alias("_size"))
    return out.select(*df.columns, name)

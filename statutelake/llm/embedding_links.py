"""Near-duplicate vectors: random-hyperplane tables, exact cosines, connected components.

Vectors of one label that fall on the same side of all hyperplanes of a table
share a bucket. Buckets are index lists for ``leader_join``: cosines are worked
out in double precision on the vectors themselves, so no link below the
threshold comes out. A pair at cosine 0.98 meets in no table with a chance of
(1 - 0.936^16)^40 = 4e-8, a nearer pair with less.

Most pairs of a bucket are far apart. The first components of two unit vectors,
with the lengths of what they leave out, give a bound that no cosine exceeds
(Cauchy-Schwarz): pairs meet by these few numbers first, and whole vectors are
only moved for pairs whose bound allows a link.

Equal vectors are collapsed first. The links of a vector are then counted inside
its component, block against block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .leader_join import across_leaders, link_classes
from .session import written

BITS, TABLES, BLOCK = 16, 40, 512
#: Components that the bound looks at, and what single precision and sums may be off.
HEAD, SLACK = 16, 1e-5
HEADS = [f"h{i}" for i in range(HEAD)]


@lru_cache(maxsize=8)
def _planes(size: int, tables: int, bits: int) -> np.ndarray:
    return np.random.RandomState(size + 1).standard_normal((size, tables * bits))


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vector): vector is the unit vector's doubles, or null if it can link with nothing."""
    for batch in batches:
        lists, labels = batch.column(2), batch.column(1)
        values, offsets = lists.values, lists.offsets.to_numpy()
        full = np.asarray(lists.is_valid()) & np.asarray(labels.is_valid()) & (np.diff(offsets) > 0)
        # A missing component counts as one that is not finite.
        numbers = values.to_numpy(zero_copy_only=False).astype(np.float64)
        out: list[bytes | None] = [None] * batch.num_rows
        for size in np.unique(np.diff(offsets)[full]):
            at = np.flatnonzero(full & (np.diff(offsets) == size))
            x = numbers[offsets[at][:, None] + np.arange(size)]
            top = np.abs(x).max(axis=1)
            usable = np.isfinite(x).all(axis=1) & (top > 0)
            at, x = at[usable], x[usable] / top[usable, None]
            x /= np.sqrt(np.array([float(row @ row) for row in x]))[:, None]
            for i, row in zip(at.tolist(), x):
                out[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), labels, pa.array(out, pa.binary())], ["id", "label", "vector"])


def _buckets(tables: int, bits: int):
    weights = (1 << np.arange(bits)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows in _by_size(batch.column(1).to_pylist()).items():
                vectors = np.array([v for _, v in rows])
                sides = (vectors @ _planes(size, tables, bits) > 0).reshape(len(rows), tables, bits)
                at = [i for i, _ in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(batch.column(0))[at], tables)),
                        pa.array(np.repeat(np.array(batch.column(2))[at], tables)),
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))),
                        pa.array((sides @ weights).reshape(-1)),
                        pa.array(np.full(len(rows) * tables, size, np.int32)),
                    ],
                    ["item", "label", "tab", "sides", "size"],
                )

    return run


def _by_size(vectors: list) -> dict[int, list]:
    found: dict[int, list] = {}
    for i, v in enumerate(vectors):
        x = np.frombuffer(v)
        found.setdefault(len(x), []).append((i, x))
    return found


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, label, the first components, rest): rest is the length of the others."""
    for batch in batches:
        heads, rest = np.zeros((batch.num_rows, HEAD)), np.zeros(batch.num_rows)
        for i, value in enumerate(batch.column(1).to_pylist()):
            x = np.frombuffer(value)
            heads[i, : min(len(x), HEAD)] = x[:HEAD]
            rest[i] = math.sqrt(float(x[HEAD:] @ x[HEAD:]))
        columns = [pa.array(c) for c in heads.T.astype(np.float32)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns, pa.array(rest)], ["item", "label", *HEADS, "rest"])


def may_link(pairs: DataFrame, heads: DataFrame, limit: float) -> DataFrame:
    """The pairs (a, b) of one label whose angle can be ``limit``, or ``radius`` more where the pairs have one."""
    x, y = (heads.select(F.col("item").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("label", *HEADS, "rest")]) for n in ("a", "b"))
    bound = F.col("rest_a") * F.col("rest_b")
    for h in HEADS:
        bound = bound + F.col(f"{h}_a").cast("double") * F.col(f"{h}_b").cast("double")
    angle = F.lit(limit + 1e-6) + (F.col("radius") if "radius" in pairs.columns else F.lit(0.0))
    near = bound >= F.cos(F.least(angle, F.lit(math.pi))) - SLACK
    # A bucket's key is a hash with the label in it; labels are compared all the same.
    return pairs.join(x, "a").join(y, "b").filter((F.col("label_a") == F.col("label_b")) & near).select("a", "b")


def _cosines(threshold: float):
    limit = math.acos(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(i).to_pylist() for i in (2, 3))
            cos = np.array([float(np.frombuffer(u) @ np.frombuffer(v)) if len(u) == len(v) else -1.0 for u, v in zip(x, y)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(np.arccos(np.clip(cos, -1, 1))), pa.array(cos >= threshold),
                    pa.array(np.full(len(cos), limit)),
                ],
                ["a", "b", "distance", "linked", "span"],
            )

    return run


def _count_links(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        """Weighted links between the two blocks of one group (or inside the one block)."""
        side = group.column("side").to_numpy()
        items, weights = group.column("item").to_numpy(), group.column("weight").to_numpy().astype(np.int64)
        vectors = group.column("vector").to_pylist()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(right)
        right = left if same else right
        totals_left, totals_right = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        a, b = (np.array([np.frombuffer(vectors[i]) for i in at]) for at in (left, right))
        if len(a) and len(b):
            linked = a @ b.T >= threshold
            if same:
                np.fill_diagonal(linked, False)
            totals_left = linked @ weights[right]
            totals_right = linked.T @ weights[left]
        rows, totals = (left, totals_left) if same else (np.concatenate([left, right]), np.concatenate([totals_left, totals_right]))
        return pa.table({"item": items[rows], "links": totals})

    return run


def embedding_links(
    df: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    bits: int = BITS, tables: int = TABLES, block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Two vectors link if their labels are equal and not null, they have as many
    components, and their cosine is at least ``threshold``. Vectors that are
    null, empty or zero, hold a null or a non-finite component or have a null
    label link with nothing. ``n_links`` counts the other vectors that a vector
    links to; repeated rows count as other vectors. ``component_id`` is the
    smallest id that can be reached, the own id without links. A null id stays
    null, links with nothing and is kept. An empty table gives no rows.
    """
    source = df.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    units = source.mapInArrow(_unit, "id long, label string, vector binary")
    usable = F.col("vector").isNotNull() & F.col("id").isNotNull()
    # Equal vectors of a label have one key: 64 bits of their digest, with the label.
    rows = written(units.withColumn("copy", F.when(usable, F.sha2(F.concat(F.col("vector"), F.encode("label", "utf-8")), 256))), "vectors")
    reps = written(
        rows.filter("copy is not null").groupBy("copy").agg(
            F.min("id").alias("item"), F.count("*").alias("weight"), F.first("vector").alias("vector"), F.first("label").alias("label")
        ),
        "distinct",
    )
    # ``item`` is a vector's place among distinct ones: ids may repeat, digests do not.
    reps = reps.withColumn("node", F.conv(F.substring("copy", 1, 15), 16, 10).cast("long"))
    lists = reps.select(F.col("node").alias("item"), "vector", "label").mapInArrow(
        _buckets(tables, bits), "item long, label string, tab int, sides long, size int"
    ).select(F.xxhash64("label", "tab", "sides", "size").alias("key"), "item", F.lit(0).alias("kind"))

    slim = reps.select(F.col("node").alias("item"), "vector", "label")

    heads = written(slim.select("item", "vector", "label").mapInArrow(
        _heads, f"item long, label string, {', '.join(f'{h} float' for h in HEADS)}, rest double"), "heads")

    def measure(pairs: DataFrame) -> DataFrame:
        x = slim.select(F.col("item").alias("a"), F.col("vector").alias("x"))
        y = slim.select(F.col("item").alias("b"), F.col("vector").alias("y"))
        met = may_link(pairs, heads, math.acos(threshold)).join(x, "a").join(y, "b")
        return met.select("a", "b", "x", "y").mapInArrow(
            _cosines(threshold), "a long, b long, distance double, linked boolean, span double"
        )

    across = across_leaders(measure, lambda distance, radius, span: distance - radius > span + 1e-6, "vectors")
    classes = link_classes(lists, measure, across, "vectors")
    classes = written(classes.select(F.col("node").alias("item"), F.col("component").alias("class")), "classes")
    members = reps.select(F.col("node").alias("item"), F.col("item").alias("id"), "weight", "vector").join(classes, "item", "left")
    members = written(members.withColumn("class", F.coalesce("class", "item")), "members")
    smallest = members.groupBy("class").agg(F.min("id").alias("component_id"))
    linked = members.join(classes.select("class").distinct(), "class", "left_semi")
    # Blocks of a class: as many as its size asks for, each pair of blocks is one group.
    sizes = linked.groupBy("class").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = linked.join(sizes, "class").withColumn("block", F.pmod(F.xxhash64("item"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "class", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "item", "weight", "vector",
    )
    # Groups are small and take long for their size: so many tasks, not as many as their bytes ask for.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        dealt.repartition(tasks, "class", "p", "q").groupBy("class", "p", "q").applyInArrow(_count_links(threshold), "item long, links long")
        .groupBy("item").agg(F.sum("links").alias("links"))
    )
    known = (
        reps.select("copy", F.col("node").alias("item"), "weight")
        .join(members.select("item", "class"), "item").join(smallest, "class").join(counts, "item", "left")
        .select("copy", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    out = rows.select("id", "copy").join(known, "copy", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )

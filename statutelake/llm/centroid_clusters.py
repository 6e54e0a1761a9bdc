"""K-means over vectors whose blocks of dimensions are stored as codes of subvector dictionaries.

Vectors become integers and are stored in chunks. A chunk cuts its dimensions
into blocks and keeps each block's distinct subvectors once, with one code for
each vector, so nothing is lost. In a round a task works out the distance from
every distinct subvector to the centroids once; a vector's distance is the sum
of its codes' entries. The new centroids come from the same tables: how often a
cluster uses each subvector, times the subvector.

A dictionary belongs to one chunk: it is bounded, needs no shuffle and is never
broadcast. What travels are the centroids, and one row of sums for each chunk
and cluster. All arithmetic is exact, on integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import columns, written

#: Vectors of a chunk and dimensions of a block.
CHUNK, WIDTH = 1 << 14, 4
#: Components beyond this are held at it, so that squared distances of up to 64 of them fit into 63 bits.
LARGEST = 1 << 27
MOST = 2**63 - 1


def _integers(batch: pa.RecordBatch, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, vectors): the places of the usable vectors of a batch, and floor(scale * x) of their components."""
    lists = batch.column(1)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = ~np.isfinite(x) | np.asarray(flat.is_null())
    ends = np.concatenate([[0], np.cumsum(bad)])
    fit = np.asarray(lists.is_valid()) & (np.diff(offsets) == size) & (ends[offsets[1:]] == ends[offsets[:-1]])
    rows = np.flatnonzero(fit)
    values = x[(offsets[rows][:, None] + np.arange(size)).reshape(-1)].reshape(len(rows), size)
    with np.errstate(over="ignore"):
        return rows, np.clip(np.floor(values * scale), -LARGEST, LARGEST).astype(np.int64)


def _kept(size: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = _integers(batch, size, scale)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), size).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists], ["vec_id", "vector"])

    return run


def encode_chunk(vectors: np.ndarray, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(codes, dictionaries): a vector's code in each block, and each block's distinct subvectors."""
    codes, entries = [], []
    for at in range(0, vectors.shape[1], width):
        distinct, code = np.unique(vectors[:, at : at + width], axis=0, return_inverse=True)
        codes.append(code.reshape(-1).astype(np.int32))
        entries.append(distinct)
    return np.stack(codes), entries


def _store(size: int, scale: int, width: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0

        def flush():
            codes, entries = encode_chunk(np.concatenate(parts), width)
            values = [
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([codes.tobytes()], pa.binary()),
                pa.array([[len(e) for e in entries]], pa.list_(pa.int32())), pa.array([b"".join(e.astype(np.int32).tobytes() for e in entries)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(values, ["ids", "codes", "sizes", "entries"])

        for batch in batches:
            rows, values = _integers(batch, size, scale)
            for at in range(0, len(rows), chunk):
                ids.append(batch.column(0).take(pa.array(rows[at : at + chunk])))
                parts.append(values[at : at + chunk])
                held += len(parts[-1])
                if held >= chunk:
                    yield flush()
                    ids, parts, held = [], [], 0
        if held:
            yield flush()

    return run


STORED = "ids array<long>, codes binary, sizes array<int>, entries binary"


def _chunks(batch: pa.RecordBatch, size: int, width: int):
    """(ids, codes, dictionaries) of each stored chunk of a batch."""
    widths = [min(width, size - at) for at in range(0, size, width)]
    for ids, codes, sizes, entries in zip(*(batch.column(i) for i in range(4))):
        flat, at, tables = np.frombuffer(entries.as_buffer(), np.int32).astype(np.int64), 0, []
        for n, w in zip(sizes.as_py(), widths):
            tables.append(flat[at : at + n * w].reshape(n, w))
            at += n * w
        yield ids.values, np.frombuffer(codes.as_buffer(), np.int32).reshape(len(widths), -1), tables


def nearest(codes: np.ndarray, tables: list[np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; the smaller number wins ties."""
    total, at = np.zeros((codes.shape[1], len(centroids)), np.int64), 0
    for code, entries in zip(codes, tables):
        part = centroids[:, at : at + entries.shape[1]]
        gap = entries[:, None, :] - part[None]
        total += (gap * gap).sum(2)[code]
        at += entries.shape[1]
    cluster = total.argmin(1)
    return cluster, total[np.arange(len(cluster)), cluster]


def _sums(centroids: np.ndarray, size: int, width: int):
    """One row for each chunk and non-empty cluster: sums of components, vectors, sum of distances in two halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        for batch in batches:
            for _, codes, tables in _chunks(batch, size, width):
                cluster, distance = nearest(codes, tables, centroids)
                number = np.bincount(cluster, minlength=k)
                sums = [np.bincount(cluster * len(e) + code, minlength=k * len(e)).reshape(k, len(e)) @ e for code, e in zip(codes, tables)]
                high, low = np.zeros(k, np.int64), np.zeros(k, np.int64)
                np.add.at(high, cluster, distance >> 32)
                np.add.at(low, cluster, distance & 0xFFFFFFFF)
                used = np.flatnonzero(number)
                values = np.concatenate([*sums, number[:, None], high[:, None], low[:, None]], 1)[used]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), values.shape[1]).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), lists], ["cluster", "sums"])

    return run


def _totals(stored: DataFrame, centroids: np.ndarray, size: int, width: int) -> dict[int, tuple[int, list[int], int]]:
    """{cluster: (vectors, sums, inertia)}: one number for each cluster and component comes to the driver."""
    rows = stored.mapInArrow(_sums(centroids, size, width), "cluster int, sums array<long>").select("cluster", F.posexplode("sums"))
    added: dict[int, dict[int, int]] = {}
    for r in rows.groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total")).collect():
        added.setdefault(r["cluster"], {})[r["pos"]] = int(r["total"])
    return {i: (t[size], [t[j] for j in range(size)], (t[size + 1] << 32) + t[size + 2]) for i, t in added.items()}


def clusters(
    df: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3:", vec_id: str = "vec_id",
    vector: str = "embedding", width: int = WIDTH, chunk: int = CHUNK,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per usable vector.

    Usable are vectors of exactly ``size`` (at most 64) components, none null or
    not finite; others give no row. Component x counts as floor(scale * x), held
    within 2^27. The centroids start as the ``k`` vectors with the smallest
    SHA-256 of ``salt`` and the id (nothing for a null id), equal ids in the
    order of their components; fewer vectors give fewer centroids. In each round
    every vector goes to the nearest centroid, the first among equals, and each
    centroid that has vectors becomes floor(sum / count) of theirs. Distances are
    squared; sums beyond 63 bits are held at 2^63 - 1. Repeated rows count each.
    A table without usable vectors gives no rows.
    """
    if not 0 < size <= 64:
        raise ValueError("vectors have 1 to 64 components")
    spark = df.sparkSession
    source = columns(df, vec_id, vector).toDF("vec_id", "vector").select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>"))
    stored = written(source.mapInArrow(_store(size, scale, width, chunk), STORED), "codes")
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = source.mapInArrow(_kept(size, scale), "vec_id long, vector array<long>").orderBy(name, "vector").limit(k)
    centroids = np.array([r["vector"] for r in first.collect()], np.int64).reshape(-1, size)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        moved = centroids.copy()
        for i, (n, sums, _) in _totals(stored, centroids, size, width).items():
            moved[i] = [s // n for s in sums]
        if (moved == centroids).all():
            break  # all further rounds change nothing
        centroids = moved
    inertia = {i: t for i, (_, _, t) in _totals(stored, centroids, size, width).items()}
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, codes, tables in _chunks(batch, size, width):
                cluster, distance = nearest(codes, tables, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    def of_cluster(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)

    each = [min(inertia.get(i, 0), MOST) for i in range(len(centroids))]
    return stored.mapInArrow(assign, "vec_id long, cluster int, distance long").select(
        "vec_id", "cluster", "distance", of_cluster(each).cast("long").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), MOST)).cast("long").alias("inertia"), of_cluster(names).alias("centroid_sha256"),
    )


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"

"""Order MinHash: fingerprints that follow the edit distance of texts.

A text is the sequence of its runs of K characters, each with the number of its
earlier occurrences. Each of the fingerprint's rows puts these numbered runs in
an order of its own and takes the LENGTH smallest; the runs taken are put back
into text order, and the hash of that tuple is the row's value. Two texts agree
in a row only if they share the smallest runs and have them in the same order,
so moved passages count as changes, which plain MinHash does not see.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hashing import U, mix
from .session import columns, written

K, LENGTH, ROWS = 8, 2, 128
#: Numbered runs that all rows look at together.
CHUNK = 1 << 12
_LAST = np.uint32(2**32 - 1)


@lru_cache(maxsize=4)
def _scratch(rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's factor, and a table that a worker's texts use one after the other."""
    factors = np.random.RandomState(20190715).randint(0, 2**31, rows, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    return factors[:, None], np.empty((rows, CHUNK), np.uint32)


def runs(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k code points; of all of them if there are fewer; none of none."""
    n, base = len(codes), U(0x9E3779B97F4A7C15)
    if n == 0:
        return np.zeros(0, U)
    total = np.zeros(max(n - k, 0) + 1, U)
    for i in range(min(k, n)):
        total = total * base + codes[i : i + len(total)]
    return mix(total + U(min(k, n)))


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """How often each element's value stood before it."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    out = np.empty(len(hashes), np.int64)
    out[order] = np.arange(len(hashes)) - np.repeat(new, np.diff(np.append(new, len(hashes))))
    return out


def sketch(text: str, k: int = K, length: int = LENGTH, rows: int = ROWS) -> np.ndarray:
    """16-bit values of a text's rows. A text with fewer than ``length`` runs gives tuples of those it has."""
    hashes = runs(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U), k)
    if not len(hashes):
        return np.zeros(rows, np.uint16)
    # The upper halves: rows multiply 32-bit numbers by odd factors of their own, which puts them in as many orders.
    numbered = (mix(hashes + occurrences(hashes).astype(U) * U(0xD6E8FEB86659FD93)) >> U(32)).astype(np.uint32)
    factors, table = _scratch(rows)
    values, places, each = [], [], np.arange(rows)
    for at in range(0, len(numbered), CHUNK):
        part = numbered[None, at : at + CHUNK]
        order = np.multiply(factors, part, out=table[:, : part.shape[1]])
        for _ in range(min(length, part.shape[1])):
            least = order.argmin(1)
            values.append(order[each, least])
            places.append(least + at)
            order[each, least] = _LAST
    values, places = np.stack(values, 1), np.stack(places, 1)
    if values.shape[1] > length:
        best = np.argsort(values, 1, kind="stable")[:, :length]  # equal values: the first in the text
        places = np.take_along_axis(places, best, 1)
    total = np.full(rows, length, U)
    for i in np.sort(places, 1).T:
        total = mix(total * U(0x9FB21C651E98DF25) + hashes[i])
    return (total >> U(48)).astype(np.uint16)


def as_hex(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def likeness(a: Column, b: Column, rows: int = ROWS) -> Column:
    """Share of the rows in which two fingerprints agree."""
    same = F.filter(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.substr(a, i * 4 + 1, F.lit(4)) == F.substr(b, i * 4 + 1, F.lit(4)))
    return F.size(same) / F.lit(float(rows))


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """(key, fingerprint), one row per input row: four hexadecimal digits for each row of the fingerprint.

    Null texts are empty; empty texts have the fingerprint of zeros, a text of
    fewer than ``k`` characters is one run. Equal texts have equal fingerprints.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_hex(sketch(v or "", k, length, rows)) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [key, "fingerprint"])

    source = columns(df, key, text).toDF(key, "text").select(F.col(key), F.col("text").cast("string"))
    return source.mapInArrow(run, f"`{key}` {source.schema[0].dataType.simpleString()}, fingerprint string")


def in_order(df: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text, bucket, copy): rows in ranges of descending doc_id, each closed by the first row of the next one.

    ``copy`` marks the rows that were added to close a bucket; the first row of
    all closes the last one. Null ids come last, equal ids go by the hash of
    their text, then by the text. Partitions hold whole buckets, sorted. What is
    looked at together is one row for each bucket.
    """
    cuts = df.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.5 / parts) if parts > 1 else []
    cuts = [-math.inf, *sorted(set(cuts)), math.inf]
    named = df.withColumn("place", F.col("doc_id").cast("double")).withColumn("order", F.xxhash64("text"))
    if len(cuts) > 2:
        named = Bucketizer(splits=cuts, inputCol="place", outputCol="range", handleInvalid="keep").transform(named)
    else:
        named = named.withColumn("range", F.lit(0.0))
    # Rows without an id lie behind all others, dealt by the leading bits of their hashes, which order them.
    behind = F.lit(len(cuts)) + F.shiftright("order", 58) + 32
    bucket = F.when(F.col("doc_id").isNull(), behind).otherwise(F.lit(len(cuts)) - 1 - F.col("range").cast("long"))
    named = named.select("doc_id", "text", "order", bucket.cast("long").alias("bucket"))
    tops = named.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    ties = named.join(F.broadcast(tops), "bucket").filter(F.col("doc_id").eqNullSafe(F.col("top")))
    heads = written(
        ties.groupBy("bucket").agg(F.min(F.struct("order", "text")).alias("first"), F.first("top").alias("doc_id")), "heads"
    )
    before = Window.orderBy("bucket")  # one row for each bucket
    closing = heads.select(
        "doc_id", "first.text", "first.order", F.coalesce(F.lag("bucket").over(before), F.max("bucket").over(Window.partitionBy())).alias("bucket")
    )
    rows = named.withColumn("copy", F.lit(0)).unionByName(closing.withColumn("copy", F.lit(1)))
    return (
        rows.repartition("bucket")
        .sortWithinPartitions("bucket", "copy", F.col("doc_id").desc_nulls_last(), "order", "text")
        .select("doc_id", "text", "bucket", "copy")
    )


EDITS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def edit_likeness(df: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Fingerprints of each text and of the text with its last half taken from the next one, and how alike they are.

    One row per input row: doc_id, n_chars (code points), edited_sha256 (of the
    edited text's UTF-8), fingerprint, edited_fingerprint, near_edited (likeness
    of those two) and near_next (likeness to the next text's fingerprint). The
    next text is that of the next smaller id, after the smallest that of the
    largest; ``in_order`` settles ties. Of the edited text, the last half of the
    characters (rounded down) are the first so many of the next text, or all of
    them if it has fewer.

    A single row is its own next. Null texts are empty; two empty texts are fully
    alike. An empty table gives no rows. Giant texts are worked on in chunks; a
    task holds two texts at a time.
    """
    parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = columns(df, key, text).toDF("doc_id", "text")
    source = source.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (doc_id, text, values, copy)
        for batch in batches:
            out = []
            for doc_id, value, copy in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                now = doc_id, value, sketch(value, k, length, rows), copy
                if last is not None and not last[3]:
                    n = len(last[1])
                    edited = last[1][: n - n // 2] + value[: n // 2]
                    values = sketch(edited, k, length, rows)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    near = [float((last[2] == other).mean()) for other in (values, now[2])]
                    out.append((last[0], n, sha, as_hex(last[2]), as_hex(values), *near))
                last = now
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r)) for r in out], SCHEMA)

    return in_order(source, parts).mapInArrow(run, EDITS)


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)

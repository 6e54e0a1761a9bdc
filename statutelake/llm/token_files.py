"""Token ids in binary files: ORC with run-length coded ids, row indexes and Bloom filters.

``encode`` turns texts into ids, ``write_ids`` writes them in ascending document
order, ``read_ids`` reads them back and ``find_ids`` reads a few documents: the
stripe and row-group statistics and the Bloom filters on ``doc_id`` let the
reader leave out the others. Each file, and each stripe in it, is read on its own.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .session import columns
from .wordcache import WordCache, split_batch

#: The id behind each document.
END_ID = 1
#: The words that the tokenizer makes of a normalised text (fixed values of word_bpe_49k.json).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

ORC = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.compress": "LZ4",
}
#: A full stop or comma behind a letter or digit and before white space is a word of its own.
_STOP = re.compile(r"(?<=[^\W_])([.,])(?=[ \n])")
#: Behind another mark it belongs to that mark's word.
_MARKS = re.compile(r"(?:[^\w\s]|_)[.,][ \n]")
_cache: dict[tuple, WordCache] = {}


def _fast(tokenizer):
    """The tokenizer for words that are normalised and split already."""
    from tokenizers import pre_tokenizers

    tokenizer.normalizer = None
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


def prepared(text: str) -> str:
    """The text as the tokenizer normalises it, with stops split off: fewer different words are left.

    Texts that may hold a special token, or the letter that Python lower-cases
    by its place, stay as they are.
    """
    if "<|" in text or "Σ" in text:
        return text
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    text = text.lower()
    if _MARKS.search(text):
        return _STOP.sub(r" \1", text)
    return text.replace("\n", " ").replace(". ", " . ").replace(", ", " , ")


def word_encoder(path: str, limit: int = 800_000) -> WordCache:
    """Memo from a word between spaces to its ids, kept by the Python worker.

    The library encodes each distinct word of a normalised text once, a thousand
    in a call. Words that hold the string of a special token go to the unchanged
    tokenizer.
    """
    key = ("ids", path)
    if key in _cache:
        return _cache[key]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole, fast = Tokenizer.from_file(path), _fast(Tokenizer.from_file(path))
    specials = [t.content for t in whole.get_added_tokens_decoder().values()]
    mark = os.path.commonprefix(specials)[:1]
    size = max(whole.get_vocab().values()) + 1
    last = [False] * size
    for piece, i in whole.get_vocab().items():
        last[i] = piece.endswith("</w>")
    split = regex.compile(WORDS).findall
    known: dict[str, list[int]] = {}

    def normal(word: str) -> str:
        if "Σ" in word:  # Python lower-cases it by its place in the word
            return whole.normalizer.normalize_str(word)
        return (word if word.isascii() else unicodedata.normalize("NFC", word)).lower()

    def cores_of(word: str) -> list[str]:
        word = normal(word)
        if word.isalpha():
            return [word]
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [word[:-1], word[-1]]
        return split(word)

    def encode_all(cores: list[str]) -> list[list[int]]:
        rows: list[list[int]] = []
        for at in range(0, len(cores), 1000):
            part = cores[at : at + 1000]
            ids = fast.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            ends = [i for i, x in enumerate(ids, 1) if last[x]]
            if len(ends) != len(part):  # a vocabulary without word ends
                rows += [e.ids for e in fast.encode_batch_fast(part, add_special_tokens=False)]
            else:
                rows += [ids[i:j] for i, j in zip([0, *ends], ends)]
        return rows

    def mixed(words: list[str]) -> list[list[int]]:
        if len(known) > limit // 2:
            known.clear()
        cores = [None if mark in w and any(s in w for s in specials) else cores_of(w) for w in words]
        new = [c for c in dict.fromkeys(c for row in cores if row for c in row) if c not in known]
        known.update(zip(new, encode_all(new)))
        return [
            whole.encode(w, add_special_tokens=False).ids if row is None else [i for c in row for i in known[c]]
            for w, row in zip(words, cores)
        ]

    def work(words: list[str]) -> list:
        plain = [w.isalpha() and normal(w) == w for w in words]
        simple = iter(encode_all([w for w, p in zip(words, plain) if p]))
        others = iter(mixed([w for w, p in zip(words, plain) if not p]))
        return [next(simple if p else others) for p in plain]

    _cache[key] = WordCache(work, limit)
    return _cache[key]


def _encoder(tokenizer: str, end_id: int | None):
    tail = [] if end_id is None else [int(end_id)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_encoder(tokenizer)
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for words, counts, places in split_batch(batch.column(1).to_pylist(), prepared):
                rows = memo.rows(words)
                ids = memo.gather_rows(rows)
                ends = np.cumsum(memo.lengths[rows])[np.cumsum(counts) - 1]
                for place, part in zip(places, np.split(ids, ends[:-1])):
                    parts[place].append(part)
            for row in parts:
                row.append(np.array(tail, np.int32))
            offsets = np.cumsum([0, *(sum(map(len, row)) for row in parts)]).astype(np.int32)
            ids = np.concatenate([x for row in parts for x in row]) if parts else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))], ["doc_id", "ids"]
            )

    return run


def encode(df: DataFrame, tokenizer: str, text: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """(doc_id long, ids array<int>): the ids of each whole text.

    Null and empty texts give the end id only; ``end_id=None`` appends none.
    Other columns are dropped; repeated rows stay repeated.
    """
    slim = columns(df, "doc_id", text).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(_encoder(tokenizer, end_id), "doc_id long, ids array<int>")


def write_ids(texts: DataFrame, path: str, tokenizer: str, files: int | None = None, **options) -> None:
    """Encode ``texts`` and write ``path`` as ORC files in ascending ``doc_id`` order.

    The texts, not the ids, are dealt out by ranges of ``doc_id`` (they are
    smaller), encoded in place, and each range becomes a file. The ranges are
    quantiles of the ids alone, so the texts are read once. Null ids have a file
    of their own and come first. Ids are an integer list, which ORC writes
    run-length coded.
    """
    slim = columns(texts, "doc_id", "text").toDF("doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = files or int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = slim.select("doc_id").approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    edges = [-math.inf, *sorted(set(cuts)), math.inf]
    ranged = slim.withColumn("place", F.col("doc_id").cast("double"))
    if len(edges) > 2:
        ranged = Bucketizer(splits=edges, inputCol="place", outputCol="range", handleInvalid="keep").transform(ranged)
    else:
        ranged = ranged.withColumn("range", F.lit(0.0))
    number = F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("range").cast("int") + 1)
    ranged = ranged.select("doc_id", "text", number.cast("int").alias("number"))
    dealt = ranged.repartitionById(len(edges), "number").sortWithinPartitions("doc_id").select("doc_id", "text")
    encode(dealt, tokenizer, **options).write.options(**ORC).orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of all files, read stripe by stripe."""
    return spark.read.schema("doc_id long, ids array<int>").orc(path)


def find_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; the predicate reaches the stripe statistics and Bloom filters."""
    return read_ids(spark, path).filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            ["file", "doc_id", "n_tokens", "ids_crc32"],
        )


def digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files.

    ``start`` is the number of ids before the document: a running sum inside
    each file plus the totals of the files before it, so no task sees more than
    one file and only one row per file is put in order. Rows with equal
    ``doc_id`` count in the order of their ids' checksum.
    """
    rows = (
        read_ids(spark, path)
        .select(F.input_file_name().alias("file"), "doc_id", "ids")
        .mapInArrow(_measure, "file string, doc_id long, n_tokens long, ids_crc32 long")
    )
    rows = _written(rows)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    # One row per file: a list of files, not of documents.
    before = Window.orderBy(F.col("lo").asc_nulls_first(), F.col("hi").asc_nulls_first(), "file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    files = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "ids_crc32", "n_tokens").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return rows.join(files, "file").select(
        "doc_id",
        (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def _written(df: DataFrame) -> DataFrame:
    from .session import written

    return written(df, "measured")

"""Benchmark decontamination: pieces found exactly, then Myers' bit-parallel distance.

A test item that occurs in a text with at most k edits keeps at least one of its
k + 1 pieces whole (pigeonhole). All pieces of all items are searched in one
pass with an automaton; around each hit the item is compared with the text by
Myers' algorithm, which handles a column of the edit matrix in a few operations
on one long integer.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import columns, written

#: Edits per hundred characters of an item, and the shortest item that may have edits; shorter ones are looked for as they are, between word borders.
ERROR_PERCENT, LEAST_CHARS = 5, 20
#: Characters of items in one automaton. More items take more slices, each with a pass of its own.
SLICE_CHARS = 4_000_000
#: Characters of a text that are normalised and searched at a time.
PIECE = 1 << 20


def normal(text: str) -> str:
    """Lower case, with runs of white space as one space."""
    return " ".join(text.lower().split())


def budget(length: int, percent: int = ERROR_PERCENT) -> int:
    return length * percent // 100


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``errors + 1`` pieces that differ in length by one at most."""
    n = errors + 1
    edges = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:]) if a < b]


class Myers:
    """Smallest edit distance between a pattern and any part of a text."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.masks: dict[str, int] = defaultdict(int)
        for i, char in enumerate(pattern):
            self.masks[char] |= 1 << i
        self.masks = dict(self.masks)

    def best(self, text: str, most: int) -> tuple[int, int] | None:
        """(distance, end) of the best part of ``text`` with at most ``most`` edits; the first of equals."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, distance, found = full, 0, self.size, None
        masks = self.masks
        for end, char in enumerate(text, 1):
            eq = masks.get(char, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            ph, mh = minus | (~(xh | plus) & full), plus & xh
            if ph & top:
                distance += 1
            elif mh & top:
                distance -= 1
            ph, mh = (ph << 1) & full, (mh << 1) & full
            plus, minus = mh | (~(xv | ph) & full), ph & xv
            if distance <= most and (found is None or distance < found[0]):
                found = distance, end
        return found


def joined(a: str, b: str) -> bool:
    """Whether there is no word border between two characters; ideographs and kana are words of their own."""
    return all(c.isalnum() and not ("\u2e80" <= c <= "\u9fff" or c >= "\U00020000") for c in (a, b))


class Searcher:
    """All items of a slice: finds the items that occur in a text within their budgets."""

    def __init__(self, items: list[tuple[int, str]], percent: int, least: int = LEAST_CHARS):
        import ahocorasick

        self.least = least
        self.texts = [(item, text, budget(len(text), percent) if len(text) >= least else 0) for item, text in items]
        self.myers: dict[int, Myers] = {}
        self.margin = max((len(t) + e for _, t, e in self.texts), default=0) + 1
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, text, errors) in enumerate(self.texts):
            for offset, piece in cut(text, errors):
                places[piece].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def search(self, text: str, first: bool = True, last: bool = True) -> dict[int, tuple[int, int, int]]:
        """item number: (distance, start window, end) of the best occurrence in a normalised text.

        ``first`` and ``last`` tell whether the text begins and ends here; what lies beyond is no border.
        """
        best: dict[int, tuple[int, int, int]] = {}
        if not len(self.automaton):
            return best
        for end, (size, found) in self.automaton.iter(text):
            for i, offset in found:
                if i in best and best[i][0] == 0:
                    continue
                _, item, errors = self.texts[i]
                if size < self.least and len(item) == size:
                    start, after = end + 1 - size, end + 1
                    before = not joined(text[start - 1], item[0]) if start else first
                    behind = not joined(item[-1], text[after]) if after < len(text) else last
                    if before and behind:
                        best[i] = (0, start, after)
                    continue
                low = max(0, end + 1 - size - offset - errors)
                high = low + len(item) + 2 * errors
                if text.startswith(item, end + 1 - size - offset) and end + 1 - size - offset >= 0:
                    best[i] = (0, end + 1 - size - offset, end + 1 - size - offset + len(item))
                    continue
                if i not in self.myers:
                    self.myers[i] = Myers(item)
                hit = self.myers[i].best(text[low:high], errors if i not in best else best[i][0] - 1)
                if hit:
                    best[i] = (hit[0], low, low + hit[1])
        return best


def _parts(text: str, margin: int) -> Iterator[tuple[int, str]]:
    """(offset, part) of a giant text; neighbouring parts share ``margin`` characters."""
    for at in range(0, max(1, len(text) - margin), PIECE):
        yield at, text[at : at + PIECE + margin]


#: The automaton that a worker built last, with the name of its slice.
_built: list[tuple[str, Searcher]] = []


def _searcher(name: str, items: Broadcast, percent: int, least: int) -> Searcher:
    if not _built or _built[0][0] != name:
        _built[:] = [(name, Searcher(items.value, percent, least))]
    return _built[0][1]


def _finder(name: str, items: Broadcast, percent: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(name, items, percent, least)
        for batch in batches:
            rows = []
            for doc, value in zip(*(c.to_pylist() for c in batch.columns)):
                if not value:
                    continue
                text, best = normal(value), {}
                for at, part in _parts(text, searcher.margin):
                    for i, (distance, start, end) in searcher.search(part, at == 0, at + len(part) == len(text)).items():
                        if i not in best or distance < best[i][0]:
                            best[i] = (distance, at + start, at + end)
                rows += [(doc, searcher.texts[i][0], *hit) for i, hit in best.items()]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
                ["doc_id", "item_id", "distance", "start", "end"],
            )

    return run


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [normal(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["item_id", "text", "size"])


def slices(benchmark: DataFrame, most: int = SLICE_CHARS) -> tuple[DataFrame, int]:
    """The normalised test items (item_id, text, slice) as a written table, and the number of slices.

    Items are dealt by their hashes to as many slices as hold about ``most``
    characters each. Null and empty items and those without an id are left out.
    """
    items = columns(benchmark, "item_id", "text").toDF("item_id", "text").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = items.mapInArrow(_normalised, "item_id long, text string, size long").filter("item_id is not null and size > 0")
    items = written(items.distinct(), "items")
    total = items.agg(F.sum("size")).first()[0] or 0
    count = -(-total // most)
    return items.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(count, 1))).alias("slice")), count


def leaks(documents: DataFrame, benchmark: DataFrame, percent: int = ERROR_PERCENT, least: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, start, end): the items that each whole text holds.

    An item counts as held if some part of the text, both in lower case and with
    single spaces, is within ``percent`` edits per hundred of its characters; an
    item of fewer than ``least`` characters only if it stands in the text as it
    is, between word borders. One row per document and item: the smallest
    distance found, ``end`` is where the part ends in the normalised text,
    ``start`` where the compared window begins. Null and empty texts hold
    nothing; rows with a null id are reported with a null id; repeated rows are
    reported each. Other columns are dropped.

    The documents are read once for each slice of the items; a slice is broadcast
    (its size is bounded), and a task builds one automaton for its slice.
    """
    context = documents.sparkSession.sparkContext
    items, count = slices(benchmark)
    docs = columns(documents, "doc_id", "text").toDF("doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, distance int, start long, `end` long"
    out = documents.sparkSession.createDataFrame([], schema)
    for i in range(count):
        rows = [(r["item_id"], r["text"]) for r in items.filter(F.col("slice") == i).select("item_id", "text").orderBy("item_id", "text").toLocalIterator()]
        part = docs.mapInArrow(_finder(uuid.uuid4().hex, context.broadcast(rows), percent, least), schema)
        out = part if i == 0 else out.unionByName(part)
    return out


def clean(documents: DataFrame, benchmark: DataFrame, percent: int = ERROR_PERCENT, least: int = LEAST_CHARS) -> DataFrame:
    """The rows of ``documents`` whose text holds no test item, with all their columns; null texts stay.

    The rows are numbered and written once; the numbers that any slice of the
    benchmark hits are left out.
    """
    inner = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    rows = written(inner.withColumn("row", F.monotonically_increasing_id()), "numbered")
    texts = rows.select(F.col("row").alias("doc_id"), F.col(f"c{documents.columns.index('text')}").alias("text"))
    hit = leaks(texts, benchmark, percent, least).select(F.col("doc_id").alias("row")).distinct()
    return rows.join(hit, "row", "left_anti").drop("row").toDF(*documents.columns)

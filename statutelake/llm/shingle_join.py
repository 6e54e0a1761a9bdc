"""Exact Jaccard join of shingle sets with index lists over blocks of positions.

A set is put in one order (that of its shingles' hashes), and the range of the
order is cut into blocks. Two sets of the sizes r and s that link differ in at
most (r + s) / 19 shingles at a similarity of 0.9, so with one block more than
that at least one block is the same in both. The index has one entry for each
block of a set, its key made of the block's position and content: sets whose
blocks all differ are skipped unseen, and a passage that many documents share
fills no list, because a block's key needs all shingles of the block.

How many blocks there are depends on the sizes, so sizes form classes with a
ratio of the threshold; a set enters the lists of its own class and, to meet
larger sets, of the next one.

Equal sets are one set with many documents. The lists are then joined through
leaders (``leader_join``): sets that link to their leader are in its class, and
what they link to follows from the class. What is left are sets of different
classes in one list. Every set has a sketch of small counters, which bounds how
near two sets can be. What the sketches of a list allow leaves a task as groups,
with one row for each set but the first, and never as pairs. Groups that share a
set are one group; its whole sets meet block against block inside tasks, and what
leaves those are the links that join two classes.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import U, mix, shingles, word_hashes
from .leader_join import link_classes, mixed_lists
from .session import written

#: Sets whose blocks a task has sent already (more copies of them send none), and rows of groups that it has sent.
SEEN = 200_000
#: Fewest and most ranges of a sketch, items of one block of a list or group, and shingles of one block of a group.
SKETCH, MOST_RANGES, BLOCK_ITEMS, BLOCK_SHINGLES = 64, 1 << 14, 256, 1 << 18
#: Distinct shingles of two blocks that are compared at a time.
COLUMNS = 1 << 12


def shingle_set(text: str | None, width: int = 3) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingles(word_hashes((text or "").encode("utf-8", "surrogatepass")), width))


def set_id(items: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    total = mix(np.array([items.sum(dtype=U) + U(len(items))], U))[0] ^ mix(np.bitwise_xor.reduce(mix(items + U(0x51ED27)), keepdims=True))[0]
    return int(np.array([total], U).view(np.int64)[0])


def _ranges(items: np.ndarray, each: int) -> np.ndarray:
    """How many shingles of a set fall into each range of a hash; the ranges are a power of two that leaves less than ``each`` to one, as far as MOST_RANGES allows."""
    ranges = min(MOST_RANGES, max(SKETCH, 1 << (len(items) // each).bit_length()))
    place = mix(items + U(0x7F4A7C15)) >> U(65 - int(ranges).bit_length())
    return np.bincount(place.astype(np.int64), minlength=ranges)


def sketch(items: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by ranges of a hash, about six to each, as half bytes.

    The counts of two sets differ by no more in total than the sets do, so a pair
    whose sketches differ by too much cannot link. That holds for counts that stop
    at 15, and for sums of neighbours, which make a sketch as short as another.
    """
    counts = np.minimum(_ranges(items, 8), 15).astype(np.uint8)
    return counts[0::2] | counts[1::2] << 4


def fine_sketch(items: np.ndarray) -> np.ndarray:
    """Like ``sketch``, with two to four shingles to a range, as whole bytes."""
    return np.minimum(_ranges(items, 4), 255).astype(np.uint8)


def opened(packed: bytes | memoryview) -> np.ndarray:
    """Counts of a sketch of half bytes."""
    halves = np.frombuffer(packed, np.uint8)
    return np.stack([halves & 15, halves >> 4], 1).reshape(-1).astype(np.int32)


def folded(counts: np.ndarray, ranges: int) -> np.ndarray:
    return counts.reshape(ranges, -1).sum(1)


def difference_limit(total: int, percent: int) -> int:
    """Largest number of shingles in which two sets of ``total`` shingles together can differ and still link."""
    # 100 * i >= p * u, with i + u = total and u - i = d.
    return (100 - percent) * total // (100 + percent)


def size_class(size: int, percent: int) -> tuple[int, int]:
    """(smallest, largest) size of the class of ``size``."""
    low = 1
    while True:
        high = max(low, 100 * low // percent)
        if size <= high:
            return low, high
        low = high + 1


class Blocks:
    """Index entries of sets: (key, kind) with kind 0 for the own class and 1 for the next."""

    def __init__(self, percent: int):
        self.percent = percent
        self.classes: dict[int, tuple[tuple[int, int], tuple[int, int]]] = {}

    def _classes(self, size: int):
        if size not in self.classes:
            own = size_class(size, self.percent)
            self.classes[size] = own, size_class(own[1] + 1, self.percent)
        return self.classes[size]

    def entries(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, kinds = [], []
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(items + U(0x2545F491)), dtype=U)])
        for kind, (low, high) in enumerate(self._classes(len(items))):
            limit = difference_limit(2 * high, self.percent)
            if kind == 1 and 100 * len(items) < self.percent * low:
                continue  # no set of the next class is small enough
            if limit == 0:
                continue  # only equal sets link, and those are one set
            count = limit + 2
            edges = np.searchsorted(items >> U(32), (np.arange(1, count, dtype=U) << U(32)) // U(count))
            edges = np.concatenate([[0], edges, [len(items)]])
            place = mix(np.arange(count, dtype=U) + U(low) * U(0x9E3779B1))
            key = mix((total[edges[1:]] - total[edges[:-1]]) ^ place).view(np.int64)
            full = edges[1:] > edges[:-1]
            if count - full.sum() < 2:
                key = key[full]  # of two equal blocks at least one has shingles
            keys.append(key)
            kinds.append(np.full(len(key), kind, np.int8))
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int8)
        return np.concatenate(keys), np.concatenate(kinds)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(v.as_py(), width) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                    pa.array([fine_sketch(s).tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "item", "sketch", "fine"],
            )

    return run


def _entries(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, seen = Blocks(percent), OrderedDict()
        for batch in batches:
            keys, kinds, items, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int8)], [np.zeros(0, np.int64)], []
            for value in batch.column(0):
                found = shingle_set(value.as_py(), width)
                if not len(found) or (name := set_id(found)) in seen:
                    continue
                seen[name] = None
                if len(seen) > SEEN:
                    seen.popitem(last=False)
                key, kind = blocks.entries(found)
                keys.append(key)
                kinds.append(kind)
                items.append(np.full(len(key), name, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(items)), pa.array(np.concatenate(kinds))], ["key", "item", "kind"]
            )

    return run


def _set_bytes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()  # a document's rows come together; one of them is enough
        for batch in batches:
            items, sets = [], []
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if item not in done and set_id(found := shingle_set(value.as_py(), width)) == item:
                    done.add(item)
                    items.append(item)
                    sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(sets, pa.binary())], ["item", "shingles"])

    return run


def _differences(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance, linked, span = [], [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                union = len(both) - common
                distance.append(float(union - common))
                linked.append(100 * common >= percent * union)
                span.append(float(difference_limit(len(both), percent)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(distance, pa.float64()), pa.array(linked, pa.bool_()), pa.array(span, pa.float64())],
                ["a", "b", "distance", "linked", "span"],
            )

    return run


def _allowed(percent: int, counts):
    """Pairs (a, b) of (a, b, size, size, sketch, sketch) that may link; the longer sketch is folded to the other's ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for m, n, u, v in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                x, y = counts(u.as_buffer()), counts(v.as_buffer())
                ranges = min(len(x), len(y))
                gap = np.abs(folded(x, ranges) - folded(y, ranges)).sum()
                keep.append(bool((100 + percent) * gap <= (100 - percent) * (m + n)))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return run


def _near_enough(percent: int):
    return _allowed(percent, opened)


def _nearer(percent: int):
    return _allowed(percent, lambda data: np.frombuffer(data, np.uint8).astype(np.int32))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """The columns of the rows of one (first, second, third column) after the other; a run's rows come together."""
    held, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        heads = [batch.column(i).to_numpy() for i in range(3)]
        new = np.flatnonzero((heads[0][1:] != heads[0][:-1]) | (heads[1][1:] != heads[1][:-1]) | (heads[2][1:] != heads[2][:-1])) + 1
        rest = [batch.column(i).to_pylist() for i in range(3, batch.num_columns)]
        for start, end in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
            name = tuple(int(h[start]) for h in heads)
            part = [column[start:end] for column in rest]
            if name == at:
                for column, more in zip(held, part):
                    column.extend(more)
                continue
            if at is not None:
                yield [at, *held]
            held, at = part, name
    if at is not None:
        yield [at, *held]


def _sides(at: tuple, side: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of what is compared with each other: the two sides, or inside one block (p = q) all with all."""
    if at[1] == at[2]:
        return np.arange(len(side)), np.arange(len(side))
    side = np.array(side)
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def _list_groups(percent: int):
    """(a, b): an item and the smallest one of its group, from the lists' blocks, which come one after the other.

    A row is (key, p, q, side, item, kind, class, size, sketch). Items of
    different classes whose sketches allow a link are in one group, and what such
    pairs connect is too: a list gives one row less than it has items at most.
    """

    def join(at, side, item, kind, group, size, packed) -> Iterator[tuple[int, int]]:
        if len(item) == 2 and (group[0] == group[1] or kind[0] + kind[1] > 1 or 100 * min(size) < percent * max(size)):
            return  # most lists are as short as this
        left, right = _sides(at, side)
        kind, group, size = np.array(kind), np.array(group, np.int64), np.array(size, np.int64)
        counts = [opened(v) for v in packed]
        ranges = min(map(len, counts))
        counts = np.stack([folded(v, ranges) for v in counts])
        name = np.arange(len(item))
        for i in left:
            # What is in the group of i already needs no answer.
            j = right[(name[right] != name[i]) & (group[right] != group[i]) & (kind[right] + kind[i] < 2)]
            j = j[100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i])]
            if at[1] == at[2]:
                j = j[j > i]
            for some in np.array_split(j, -(-len(j) * ranges // (1 << 20)) or 1):
                gap = np.abs(counts[some] - counts[i]).sum(1)
                near = some[(100 + percent) * gap <= (100 - percent) * (size[some] + size[i])]
                if len(near):
                    name[np.isin(name, name[near])] = name[i]
        order = np.argsort(name, kind="stable")
        edges = np.flatnonzero(np.diff(name[order])) + 1
        for members in np.split(order, edges):
            if len(members) > 1:
                items = sorted(item[k] for k in members)
                yield from ((items[0], other) for other in items[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, fresh = OrderedDict(), []

        def rows() -> pa.RecordBatch:
            a, b = zip(*fresh) if fresh else ((), ())
            fresh.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for block in _runs(batches):
            for pair in join(*block):
                if pair not in sent:
                    sent[pair] = None
                    fresh.append(pair)
                    if len(sent) > SEEN:
                        sent.popitem(last=False)
            if len(fresh) > 10_000:
                yield rows()
        yield rows()

    return run


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of one side has in common with each of the other."""
    sizes = [len(s) for s in (*left, *right)]
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    flat = np.concatenate([*left, *right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.append(True, flat[1:] != flat[:-1])
    # Shingles of one set only are no one's common ones.
    kept = ~(new & np.append(new[1:], True))
    column, owner = np.cumsum(new[kept]) - 1, owner[kept]
    out = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        table = np.zeros((len(sizes), COLUMNS), np.float32)
        table[owner[a:b], column[a:b] - start] = 1
        out += (table[: len(left)] @ table[len(left) :].T).astype(np.int64)
    return out


def _group_links(percent: int):
    """Links (a, b) that join different classes, from the groups' blocks, which come one after the other.

    A row is (group, p, q, side, item, class, shingles). All pairs of a block are
    compared on their whole sets; of the links only those are rows that join
    classes which earlier ones of the same block have not joined.
    """

    def links(at, side, item, group, packed) -> Iterator[tuple[int, int]]:
        left, right = _sides(at, side)
        sets = [np.frombuffer(v, U) for v in packed]
        size = np.array([len(s) for s in sets], np.int64)
        if not len(left) or not len(right):
            return
        common = _shared([sets[i] for i in left], [sets[j] for j in right])
        union = size[left][:, None] + size[right][None] - common
        linked = 100 * common >= percent * union
        name = np.unique(np.array(group, np.int64), return_inverse=True)[1]
        for row, i in enumerate(left):
            for j in right[linked[row]]:
                if name[i] != name[j]:
                    name[name == name[j]] = name[i]
                    yield min(item[i], item[j]), max(item[i], item[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches):
            if pairs := list(links(*block)):
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _dealt(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """The rows with (p, q, side): once for each pair of blocks that a row's block is in.

    Items of a key are unique, so blocks by hash are even; ``blocks`` has (key, blocks).
    """
    dealt = rows.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("item"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    block, other = F.col("block"), F.col("other")
    return dealt.select(*rows.columns, F.least(block, other).alias("p"), F.greatest(block, other).alias("q"), (block > other).cast("int").alias("side"))


def _across_lists(slim: DataFrame, whole, percent: int, name: str):
    """Links between items of different classes that share a list; ``whole`` takes items and returns their sets.

    Lists and groups are dealt into blocks, and blocks are compared in pairs inside tasks.
    """

    def run(near: DataFrame, first: DataFrame, stars: DataFrame) -> DataFrame:
        rows = mixed_lists(near, first, name)
        sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ITEMS).cast("int").alias("blocks"))
        full = _dealt(rows, "key", sizes).join(slim, "item")
        full = full.select("key", "p", "q", "side", "item", F.col("kind").cast("int").alias("kind"), "class", "size", "sketch")
        full = full.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
        found = written(full.mapInArrow(_list_groups(percent), "a long, b long").distinct(), f"{name}-allowed")
        groups = components(found).select(F.col("node").alias("item"), F.col("component").alias("group"))
        groups = groups.join(slim.select("item", "size"), "item").join(first.withColumnRenamed("node", "item"), "item", "left")
        groups = written(groups.select("group", "item", "size", F.coalesce("component", "item").alias("class")), f"{name}-groups")
        most = F.greatest(F.count("*") / BLOCK_ITEMS, F.sum("size") / BLOCK_SHINGLES)
        sizes = groups.groupBy("group").agg(F.ceil(most).cast("int").alias("blocks"))
        sets = _dealt(groups, "group", sizes).join(whole(groups.select("item")), "item")
        sets = sets.select("group", "p", "q", "side", "item", "class", "shingles").repartition("group", "p", "q").sortWithinPartitions("group", "p", "q")
        return sets.mapInArrow(_group_links(percent), "a long, b long")

    return run


def jaccard_join(df: DataFrame, percent: int = 90, width: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    Words are lower-cased (A-Z) runs of bytes other than ASCII white space; the
    set of a text holds its distinct runs of ``width`` words, or its whole
    sequence if it has fewer. Two documents link if their sets' intersection is
    at least ``percent`` hundredths of the union. ``component_id`` is the
    smallest id that links reach, the own id without links. Texts without words
    link with nothing and have 0 shingles. Rows with a null id stay, count as
    no one's partner and have a null component. Repeated rows are copies of one
    document. An empty table gives no rows.
    """
    source = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    docs = written(source.mapInArrow(_sets(width), "doc_id long, n_shingles long, item long, sketch binary, fine binary"), "sets")
    named = source.filter("doc_id is not null")
    lists = named.select("text").mapInArrow(_entries(width, percent), "key long, item long, kind byte")

    # One document stands for each set.
    usable = docs.filter("item is not null and doc_id is not null")
    copies = written(usable.groupBy("item").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"), F.first("fine").alias("fine")), "copies")
    slim = copies.select("item", "size", "sketch")

    def whole(wanted: DataFrame) -> DataFrame:
        """(item, shingles) of the wanted items."""
        chosen = written(copies.select("item", "doc_id").join(wanted, "item"), "wanted")
        texts = named.join(chosen.hint("shuffle_hash"), "doc_id").select("item", "text")
        return written(texts.mapInArrow(_set_bytes(width), "item long, shingles binary"), "shingles")

    def measure(pairs: DataFrame) -> DataFrame:
        """Pairs that may link, compared on their whole sets; sketches rule out most others before any set is sent."""
        for name, test in (("sketch", _near_enough), ("fine", _nearer)):
            x = copies.select(F.col("item").alias("a"), F.col("size").alias("m"), F.col(name).alias("x"))
            y = copies.select(F.col("item").alias("b"), F.col("size").alias("n"), F.col(name).alias("y"))
            both = pairs.join(x, "a").join(y, "b").select("a", "b", "m", "n", "x", "y")
            pairs = written(both.mapInArrow(test(percent), "a long, b long"), f"{name}-pairs")
        sets = whole(pairs.select(F.col("a").alias("item")).unionByName(pairs.select(F.col("b").alias("item"))).distinct())
        x = sets.select(F.col("item").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("item").alias("b"), F.col("shingles").alias("y"))
        return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(
            _differences(percent), "a long, b long, distance double, linked boolean, span double"
        )

    classes = link_classes(lists, measure, _across_lists(slim, whole, percent, "jaccard"), "jaccard")
    classes = written(classes.select(F.col("node").alias("item"), F.col("component").alias("class")), "classes")
    copies = copies.select("item", "doc_id")
    members = copies.join(classes, "item")
    smallest = members.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    known = copies.join(classes, "item", "left").join(smallest, "class", "left").select(
        "item", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    out = docs.join(known, "item", "left")
    return out.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )

"""SentencePiece encoding and decoding with a max-plus scan over chunks of giant texts.

The model's pieces and scores are used as a unigram model: the best
segmentation of a text is the path of pieces with the largest sum of scores. No
piece holds a space behind another character, so a path is cut before every run
of spaces; words between cuts are worked out once each.

A giant text is split into chunks of fixed length, wherever they end. A piece
may reach over a chunk's end by 0 to L - 1 characters (L: the longest piece);
that overhang is the state at the boundary. A chunk gives a matrix of the best
sums from each entry state to each exit state. Where a chunk has cuts, every path
takes the same pieces between the first and the last one, so their sum would raise
all entries alike and change no choice: it is left out. Products of these matrices in
the (max, +) algebra are associative: they are combined block by block, and a
scan over the blocks gives the best sums at every boundary. With them each chunk
finds, on its own, from which entry each exit comes; these tables are composed
from the end in the same two levels, and each chunk then traces its own pieces.

Scores are whole numbers (scaled and rounded), so sums do not depend on how the
text is split, and neither do the pieces: of equal sums the longest last piece
wins at every position.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import long_or_null, written
from .wordcache import WordCache

#: Characters of a chunk, and chunks of a block. A text has at most 2^31 characters, so at most 256 blocks.
CHUNK, BLOCK = 1 << 15, 256
SPACE = "▁"
#: Characters of short texts that are encoded at a time, and of a word that is worked out together with others.
SLICE, WORD = 1 << 20, 64
#: Worse than any sum of scores; two of them still fit a 64-bit integer.
NEVER = -(1 << 61)
SCALE = 1 << 10

_cache: dict[str, "Model"] = {}


class Model:
    """Pieces and whole-number scores of a model file, with a memo of words."""

    def __init__(self, path: str, limit: int = 200_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        scores = [model.get_score(i) for i in range(size)]
        scale = 1 if all(s == int(s) for s in scores) else SCALE
        self.text: list[str] = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {int(self.text[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = model.unk_id()
        self.trie: dict = {}
        self.longest, low = 1, 0
        for i in range(size):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            piece, value = self.text[i], int(round(scores[i] * scale))
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} holds a space inside: texts cannot be cut at spaces")
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = (value, i)
            self.longest, low = max(self.longest, len(piece)), min(low, value)
        #: An unknown character costs more than any piece.
        self.penalty = low - 10 * scale
        self._number_trie()
        self.words = WordCache(self._words, limit)

    def _number_trie(self) -> None:
        """The trie as arrays: nodes and characters get numbers, steps are sorted by node and character."""
        marks, steps, hits, nodes = {}, [], [None], [self.trie]
        for number, node in enumerate(nodes):  # grows on the way
            for char, child in node.items():
                if char:
                    steps.append((number, marks.setdefault(char, len(marks) + 1), len(nodes)))
                    nodes.append(child)
                    hits.append(child.get(""))
        self.marks = np.zeros(0x110000, np.int16 if len(marks) < 1 << 15 else np.int32)
        for char, mark in marks.items():
            self.marks[ord(char)] = mark
        self.width = len(marks) + 1
        table = np.array(sorted((a * self.width + m, b) for a, m, b in steps), np.int64).reshape(-1, 2)
        self.steps, self.targets = table[:, 0].copy(), table[:, 1].astype(np.int32)
        self.first = np.zeros(self.width, np.int32)
        self.first[self.steps[: len(self.trie)]] = self.targets[: len(self.trie)]
        self.value = np.array([NEVER if h is None else h[0] for h in hits], np.int64)
        self.piece = np.array([-1 if h is None else h[1] for h in hits], np.int32)
        self.byte_ids = np.array([self.bytes.get(b, self.unknown) for b in range(256)], np.int32)

    def _edges(self, marks: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, value, id) of every piece in the words; a character that is no piece gives one of id -1."""
        out, at = [], np.flatnonzero(~ends)
        node = self.first[marks[at]]
        single = self.piece[node] >= 0
        none = at[~single]
        out.append((none, np.ones(len(none), np.int64), np.full(len(none), self.penalty, np.int64), np.full(len(none), -1, np.int32)))
        length = 1
        at, node = at[node > 0], node[node > 0]
        while len(at):
            hit = self.piece[node] >= 0
            out.append((at[hit], np.full(int(hit.sum()), length, np.int64), self.value[node[hit]], self.piece[node[hit]]))
            # Words end in a character without a number, which no step has.
            step = node.astype(np.int64) * self.width + marks[at + length]
            place = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            on = (self.steps[place] == step) & (marks[at + length] > 0)
            at, node, length = at[on], self.targets[place[on]], length + 1
        return tuple(np.concatenate(c) for c in zip(*out))

    def paths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and the ids, one text after the other: ``forward`` and ``trace`` for many words at once.

        All words take a step of one character together; ends are reached from
        early starts first, so of equal sums the longest last piece wins here too.
        """
        codes = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        stops = np.cumsum(sizes) - 1
        begins = stops - sizes + 1
        ends = np.zeros(len(codes), bool)
        ends[stops] = True
        marks = self.marks[codes]
        marks[stops] = 0
        start, length, value, piece = self._edges(marks, ends)
        depth = (start - np.repeat(begins, sizes)[start]).astype(np.int32 if sizes.max() > 1 << 15 else np.int16)
        order = np.argsort(depth, kind="stable")
        bounds = np.searchsorted(depth[order], np.arange(int(sizes.max()), dtype=depth.dtype))
        best = np.full(len(codes), NEVER, np.int64)
        best[begins] = 0
        edge = np.zeros(len(codes), np.int64)
        for a, b in zip(bounds[:-1], bounds[1:]):
            some = order[a:b]
            sums, goal = best[start[some]] + value[some], start[some] + length[some]
            better = sums > best[goal]
            best[goal[better]], edge[goal[better]] = sums[better], some[better]
        on_path, now, begin = np.zeros(len(codes), bool), stops, begins
        while len(now):
            on = now > begin
            now, begin = now[on], begin[on]
            on_path[now] = True
            now = start[edge[now]]
        places = np.flatnonzero(on_path)
        ids = piece[edge[places]]
        counts = np.ones(len(ids), np.int64)
        unknown = np.flatnonzero(ids < 0)
        if len(unknown) and self.bytes:
            chars = codes[places[unknown] - 1]
            data = chars.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            counts[unknown] = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
            low = np.repeat(ids < 0, counts)
            ids = np.repeat(ids, counts)
            ids[low] = self.byte_ids[np.frombuffer(data, np.uint8)]
        else:
            ids[unknown] = self.unknown
        before = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(before[np.searchsorted(places, np.append(begins, len(codes)))]), ids

    def forward(self, text: str, starts: dict[int, int], stop: int) -> tuple[list[int], list[int], list[int]]:
        """Best sum, start and id of the last piece for each end position.

        ``starts`` has the sums at the entry positions (their start is -1); pieces
        begin before ``stop`` and may end behind it.
        """
        n, trie = len(text), self.trie
        best, back, last = [NEVER] * (n + 1), [-2] * (n + 1), [0] * (n + 1)
        for i, value in starts.items():
            best[i], back[i] = value, -1
        for i in range(min(stop, n)):
            base = best[i]
            if base <= NEVER:
                continue
            node = trie.get(text[i])
            single = False
            if node is not None:
                j = i + 1
                while True:
                    hit = node.get("")
                    if hit is not None:
                        single = single or j == i + 1
                        if base + hit[0] > best[j]:
                            best[j], back[j], last[j] = base + hit[0], i, hit[1]
                    if j >= n:
                        break
                    node = node.get(text[j])
                    if node is None:
                        break
                    j += 1
            if not single and base + self.penalty > best[i + 1]:
                best[i + 1], back[i + 1], last[i + 1] = base + self.penalty, i, -1
        return best, back, last

    def trace(self, text: str, back: list[int], last: list[int], end: int) -> tuple[list[int], int]:
        """Ids of the pieces that lead to ``end``, and the entry they begin at."""
        ids: list[int] = []
        while back[end] >= 0:
            start = back[end]
            if last[end] >= 0:
                ids.append(last[end])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in reversed(text[start:end].encode("utf-8", "surrogatepass")))
            else:
                ids.append(self.unknown)
            end = start
        return ids[::-1], end

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = [SPACE + word.replace(" ", SPACE) for word in words]
        if max(map(len, texts)) <= WORD:
            return self.paths(texts)
        # The steps of the longest word count for all: long ones go one by one.
        short = [i for i, text in enumerate(texts) if len(text) <= WORD]
        rows: list = [None] * len(texts)
        if short:
            sizes, flat = self.paths([texts[i] for i in short])
            for i, ids in zip(short, np.split(flat, np.cumsum(sizes)[:-1])):
                rows[i] = ids
        for i, text in enumerate(texts):
            if rows[i] is None:
                _, back, last = self.forward(text, {0: 0}, len(text))
                rows[i] = np.array(self.trace(text, back, last, len(text))[0], np.int32)
        return np.fromiter(map(len, rows), np.int64, len(rows)), np.concatenate(rows)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the pieces, a space for each word mark; the leading space stays."""
        table = self.piece_bytes()
        return b"".join([table[i] for i in ids])

    def piece_bytes(self) -> list[bytes]:
        if not hasattr(self, "_bytes"):
            self._bytes = [
                bytes([self.byte_of[i]]) if i in self.byte_of else piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")
                for i, piece in enumerate(self.text)
            ]
        return self._bytes


def model_of(path: str) -> Model:
    """The model of a file, made once in each Python worker."""
    if path not in _cache:
        _cache[path] = Model(path)
    return _cache[path]


def words_of(text: str) -> list[str]:
    """The text cut before each run of spaces, each part without its first space; the text gets one space in front."""
    parts = text.split(" ")
    if "" not in parts:
        return parts
    out, run = [], 0
    for i, part in enumerate(parts):
        if part or i == len(parts) - 1:
            out.append(" " * run + part)
            run = 0
        else:
            run += 1
    return out


def _plain(value: str | None) -> str:
    return (value or "").replace(SPACE, " ")


# --- whole texts ---------------------------------------------------------------------------------


def _encode_short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // SLICE)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows] if batch.num_rows else []):
                part = batch.slice(a, b - a)
                words, counts = [], []
                for value in part.column(1):
                    text = _plain(value.as_py())
                    more = words_of(text) if text else []
                    words += more
                    counts.append(len(more))
                rows = model.words.rows(words)
                ids = [model.words.gather_rows(r) for r in np.split(rows, np.cumsum(counts)[:-1])]
                yield _id_batch(part.column(0), pa.array(np.zeros(len(ids), np.int32)), ids)

    return run


def _id_batch(docs, parts, ids: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([docs, parts, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["row", "part", "ids"])


# --- chunks of giant texts -----------------------------------------------------------------------


def _chunks(longest: int, chunk: int):
    """(row, part, final, text): a chunk with one character before it and the overhang behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, value in zip(batch.column(0), batch.column(1)):
                text = " " + _plain(value.as_py())
                rows = []
                for at in range(0, len(text), chunk):
                    before = text[at - 1] if at else "x"
                    rows.append((row.as_py(), at // chunk, at + chunk >= len(text), before + text[at : at + chunk + longest - 1]))
                    if len(rows) == 64:
                        yield _chunk_batch(rows)
                        rows = []
                if rows:
                    yield _chunk_batch(rows)

    return run


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["row", "part", "final", "text"])


class Chunk:
    """One chunk: its text with the overhang, its length, and the places where every path is cut."""

    def __init__(self, model: Model, text: str, chunk: int):
        self.model, self.text = model, text[1:].replace(" ", SPACE)
        self.stop = min(chunk, len(self.text))
        marks = np.frombuffer((text[0] + text[1 : self.stop + 1]).encode("utf-32-le"), np.uint32) == 0x20
        self.cuts = np.flatnonzero(marks[1:] & ~marks[:-1])

    def _exits(self, best: list[int], offset: int, states: int) -> list[int]:
        out = best[self.stop - offset : self.stop - offset + states]
        return out + [NEVER] * (states - len(out))

    def matrix(self) -> np.ndarray:
        """Best sums from each entry state to each exit state, without what all paths share; NEVER where no path leads.

        An entry behind the end of a short last chunk stays as it is.
        """
        states = self.model.longest
        out = np.full((states, states), NEVER, np.int64)
        if len(self.cuts) and self.cuts[0] < self.stop:
            first, final = int(self.cuts[0]), int(self.cuts[-1])
            tail = np.array(self._exits(self.model.forward(self.text[final:], {0: 0}, self.stop - final)[0], final, states), np.int64)
            for i in range(min(first + 1, states)):
                head = 0 if i == first else self.model.forward(self.text[i:first], {0: 0}, first - i)[0][-1]
                if head > NEVER:
                    out[i] = np.where(tail > NEVER, tail + head, NEVER)
            return out
        for i in range(states):
            if i >= self.stop:
                if i - self.stop < states:
                    out[i, i - self.stop] = 0
                continue
            best = self.model.forward(self.text[i:], {0: 0}, self.stop - i)[0]
            out[i] = self._exits(best, i, states)
        return out

    def entry(self, sums: np.ndarray) -> np.ndarray:
        """The entry state that each exit state comes from, given the best sums at the entry; -1 where none does."""
        states = self.model.longest
        out = np.full(states, -1, np.int32)
        starts = {i: int(v) for i, v in enumerate(sums) if v > NEVER}
        if len(self.cuts):
            first, final = int(self.cuts[0]), int(self.cuts[-1])
            heads = {i: v for i, v in starts.items() if i <= first}
            _, back, last = self.model.forward(self.text[:first], heads, first)
            source = self.model.trace(self.text, back, last, first)[1]
            tail = self._exits(self.model.forward(self.text[final:], {0: 0}, self.stop - final)[0], final, states)
            out[[j for j, v in enumerate(tail) if v > NEVER]] = source
            return out
        _, back, last = self.model.forward(self.text, starts, self.stop)
        for j in range(min(states, len(self.text) - self.stop + 1)):
            if back[self.stop + j] != -2:
                out[j] = self.model.trace(self.text, back, last, self.stop + j)[1]
        return out

    def ids(self, sums: np.ndarray, entry: int, leave: int) -> np.ndarray:
        """Ids of the pieces between an entry and an exit state."""
        end = self.stop + leave
        if entry >= end:
            return np.zeros(0, np.int32)
        if len(self.cuts):
            first, final = int(self.cuts[0]), int(self.cuts[-1])
            heads = {i: int(v) for i, v in enumerate(sums) if v > NEVER and i <= first}
            _, back, last = self.model.forward(self.text[:first], heads, first)
            head = self.model.trace(self.text, back, last, first)[0]
            middle = self.model.words.gather(words_of(self.text[first + 1 : final].replace(SPACE, " "))) if first < final else []
            _, back, last = self.model.forward(self.text[final:], {0: 0}, self.stop - final)
            tail = self.model.trace(self.text[final:], back, last, end - final)[0]
            return np.concatenate([np.array(head, np.int32), middle, np.array(tail, np.int32)]).astype(np.int32)
        starts = {i: int(v) for i, v in enumerate(sums) if v > NEVER}
        _, back, last = self.model.forward(self.text, starts, self.stop)
        return np.array(self.model.trace(self.text, back, last, end)[0], np.int32)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(max, +) product of a vector or matrix with a matrix."""
    a = np.atleast_2d(a)
    out = (np.maximum(a, NEVER)[:, :, None] + b[None, :, :]).max(axis=1)
    return np.where(out <= NEVER // 2, NEVER, out)


def _matrix(value: bytes, states: int) -> np.ndarray:
    return np.frombuffer(value, np.int64).reshape(-1, states)


def _block_product(states: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for value in group.sort_values("part")["matrix"]:
            m = _matrix(value, states)
            total = m if total is None else times(total, m)
        return pd.DataFrame({"row": [group["row"].iloc[0]], "block": [group["block"].iloc[0]], "matrix": [total.tobytes()]})

    return run


def _start(states: int) -> np.ndarray:
    sums = np.full(states, NEVER, np.int64)
    sums[0] = 0
    return sums


def _scan_blocks(states: int):
    """Best sums before each block of one text: at most 256 rows."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group, sums, out = group.sort_values("block"), _start(states), []
        for value in group["matrix"]:
            out.append(sums.tobytes())
            sums = times(sums, _matrix(value, states))[0]
        return pd.DataFrame({"row": group["row"], "block": group["block"], "sums": out})

    return run


def _scan_chunks(states: int):
    """Best sums before each chunk of one block: at most 256 rows."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, out = left.sort_values("part"), []
        sums = np.frombuffer(right["sums"].iloc[0], np.int64)
        for value in left["matrix"]:
            out.append(sums.tobytes())
            sums = times(sums, _matrix(value, states))[0]
        return pd.DataFrame({"row": left["row"], "block": left["block"], "part": left["part"], "sums": out})

    return run


def _follow(table: np.ndarray, states: np.ndarray) -> np.ndarray:
    return np.where(states >= 0, table[np.maximum(states, 0)], -1).astype(np.int32)


def _block_table(states: int):
    """Entry of a block for each of its exits."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        now = np.arange(states, dtype=np.int32)
        for value in group.sort_values("part", ascending=False)["entries"]:
            now = _follow(np.frombuffer(value, np.int32), now)
        return pd.DataFrame({"row": [group["row"].iloc[0]], "block": [group["block"].iloc[0]], "entries": [now.tobytes()]})

    return run


def _block_exits(group: pd.DataFrame) -> pd.DataFrame:
    """Exit state of each block of one text; the last one ends without overhang."""
    group, leave, out = group.sort_values("block", ascending=False), 0, []
    for value in group["entries"]:
        out.append(leave)
        leave = int(np.frombuffer(value, np.int32)[leave])
    return pd.DataFrame({"row": group["row"], "block": group["block"], "leave": out})


def _chunk_exits(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    left, leave, rows = left.sort_values("part", ascending=False), int(right["leave"].iloc[0]), []
    for row, part, value in zip(left["row"], left["part"], left["entries"]):
        entry = int(np.frombuffer(value, np.int32)[leave])
        rows.append((row, part, entry, leave))
        leave = entry
    return pd.DataFrame(rows, columns=["row", "part", "entry", "leave"])


def _on_chunks(path: str, chunk: int, work: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            values = []
            for i in range(batch.num_rows):  # one chunk in memory at a time
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                part = Chunk(model, row["text"], chunk)
                if work == "matrix":
                    values.append(part.matrix().tobytes())
                elif work == "entries":
                    values.append(part.entry(np.frombuffer(row["sums"], np.int64)).tobytes())
                else:
                    values.append(part.ids(np.frombuffer(row["sums"], np.int64), row["entry"], row["leave"]))
            if work == "ids":
                yield _id_batch(batch.column("row"), batch.column("part"), values)
            else:
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("part"), pa.array(values, pa.binary())], ["row", "part", work])

    return run


def _encode_giant(giants: DataFrame, path: str, chunk: int) -> DataFrame:
    states = model_of(path).longest
    block = F.expr(f"part div {BLOCK}").cast("int")
    key = ["row", "part"]
    chunks = written(
        giants.mapInArrow(_chunks(states, chunk), "row string, part int, final boolean, text string").repartition(*key), "chunks"
    )
    matrices = written(
        chunks.select("row", "part", "text").mapInArrow(_on_chunks(path, chunk, "matrix"), "row string, part int, matrix binary")
        .withColumn("block", block), "matrices",
    )
    blocks = matrices.groupBy("row", "block").applyInPandas(_block_product(states), "row string, block int, matrix binary")
    before = blocks.groupBy("row").applyInPandas(_scan_blocks(states), "row string, block int, sums binary")
    sums = matrices.groupBy("row", "block").cogroup(before.groupBy("row", "block")).applyInPandas(
        _scan_chunks(states), "row string, block int, part int, sums binary"
    )
    sums = written(sums.select("row", "part", "sums"), "sums")
    entries = written(
        chunks.join(sums, key).select("row", "part", "text", "sums")
        .mapInArrow(_on_chunks(path, chunk, "entries"), "row string, part int, entries binary").withColumn("block", block), "entries",
    )
    tables = entries.groupBy("row", "block").applyInPandas(_block_table(states), "row string, block int, entries binary")
    exits = tables.groupBy("row").applyInPandas(_block_exits, "row string, block int, leave int")
    paths = entries.groupBy("row", "block").cogroup(exits.groupBy("row", "block")).applyInPandas(
        _chunk_exits, "row string, part int, entry int, leave int"
    )
    traced = chunks.join(sums, key).join(paths, key).select("row", "part", "text", "sums", "entry", "leave")
    return traced.mapInArrow(_on_chunks(path, chunk, "ids"), "row string, part int, ids array<int>")


def encode(df: DataFrame, model_file: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc_id, part, ids): the ids of each whole text, giant texts in several parts.

    ``part`` counts from 0; the parts' ids one after the other are the text's.
    One row per input row and part: null and empty texts give one row without
    ids, repeated rows stay repeated (those of giant texts are told apart by a
    number, so their parts do not mix). Null ids stay null. The mark U+2581 in a
    text counts as a space. Other columns are dropped.
    """
    slim = df.select(long_or_null(df, "doc_id").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    long_text = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = slim.filter(~long_text).select(F.col("doc_id").cast("string").alias("row"), "text")
    short = short.mapInArrow(_encode_short(model_file), "row string, part int, ids array<int>")
    # A number for each row keeps repeated rows apart; the chunks are written before it is used twice.
    giants = slim.filter(long_text).select(
        F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.monotonically_increasing_id()).alias("row"), "text"
    )
    both = short.unionByName(_encode_giant(giants, model_file, chunk))
    doc = F.split("row", "/")[0]
    return both.select(F.when(doc != "", doc).cast("long").alias("doc_id"), "part", "ids")


def decode(ids: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, part, text): what each part's ids stand for.

    Pieces end where parts end, so each part is decoded on its own and a text is
    its parts one after the other. The space that encoding puts in front of a
    text is taken off again. Parts without ids give an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(model_file)
        for batch in batches:
            out = []
            for part, row in zip(batch.column(1).to_pylist(), batch.column(2)):
                value = model.decode(row.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace") if row.is_valid else ""
                out.append(value[1:] if part == 0 and value[:1] == " " else value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["doc_id", "part", "text"])

    return ids.select("doc_id", "part", "ids").mapInArrow(run, "doc_id long, part int, text string")


def digest(ids: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, part, ids, n_tokens, text_bytes, text_crc32): the ids and what they decode to, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(model_file)
        for batch in batches:
            lists, sizes, sums = batch.column(2), [], []
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for part, a, b in zip(batch.column(1).to_pylist(), offsets[:-1], offsets[1:]):
                data = model.decode(values[a:b].tolist())
                data = data[1:] if part == 0 else data
                sizes.append(len(data))
                sums.append(zlib.crc32(data))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.diff(offsets).astype(np.int64)), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "part", "ids", "n_tokens", "text_bytes", "text_crc32"],
            )

    return ids.select("doc_id", "part", "ids").mapInArrow(
        run, "doc_id long, part int, ids array<int>, n_tokens long, text_bytes long, text_crc32 long"
    )

"""Word-piece counts by an automaton over the vocabulary, without building pieces.

The vocabulary is a trie with failure links: when no edge goes on, the link
leads to the trie node that stands for the rest of what was read after the
longest pieces have been taken off, and it carries how many pieces that were.
Each character is read once. A word's pieces are the greedy longest matches
from the left; the first piece is taken from the word-initial pieces, the others
from the continuation pieces. A word that cannot be matched counts as one.
"""

from __future__ import annotations

import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import long_or_null
from .wordcache import WordCache, split_batch

_cache: dict[tuple, WordCache] = {}


def piece_vocabulary(model_file: str) -> tuple[frozenset[str], frozenset[str]]:
    """Word-initial and continuation pieces of a SentencePiece model (a word starts with U+2581)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    initial, inner = set(), set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        if "▁" in piece[1:]:
            continue
        (initial if piece[0] == "▁" else inner).add(piece.lstrip("▁"))
    return frozenset(initial - {""}), frozenset(inner)


class Automaton:
    """Trie with two roots (word start, continuation), failure links and popped counts."""

    START, INNER = 0, 1

    def __init__(self, initial: Iterable[str], inner: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        self.final = [False, False]
        for root, words in ((self.START, initial), (self.INNER, inner)):
            for word in words:
                node = root
                for char in word:
                    node = self.edges[node].setdefault(char, len(self.edges))
                    if node == len(self.edges):
                        self.edges.append({})
                        self.final.append(False)
                self.final[node] = True
        self.link = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        self._links()

    def _links(self) -> None:
        queue = deque([self.START, self.INNER])
        while queue:
            node = queue.popleft()
            for char, child in self.edges[node].items():
                if self.final[child]:
                    # All that was read is one piece; the rest is empty.
                    self.link[child], self.popped[child] = self.INNER, 1
                else:
                    at, count = self.link[node], self.popped[node]
                    while at >= 0 and char not in self.edges[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[child], self.popped[child] = self.edges[at][char], count
                queue.append(child)

    def count(self, word: str) -> int:
        """Number of greedy longest-match pieces; 1 for a word that has none, 0 for an empty word."""
        if not word:
            return 0
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for char in word:
            while char not in edges[node]:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = edges[node][char]
        while node != self.INNER:
            total += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return total


def split_words(text: str) -> list[str]:
    """Runs of other characters than white space and punctuation; each punctuation mark alone."""
    out, word = [], []
    for char in text:
        if char.isspace():
            mark = None
        elif char.isalnum() or not (33 <= ord(char) <= 126 or unicodedata.category(char)[0] == "P"):
            word.append(char)
            continue
        else:
            mark = char
        if word:
            out.append("".join(word))
            word = []
        if mark:
            out.append(mark)
    if word:
        out.append("".join(word))
    return out


def counter(model_file: str) -> WordCache:
    """Memo from a string between spaces to [pieces, words], kept by the Python worker."""
    key = ("count", model_file)
    if key not in _cache:
        count = Automaton(*piece_vocabulary(model_file)).count

        def work(strings: list[str]) -> list:
            rows = []
            for string in strings:
                words = [string] if string.isalnum() else split_words(string)
                rows.append((sum(map(count, words)), len(words)))
            return rows

        _cache[key] = WordCache(work)
    return _cache[key]


def count_tokens(df: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """(doc_id long, n_words long, n_tokens long) of each whole text, one row per input row.

    Null and empty texts count 0. Giant texts are counted a million characters
    at a time. Other columns are dropped; repeated rows stay repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = counter(model_file)
        for batch in batches:
            totals = np.zeros((2, batch.num_rows), np.int64)
            for strings, counts, places in split_batch(batch.column(1).to_pylist()):
                rows = memo.rows(strings)
                starts, heads = memo.starts[rows], np.cumsum([0, *counts[:-1]])
                for i in (0, 1):
                    np.add.at(totals[i], places, np.add.reduceat(memo.flat[starts + i].astype(np.int64), heads))
            tokens, words = totals
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return df.select(long_or_null(df, "doc_id").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long"
    )

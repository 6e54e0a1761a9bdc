"""Per-worker memo of words: each distinct word is worked out once, texts are gathered.

Most words of a corpus repeat. A tokenizer whose pieces never cross a space can
therefore work out each word once and build the answer for a text by lookups,
which gives the same ids as a call over the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Characters of text that are split into words at a time.
PIECE = 1 << 20


def pieces(text: str, limit: int = PIECE) -> Iterator[str]:
    """Parts of a text cut at spaces (which are dropped), so that a giant text needs little memory."""
    at, end = 0, len(text)
    while end - at > limit:
        cut = text.find(" ", at + limit)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


class WordCache:
    """Maps words to rows of integers, at most ``limit`` words at a time.

    ``work`` gets a list of unknown words and returns a list of integer lists, or
    two arrays: the rows' lengths and their integers one after the other.
    The memo is emptied when it is full; that only costs time.
    """

    def __init__(self, work: Callable[[list[str]], list | tuple[np.ndarray, np.ndarray]], limit: int = 500_000):
        self.work, self.limit = work, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.int32)
        self.used = 0

    def learn(self, words: list[str]) -> None:
        rows = self.work(words)
        sizes = rows[0] if isinstance(rows, tuple) else np.fromiter(map(len, rows), np.int64, len(rows))
        first, total = len(self.index), int(sizes.sum())
        while first + len(sizes) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        ends = np.cumsum(sizes)
        self.lengths[first : first + len(sizes)] = sizes
        self.starts[first : first + len(sizes)] = self.used + ends - sizes
        self.flat[self.used : self.used + total] = rows[1] if isinstance(rows, tuple) else np.fromiter((i for row in rows for i in row), np.int32, total)
        self.used += total
        self.index.update(zip(words, range(first, first + len(words))))

    def rows(self, words: list[str]) -> np.ndarray:
        """Row number of each word."""
        if len(self.index) > self.limit:
            self.clear()
        found = list(map(self.index.get, words))
        if None in found:
            missing = [i for i, row in enumerate(found) if row is None]
            self.learn(list(dict.fromkeys([words[i] for i in missing])))
            for i in missing:
                found[i] = self.index[words[i]]
        return np.array(found, np.int64)

    def gather(self, words: list[str]) -> np.ndarray:
        """The integers of all words, one after the other."""
        return self.gather_rows(self.rows(words))

    def gather_rows(self, rows: np.ndarray) -> np.ndarray:
        sizes = self.lengths[rows]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[rows] - ends + sizes, sizes) + np.arange(total)]


def split_batch(texts: list[str | None], prepare: Callable[[str], str] = str) -> Iterator[tuple[list[str], list[int], list[int]]]:
    """Words between spaces and line ends, for about PIECE characters at a time.

    Gives (words, counts, places): counts[i] words belong to texts[places[i]]. A
    giant text comes in several parts; null and empty texts do not come at all.
    ``prepare`` changes a part before it is split.
    """
    words, counts, places, size = [], [], [], 0
    for place, text in enumerate(texts):
        for part in pieces(text) if text else ():
            if size and size + len(part) > PIECE:
                yield words, counts, places
                words, counts, places, size = [], [], [], 0
            more = prepare(part).replace("\n", " ").split(" ")
            words += more
            counts.append(len(more))
            places.append(place)
            size += len(part)
    if places:
        yield words, counts, places

"""Words of a text as 64-bit hashes, worked out on whole arrays of bytes.

Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. The
hash of a word is a polynomial over random values of its bytes, taken from one
running sum over the text. Equal words have equal hashes; two different words
share one with a chance of about 2^-60.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Bytes that are hashed at a time, and the length from which a word is hashed on its own.
SEGMENT, LONG_WORD = 1 << 20, 1 << 12

_random = np.random.RandomState(20240229)
_VALUE = _random.randint(0, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUE = _VALUE[_LOWER]
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the input changes every bit of the output."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _power_arrays() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, made once for each Python worker."""
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            out = np.full(SEGMENT + 1, base, U)
            out[0] = 1
            _powers.append(np.multiply.accumulate(out))
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of at most SEGMENT bytes of data."""
    forth, back = _power_arrays()
    total = np.concatenate([np.zeros(1, U), np.cumsum(_VALUE[data] * forth[: len(data)], dtype=U)])
    out = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = _long(data[starts[i] : ends[i]])
    return out


def _segment(data: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space[data], [True]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    return span_hashes(data, starts, ends), starts, ends


def _long(word: np.ndarray) -> np.uint64:
    return U(int.from_bytes(hashlib.blake2b(_LOWER[word].astype(np.uint8).tobytes(), digest_size=8).digest(), "little"))


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of each word of a UTF-8 text, in order. Memory beyond the result is bounded by SEGMENT and the longest word."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= SEGMENT:
        return _segment(data, _SPACE)[0]
    return np.concatenate([hashes for hashes, _, _ in word_spans(data)])


def word_spans(data: np.ndarray, space: np.ndarray = _SPACE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, starts, ends) of the words of a text's bytes, segment by segment; ``space`` tells which bytes end a word."""
    at = 0
    while at < len(data):
        part = data[at : at + SEGMENT]
        if at + SEGMENT < len(data):
            last = np.flatnonzero(space[part])
            if len(last):
                part = part[: last[-1] + 1]
            else:  # inside a giant word: it goes on to the next space
                end = at + SEGMENT
                while end < len(data) and not space[data[end]]:
                    end += 1
                yield np.array([_long(data[at:end])], U), np.array([at]), np.array([end])
                at = end
                continue
        hashes, starts, ends = _segment(part, space)
        yield hashes, starts + at, ends + at
        at += len(part)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of the whole sequence if it is shorter; none of no words."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    total = np.full(n - width + 1, width, U)
    for i in range(width):
        total = mix(total * U(0x9FB21C651E98DF25) + words[i : n - width + 1 + i])
    return total

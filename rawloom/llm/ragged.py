"""Ragged texts of one Arrow batch as flat numpy arrays.

Every text operator works on the bytes of many texts at once: ``data`` holds the bytes of a run
of texts back to back, ``offsets`` where each begins and the last one ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive texts of ``limit`` bytes together, or one longer text alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of a column's texts."""
    data, offsets = flat(column)
    for i, j in runs(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def noise(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if len(have) <= 4 * CHUNK_BYTES:
            _powers[name] = have
    return have[:n]


class Rolling:
    """Hashes of any substrings of ``data`` in constant time each, from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray, table: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * _power("up", _BASE, n), out=self.sums[1:])
        self.inverse = _power("down", _BASE_INVERSE, n + 1)

    def hashes(self, starts, ends) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes from each position on."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, none across texts, and each text's first word."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lowered_table(seed: int) -> np.ndarray:
    """A random number for each byte, the same for A-Z as for a-z."""
    table = noise(256, seed)
    table[65:91] = table[97:123]
    return table


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, and their offsets."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    at = heads[offsets]
    if at[-1] != len(points):  # not UTF-8 after all
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return points, at

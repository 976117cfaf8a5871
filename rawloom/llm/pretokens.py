"""Pre-tokens of byte-level vocabularies, and the mapping between bytes and printable characters."""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat

import numpy as np

from . import ragged

# The white space of Unicode, written out because libraries differ in what \s covers.
SPACE = r"\t-\r \x85\xa0  -     　"

@lru_cache(1)
def _classes() -> np.ndarray:
    """For each code point: 0 white space, 1 letter, 2 number, 3 anything else."""
    import regex

    every = np.arange(0x110000, dtype=np.uint32)
    every[0xD800:0xE000] = 0xFFFD
    text = every.tobytes().decode("utf-32-le")
    out = np.full(0x110000, 3, np.uint8)
    for k, kind in ((0, rf"[{SPACE}]+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
        for m in regex.finditer(kind, text):
            out[m.start() : m.end()] = k
    return out


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each pre-token of UTF-8 texts begins, and each text's first pre-token.

    The pre-tokens are the successive matches of the pattern: runs of letters, of numbers and of
    other signs, each with one blank before it; white space up to the last character before a
    run; and the English contractions that begin where a match ended. They cover each text.
    """
    points, at = ragged.code_points(data, offsets)
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[at] = True
    cut = np.ones(n, bool)
    cut[1:] = kind[1:] != kind[:-1]
    cut |= first[:n]
    # the last white space before a run stands alone, or belongs to the run if it is a blank
    after = np.flatnonzero(cut[1:] & ~first[1:n] & (kind[:-1] == 0)) + 1
    cut[after - 1] = True
    cut[after[points[after - 1] == 32]] = False
    quote = np.flatnonzero((points == 39) & cut)
    if len(quote):
        padded = np.concatenate([points, [0, 0, 0]])
        ends = np.searchsorted(at, quote, "right")
        room = at[ends] - quote
        a, b = padded[quote + 1], padded[quote + 2]
        one = (room > 1) & np.isin(a, [ord(c) for c in "stmd"])
        two = (room > 2) & (((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l"))))
        size = np.where(one, 2, np.where(two, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        cut[quote + 1] = False
        rest = quote + size
        cut[rest[rest < n]] = True
    chosen = np.flatnonzero(cut)
    heads = chosen if n == len(data) else np.flatnonzero((data & 0xC0) != 0x80)[chosen]
    return heads, np.searchsorted(heads, offsets)


class Remembered:
    """Numbers the distinct pre-tokens of a worker; ``learn`` is told the new ones in the order of their numbers.

    Pre-tokens are told apart by 64-bit hashes. At most ``limit`` of them and those of one batch are
    remembered, then all are forgotten.
    """

    def __init__(self, learn, forget, limit: int):
        self.learn, self.forget, self.limit = learn, forget, limit
        self.known: dict[int, int] = {}
        self.table = ragged.noise(256, 5)

    def numbers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
            self.forget()
        ends = np.append(starts[1:], len(data))
        hashes = ragged.Rolling(data, self.table).hashes(starts, ends)
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        number = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(distinct[new].tolist(), number[new].tolist()))
            self.learn(data, starts[where[new]], ends[where[new]])
        return number[back]


@lru_cache(1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next one from 256 on."""
    out, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out.append(chr(byte))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def take_ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[start : start + length]`` over all pairs."""
    total = int(lengths.sum())
    if total == 0:
        return flat[:0]
    ends = np.cumsum(lengths)
    steps = np.repeat(starts - (ends - lengths), lengths)
    return flat[steps + np.arange(total)]

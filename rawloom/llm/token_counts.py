"""Token counts by rank-synchronous merging of ragged arrays.

Texts are split into pre-tokens. The symbols of all pre-tokens of a batch that were not seen
before lie in one array; in each round every pre-token merges all occurrences of its own
lowest-ranked pair, until no pre-token has a pair left. Only the number of symbols that survive
is kept.
"""

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ragged
from .frames import table, vocabulary
from .pretokens import Remembered, byte_characters, pretokens, take_ragged

NEVER = np.int32(2**31 - 1)
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 300_000


class Merges:
    """The merge list of a byte-level vocabulary as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.size = np.int64(max(ids.values()) + 1)
        self.byte_ids = np.array([ids[c] for c in byte_characters()], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * int(self.size) + ids[b] for a, b in pairs], np.int64)
        self.product = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], NEVER)

    def surviving(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """How many symbols each sequence of bytes ends with."""
        counts = lengths.copy()
        alive = np.flatnonzero(lengths > 1)
        inside = np.repeat(lengths > 1, lengths)
        symbols, sizes = self.byte_ids[data[inside]], lengths[alive]
        rank = np.full(len(symbols), NEVER)
        if len(symbols) > 1:
            rank[:-1] = self.ranks(symbols[:-1].astype(np.int64), symbols[1:])
        if len(sizes):
            rank[np.cumsum(sizes) - 1] = NEVER
        while len(alive):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NEVER
            if done.any():
                counts[alive[done]] = sizes[done]
                stay = np.repeat(~done, sizes)
                symbols, rank = symbols[stay], rank[stay]
                alive, sizes, lowest = alive[~done], sizes[~done], lowest[~done]
                if not len(alive):
                    break
            owner = np.repeat(np.arange(len(sizes)), sizes)
            at = np.flatnonzero(rank == lowest[owner])
            # of overlapping occurrences (a a a) every other one merges, from the left
            head = np.ones(len(at), bool)
            head[1:] = np.diff(at) != 1
            first = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.product[rank[at]]
            ends = np.cumsum(sizes) - 1
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            sizes = sizes - np.bincount(owner[at], minlength=len(sizes))
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            before = at - 1
            before = before[before >= 0]
            # the symbol before may itself have been taken in by a merge to its left
            changed[np.where(gone[before], before - 1, before)] = True
            last = np.zeros(len(symbols), bool)
            last[ends] = True
            last[ends[gone[ends]] - 1] = True
            keep = ~gone
            symbols, rank, changed, last = symbols[keep], rank[keep], changed[keep], last[keep]
            again = np.flatnonzero(changed & ~last)
            rank[again] = self.ranks(symbols[again].astype(np.int64), symbols[again + 1])
            rank[last] = NEVER
        return counts


@lru_cache(2)
def _merges(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Counts the tokens of texts; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str):
        self.merges = _merges(path)
        self.special = [s.encode() for s in self.merges.special]
        self.forget()
        self.remembered = Remembered(self.learn, self.forget, REMEMBERED)

    def forget(self) -> None:
        self.sizes = np.zeros(0, np.int64)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        lengths = ends - starts
        self.sizes = np.append(self.sizes, self.merges.surviving(take_ragged(data, starts, lengths), lengths))

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text; a special string counts as one and ends the pre-token before it."""
        extra = np.zeros(len(offsets) - 1, np.int64)
        pieces, piece_offsets, owner = data, offsets, None
        raw = data.tobytes()
        if any(s in raw for s in self.special):
            parts, owner = [], []
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                own = [raw[a:b]]
                for s in self.special:
                    own = [p for part in own for p in part.split(s)]
                extra[i] = len(own) - 1
                parts += own
                owner += [i] * len(own)
            pieces = np.frombuffer(b"".join(parts), np.uint8)
            piece_offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        starts, at = pretokens(pieces, piece_offsets)
        number = self.remembered.numbers(pieces, starts)
        sums = np.concatenate([[0], np.cumsum(self.sizes[number])])
        found = sums[at[1:]] - sums[at[:-1]]
        if owner is not None:
            found = np.bincount(owner, found, len(extra)).astype(np.int64)
        return found + extra


def token_counts(docs: DataFrame, path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to every row; columns of these names are replaced.

    Counts are those of the vocabulary's library without special tokens added; special strings in a
    text count as the special token, as is the library's default. NULL and empty texts have 0 bytes
    and 0 tokens. Rows are counted one by one: repeated rows stay, an empty table stays empty.
    """

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for series in batches:
            found = [counter.counts(data, offsets) for _, _, data, offsets in ragged.chunks(pa.array(series, pa.large_string()))]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0, np.int64))

    return (
        docs.withColumn("n_bytes", F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")))
        .withColumn("n_tokens", count(F.col(text)))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, vocabulary("byte_bpe_50k.json")).drop("text")

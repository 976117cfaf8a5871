"""Byte-level BPE encoding and decoding with the tokenizers library.

The ranks of a rank file become a vocabulary and a merge list over printable characters, one for
each byte. Texts are split by the public pattern; each distinct pre-token of an Arrow batch goes
through the library once, and texts are put together from the pre-tokens' ids. Decoding looks
up the bytes of each id in one flat table, so that a character split over tokens comes back whole.
"""

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import ragged
from .frames import table, tidy, vocabulary
from .pretokens import Remembered, byte_characters, pretokens, take_ragged

#: Pre-tokens whose ids a worker remembers.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_list(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every pair of tokens whose concatenation is a token, by the rank of the result."""
    out = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        out += [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    return out


class Codec:
    """One vocabulary in a worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        chars = byte_characters()
        shown = {token: "".join(chars[b] for b in token) for token in ranks}
        merges = [(shown[a], shown[b]) for a, b in merge_list(ranks)]
        self.library = Tokenizer(models.BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # bytes by id, with nothing for ids that no token has
        size = max(ranks.values()) + 1
        self.sizes = np.zeros(size, np.int64)
        by_id = [b""] * size
        for token, rank in ranks.items():
            by_id[rank] = token
            self.sizes[rank] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.renew()

    def renew(self) -> None:
        """Forget all pre-tokens: workers outlive their tasks, and other tasks need the memory."""
        self.forget()
        self.remembered = Remembered(self.learn, self.forget, REMEMBERED)

    def forget(self) -> None:
        self.ids = np.zeros(0, np.uint32)
        self.at, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode pre-tokens in one call of the library and remember their ids."""
        raw = data.tobytes()
        words = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
        found = self.library.encode(words, is_pretokenized=True, add_special_tokens=False)
        n = np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, np.array(found.ids, np.uint32)])
        self.at, self.n = np.concatenate([self.at, at]), np.concatenate([self.n, n])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's offset among them."""
        starts, at = pretokens(data, offsets)
        number = self.remembered.numbers(data, starts)
        n = self.n[number]
        return take_ragged(self.ids, self.at[number], n), np.concatenate([[0], np.cumsum(n)])[at]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all sequences of ids, and each sequence's offset among them; unknown ids have no bytes."""
        known = ids < len(self.sizes)
        ids = np.where(known, ids, 0).astype(np.int64)
        n = np.where(known, self.sizes[ids], 0)
        return take_ragged(self.bytes, self.starts[ids], n), np.concatenate([[0], np.cumsum(n)])[offsets]

    def spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character, and the one after the last, that each token of one text has bytes of."""
        n = self.sizes[ids.astype(np.int64)]
        data = take_ragged(self.bytes, self.starts[ids.astype(np.int64)], n)
        heads = np.cumsum((data & 0xC0) != 0x80)  # characters begun up to each byte
        ends = np.cumsum(n)
        return (heads[ends - n] - 1, heads[ends - 1]) if len(n) else (n, n)


@lru_cache(2)
def _codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", spans: bool = False) -> DataFrame:
    """The key and ``ids`` of every row's text; with ``spans`` also each token's characters (``starts``, ``ends``).

    A token that holds part of a character counts that character. NULL and empty texts have no
    ids; special strings are ordinary text. Repeated rows stay, an empty table stays empty.
    """
    kind = docs.schema[key]
    fields = [kind, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    if spans:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType(), False), False) for n in ("starts", "ends")]

    def rows(batches):
        codec = _codec(path)
        codec.renew()
        for batch in batches:
            for i, j, data, offsets in ragged.chunks(batch.column(1)):
                ids, at = codec.encode(data, offsets)
                lists = [ids.astype(np.int32)]
                if spans:
                    both = [codec.spans(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
                    lists += [np.concatenate([x[k] for x in both]).astype(np.int32) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], *[pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x)) for x in lists]],
                    [f.name for f in fields],
                )

    return docs.select(key, text).mapInArrow(tidy(rows), T.StructType(fields))


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The key and the decoded bytes (``decoded``) of every row's ids; NULL lists are empty."""
    fields = T.StructType([encoded.schema[key], T.StructField("decoded", T.BinaryType(), False)])

    def rows(batches):
        codec = _codec(path)
        for batch in batches:
            column = batch.column(1)
            for i in range(len(column)):
                values = column[i].as_py() or []
                data, _ = codec.decode(np.array([v if v is not None and v >= 0 else 2**31 for v in values], np.uint32), np.array([0, len(values)]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], pa.array([data.tobytes()], pa.binary())], [f.name for f in fields])

    return encoded.select(key, ids).mapInArrow(tidy(rows), fields)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text; per row the key, ``n_tokens`` and the digests ``ids_sha256`` and ``decoded_sha256``.

    The ids are digested as little-endian unsigned 32-bit integers, and the bytes decoded from
    them as they are. NULL and empty texts have no tokens and the digest of nothing. Repeated rows
    stay, an empty table stays empty.
    """
    fields = T.StructType([
        docs.schema[key],
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids_sha256", T.StringType(), False),
        T.StructField("decoded_sha256", T.StringType(), False),
    ])

    def rows(batches):
        codec = _codec(path)
        codec.renew()
        digest = lambda flat, a, b: hashlib.sha256(flat[a:b]).hexdigest()
        for batch in batches:
            for i, j, data, offsets in ragged.chunks(batch.column(1)):
                ids, at = codec.encode(data, offsets)
                back, ends = codec.decode(ids, at)
                ids = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([digest(ids, a, b) for a, b in zip(at[:-1], at[1:])], pa.string()),
                        pa.array([digest(back, a, b) for a, b in zip(ends[:-1], ends[1:])], pa.string()),
                    ],
                    [f.name for f in fields],
                )
        codec.renew()

    return docs.select(key, text).mapInArrow(tidy(rows), fields)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))

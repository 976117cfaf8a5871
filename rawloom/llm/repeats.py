"""Removal of strings that an earlier document has too, by prefix-free parsing.

A rolling hash cuts every text into phrases: a phrase begins where the hash of the next bytes is
small, and reaches ``length - 1`` bytes into the phrases that follow, so that every string of
``length`` bytes lies in the phrase that its first byte is in. The distinct phrases are the
dictionary, the texts' sequences of them the parse. In highly repetitive text the dictionary is
small, and the parse alone settles most: a phrase that an earlier document has goes as a whole.

What is left is to put the suffixes of different dictionary phrases into corpus order. Suffixes that
agree in ``length`` bytes have the same least k-gram there, so suffixes are dealt out by it: a first
round finds k-grams that several phrases share, also in the bytes to their left or right; a second
one sorts the suffixes that have those (the suffix array of this part of the dictionary), and in each
run of suffixes that agree in ``length`` bytes the smallest document keeps its string. Both rounds
move packed arrays, one for each batch of documents and bucket, after dropping what the batch itself
can settle; so a passage that a third of all documents share comes once from each batch.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .frames import released, stored, table, tidy
from .pretokens import take_ragged

LENGTH = 50
GRAM = 24
#: Mean number of strings that begin in a phrase.
PHRASE = 384
#: Bytes of text whose arrays make one bucket.
BUCKET_BYTES = 8 << 20

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 8 << 20
#: Strings of a bucket that are sorted at a time.
PASS = 1 << 17
#: Documents that are asked for strings around one k-gram, from which on these are dealt out string by string; at most
#: ``MOST_HEAVY`` k-grams ever are, as more documents then make one heavy.
HEAVY, MOST_HEAVY = 20_000, 1_000_000

ONE, TWO = ragged.noise(256, 21), ragged.noise(256, 22)
TRIGGER = np.uint64((1 << 64) // PHRASE)
BATCH = T.StructType([
    T.StructField("bucket", T.LongType()),
    T.StructField("docs", T.BinaryType()),
    T.StructField("phrases", T.BinaryType()),
    T.StructField("grams", T.BinaryType()),
    T.StructField("spans", T.BinaryType()),
])
SPAN = "doc long, start long, n long"
SEGMENT_ROW = np.dtype([("start", "<i8"), ("size", "<u4"), ("late", "<u4")])
PHRASE_ROW = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("n", "<u4")])
GRAM_ROW = np.dtype([("code", "<u8"), ("sides", "<u2"), ("doc", "<u2")])
SPAN_ROW = np.dtype([("doc", "<u4"), ("start", "<u4"), ("n", "<u4")])


def _sliding(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return values if span == width else np.minimum(values[: len(values) - (width - span)], values[width - span :])


class Parse:
    """Phrases and least k-grams of the strings of ``length`` bytes in a run of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, phrases: bool = True):
        self.rolling = ragged.Rolling(data, ONE)
        grams = self.rolling.windows(GRAM)
        n = max(len(data) - length + 1, 0)
        texts = np.flatnonzero(np.diff(offsets) >= length)
        first, after = offsets[:-1][texts], offsets[1:][texts] - length + 1
        valid = np.zeros(n + 1, np.int8)
        valid[first] = 1
        valid[after] -= 1
        valid = np.cumsum(valid[:n], dtype=np.int8) > 0
        self.least = _sliding(grams, length - GRAM + 1)[:n] if n else np.zeros(0, np.uint64)
        begins = np.zeros(n, bool)
        begins[first] = True
        if phrases:
            begins |= (grams[:n] < TRIGGER) & valid
        self.start = np.flatnonzero(begins)
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.stop = np.minimum(np.append(self.start[1:], n), offsets[1:][self.doc] - length + 1) if n else self.start
        # runs of strings with one least k-gram, none across phrases
        turn = np.ones(n, bool)
        turn[1:] = self.least[1:] != self.least[:-1]
        turn = (turn | begins) & valid
        self.run = np.flatnonzero(turn)
        self.of = np.searchsorted(self.start, self.run, "right") - 1
        self.run_stop = np.minimum(np.append(self.run[1:], n), self.stop[self.of]) if n else self.run
        self.grams, self.length, self.data = grams, length, data

    def codes(self) -> np.ndarray:
        return ragged.mixed(self.least[self.run])

    def sides(self) -> np.ndarray:
        """A byte each for what lies left and right of a run's k-gram; 0 if its place isn't certain.

        A string of ``length`` bytes has at least half of the bytes beside its k-gram on one side of it.
        """
        beside = (self.length - GRAM + 1) // 2
        width = self.length - GRAM
        value, last = self.least[self.run], np.minimum(self.run_stop - 1 + width, len(self.grams) - 1)
        at, times = np.full(len(self.run), -1), np.zeros(len(self.run), np.int64)
        low = np.zeros(len(self.grams), bool)  # k-grams that are the least of some string
        if len(self.least):
            high = ~_sliding(~np.concatenate([np.zeros(width, np.uint64), self.least, np.zeros(width, np.uint64)]), width + 1)
            m = min(len(high), len(self.grams))
            low[:m] = high[:m] == self.grams[:m]
        places = np.flatnonzero(low)
        here, going = np.searchsorted(places, self.run), np.arange(len(self.run))
        while len(going):
            going = going[here[going] < len(places)]
            going = going[places[here[going]] <= last[going]]
            same = going[self.grams[places[here[going]]] == value[going]]
            times[same] += 1
            at[same] = places[here[same]]
            here[going] += 1
            going = going[times[going] < 2]
        sure = (times == 1) & (self.run_stop - self.run <= width + 1)
        lo = np.clip(at - beside, 0, None)
        hi = np.minimum(at + GRAM + beside, len(self.data))
        at = np.clip(at, 0, None)
        left = self.rolling.hashes(lo, np.maximum(at, lo)) % np.uint64(255) + np.uint64(1)
        right = self.rolling.hashes(np.minimum(at + GRAM, hi), hi) % np.uint64(255) + np.uint64(1)
        return np.where(sure, left << np.uint64(8) | right, 0).astype(np.uint16)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together (the first key counts most), and where groups begin in it."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for key in keys:
        sorted_key = key[order]
        fresh[1:] |= sorted_key[1:] != sorted_key[:-1]
    return order, np.flatnonzero(fresh)


def _spread(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(starts, n)))


def _shared(code: np.ndarray, sides: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which k-grams may be in strings that different phrases and documents share.

    The lower 40 bits of a code tell phrases apart, the others k-grams. A k-gram of a phrase counts
    for the smallest document alone.
    """
    gram = code >> np.uint64(40)
    out = np.zeros(len(code), bool)
    if not len(code):
        return out
    order, starts = _groups(gram)
    unsure = np.zeros(len(code), bool)
    unsure[order] = _spread(np.logical_or.reduceat(sides[order] == 0, starts), starts, len(code))
    for side in (np.where(unsure, 0, sides >> 8), np.where(unsure, 0, sides & 255)):
        order, starts = _groups(gram, side.astype(np.uint16))
        d, c = doc[order], code[order]
        several = (np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)) & (
            np.minimum.reduceat(c, starts) != np.maximum.reduceat(c, starts)
        )
        out[order] |= _spread(several, starts, len(code))
    return out


def _parsed(docs: DataFrame, buckets: int, length: int) -> DataFrame:
    """Packed phrases and k-grams of each batch of documents, by bucket."""

    def rows(batches):
        for whole in batches:
            for lo, hi in _slices(ragged.flat(whole.column(1))[1]):
                yield from _parse_batch(whole.slice(lo, hi - lo), buckets, length)

    return docs.select("doc", "text").mapInArrow(tidy(rows), BATCH)


def _slices(offsets: np.ndarray):
    """Runs of texts that are worked on together: few enough for 16-bit numbers, and of bounded size unless one text is longer."""
    for lo, hi in ragged.runs(offsets, SLICE_BYTES):
        for i in range(lo, hi, 60_000):
            yield i, min(i + 60_000, hi)


def _parse_batch(batch, buckets: int, length: int):
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    found = [[] for _ in range(9)]
    n_phrases = 0
    for i, _, data, offsets in ragged.chunks(batch.column(1)):
        p = Parse(data, offsets, length)
        if not len(p.start):
            continue
        second = ragged.Rolling(data, TWO)
        ends = p.stop + length - 1
        for k, part in enumerate((
            p.rolling.hashes(p.start, ends), second.hashes(p.start, ends), p.doc + i, p.start - offsets[p.doc], p.stop - p.start,
            p.codes(), p.sides(), p.of + n_phrases,
        )):
            found[k].append(part)
        n_phrases += len(p.start)
    if not n_phrases:
        return
    h1, h2, doc, start, n, gram, sides, of = (np.concatenate(f) for f in found[:8])
    # the batch's first document with a phrase speaks for it; in others the phrase goes
    order, starts = _groups(h1, h2, ids[doc])
    _, heads = _groups(h1, h2)
    key = ids[doc]
    by_hash = np.lexsort((h2, h1))
    earliest = np.empty(n_phrases, np.int64)
    earliest[by_hash] = _spread(np.minimum.reduceat(key[by_hash], heads), heads, n_phrases)
    stays = key == earliest
    phrases = np.zeros(int(stays.sum()), PHRASE_ROW)
    for name, values in (("h1", h1), ("h2", h2), ("doc", doc), ("start", start), ("n", n)):
        phrases[name] = values[stays]
    phrase_bucket = (h1[stays] % np.uint64(buckets)).astype(np.int64)
    spans = np.zeros(int((~stays).sum()), SPAN_ROW)
    for name, values in (("doc", doc), ("start", start), ("n", n)):
        spans[name] = values[~stays]

    # one occurrence of a k-gram for each phrase; those shared within the batch are known to be
    use = stays[of]
    gram, sides, of = gram[use], sides[use], of[use]
    bucket = (gram % np.uint64(buckets)).astype(np.int64)
    code = ((gram >> np.uint64(40)) << np.uint64(40)) | (h1[of] & np.uint64((1 << 40) - 1))
    order, starts = _groups(bucket, code, sides, key[of])
    order = order[starts]
    bucket, code, sides, of = bucket[order], code[order], sides[order], of[order]
    known = _shared_by_bucket(bucket, code, sides, key[of])
    told = [(doc[of[known]], _address(bucket[known], code[known]))]
    # one of each kind of context goes on for them
    rest = np.flatnonzero(~known)
    if known.any():
        own = np.flatnonzero(known)
        order, starts = _groups(bucket[own], code[own] >> np.uint64(40), sides[own], key[of[own]])
        _, heads = _groups(bucket[own], code[own] >> np.uint64(40), sides[own])
        rest = np.concatenate([rest, own[order[heads]]])
    grams = np.zeros(len(rest), GRAM_ROW)
    grams["code"], grams["sides"], grams["doc"] = code[rest], sides[rest], doc[of[rest]]
    gram_bucket = bucket[rest]

    phrase_order = np.argsort(phrase_bucket, kind="stable")
    gram_order = np.lexsort((grams["doc"], gram_bucket))
    phrases, grams = phrases[phrase_order], grams[gram_order]
    phrase_at = np.searchsorted(phrase_bucket[phrase_order], np.arange(buckets + 1))
    gram_at = np.searchsorted(gram_bucket[gram_order], np.arange(buckets + 1))
    out = []
    for b in range(buckets):
        own, own_grams = phrases[phrase_at[b] : phrase_at[b + 1]].copy(), grams[gram_at[b] : gram_at[b + 1]].copy()
        if not len(own) and not len(own_grams):
            continue
        used = np.zeros(len(ids), bool)
        used[own["doc"]] = True
        used[own_grams["doc"]] = True
        number = np.cumsum(used) - 1
        own["doc"], own_grams["doc"] = number[own["doc"]], number[own_grams["doc"]]
        out.append((b, _packed_ids(ids[used]), own.tobytes(), _packed_grams(own_grams), b""))
    settled = np.zeros(len(told[0][0]), np.dtype([("doc", "<u4"), ("start", "<u8")]))
    settled["doc"], settled["start"] = told[0]
    if len(spans) or len(settled):
        b = int(ids[0]) % buckets
        out.append((b, _packed_ids(ids), b"", b"", len(spans).to_bytes(8, "little") + spans.tobytes() + settled.tobytes()))
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), *[pa.array([r[k] for r in out], pa.binary()) for k in range(1, 5)]], BATCH.names
        )


def _packed_ids(ids: np.ndarray) -> bytes:
    """Differences of neighbours, which compress well."""
    return np.diff(ids, prepend=np.int64(0)).tobytes()


def _packed_grams(rows: np.ndarray) -> bytes:
    """Column by column, which compresses better than row by row."""
    return b"".join(rows[name].tobytes() for name in GRAM_ROW.names)


def _unpacked_grams(raw: bytes) -> list[np.ndarray]:
    n = len(raw) // GRAM_ROW.itemsize
    return [np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "<u2", n, 8 * n), np.frombuffer(raw, "<u2", n, 10 * n)]


def _address(bucket: np.ndarray, code: np.ndarray) -> np.ndarray:
    """What names a k-gram to all tasks: its bucket and the upper bits of its code."""
    return (bucket.astype(np.uint64) << np.uint64(24)) | (code >> np.uint64(40))


def _shared_by_bucket(bucket, code, sides, doc) -> np.ndarray:
    """``_shared`` with the bucket as part of the k-gram."""
    order, starts = _groups(bucket, code >> np.uint64(40))
    number = np.empty(len(code), np.uint64)
    number[order] = _spread(np.arange(len(starts), dtype=np.uint64), starts, len(code))
    return _shared((number << np.uint64(40)) | (code & np.uint64((1 << 40) - 1)), sides, doc)


def _settle(bucket_table: pa.Table) -> pa.Table:
    """Spans that go, and k-grams that several phrases share (with ``n`` = -1), of one bucket."""
    phrases, phrase_ids, grams, out = [], [], [], [[], [], []]
    bucket = bucket_table.column("bucket")[0].as_py()
    for docs, packed, packed_grams, spans in zip(*(bucket_table.column(c).to_pylist() for c in ("docs", "phrases", "grams", "spans"))):
        ids = np.cumsum(np.frombuffer(docs, np.int64))
        own = np.frombuffer(packed, PHRASE_ROW)
        phrases.append(own)
        phrase_ids.append(ids[own["doc"]])
        code, sides, doc = _unpacked_grams(packed_grams)
        grams.append((code, sides, ids[doc]))
        if spans:
            n = int.from_bytes(spans[:8], "little")
            split = 8 + n * SPAN_ROW.itemsize
            gone = np.frombuffer(spans[8:split], SPAN_ROW)
            told = np.frombuffer(spans[split:], np.dtype([("doc", "<u4"), ("start", "<u8")]))
            out[0] += [ids[gone["doc"]], ids[told["doc"]]]
            out[1] += [gone["start"].astype(np.int64), told["start"].astype(np.int64)]
            out[2] += [gone["n"].astype(np.int64), np.full(len(told), -1)]
    rows, key = np.concatenate(phrases), np.concatenate(phrase_ids)
    if len(rows):
        order, heads = _groups(rows["h1"], rows["h2"])
        earliest = np.empty(len(rows), np.int64)
        earliest[order] = _spread(np.minimum.reduceat(key[order], heads), heads, len(rows))
        late = key > earliest
        out[0].append(key[late])
        out[1].append(rows["start"][late].astype(np.int64))
        out[2].append(rows["n"][late].astype(np.int64))
    code, sides, doc = (np.concatenate([g[k] for g in grams]) for k in range(3))
    if len(code):
        # the smallest document that has a phrase is asked for its strings
        order, starts = _groups(code, sides, doc)
        _, heads = _groups(code, sides)
        first = order[heads]
        shared = first[_shared(code[first], sides[first], doc[first])]
        address = np.unique(np.column_stack([doc[shared], _address(np.full(len(shared), bucket), code[shared]).astype(np.int64)]), axis=0)
        out[0].append(address[:, 0])
        out[1].append(address[:, 1])
        out[2].append(np.full(len(address), -1))
    return pa.table([pa.array(np.concatenate(o) if o else np.zeros(0, np.int64), pa.int64()) for o in out], ["doc", "start", "n"])


def _heavy(settled: DataFrame, heavy: int) -> np.ndarray:
    """The k-grams for which more than ``heavy`` documents are asked, in order; at most ``MOST_HEAVY``."""
    asks = settled.where("n < 0")
    limit = max(heavy, asks.count() // MOST_HEAVY)
    return asks.groupBy("start").agg(F.count("*").alias("n")).where(F.col("n") > limit).orderBy("start").toArrow()["start"].to_numpy()


def _suffixes(asked: DataFrame, buckets: int, addresses: int, length: int, heavy) -> DataFrame:
    """The strings around the k-grams that documents are asked for, packed by bucket; equal ones of a batch once.

    Strings around a ``heavy`` k-gram go each to the bucket of its own hash, so that no bucket gets all that surrounds one k-gram.
    """

    def rows(batches):
        import zstandard

        unpack, split = zstandard.ZstdDecompressor().decompress, heavy.value.astype(np.uint64)
        for batch in _smaller(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = pa.array([unpack(t) for t in batch.column(1).to_pylist()], pa.large_binary())
            wanted = batch.column(2)
            parts, where = [], [[], [], []]
            for i, j, data, offsets in ragged.chunks(texts):
                p = Parse(data, offsets, length, phrases=False)
                if not len(p.run):
                    continue
                gram = p.codes()
                doc = p.doc[p.of]
                address = _address((gram % np.uint64(addresses)).astype(np.int64), gram)
                flat = wanted.slice(i, j - i)
                asks = flat.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
                asker = np.repeat(np.arange(j - i), pa.compute.list_value_length(flat).to_numpy(zero_copy_only=False))
                mark = lambda who, what: ragged.mixed(what ^ ragged.mixed(who.astype(np.uint64)))
                hit = np.flatnonzero(np.isin(mark(doc, address), mark(asker, asks)))
                begin, end, doc, bucket = p.run[hit], p.run_stop[hit], doc[hit], address[hit] % np.uint64(buckets)
                apart = np.isin(address[hit], split) if len(split) else np.zeros(len(hit), bool)
                if apart.any():
                    n = (end - begin)[apart]
                    each = np.repeat(begin[apart] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    begin, end = np.concatenate([begin[~apart], each]), np.concatenate([end[~apart], each + 1])
                    doc = np.concatenate([doc[~apart], np.repeat(doc[apart], n)])
                    bucket = np.concatenate([bucket[~apart], p.rolling.hashes(each, each + length) % np.uint64(buckets)])
                parts.append((take_ragged(data, begin, end - begin + length - 1), end - begin + length - 1))
                where[0].append(doc + i)
                where[1].append(begin - offsets[doc])
                where[2].append(bucket)
            if not parts:
                continue
            data, sizes = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
            doc, start, bucket = (np.concatenate(w) for w in where)
            yield from _pack_suffixes(data, sizes, ids[doc], start, bucket.astype(np.int64), buckets)

    fields = "bucket long, docs binary, rows binary, data binary"
    return asked.select("doc", "packed", "asks").mapInArrow(tidy(rows), fields)


def _smaller(batches):
    """Batches whose compressed texts are a quarter of a slice, or one text."""
    for batch in batches:
        for lo, hi in ragged.runs(ragged.flat(batch.column(1))[1], SLICE_BYTES // 4):
            yield batch.slice(lo, hi - lo)


def _pack_suffixes(data, sizes, key, start, bucket, buckets: int):
    at = np.cumsum(sizes) - sizes
    content, other = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    for lo, hi in ragged.runs(np.append(at, len(data))):
        here, begin = data[at[lo] : at[hi - 1] + sizes[hi - 1]], at[lo:hi] - at[lo]
        for values, noise in ((content, ONE), (other, TWO)):
            values[lo:hi] = ragged.Rolling(here, noise).hashes(begin, begin + sizes[lo:hi])
    # of equal segments the smallest document's speaks; for the others an empty one is sent to be settled here
    order, heads = _groups(content, other)
    earliest = np.empty(len(key), np.int64)
    earliest[order] = _spread(np.minimum.reduceat(key[order], heads), heads, len(key)) if len(key) else earliest
    late = key > earliest
    rows = np.zeros(len(key), SEGMENT_ROW)
    rows["start"], rows["size"], rows["late"] = start, sizes, late
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    out = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[b] : edges[b + 1]]
        kept = own[~late[own]]
        out.append((b, _packed_ids(key[own]), rows[own].tobytes(), take_ragged(data, at[kept], sizes[kept]).tobytes()))
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), *[pa.array([r[k] for r in out], pa.binary()) for k in (1, 2, 3)]],
            ["bucket", "docs", "rows", "data"],
        )


def suffix_array(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes that begin at ``at`` by their first ``length`` bytes, and where runs of equal ones begin."""
    words = -(-length // 8)
    padded = np.concatenate([data, np.zeros(8 * words, np.uint8)])
    keys = []
    for w in range(words):
        block = np.zeros((len(at), 8), np.uint8)
        for k in range(min(8, length - 8 * w)):
            block[:, k] = padded[at + 8 * w + k]
        keys.append(block.view(">u8")[:, 0].astype(np.uint64))
    return _groups(*keys)


def _ordered(bucket_table: pa.Table, length: int, at_once: int = PASS) -> pa.Table:
    """Spans of strings that a smaller document has, of one bucket.

    Beside the strings' bytes there is a hash for each string; the rest is done for ``at_once`` strings at a time, dealt out by hash.
    """
    data, segments, out = [], [], []
    for docs, packed, raw in zip(*(bucket_table.column(c).to_pylist() for c in ("docs", "rows", "data"))):
        ids = np.cumsum(np.frombuffer(docs, np.int64))
        rows = np.frombuffer(packed, SEGMENT_ROW)
        late = rows["late"] > 0
        if late.any():
            out.append((ids[late], rows["start"][late], rows["size"][late].astype(np.int64) - length + 1))
        segments.append((ids[~late], rows["start"][~late], rows["size"][~late].astype(np.int64)))
        data.append(np.frombuffer(raw, np.uint8))
    data = np.concatenate(data)
    key, start, size = (np.concatenate([s[k] for s in segments]) for k in range(3))
    at = np.cumsum(size) - size
    n = size - length + 1
    first = np.cumsum(n) - n  # the strings' numbers
    total = int(n.sum())
    hashes = np.empty(total, np.uint64)
    for lo, hi in ragged.runs(np.append(at, len(data))):
        rolling = ragged.Rolling(data[at[lo] : at[hi - 1] + size[hi - 1]], ONE)
        place = np.repeat(at[lo:hi] - at[lo] - (first[lo:hi] - first[lo]), n[lo:hi]) + np.arange(int(n[lo:hi].sum()))
        hashes[first[lo] : first[lo] + len(place)] = rolling.hashes(place, place + length)
    gone = []
    passes = max(1, -(-total // at_once))
    for k in range(passes):
        own = np.flatnonzero(hashes % np.uint64(passes) == k) if passes > 1 else np.arange(total)
        segment = np.searchsorted(first, own, "right") - 1
        who = key[segment]
        # only strings whose hash several documents have need sorting
        order, heads = _groups(hashes[own])
        if not len(order):
            continue
        several = np.minimum.reduceat(who[order], heads) != np.maximum.reduceat(who[order], heads)
        keep = order[_spread(several, heads, len(order))]
        own, segment, who = own[keep], segment[keep], who[keep]
        if len(own):
            order, heads = suffix_array(data, at[segment] + own - first[segment], length)
            earliest = _spread(np.minimum.reduceat(who[order], heads), heads, len(order))
            gone.append(own[order[who[order] > earliest]])
    if gone:
        gone = np.sort(np.concatenate(gone))
        segment = np.searchsorted(first, gone, "right") - 1
        fresh = np.ones(len(gone), bool)
        fresh[1:] = (np.diff(gone) > 1) | (segment[1:] != segment[:-1])
        heads = np.flatnonzero(fresh)
        out.append((key[segment[heads]], (start[segment] + gone - first[segment])[heads], np.diff(np.append(heads, len(gone)))))
    return pa.table([pa.array(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64), pa.int64()) for k in range(3)], ["doc", "start", "n"])


def _packed(docs: DataFrame) -> DataFrame:
    """``doc``, the text compressed for the shuffle as ``packed``, and the other columns."""

    def rows(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary()).to_pylist()
            packed = pa.array([None if t is None else pack(t) for t in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, *batch.columns[2:]], ["doc", "packed", *batch.schema.names[2:]])

    fields = T.StructType([docs.schema["doc"], T.StructField("packed", T.BinaryType()), *docs.schema.fields[2:]])
    return docs.mapInArrow(tidy(rows), fields)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, heavy: int = HEAVY) -> DataFrame:
    """(``doc``, ``start``, ``n``): ``n`` strings of ``length`` bytes from ``start`` on that also begin in a smaller document.

    Spans of a document may repeat and overlap. Rows with a NULL key neither lose nor take anything.
    """
    if length <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).where(F.col(key).isNotNull() & (F.octet_length(text) >= length))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(1 << 30, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))))

    def settle(rows: pa.Table) -> pa.Table:
        try:
            return _settle(rows)
        finally:
            released()

    def ordered(rows: pa.Table) -> pa.Table:
        try:
            return _ordered(rows, length)
        finally:
            released()

    settled = stored(_parsed(texts, buckets, length).groupBy("bucket").applyInArrow(settle, SPAN), "settled")
    asks = settled.where("n < 0").groupBy("doc").agg(F.collect_set("start").alias("asks"))
    asked = _packed(texts).join(asks, "doc")
    split = spark.sparkContext.broadcast(_heavy(settled, heavy))
    sorted_spans = _suffixes(asked, buckets, buckets, length, split).groupBy("bucket").applyInArrow(ordered, SPAN)
    return settled.where("n > 0").unionByName(stored(sorted_spans, "sorted"))


def _runs(starts: np.ndarray, sizes: np.ndarray, length: int, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that the strings cover."""
    order = np.argsort(starts, kind="stable")
    begin, end = starts[order], np.minimum(starts[order] + sizes[order] + length - 1, n_bytes)
    reach = np.maximum.accumulate(end) if len(end) else end
    fresh = np.ones(len(begin), bool)
    fresh[1:] = begin[1:] > reach[:-1]
    heads = np.flatnonzero(fresh)
    return begin[heads], reach[np.append(heads[1:], len(begin)) - 1] if len(heads) else reach


def _kept(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, end, -1)
    return np.cumsum(edges[:-1]) == 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, texts: bool = False) -> DataFrame:
    """Per row: the key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``; with ``texts`` instead all columns, the text cut.

    Every byte goes that lies in a string of ``length`` bytes which also begins in a document with a
    smaller key. Strings are compared in the texts as given, and none crosses documents. A cut text
    keeps a character of which a byte stays; NULL stays NULL. NULL and empty texts have no bytes. Keys should be
    distinct: equal keys take nothing from each other, and rows with one key all lose the spans found
    for any of them. Rows with a NULL key stay whole. An empty table gives an empty table.
    """
    spans = repeated_spans(docs, key, text, length).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    kind = docs.schema[key].dataType
    others = [c for c in docs.columns if texts and c not in (key, text)]
    rows_in = (
        _packed(docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), *_renamed(others)))
        .join(spans, "doc", "left")
        .select("doc", "packed", F.col("spans.start").alias("start"), F.col("spans.n").alias("n"), *[f"c{i}" for i in range(len(others))])
    )
    fields = T.StructType([T.StructField("doc", T.LongType())])
    if texts:
        fields = fields.add("text", "string")
        for i, c in enumerate(others):
            fields = fields.add(f"c{i}", docs.schema[c].dataType)
    else:
        for name, t in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")):
            fields = fields.add(name, t)

    def rows(batches):
        import zstandard

        unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor().compress
        for batch in _smaller(batches):
            out = [[], [], [], []]
            for i, packed in enumerate(batch.column(1).to_pylist()):
                if packed is None:
                    packed = pack(b"")
                data = np.frombuffer(unpack(packed), np.uint8)
                stays, n_spans = None, 0
                if batch.column(2)[i].is_valid:
                    starts, sizes = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (2, 3))
                    inside = starts < len(data)
                    begin, end = _runs(starts[inside], sizes[inside], length, len(data))
                    stays, n_spans = _kept(data, begin, end), len(begin)
                if texts:
                    if stays is not None and len(data):  # whole characters
                        heads = np.cumsum((data & 0xC0) != 0x80) - 1
                        whole = np.zeros(heads[-1] + 1, bool)
                        whole[heads[stays]] = True
                        data = data[whole[heads]]
                    out[0].append(data.tobytes().decode("utf-8", "replace"))
                else:
                    kept = data if stays is None else data[stays]
                    for column, value in zip(out, (len(data), len(data) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())):
                        column.append(value)
            if texts:
                null = batch.column(1).is_null()
                cut = pa.array(out[0], pa.string())
                columns = [batch.column(0), pa.compute.if_else(null, pa.scalar(None, pa.string()), cut), *batch.columns[4:]]
            else:
                columns = [batch.column(0), *[pa.array(o, pa.int64()) for o in out[:3]], pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, fields.names)

    found = rows_in.mapInArrow(tidy(rows), fields)
    if not texts:
        return found.select(F.col("doc").cast(kind).alias(key), *found.columns[1:])
    place = {key: F.col("doc").cast(kind), text: F.col("text"), **{c: F.col(f"c{i}") for i, c in enumerate(others)}}
    return found.select(*[place[c].alias(c) for c in docs.columns])


def _renamed(columns: list[str]) -> list:
    """Columns under names that clash with none of ours."""
    return [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))

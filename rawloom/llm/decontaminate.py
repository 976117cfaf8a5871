"""Benchmark decontamination: Wu-Manber search for all windows of all benchmark items at once.

Texts are words; a pattern is a window of words. Patterns of one length share a shift table over
hashed blocks of two words: it says how far the search may skip from a block before a pattern
can end there. Where the shift is 0, the block's suffix bucket names the patterns that end so;
those whose first block also agrees are compared word by word. All texts of a batch are searched
together, in lanes that advance by their own shifts.
"""

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .frames import stored, table, tidy

WINDOW = 13
#: Bytes of benchmark text that one broadcast holds; larger benchmarks are searched in several passes.
PASS_BYTES = 8 << 20
LANE = 256

IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0") : ord("9") + 1] = IS_WORD[ord("a") : ord("z") + 1] = IS_WORD[ord("A") : ord("Z") + 1] = IS_WORD[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
TABLE = ragged.lowered_table(3)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words, and each text's first word."""
    starts, ends, first = ragged.word_spans(data, offsets, IS_WORD)
    return starts, ends, ragged.Rolling(data, TABLE).hashes(starts, ends), first


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Words in lower case with a blank between them."""
    raw = LOWER[data[starts[0] : ends[-1]]].tobytes()
    return b" ".join(raw[a:b] for a, b in zip((starts - starts[0]).tolist(), (ends - starts[0]).tolist()))


class Patterns:
    """All windows of one length, as places among the words of all items: ``place`` is a window's first word.

    Equal windows, told by 128 bits of hash, are one pattern; ``owners`` are the numbers of the items that have it.
    """

    def __init__(self, length: int, place: np.ndarray, item: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, data: np.ndarray):
        m, block = length, min(2, length)
        self.length, self.block = length, block
        self.starts, self.ends, self.hashes, self.data = starts, ends, hashes, data
        marks = []
        for seed in (41, 42):
            factors = ragged.noise(m, seed) | np.uint64(1)
            marks.append(sum(((hashes[place + k] * factors[k]) for k in range(m)), np.zeros(len(place), np.uint64)))
        order = np.lexsort((item, *marks))
        fresh = np.ones(len(order), bool)
        for mark in marks:
            mark[:] = mark[order]
        fresh[1:] = (marks[0][1:] != marks[0][:-1]) | (marks[1][1:] != marks[1][:-1])
        heads = np.flatnonzero(fresh)
        self.place, self.owners = place[order[heads]], item[order]
        self.owners_at = np.append(heads, len(order))
        # a slot for each block many times over, so that few blocks of other texts meet one
        self.bits = int(np.clip(np.ceil(np.log2(max(len(heads), 1) * 8)), 16, 24))
        self.shift = np.full(1 << self.bits, m - block + 1, np.int8 if m < 128 else np.int64)
        for j in range(m - block + 1):  # later blocks are nearer to the end and so need less
            slot = self.slots(hashes[self.place + j], hashes[self.place + j + block - 1], self.bits)
            self.shift[slot] = np.minimum(self.shift[slot], m - block - j)
        suffix = self.slots(hashes[self.place + m - block], hashes[self.place + m - 1], self.bits)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order].astype(np.int32)

    def items(self, pattern: int) -> list[int]:
        return self.owners[self.owners_at[pattern] : self.owners_at[pattern + 1]].tolist()

    def spelled(self, pattern: int) -> bytes:
        own = slice(self.place[pattern], self.place[pattern] + self.length)
        return spelled(self.data, self.starts[own], self.ends[own])

    @staticmethod
    def slots(first: np.ndarray, last: np.ndarray, bits: int) -> np.ndarray:
        x = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (last + (first >> np.uint64(7)))
        return ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)

    def search(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of the occurrences by their hashes; none crosses texts."""
        m, none = self.length, np.zeros(0, np.int64)
        sizes = np.diff(first)
        # a lane tests the windows that end in its part of a text
        long = np.flatnonzero(sizes >= m)
        if not len(long) or not len(self.place):
            return none, none
        lanes = -(-(sizes[long] - m + 1) // LANE)
        text = np.repeat(long, lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = first[text] + m - 1 + nth * LANE
        stop = np.minimum(at + LANE, first[text + 1])
        found_at, found = [], []
        while len(at):
            slot = self.slots(hashes[at - self.block + 1], hashes[at], self.bits)
            step = self.shift[slot]
            hit = np.flatnonzero(step == 0)
            if len(hit):
                here, slot = at[hit], slot[hit]
                bucket = np.searchsorted(self.suffix, slot, "left")
                n = np.searchsorted(self.suffix, slot, "right") - bucket
                where = np.repeat(here, n)
                offset = np.arange(len(where)) - np.repeat(np.cumsum(n) - n, n)
                pattern = self.order[np.repeat(bucket, n) + offset]
                begin = where - m + 1
                for k in (0, m - 1, *range(1, m - 1)):
                    same = hashes[begin + k] == self.hashes[self.place[pattern] + k]
                    begin, pattern = begin[same], pattern[same]
                    if not len(begin):
                        break
                found_at.append(begin)
                found.append(pattern)
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        return (np.concatenate(found_at), np.concatenate(found)) if found else (none, none)


def patterns(items: list[tuple[object, bytes]], window: int = WINDOW) -> list[Patterns]:
    """The windows of the items, by length: of ``window`` words, and whole items of fewer."""
    data = np.frombuffer(b"".join(raw for _, raw in items), np.uint8)
    starts, ends, hashes, first = words(data, np.cumsum([0, *(len(raw) for _, raw in items)]))
    sizes = np.diff(first)
    out = []
    for m in np.unique(np.minimum(sizes, window)).tolist():
        own = np.flatnonzero(np.minimum(sizes, window) == m)
        if m:
            n = sizes[own] - m + 1
            place = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out.append(Patterns(m, place, np.repeat(own, n), starts, ends, hashes, data))
    return out


@dataclass
class Kept:
    """The index that a worker has built last, which its next tasks use again."""

    name: str = ""
    index: list[Patterns] = field(default_factory=list)

    def of(self, name: str, items: list[tuple[object, bytes]], window: int) -> list[Patterns]:
        if name != self.name:
            self.name, self.index = name, patterns(items, window)
        return self.index


_kept = Kept()


def search(data: np.ndarray, offsets: np.ndarray, all_patterns: list[Patterns], names: list) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set]]:
    """Per text: its words, the runs of hit words (first, after the last), and the items found."""
    starts, ends, hashes, first = words(data, offsets)
    n = len(offsets) - 1
    runs: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    items: list[set] = [set() for _ in range(n)]
    edge = np.zeros(len(starts) + 1, np.int64)
    for p in all_patterns:
        at, which = p.search(hashes, first)
        owner = np.searchsorted(first, at, "right") - 1
        for a, k, text in zip(at.tolist(), which.tolist(), owner.tolist()):
            if spelled(data, starts[a : a + p.length], ends[a : a + p.length]) == p.spelled(k):
                edge[a] += 1
                edge[a + p.length] -= 1
                items[text].update(names[i] for i in p.items(k))
    hit = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    turns = np.flatnonzero(hit[1:] != hit[:-1])
    # runs of neighbouring texts may touch: cut them where a text begins
    for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
        while a < b:
            text = int(np.searchsorted(first, a, "right")) - 1
            end = min(b, int(first[text + 1]))
            runs[text].append((a - int(first[text]), end - int(first[text])))
            a = end
    return np.diff(first), runs, items


def _passes(benchmark: DataFrame, key: str, text: str, limit: int):
    """The number of passes, and an iterator over their groups of items of about ``limit`` bytes; the driver has one group at a time."""
    items = benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0
    n = max(1, -(-size // limit))
    if n > 1:
        items = stored(items.distinct().withColumn("pass", F.pmod(F.xxhash64("item", "text"), F.lit(n))), "items")

    def groups():
        for k in range(n):
            rows = items.where(F.col("pass") == k) if n > 1 else items
            yield [(row["item"], row["text"].encode()) for row in rows.select("item", "text").collect()]

    return n, groups()


FOUND = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("hit_runs", T.ArrayType(T.ArrayType(T.IntegerType(), False), False), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
])


def _named(items: list[tuple[object, bytes]]) -> tuple[str, list[tuple[object, bytes]]]:
    """Items under a name of their own, by which workers know an index that they have built."""
    return uuid.uuid4().hex, items


def occurrences(docs: DataFrame, shared: Broadcast, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One pass over broadcast items: the key, ``n_words``, ``hit_runs`` and ``items`` of every row."""
    fields = T.StructType([docs.schema[key], *FOUND.fields])

    def rows(batches):
        name, items = shared.value
        own, item_names = _kept.of(name, items, window), [i for i, _ in items]
        for batch in batches:
            for i, j, data, offsets in ragged.chunks(batch.column(1)):
                n, runs, found = search(data, offsets, own, item_names)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(n, pa.int64()),
                        pa.array(runs, pa.list_(pa.list_(pa.int32()))),
                        pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                    ],
                    [f.name for f in fields],
                )

    return docs.select(key, text).mapInArrow(tidy(rows), fields)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The key of every document with ``n_words``, the runs of its words inside benchmark windows and the items they are from.

    The benchmark is read to the driver in groups of about ``pass_bytes``, one at a time, and each group is
    searched in a pass of its own. With several passes the rows are numbered and stored before, the hits of
    all passes are stored, and each row gets its own by number. Rows are searched one by one: repeated rows,
    and rows without a key, stay. NULL and empty texts have no words; items with a NULL key or text, or
    without words, find nothing; items of one text are all found. An empty table on either side gives no
    hits. Further columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    n, groups = _passes(benchmark, item, "text", pass_bytes)
    if n == 1:
        return occurrences(docs, context.broadcast(_named(next(groups))), key, text, window)
    row = F.struct(F.monotonically_increasing_id().alias("number"), F.col(key).alias("key"))
    numbered = stored(docs.select(row.alias("row"), F.col(text).alias("text")), "documents")
    first, hits = None, None
    for group in groups:
        shared = context.broadcast(_named(group))
        found = occurrences(numbered, shared, "row", "text", window)
        if first is None:
            first = found = stored(found.select("row", "n_words", "hit_runs", "items"), "found")
        own = found.where(F.size("items") > 0).select("row.number", "hit_runs", "items")
        own = own if found is first else stored(own, "hits")
        hits = own if hits is None else hits.unionByName(own)
        shared.destroy()
    merged = hits.groupBy("number").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_runs")))).alias("hit_runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    # runs in order of their first word, joined where they overlap
    joined = F.aggregate(
        "hit_runs",
        F.array().cast("array<array<int>>"),
        lambda done, run: F.when(
            (F.size(done) > 0) & (F.element_at(F.element_at(F.when(F.size(done) > 0, done).otherwise(F.array(run)), -1), 2) >= run[0]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.array(F.get(F.get(done, F.size(done) - 1), F.lit(0)), F.greatest(F.get(F.get(done, F.size(done) - 1), F.lit(1)), run[1]))),
            ),
        ).otherwise(F.concat(done, F.array(run))),
    )
    merged = merged.withColumn("hit_runs", joined)
    no_runs, no_items = F.array().cast("array<array<int>>"), F.array().cast("array<string>")
    return first.select("row", "n_words").join(merged, F.col("row.number") == F.col("number"), "left").select(
        F.col("row.key").alias(key), "n_words", F.coalesce("hit_runs", no_runs).alias("hit_runs"), F.coalesce("items", no_items).alias("items")
    )


def op3_columns(found: DataFrame, key: str = "doc_id") -> DataFrame:
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda total, run: total + (run[1] - run[0]))
    return found.select(
        key,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_columns(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))

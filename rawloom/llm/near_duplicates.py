"""MinHash near-duplicates: universal hash minima, banding, signature and set verification, components.

Every text becomes its set of distinct word shingles. Texts with equal sets are one class, for which
the smallest key stands. Minima of many universal hash functions over a set are cut into bands; texts
that agree in a band are candidates. Candidates are compared first by signature (two bits of each
minimum), then by their full sets. In each band's bucket all texts are compared with its centre, the text
that meets most others. Two others of the bucket can then only be a link across components if they
share shingles that the centre lacks, and only such pairs are compared. So a bucket of many copies
costs one comparison a copy, and no link is missed that could join two components.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged
from .components import components
from .frames import broadcastable, stored, table, tidy

SHINGLE = 5
BANDS, ROWS = 28, 4
#: Bits of 224 in which signatures may differ: over six standard deviations more than sets of similarity 0.8 do.
DIFFERENT_BITS = 58
#: Texts in a bucket of which pairs are compared directly.
BUCKET = 1000
#: Keys that a broadcast may hold.
SMALL = 1_000_000

IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
TABLE = ragged.lowered_table(2)
PLACE = ragged.noise(SHINGLE, 11) | np.uint64(1)
FACTORS = ragged.noise(BANDS * ROWS, 12) | np.uint64(1)
SUMMANDS = ragged.noise(BANDS * ROWS, 13)
BAND_SEEDS = ragged.noise(BANDS, 14)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of each text's distinct shingles, and each text's offset among them."""
    starts, ends, first = ragged.word_spans(data, offsets, IS_WORD)
    words = ragged.Rolling(data, TABLE).hashes(starts, ends)
    n = np.diff(first)
    sizes = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    total = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        total += words[k : k + len(total)] * PLACE[k]
    at = np.concatenate([[0], np.cumsum(sizes)])
    hashes = np.zeros(int(at[-1]), np.uint64)
    for i in range(len(n)):
        a, b = at[i], at[i + 1]
        if n[i] >= SHINGLE:
            hashes[a:b] = total[first[i] : first[i] + b - a]
        elif n[i]:
            hashes[a] = (words[first[i] : first[i + 1]] * PLACE[: n[i]]).sum(dtype=np.uint64) + np.uint64(n[i])
    hashes = ragged.mixed(hashes)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[at[:-1][sizes > 0]] = True
    return hashes[fresh], np.concatenate([[0], np.cumsum(fresh)])[at]


def signatures(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (texts x BANDS) and sketches (texts x 4 words) of nonempty sets."""
    n = len(at) - 1
    minima = np.empty((n, BANDS * ROWS), np.uint64)
    for k in range(BANDS * ROWS):
        minima[:, k] = np.minimum.reduceat(hashes * FACTORS[k] + SUMMANDS[k], at[:-1])
    minima = ragged.mixed(minima)
    bands = np.tile(BAND_SEEDS, (n, 1))
    for k in range(ROWS):
        bands = ragged.mixed(bands * np.uint64(0x9E3779B97F4A7C15) + minima[:, k::ROWS])
    bits = np.zeros((n, 256), np.uint8)
    bits[:, : BANDS * ROWS] = (minima >> np.uint64(63)).astype(np.uint8)
    bits[:, 128 : 128 + BANDS * ROWS] = ((minima >> np.uint64(62)) & np.uint64(1)).astype(np.uint8)
    return bands, np.packbits(bits, axis=1).view(np.int64)


SIGNED = T.StructType([
    T.StructField("n_shingles", T.LongType(), False),
    T.StructField("f1", T.LongType(), False),
    T.StructField("f2", T.LongType(), False),
    T.StructField("bands", T.ArrayType(T.LongType(), False), False),
    T.StructField("sketch", T.ArrayType(T.LongType(), False), False),
])


def _signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    fields = T.StructType([T.StructField("doc", docs.schema[key].dataType), *SIGNED.fields])

    def lists(values: np.ndarray, full: np.ndarray, width: int) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(np.where(full, width, 0))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.reshape(-1).view(np.int64)))

    def rows(batches):
        for batch in batches:
            for i, j, data, offsets in ragged.chunks(batch.column(1)):
                hashes, at = shingle_sets(data, offsets)
                n = np.diff(at)
                full = n > 0
                print_1, print_2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                bands, sketch = np.zeros((0, BANDS), np.uint64), np.zeros((0, 4), np.int64)
                if full.any():
                    own = np.append(at[:-1][full], at[-1])
                    bands, sketch = signatures(hashes, own)
                    print_1[full] = np.add.reduceat(hashes, own[:-1])
                    print_2[full] = np.bitwise_xor.reduceat(hashes * FACTORS[0] ^ (hashes >> np.uint64(29)), own[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(n, pa.int64()),
                        pa.array(print_1.view(np.int64)),
                        pa.array(print_2.view(np.int64)),
                        lists(bands, full, BANDS),
                        lists(sketch, full, 4),
                    ],
                    [f.name for f in fields],
                )

    return docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(tidy(rows), fields)


def _sets(docs: DataFrame) -> DataFrame:
    """``doc`` and ``set``, the sorted hashes of its shingles."""
    fields = T.StructType([docs.schema["doc"], T.StructField("set", T.BinaryType())])

    def rows(batches):
        for batch in batches:
            for i, j, data, offsets in ragged.chunks(batch.column(1)):
                hashes, at = shingle_sets(data, offsets)
                raw = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(raw, pa.binary())], [f.name for f in fields])

    return docs.select("doc", "text").mapInArrow(tidy(rows), fields)


def _agree(left, right, percent: int):
    """Whether sizes and signatures of two texts allow the similarity."""
    bits = sum((F.bit_count(F.get(left["sketch"], F.lit(k)).bitwiseXOR(F.get(right["sketch"], F.lit(k)))) for k in range(4)), F.lit(0))
    small, large = F.least(left["n"], right["n"]), F.greatest(left["n"], right["n"])
    return (100 * small >= percent * large) & (bits <= DIFFERENT_BITS)


TESTED = T.StructType([
    T.StructField("both", T.LongType()),
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("extras", T.ArrayType(T.LongType(), False)),
])


def _compared(pairs: DataFrame, percent: int) -> DataFrame:
    """Sizes of two sets and of their intersection; with ``more`` what the second has beyond the first.

    Of these extras a prefix (in the order of hashes) is enough: for a link with another text that
    shares fewer than ``percent`` of the second's size with the first, the rest must be among them.
    """
    fields = T.StructType([pairs.schema["a"], pairs.schema["b"], *TESTED.fields])

    def rows(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                sets = [ragged.flat(batch.column(c)) for c in (2, 3)]
                both, n_a, n_b, extras = [], [], [], []
                for i, m in enumerate(batch.column(4).to_pylist()):
                    x, y = (data[at[i] : at[i + 1]].view(np.uint64) for data, at in sets)
                    at = np.minimum(np.searchsorted(x, y), max(len(x) - 1, 0))
                    inside = x[at] == y if len(x) else np.zeros(len(y), bool)
                    n = int(inside.sum())
                    beyond = y[~inside] if m else y[:0]
                    short = max(1, -((100 * n - percent * len(y)) // 100))
                    both.append(n)
                    n_a.append(len(x))
                    n_b.append(len(y))
                    extras.append(beyond[: max(len(beyond) - short + 1, 0)].view(np.int64))
                ends = np.concatenate([[0], np.cumsum([len(e) for e in extras])])
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:2],
                        *[pa.array(c, pa.int64()) for c in (both, n_a, n_b)],
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(extras))),
                    ],
                    fields.names,
                )

    return pairs.select("a", "b", "set_a", "set_b", "more").mapInArrow(tidy(rows), fields)


def _tested(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Full comparison of pairs (``a``, ``b``, ``more``)."""
    wanted = stored(pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct(), "wanted")
    sets = stored(_sets(docs.join(_small(wanted), "doc", "left_semi")), "sets")
    compared = (
        pairs.join(sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b")), "b")
        .join(sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a")), "a")
    )
    return stored(_compared(compared, percent), "tested")


def _small(table: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it has at most ``SMALL`` rows."""
    return F.broadcast(table) if broadcastable(table, SMALL) else table


def _linked(tested: DataFrame, percent: int) -> DataFrame:
    return tested.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def _across(members: DataFrame, found: DataFrame, percent: int, homes: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """What may link components, among texts compared with the same one: pairs, and stars of large buckets.

    Two texts x, y share at most the smaller of what each shares with the text p that both were compared
    with, and what both have beyond p. So either the former is enough for a link (seldom: then the pair is
    compared), or they share a shingle of their extras beyond p. Of up to ``BUCKET`` texts that share one,
    the pairs across components are compared; of more, all with the smallest, whose group is then
    treated like p's. A pair whose texts both have most in common with another p is left to that p's group.
    """
    placed = members.join(found.withColumnRenamed("node", "b"), "b", "left").withColumn("component", F.coalesce("component", "b"))
    placed = placed.withColumn("home", F.col("a")) if homes is None else placed.join(homes, "b")
    several = placed.groupBy("a").agg((F.min("component") < F.max("component")).alias("mixed")).where("mixed").select("a")
    placed = stored(placed.join(stored(several, "several"), "a"), "mixed")
    extra = placed.select("a", "b", "component", "home", F.explode("extras").alias("shingle"))
    keys = extra.groupBy("a", "shingle").agg(
        F.count("*").alias("size"), F.min("b").alias("first"), (F.min("component") < F.max("component")).alias("mixed")
    )
    keys = stored(keys.where("mixed").select("a", "shingle", "size", "first"), "keys")
    extra = stored(extra.join(keys, ["a", "shingle"]), "extras")
    stars = extra.where((F.col("size") > BUCKET) & (F.col("first") != F.col("b"))).select(F.col("first").alias("a"), "b")

    def other(x: str, y: str):
        return (F.col(f"{x}.b") < F.col(f"{y}.b")) & (F.col(f"{x}.component") != F.col(f"{y}.component")) & (
            (F.col(f"{x}.home") != F.col(f"{y}.home")) | (F.col(f"{x}.home") == F.col(f"{x}.a")))

    few = extra.where(F.col("size") <= BUCKET)
    x, y = few.alias("x"), few.alias("y")
    pairs = x.join(y, (F.col("x.a") == F.col("y.a")) & (F.col("x.shingle") == F.col("y.shingle")) & other("x", "y"))
    pairs = pairs.select(F.col("x.b").alias("a"), F.col("y.b").alias("b"))
    # texts that share enough with p alone
    able = 100 * F.col("both") + percent * F.col("both") >= percent * (F.col("n_b") + F.ceil(F.col("n_b") * percent / 100))
    x, y = placed.where(able).alias("x"), placed.where(able).alias("y")
    least = F.least("x.both", "y.both")
    enough = 100 * least + percent * least >= percent * (F.col("x.n_b") + F.col("y.n_b"))
    whole = x.join(y, (F.col("x.a") == F.col("y.a")) & other("x", "y") & enough)
    pairs = pairs.unionByName(whole.select(F.col("x.b").alias("a"), F.col("y.b").alias("b")))
    return stored(pairs.distinct(), "pairs"), stored(stars.distinct(), "hot")


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are linked whose sets of shingles of five words have 100 * intersection >= percent * union
    (80 to 100). Words are runs of anything but ASCII white space, A-Z in lower case; a text of one to
    four words has one shingle. ``component_id`` is the smallest key that links reach. NULL, empty and
    blank texts have no shingles and no links. Keys are whole numbers and should be distinct: rows that share a key are one
    node, each with its own count, and stay or go together. Rows with a NULL key have no links, a NULL
    component and are kept. An empty table gives an empty table. Two texts of the threshold's similarity
    are missed with a probability of 4e-7 at 80 and 2e-9 at 85 percent.
    """
    if not 80 <= percent <= 100:
        raise ValueError("bands and signatures are made for similarities of 0.8 or more")
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key} must be whole numbers; number other keys first")
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    signed = stored(_signed(docs, key, text), "signed")
    able = signed.where("n_shingles > 0 AND doc IS NOT NULL")
    classes = stored(
        able.groupBy("n_shingles", "f1", "f2").agg(F.min("doc").alias("class"), F.count("*").alias("size")).where("size > 1").drop("size"), "classes"
    )
    # one text of each class goes on; a shared key joins classes besides
    # a class may hold a third of all rows: they stay where they are if the list of classes is small
    copies = able.select("doc", "n_shingles", "f1", "f2").join(_small(classes), ["n_shingles", "f1", "f2"])
    copies = stored(copies.where("doc <> class").distinct(), "copies")
    same = copies.select(F.col("class").alias("a"), F.col("doc").alias("b"))
    single = able.join(_small(copies), ["doc", "n_shingles", "f1", "f2"], "left_anti").select("doc", F.col("n_shingles").alias("n"), "sketch", "bands")
    single = stored(single, "single")

    member = single.select("doc", F.explode("bands").alias("bucket"))
    buckets = stored(member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    member = stored(member.join(buckets, "bucket"), "members")
    # each bucket's centre: the text that meets most others in all its buckets
    weight = stored(member.groupBy("doc").agg(F.sum("size").alias("weight")), "weights")
    member = member.join(weight, "doc")
    centres = stored(member.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("doc")).alias("minus"))).alias("c")), "centres")
    stars = member.join(centres, "bucket").select((-F.col("c.minus")).alias("a"), F.col("doc").alias("b")).where("a <> b").distinct()
    stars = stored(stars, "stars")
    groups = stored(stars.groupBy("a").agg((F.count("*") > 1).alias("more")), "groups")
    new = _signature_checked(stars, single.select("doc", "n", "sketch"), percent).join(groups, "a").where("more OR agree")

    # in each bucket all with its centre; then what may link across the components so found
    tested = _tested(stored(new.select("a", "b", "more"), "candidates"), texts, percent)
    edges = same.unionByName(_linked(tested, percent))
    members = tested.join(groups.where("more"), "a").drop("more")
    best = members.groupBy("b").agg(F.max(F.struct("both", (-F.col("a")).alias("minus"))).alias("best"))
    homes = stored(best.select("b", (-F.col("best.minus")).alias("home")), "homes")
    while True:
        found = stored(components(edges), "found")
        pairs, hot = _across(members, found, percent, homes)
        asked = pairs.withColumn("more", F.lit(False)).unionByName(hot.withColumn("more", F.lit(True)))
        asked = stored(asked.groupBy("a", "b").agg(F.max("more").alias("more")), "asked")
        if asked.isEmpty():
            break
        new = _tested(asked, texts, percent)
        edges = found.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(_linked(new, percent))
        # nothing else is compared with the centre of a large bucket in its group
        members, homes = new.join(hot, ["a", "b"], "left_semi"), None
    reached = _small(found.withColumnRenamed("node", "doc"))
    return (
        signed.select("doc", "n_shingles")
        .join(reached, "doc", "left")
        .select(
            F.col("doc").alias(key),
            "n_shingles",
            F.coalesce("component", "doc").alias("component_id"),
            F.coalesce(F.col("doc") == F.coalesce("component", "doc"), F.lit(True)).alias("kept"),
        )
    )


def _signature_checked(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """The pairs, and whether their signatures ``agree``."""
    a = sketch.select(F.col("doc").alias("a"), F.struct("n", "sketch").alias("left"))
    b = sketch.select(F.col("doc").alias("b"), F.struct("n", "sketch").alias("right"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", _agree(F.col("left"), F.col("right"), percent).alias("agree"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)

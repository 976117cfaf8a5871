"""Shards of equal row counts by balanced label propagation: linked documents move towards their neighbours.

Documents are linked that share a value (their text, unless told otherwise); a document's neighbours are
the others of its group. At first the linked documents are dealt out evenly. In each round Spark counts every group's
documents by shard; those outside the shard where most of their group is ask to go there. Quotas say how
many may go from each shard to each other: what comes may not exceed a shard's rows, less what leaves
it in the same round. Every second round asks only for shards that have room, so that groups which don't
fit into their best shard gather in the next. The documents without links fill the shards in the end to exactly equal
sizes, so that they leave all the room to those with links, at no cut.

Nothing but counts by pairs of shards reaches the driver. Groups are asked for in slices, so that
a group larger than a shard moves in parts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import broadcastable, stored, table

SHARDS, ROUNDS, MOST_SHARDS = 8, 12, 256
#: Slices in which the documents that go from one shard to another are let through.
SLICES = 256
#: Slices of a shard's size that a group is cut into, if it has as many documents.
PIECES = 64
#: Rows that a broadcast may hold, and blocks of rows that are numbered each by itself.
SMALL = 1_000_000
BLOCKS = 100_000


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if broadcastable(rows, SMALL) else rows


def _numbered(rows: DataFrame, block, *among: str) -> DataFrame:
    """``number``: the place of each row among those of equal ``among``, from 0, in the order of ``row``.

    Rows are numbered inside blocks; the blocks' counts are summed besides.
    """
    rows = rows.withColumn("block", block)
    counts = rows.groupBy("block", *among).agg(F.count("*").alias("n"))
    before = Window.partitionBy(*among).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.select("block", *among, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "offsets")
    inside = F.row_number().over(Window.partitionBy("block", *among).orderBy("row")) - 1
    return rows.join(_small(offsets), ["block", *among]).withColumn("number", F.col("before") + inside).drop("block", "before")


def quotas(sizes: list[int], targets: list[int], asked: dict[tuple[int, int, int], int], slices: int) -> dict[tuple[int, int], int]:
    """For each (from, to) the number of slices that may go, so that no shard exceeds its target.

    ``asked`` counts rows by (from, to, slice). All are let through at first; while a shard has too many, the
    last slice of the largest stream into it is held back, which may leave too many where it comes from.
    """
    cut = {(a, b): slices for a, b, _ in asked}
    stream = {pair: 0 for pair in cut}
    now = list(sizes)
    for (a, b, _), n in asked.items():
        stream[a, b] += n
        now[a] -= n
        now[b] += n
    while over := [s for s in range(len(now)) if now[s] > targets[s]]:
        to = max(over, key=lambda s: now[s] - targets[s])
        pair = max((p for p in cut if p[1] == to), key=lambda p: (stream[p], p))
        while stream[pair]:
            cut[pair] -= 1
            n = asked.get((*pair, cut[pair]), 0)
            if n:
                stream[pair] -= n
                now[pair[0]] += n
                now[to] -= n
                break
    return {pair: n for pair, n in cut.items() if stream[pair]}


def _gathered(linked: DataFrame, targets: list[int], rounds: int) -> tuple[DataFrame, list[int]]:
    """The linked rows (``row``, ``group``, ``members``, ``shard``) after the rounds, and their number in each shard."""
    spark = linked.sparkSession
    shards, largest = len(targets), max(1, max(targets))
    slices = max(4, min(SLICES, (1 << 16) // shards**2))
    state, idle = linked, 0
    for r in range(rounds + 1):
        tally = stored(state.groupBy("group", "shard").agg(F.count("*").alias("n")), "tally")
        told = dict(map(tuple, tally.groupBy("shard").agg(F.sum("n")).collect()))
        sizes = [told.get(s, 0) for s in range(shards)]
        if r == rounds or idle == 2 or not told:
            break
        open_ = [s for s in range(shards) if r % 2 == 0 or sizes[s] < targets[s]]
        rank = F.struct("n", F.pmod(F.xxhash64("group", "shard"), F.lit(1 << 30)).alias("tie"), F.col("shard").alias("to"))
        tally = tally.withColumn("rank", rank)
        best = tally.where(F.col("shard").isin(open_)).groupBy("group").agg(F.max("rank").alias("best"))
        wish = tally.join(best, "group").where("best > rank").select("group", "shard", F.col("best.to").alias("to"))
        wish = stored(wish, "wishes")
        pieces = F.ceil(F.col("members") * PIECES / F.lit(largest))
        piece = F.pmod(F.xxhash64("row"), F.when(F.col("members") * PIECES > largest, F.least(pieces, F.col("members"))).otherwise(1))
        sliced = state.withColumn("slice", F.pmod(F.xxhash64("group", piece, F.lit(r)), F.lit(slices)))
        counted = sliced.join(_small(wish), ["group", "shard"]).groupBy("shard", "to", "slice").agg(F.count("*").alias("n")).collect()
        let = quotas(sizes, targets, {(c["shard"], c["to"], c["slice"]): c["n"] for c in counted}, slices)
        idle = 0 if let else idle + 1
        if let:
            cuts = spark.createDataFrame([(a, b, n) for (a, b), n in let.items()], "shard int, to int, cut int")
            wish = stored(wish.join(F.broadcast(cuts), ["shard", "to"]), "let")
            goes = F.coalesce(F.col("slice") < F.col("cut"), F.lit(False))
            state = sliced.join(_small(wish), ["group", "shard"], "left").select(
                "row", "group", "members", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard")
            )
            state = stored(state, "shards")
    return state, sizes


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, key: str = "doc_id", text: str = "text", link: str | None = None) -> DataFrame:
    """Per row: the key, ``size``, ``text_crc32``, ``law`` (``rows``), ``shard``, ``slot`` and ``grown_shard``.

    Shards have equally many rows, or one more in the first ones; ``slot`` numbers a shard's rows from 0 without gaps. Rows with one
    value of ``link`` (the text, if not named) are linked and gather in as few shards as the counts let them;
    NULL links nothing, empty texts are equal. ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` their checksum; NULL has
    no bytes. ``grown_shard`` is NULL, as this law deals all rows anew for another number of shards. Repeated
    rows, and rows whose key is NULL or shared, each have a place of their own. Which shard a row gets depends on how the
    table is partitioned; counts don't. Further columns are ignored; an empty table gives an empty one.
    """
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"1 to {MOST_SHARDS} shards")
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).alias("key"),
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("crc"),
            F.unhex(F.sha2(F.col(link or text).cast("string"), 256)).alias("mark"),
        ),
        "base",
    )
    n = base.count()
    targets = [n // shards + (s < n % shards) for s in range(shards)]
    bits = max(8, math.ceil(math.log2(max(n, 1) / BLOCKS)))
    block = F.shiftright("row", bits)

    groups = base.where("mark IS NOT NULL").groupBy("mark").agg(F.count("*").alias("members"), F.min("row").alias("group")).where("members > 1")
    linked = base.select("row", "mark").join(_small(stored(groups, "groups")), "mark").select("row", "group", "members")
    dealt = _numbered(stored(linked, "linked"), block).withColumn("shard", (F.col("number") % shards).cast("int")).drop("number")
    state, sizes = _gathered(stored(dealt, "dealt"), targets, rounds)

    placed = stored(base.drop("mark").join(_small(state.select("row", "shard")), "row", "left").fillna(-1, "shard"), "placed")
    starts = [sum(t - s for t, s in zip(targets[:k], sizes[:k])) for k in range(shards)]
    free = n - sum(sizes)
    step = max(1, min(int(free * 0.618), (1 << 62) // max(free, 1)))
    while math.gcd(step, free) > 1:
        step += 1
    literal = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    # a bijection that spreads neighbouring rows without links over the shards
    turn = F.when(F.col("shard") < 0, F.pmod(F.col("number") * step, F.lit(max(free, 1))))
    filled = F.size(F.filter(literal(starts), lambda s: s <= F.col("turn"))) - 1
    out = _numbered(placed, block, "shard").withColumn("turn", turn).withColumn("filled", filled)
    own = F.col("turn").isNull()
    return out.select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.when(own, F.col("shard")).otherwise(F.col("filled")).cast("int").alias("shard"),
        F.when(own, F.col("number"))
        .otherwise(F.get(literal(sizes), F.col("filled")) + F.col("turn") - F.get(literal(starts), F.col("filled")))
        .alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"))

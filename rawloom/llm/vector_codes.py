"""Vectors as short codes: each part by its nearest codebook entry, found with LAESA's pivots.

A few of the first entries of each part's codebook are its pivots and stay so. Each part's distances to
its pivots are computed once and stored beside the vector. The entries move in every round, so their own
distances to the pivots are computed anew, a few for each entry. By the triangle inequality the difference
of the two bounds the distance from below. A part first meets the entry with the least bound; entries
whose bounds are over the distance found are pruned, the rest follow in the order of their bounds
until the next bound is over the best distance. Bounds have a margin for rounding, and what decides are exact
sums of whole numbers, of equal ones the smaller index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import whole_vectors
from .frames import broadcastable, stored, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 8
#: Labels that a broadcast may hold.
SMALL = 1_000_000
#: Vectors whose bounds are in memory at a time.
BLOCK = 2048
#: What rounding may add to a bound, as a share of the distances that it comes from.
MARGIN = 1e-6


def pivots_of(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Of one part's first entries some far from each other: each has the largest sum of distances to those before."""
    if not len(entries):
        return entries
    chosen, total = [0], np.zeros(len(entries))
    while len(chosen) < min(n, len(entries)):
        total += np.sqrt(((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return entries[chosen]


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of points to pivots, as (points, pivots)."""
    out = np.empty((len(points), len(pivots)), np.float32)
    for p, pivot in enumerate(pivots):
        out[:, p] = np.sqrt(((points - pivot) ** 2).sum(axis=1))
    return out


@dataclass
class Codebook:
    """One part's entries, and their distances to its pivots."""

    entries: np.ndarray
    pivots: np.ndarray

    def __post_init__(self):
        self.reach = to_pivots(self.entries, self.pivots)

    def nearest(self, points: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each point's nearest entry and its squared distance, by the point's distances to the pivots; and how many distances that took."""
        which, best, taken = np.empty(len(points), np.int64), np.empty(len(points), np.int64), 0
        for lo in range(0, len(points), BLOCK):
            which[lo : lo + BLOCK], best[lo : lo + BLOCK], n = self._block(points[lo : lo + BLOCK], reach[lo : lo + BLOCK])
            taken += n
        return which, best, taken

    def _distances(self, points: np.ndarray, who: np.ndarray, entry: np.ndarray) -> np.ndarray:
        apart = points[who] - self.entries[entry]
        return np.einsum("ij,ij->i", apart, apart)

    def _block(self, points: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        n = len(points)
        bound = np.zeros((n, len(self.entries)), np.float32)
        for p in range(len(self.pivots)):
            np.maximum(bound, np.abs(reach[:, p, None] - self.reach[None, :, p]), out=bound)
        bound -= np.float32(MARGIN) * (reach.max(axis=1)[:, None] + self.reach.max(axis=1)[None, :]) + np.float32(MARGIN)
        np.maximum(bound, 0, out=bound)
        everyone = np.arange(n)
        which = bound.argmin(axis=1)
        best, taken = self._distances(points, everyone, which), n
        radius = self._radius(best)
        bound[everyone, which] = np.inf
        # what is left, by point and bound: the point, the bound's bits (which order like it) and the entry in one number
        who, entry = np.nonzero(bound <= radius[:, None])
        keys = (who.astype(np.uint64) << np.uint64(40)) | (bound[who, entry].view(np.uint32).astype(np.uint64) << np.uint64(8)) | entry.astype(np.uint64)
        keys.sort()
        who, entry = (keys >> np.uint64(40)).astype(np.int64), (keys & np.uint64(255)).astype(np.int64)
        bounds = (keys >> np.uint64(8)).astype(np.uint32).view(np.float32)
        heads = np.searchsorted(who, everyone)
        rank = np.arange(len(who)) - heads[who]
        wave = 4
        while len(who):
            now = rank < wave
            some, own = who[now], entry[now]
            distance = self._distances(points, some, own)
            taken += len(some)
            heads = np.flatnonzero(np.diff(some, prepend=-1))  # points are together
            at, d = some[heads], np.minimum.reduceat(distance, heads)
            own[distance > np.repeat(d, np.diff(np.append(heads, len(some))))] = 256
            e = np.minimum.reduceat(own, heads)
            nearer = (d < best[at]) | ((d == best[at]) & (e < which[at]))
            which[at[nearer]], best[at[nearer]] = e[nearer], d[nearer]
            radius = self._radius(best)
            left = ~now & (bounds <= radius[who])
            who, entry, rank, bounds = who[left], entry[left], rank[left], bounds[left]
            wave *= 2
        return which, best, taken

    @staticmethod
    def _radius(best: np.ndarray) -> np.ndarray:
        """At least the distance, so that an equally near entry is not pruned."""
        return (np.sqrt(best) * (1 + MARGIN)).astype(np.float32) + np.float32(MARGIN)


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
             key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per vector: the key, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Components count as whole numbers, floor(scale * x); vectors are cut into ``parts`` equal parts. A part's
    codebook starts as that part of the vectors with the ``entries`` (256 at most) smallest keys; of equal keys the
    smaller vector comes first, NULL keys last. Each round gives parts to their nearest entries, of equally
    near ones to the smaller index, and moves entries to the floors of the means; unused ones stay. Then parts are given once
    more. ``code`` has two hex digits for each part, ``error`` is the squared distance summed over the parts,
    ``label_error`` its sum over the vectors of a label, NULL being one too; a sum beyond 64 bits is NULL.

    Vectors that are NULL, or hold NULL or components that aren't finite, have no row. The size of
    vectors is that of the first one whose size the parts divide; vectors of other sizes, and those with whole numbers over
    2**26, whose distances might not fit into 64 bits, have no row either. Repeated rows count as often as they are there.
    Further columns are ignored; an empty table gives an empty one.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    spark = rows.sparkSession
    v = F.col(vector)
    kept = rows.where((F.size(v) > 0) & (F.size(v) % parts == 0) & whole_vectors.usable(v, scale)).select(
        F.col(key).alias("key"), F.col(label).alias("label"), whole_vectors.whole(v, scale).alias("v")
    )
    in_order = [F.asc_nulls_last("key"), "v"]
    head = kept.select("key", "v").orderBy(*in_order).limit(1).collect()
    size = len(head[0]["v"]) if head else parts
    kept = kept.where(F.size("v") == size)
    first = kept.select("key", "v").orderBy(*in_order).limit(entries).collect()
    width = size // parts
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    fixed = [pivots_of(s, pivots) for s in start]
    measured = stored(kept.mapInArrow(_measuring(fixed, size), _fields(kept, "v array<long>, reach array<float>")), "measured")
    centres = start
    for _ in range(rounds if len(first) else 0):
        shared = spark.sparkContext.broadcast([Codebook(c, p) for c, p in zip(centres, fixed)])
        sums = measured.select("v", "reach").mapInArrow(_summing(shared, size), whole_vectors.Sums.SCHEMA)
        centres = whole_vectors.moved(centres.reshape(-1, width), sums).reshape(centres.shape)
        shared.unpersist()
    shared = spark.sparkContext.broadcast([Codebook(c, p) for c, p in zip(centres, fixed)])
    coded = stored(measured.mapInArrow(_coding(shared, size), _fields(kept, "code string, error long")), "coded")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error"))
    by_label = stored(by_label, "labels")
    digest = hashlib.sha256(",".join(map(str, centres.reshape(-1).tolist())).encode()).hexdigest()
    return coded.join(F.broadcast(by_label) if broadcastable(by_label, SMALL) else by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _fields(kept: DataFrame, more: str) -> str:
    return ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in ("key", "label")) + ", " + more


def _pieces(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(vectors, parts, axis=1)]


def _measuring(fixed: list[np.ndarray], size: int):
    def rows(batches):
        for batch in batches:
            vectors = whole_vectors.matrix(batch.column("v"), size)
            reach = np.concatenate([to_pivots(p, f) for p, f in zip(_pieces(vectors, len(fixed)), fixed)], axis=1)
            ends = np.arange(len(vectors) + 1, dtype=np.int32) * reach.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(reach.reshape(-1), pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), batch.column("v"), lists], ["key", "label", "v", "reach"])

    return rows


def _nearest(batch: pa.RecordBatch, books: list[Codebook], size: int):
    """Each part's points, nearest entries and squared distances."""
    pieces = _pieces(whole_vectors.matrix(batch.column("v"), size), len(books))
    reach = batch.column("reach").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(books), -1)
    for part, (points, book) in enumerate(zip(pieces, books)):
        yield points, *book.nearest(points, reach[:, part])[:2]


def _summing(shared, size: int):
    def rows(batches):
        books = shared.value
        n = len(books[0].entries)
        sums = whole_vectors.Sums(len(books) * n, size // len(books))
        for batch in batches:
            for part, (points, which, _) in enumerate(_nearest(batch, books, size)):
                sums.add(which + part * n, points)
        yield sums.batch()

    return rows


def _coding(shared, size: int):
    def rows(batches):
        books = shared.value
        for batch in batches:
            digits = np.empty((batch.num_rows, len(books)), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for part, (_, which, distance) in enumerate(_nearest(batch, books, size)):
                digits[:, part] = which
                error += distance
            codes = [row.tobytes().hex() for row in digits]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error, pa.int64())], ["key", "label", "code", "error"]
            )

    return rows


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds one after the other; vectors have 64 components."""
    width = 64 // PARTS
    floor_mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    piece = f"list_slice(v, CAST({width} * p + 1 AS BIGINT), CAST({width} * (p + 1) AS BIGINT))"
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"pieces AS MATERIALIZED (SELECT id, p, {piece} AS v FROM kept, range({PARTS}) r(p))",
        "cells AS MATERIALIZED (SELECT id, p, unnest(v) AS x, unnest(range(len(v))) AS i FROM pieces)",
        f"""c0 AS MATERIALIZED (SELECT p, e, {piece} AS v FROM (SELECT row_number() OVER (ORDER BY vec_id, v) - 1 AS e, v FROM
  (SELECT vec_id, v FROM kept ORDER BY vec_id, v LIMIT {ENTRIES})), range({PARTS}) r(p))""",
    ]
    distance = "list_sum(list_transform(list_zip(k.v, o.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT id, p, min(dist).d AS d, min(dist).e AS e FROM
  (SELECT k.id, k.p, {{'d': {distance}, 'e': o.e}} AS dist FROM pieces k JOIN c{r} o ON k.p = o.p) GROUP BY id, p)""")
        if r < ROUNDS:
            parts.append(f"m{r} AS (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM cells JOIN a{r} USING (id, p) GROUP BY p, e, i)")
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(any_value(l.v), any_value(o.v)) AS v FROM c{r} o
  LEFT JOIN (SELECT p, e, list({floor_mean} ORDER BY i) AS v FROM m{r} GROUP BY p, e) l USING (p, e) GROUP BY o.p, o.e)""")
    return f"""WITH {", ".join(parts)},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS digest FROM c{ROUNDS}),
coded AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT digest FROM books) AS codebooks_sha256
FROM coded JOIN kept USING (id)"""


SQL = _sql()

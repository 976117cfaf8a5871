"""Approximate nearest neighbours by cosine: p-stable hashing with query-directed probes.

Vectors of length one are projected on Gaussian directions and cut into cells of a width; the cells of
several directions make a bucket, and several tables have directions of their own. A query visits
in each table the buckets next to its own in the order in which they are likely to hold near
vectors: by the sum of squared distances to the cell borders that lie between, with the sets of
steps taken from one list for all queries (by the expected distances of the nearest, second nearest,
... border). Vectors and probes meet by bucket in bounded groups, where exact cosines rank them.
"""

import heapq
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ragged
from .frames import stored, table

#: Vectors of a group, and of a bucket before it is split. At most a million buckets are ever listed as split.
GROUP_ROWS = 20_000
MOST_SPLIT = 1_000_000
#: Queries that are compared with all vectors at a time.
QUERY_BLOCK = 4096


@dataclass(frozen=True)
class Index:
    """Tables, directions of each, width of a cell, buckets that a query visits in each table."""

    tables: int = 8
    directions: int = 16
    width: float = 3.5
    probes: int = 400
    seed: int = 7


@lru_cache(8)
def _projection(index: Index, size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([index.seed, size])
    n = index.tables * index.directions
    return rng.standard_normal((size, n)), rng.uniform(0, index.width, n)


@lru_cache(8)
def probe_order(directions: int, probes: int) -> tuple[tuple[int, ...], ...]:
    """Sets of steps (numbers of borders by nearness) in the order of their expected distances."""
    m = directions
    near = np.arange(1, m + 1)
    scale = 4 * (m + 1) * (m + 2)
    expected = np.concatenate([near * (near + 1) / scale, (1 - (m + 1 - near) / (m + 1) + (m + 1 - near) * (m + 2 - near) / scale)])
    out, heap = [()], [(expected[0], (0,))]
    while heap and len(out) < probes:
        total, steps = heapq.heappop(heap)
        if all(2 * m - 1 - s not in steps for s in steps):  # not over both borders of a direction
            out.append(steps)
        last = steps[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total + expected[last + 1], (*steps, last + 1)))
            heapq.heappush(heap, (total - expected[last] + expected[last + 1], (*steps[:-1], last + 1)))
    return tuple(out)


def _cells(index: Index, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers and places within the cells, as (vectors, tables, directions)."""
    directions, shift = _projection(index, vectors.shape[1])
    at = (vectors @ directions + shift) / index.width
    cell = np.floor(at)
    shape = (len(vectors), index.tables, index.directions)
    return cell.astype(np.int64).reshape(shape), (at - cell).reshape(shape)


def _factors(index: Index) -> np.ndarray:
    return (ragged.noise(index.tables * index.directions, 31) | np.uint64(1)).reshape(index.tables, index.directions)


def _bucket_sums(index: Index, cells: np.ndarray) -> np.ndarray:
    return (cells.astype(np.uint64) * _factors(index)).sum(axis=2, dtype=np.uint64)


def _named(index: Index, sums: np.ndarray, size: int) -> np.ndarray:
    """Buckets of different tables and vector sizes are different."""
    salt = ragged.noise(index.tables, 32 + size)
    return ragged.mixed(sums + salt.reshape((1, index.tables) + (1,) * (sums.ndim - 2)))


def buckets(index: Index, vectors: np.ndarray) -> np.ndarray:
    """Each vector's bucket in each table."""
    return _named(index, _bucket_sums(index, _cells(index, vectors)[0]), vectors.shape[1])


def probed(index: Index, vectors: np.ndarray) -> np.ndarray:
    """Buckets that each query visits, as (queries, tables, probes)."""
    cells, place = _cells(index, vectors)
    home = _bucket_sums(index, cells)
    m = index.directions
    borders = np.concatenate([place, 1 - place], axis=2)
    order = np.argsort(borders, axis=2, kind="stable")
    # what a step over the j-th nearest border adds to the bucket's sum
    both = np.concatenate([np.zeros_like(_factors(index)) - _factors(index), _factors(index)], axis=1)
    gain = np.take_along_axis(np.broadcast_to(both, (len(vectors), *both.shape)), order, axis=2)
    chosen = probe_order(m, index.probes)
    steps = np.zeros((2 * m, len(chosen)), np.uint64)
    for k, numbers in enumerate(chosen):
        steps[list(numbers), k] = 1
    total = np.zeros((len(vectors), index.tables, len(chosen)), np.uint64)
    for j in range(2 * m):
        used = np.flatnonzero(steps[j])
        if len(used):
            total[:, :, used] += gain[:, :, j, None]
    return _named(index, home[:, :, None] + total, vectors.shape[1])


def _unit(raw: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Positions and unit vectors, by vector size."""
    by_size: dict[int, list[int]] = {}
    for i, r in enumerate(raw):
        by_size.setdefault(len(r) // 8, []).append(i)
    out = {}
    for size, rows in by_size.items():
        v = np.frombuffer(b"".join(raw[i] for i in rows), np.float64).reshape(len(rows), size)
        out[size] = np.array(rows), v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    return out


def _vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` (doubles as binary) of the rows that take part."""
    v = F.col("v")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists("v", lambda x: x != 0)
    )

    def packed(batches):
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False) + 0.0  # no negative zeros
            ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            raw = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["id", "vector"])

    return usable.mapInArrow(packed, "id long, vector binary")


def _indexed(distinct: DataFrame, index: Index) -> DataFrame:
    def rows(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            for at, unit in _unit(raw).values():
                found = buckets(index, unit)
                take = pa.array(np.repeat(at, index.tables))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.reshape(-1).view(np.int64)), batch.column(0).take(take), batch.column(1).take(take)], ["bucket", "id", "vector"]
                )

    return distinct.mapInArrow(rows, "bucket long, id long, vector binary")


def _probes(queries: DataFrame, index: Index, groups: int, split) -> DataFrame:
    """A row for each query and group that holds buckets it visits."""

    def rows(batches):
        parts = split.value
        for batch in batches:
            raw = batch.column(1).to_pylist()
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, unit in _unit(raw).values():
                for lo in range(0, len(at), 64):
                    visited = probed(index, unit[lo : lo + 64]).reshape(min(64, len(at) - lo), -1)
                    out = [[], [], [], []]
                    for i, own in zip(at[lo : lo + 64].tolist(), visited):
                        own = np.unique(own).view(np.int64)
                        group = _group_of(own, np.zeros(len(own), np.int64), groups)
                        for b in own[np.isin(own, parts[0])].tolist() if len(parts[0]) else []:
                            n = parts[1][np.searchsorted(parts[0], b)]
                            own = np.concatenate([own, np.full(n - 1, b)])
                            group = np.concatenate([group, _group_of(np.full(n - 1, b), np.arange(1, n), groups)])
                        order = np.lexsort((own, group))
                        own, group = own[order], group[order]
                        fresh = np.ones(len(own), bool)  # two splits of a bucket may meet in a group
                        fresh[1:] = (own[1:] != own[:-1]) | (group[1:] != group[:-1])
                        own, group = own[fresh], group[fresh]
                        heads = np.flatnonzero(np.diff(group, prepend=-1))
                        for a, b in zip(heads, np.append(heads[1:], len(own))):
                            out[0].append(group[a])
                            out[1].append(ids[i])
                            out[2].append(raw[i])
                            out[3].append(own[a:b].tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
                        ["part", "query", "vector", "buckets"],
                    )

    return queries.mapInArrow(rows, "part long, query long, vector binary, buckets binary")


def _group_of(bucket: np.ndarray, salt: np.ndarray, groups: int) -> np.ndarray:
    return (ragged.mixed(bucket.view(np.uint64) + ragged.mixed(salt.astype(np.uint64) + np.uint64(1))) % np.uint64(groups)).astype(np.int64)


def _grouped(indexed: DataFrame, groups: int, split) -> DataFrame:
    def rows(batches):
        keys, times = split.value
        for batch in batches:
            bucket, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            salt = np.zeros(len(bucket), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, bucket), len(keys) - 1)
                n = np.where(keys[at] == bucket, times[at], 1)
                salt = (ragged.mixed(ids.astype(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_group_of(bucket, salt, groups)), *batch.columns], ["part", *batch.schema.names])

    return indexed.mapInArrow(rows, "part long, bucket long, id long, vector binary")


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, summed in one order wherever the rows stand."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _best(query: np.ndarray, other: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` best, without repeats."""
    order = np.lexsort((other, -score, query))
    q, o = query[order], other[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (o[1:] != o[:-1])
    order, q = order[fresh], q[fresh]
    begin = np.ones(len(q), bool)
    begin[1:] = q[1:] != q[:-1]
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(begin, np.arange(len(q)), 0))
    return order[rank < k]


def _met(vectors: pa.Table, probes: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest of each query among the vectors of the buckets that it visits in this group."""
    found = [[], [], []]
    if vectors.num_rows and probes.num_rows:
        raw = vectors.column("vector").to_pylist()
        query_raw = probes.column("vector").to_pylist()
        ids, query_ids = vectors.column("id").to_numpy(), probes.column("query").to_numpy()
        bucket = vectors.column("bucket").to_numpy()
        visits = [np.frombuffer(b, np.int64) for b in probes.column("buckets").to_pylist()]
        visitor = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
        visits = np.concatenate(visits)
        order, visit_order = np.argsort(bucket, kind="stable"), np.argsort(visits, kind="stable")
        ordered, visited = bucket[order], visits[visit_order]
        for b in np.intersect1d(ordered, visited):
            own = order[np.searchsorted(ordered, b, "left") : np.searchsorted(ordered, b, "right")]
            who = visitor[visit_order[np.searchsorted(visited, b, "left") : np.searchsorted(visited, b, "right")]]
            size = len(raw[own[0]]) // 8
            v = np.frombuffer(b"".join(raw[i] for i in own), np.float64).reshape(len(own), size)
            unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
            for lo in range(0, len(who), 256):
                some = who[lo : lo + 256]
                q = np.frombuffer(b"".join(query_raw[i] for i in some), np.float64).reshape(len(some), size)
                near = (q / np.sqrt((q * q).sum(axis=1, keepdims=True))) @ unit.T
                if len(own) > k:
                    least = np.partition(near, len(own) - k, axis=1)[:, len(own) - k]
                    i, j = np.nonzero(near >= least[:, None] - 1e-9)
                else:
                    i, j = np.nonzero(np.ones_like(near, bool))
                score = _exact(q[i], v[j])
                best = _best(i, ids[own[j]], score, k)
                found[0].append(query_ids[some[i[best]]])
                found[1].append(ids[own[j[best]]])
                found[2].append(score[best])
    query, other, score = (np.concatenate(f) if f else np.zeros(0) for f in found)
    best = _best(query, other, score, k) if len(query) else np.zeros(0, np.int64)
    return pa.table([pa.array(query[best], pa.int64()), pa.array(other[best], pa.int64()), pa.array(score[best], pa.float64())], ["query", "vec_id", "score"])


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, index: Index = Index(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each query's ``k`` nearest rows found, but itself: ``query_id``, ``rank``, ``vec_id``, ``score`` (the cosine).

    Rows and queries have the same columns; a query leaves out the row of its own key. Vectors that are
    NULL, empty, zero or hold NULL or values that aren't finite take no part, nor do NULL keys. Only
    vectors of one size are compared. Ties go to the smaller key. Queries whose buckets hold fewer than ``k``
    others are compared with all vectors, in blocks of ``QUERY_BLOCK`` queries, so that a query has fewer rows only if there
    are fewer other vectors of its size. Repeated rows of one key and vector count once. A key with several vectors is one
    query for each, whose nearest are ranked together. Of equal vectors only the ``k + 1`` smallest keys are indexed, as no
    others can be among the nearest. Empty tables give an empty result.
    """
    spark = rows.sparkSession
    first = Window.partitionBy("vector").orderBy("id")
    points = _vectors(rows, key, vector).distinct()
    distinct = points.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).select("id", "vector")
    distinct = stored(distinct, "vectors")
    indexed = stored(_indexed(distinct, index), "indexed")
    n = indexed.count()
    limit = max(GROUP_ROWS, n // MOST_SPLIT)
    hot = indexed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > limit).orderBy("bucket").toArrow()
    split = spark.sparkContext.broadcast((hot["bucket"].to_numpy(), -(-hot["n"].to_numpy() // limit)))
    groups = int(min(1 << 30, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // GROUP_ROWS))))

    asked = _vectors(queries, key, vector).distinct()
    asked = stored(asked.join(asked.groupBy("vector").agg(F.min("id").alias("stands")), "vector"), "asked")
    single = asked.where("id = stands").select("id", "vector")

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        return _met(left, right, k + 1)

    found = (
        _grouped(indexed, groups, split)
        .groupBy("part")
        .cogroup(_probes(single, index, groups, split).groupBy("part"))
        .applyInArrow(met, "query long, vec_id long, score double")
        .distinct()
    )
    reached = stored(_ranked(found, asked, k), "reached")
    # queries whose buckets hold too few are compared with all vectors, in blocks
    full = reached.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = stored(asked.join(full, asked["id"] == full["query_id"], "left_anti").select("stands").distinct(), "short")
    if short.isEmpty():
        return reached
    left = stored(single.join(short, single["id"] == short["stands"], "left_semi").withColumn("number", F.monotonically_increasing_id()), "left")
    every = None
    for lower, upper in _blocks(left):
        block = spark.sparkContext.broadcast([tuple(r) for r in left.where(F.col("number").between(lower, upper)).select("id", "vector").collect()])
        own = distinct.mapInArrow(_compared_with(block, k + 1), "query long, vec_id long, score double")
        every = own if every is None else every.unionByName(own)
    of_short = asked.join(short, "stands", "left_semi")
    others = reached.join(of_short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
    return others.unionByName(_ranked(every, of_short, k))


def _ranked(found: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query from what was found for the one that stands for its vector."""
    nearest_first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k + 1).drop("rank")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select(F.col("id").alias("query_id"), F.col("stands").alias("query"))
        .join(best, "query")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(own).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _blocks(numbered: DataFrame) -> list[tuple[int, int]]:
    """Ranges of numbers that hold up to ``QUERY_BLOCK`` rows each."""
    runs = numbered.groupBy(F.floor(F.col("number") / QUERY_BLOCK).alias("run")).agg(F.count("*").alias("n")).orderBy("run").collect()
    out, rows = [], QUERY_BLOCK + 1
    for run, n in runs:
        if rows + n > QUERY_BLOCK:
            out.append([run * QUERY_BLOCK, 0])
            rows = 0
        out[-1][1] = (run + 1) * QUERY_BLOCK - 1
        rows += n
    return [tuple(r) for r in out]


def _compared_with(block, k: int):
    """The ``k`` nearest of each query of a block among each batch of vectors of its size."""

    def rows(batches):
        queries = block.value
        asked = _unit([v for _, v in queries])
        names = np.array([i for i, _ in queries], np.int64)
        for batch in batches:
            raw, ids = batch.column(1).to_pylist(), batch.column(0).to_numpy(zero_copy_only=False)
            for size, (at, unit) in _unit(raw).items():
                if size not in asked:
                    continue
                who, query_unit = asked[size]
                v = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), size)
                for lo in range(0, len(who), 256):
                    some = who[lo : lo + 256]
                    near = query_unit[lo : lo + 256] @ unit.T
                    least = np.partition(near, max(len(at) - k, 0), axis=1)[:, max(len(at) - k, 0)]
                    i, j = np.nonzero(near >= least[:, None] - 1e-9)
                    q = np.frombuffer(b"".join(queries[s][1] for s in some), np.float64).reshape(len(some), size)
                    score = _exact(q[i], v[j])
                    best = _best(i, ids[at[j]], score, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[some[i[best]]]), pa.array(ids[at[j[best]]]), pa.array(score[best])], ["query", "vec_id", "score"]
                    )

    return rows


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 50 == 0))

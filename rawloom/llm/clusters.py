"""Clustering around centroids: each vector finds its centroid in a vantage-point tree.

The tree splits the centroids by their distance from one of them, the vantage point; each half keeps
the least and largest of its distances. A vector opens nodes best first, that with the least possible
distance next, and stops when no open node can hold a centroid within the radius of the best found so
far, the radius itself included, so that a tie with a smaller number is not missed. Distances that
decide are exact sums of whole numbers; square roots with a margin only bound. The vectors of an
Arrow batch are searched together, each with bounds and a radius of its own. After every round Spark
sums the vectors of each centroid, and a tree over the moved centroids is broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import whole_vectors
from .frames import stored, table

CLUSTERS, ROUNDS, SIZE, SCALE = 16, 3, 64, 64
#: Centroids of a leaf.
LEAF = 2
#: Bounds of a search in memory at a time (vectors by nodes).
BOUNDS = 1 << 20


class Tree:
    """A vantage-point tree as flat arrays, so that many vectors can walk it at once."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        items, children, ranges = [], [], []

        def grow(own: np.ndarray) -> int:
            node = len(items)
            items.append(np.full(max(leaf, 1), -1, np.int64))
            children.append([-1, -1])
            ranges.append(np.zeros((2, 2)))
            if len(own) <= leaf:
                items[node][: len(own)] = own
                return node
            point = self._vantage(own)
            items[node][0] = point
            rest = own[own != point]
            distance = np.sqrt(((centroids[rest] - centroids[point]) ** 2).sum(axis=1))
            order = np.argsort(distance, kind="stable")
            halves = np.array_split(order, 2)
            for side, half in enumerate(h for h in halves if len(h)):
                ranges[node][side] = distance[half[0]], distance[half[-1]]
                children[node][side] = grow(rest[half])
            return node

        if len(centroids):
            grow(np.arange(len(centroids)))
        self.items = np.array(items, np.int64).reshape(len(items), max(leaf, 1))
        self.children = np.array(children, np.int64).reshape(len(items), 2)
        self.ranges = np.array(ranges).reshape(len(items), 2, 2)

    def _vantage(self, own: np.ndarray) -> int:
        """Of a few centroids that with the most different distances to the others."""
        some = own[:: max(1, len(own) // 8)]
        spread = [np.sqrt(((self.centroids[own] - self.centroids[p]) ** 2).sum(axis=1)).std() for p in some]
        return int(some[int(np.argmax(spread))])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each vector's nearest centroid, of equally near ones the smallest, its squared distance; and how many distances that took."""
        which, best = np.full(len(vectors), -1, np.int64), np.full(len(vectors), np.iinfo(np.int64).max)
        step, taken = max(1, BOUNDS // max(1, len(self.items))), 0
        for lo in range(0, len(vectors), step):
            which[lo : lo + step], best[lo : lo + step], n = self._search(vectors[lo : lo + step])
            taken += n
        return which, best, taken

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        n, taken = len(vectors), 0
        which, best = np.full(n, -1, np.int64), np.full(n, np.iinfo(np.int64).max)
        radius = np.full(n, np.inf)
        bound = np.full((n, len(self.items)), np.inf)
        bound[:, :1] = 0
        going = np.arange(n) if len(self.items) else np.zeros(0, np.int64)
        while len(going):
            node = bound[going].argmin(axis=1)
            least = bound[going, node]
            inside = (least <= radius[going]) & (least < np.inf)
            going, node, least = going[inside], node[inside], least[inside]
            bound[going, node] = np.inf
            for slot in range(self.items.shape[1]):
                item = self.items[node, slot]
                there = np.flatnonzero(item >= 0)
                who, item = going[there], item[there]
                distance = ((vectors[who] - self.centroids[item]) ** 2).sum(axis=1)
                taken += len(who)
                nearer = (distance < best[who]) | ((distance == best[who]) & (item < which[who]))
                which[who[nearer]], best[who[nearer]] = item[nearer], distance[nearer]
                if slot == 0:
                    to_point = np.sqrt(distance)  # every node has a first item
            radius[going] = np.sqrt(best[going]) * (1 + 1e-9) + 1e-6
            for side in range(2):
                child = self.children[node, side]
                there = np.flatnonzero(child >= 0)
                near, far = self.ranges[node[there], side].T
                lower = np.maximum(near - to_point[there], to_point[there] - far)
                bound[going[there], child[there]] = np.maximum(np.maximum(lower, least[there]) * (1 - 1e-9) - 1e-6, 0)
        return which, best, taken


def by_digest(key: Column) -> Column:
    """The order in which vectors become the first centroids."""
    return F.sha2(F.concat(F.lit("1:"), key.cast("string")), 256)


def cluster(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
            key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per vector: the key, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors of ``size`` components, none NULL or not finite, count as whole numbers, floor(scale * x). The
    vectors with the least digests of their keys are the first centroids; of equal keys the smaller vector
    comes first, NULL keys last. Each round gives every vector to its nearest centroid, of equally near ones
    to the smallest number, and moves centroids to the floors of the means; those without vectors stay. Then
    vectors are given once more. Fewer vectors than ``clusters`` are all centroids. Other vectors, and those with whole
    numbers over 2**26, whose distances might not fit into 64 bits, have no row; repeated rows count as often as
    they are there. A sum beyond 64 bits is NULL. Further columns are ignored; an empty table gives an empty one.
    """
    spark = rows.sparkSession
    v = F.col(vector)
    kept = rows.where((F.size(v) == size) & whole_vectors.usable(v, scale)).select(F.col(key).alias("key"), whole_vectors.whole(v, scale).alias("v"))
    kept = stored(kept, "vectors")
    first = kept.select("v", by_digest(F.col("key")).alias("digest")).orderBy(F.asc_nulls_last("digest"), "v").limit(clusters).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), size)
    for _ in range(rounds if len(centroids) else 0):
        shared = spark.sparkContext.broadcast(Tree(centroids))
        centroids = whole_vectors.moved(centroids, kept.mapInArrow(_summing(shared, size), whole_vectors.Sums.SCHEMA))
        shared.unpersist()
    shared = spark.sparkContext.broadcast(Tree(centroids))
    fields = f"key {kept.schema['key'].dataType.simpleString()}, cluster int, distance long"
    given = stored(kept.mapInArrow(_giving(shared, size), fields), "given")
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    # as many rows as there are centroids
    sums = given.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = [(r["cluster"], int(r["sum"])) for r in sums.collect()]
    total = sum(s for _, s in sums)
    fits = lambda n: n if n < 1 << 63 else None
    told = spark.createDataFrame(
        [(i, fits(s), fits(total), digests[i][1]) for i, s in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return given.join(F.broadcast(told), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _summing(shared, size: int):
    def rows(batches):
        tree = shared.value
        sums = whole_vectors.Sums(len(tree.centroids), size)
        for batch in batches:
            vectors = whole_vectors.matrix(batch.column("v"), size)
            sums.add(tree.nearest(vectors)[0], vectors)
        yield sums.batch()

    return rows


def _giving(shared, size: int):
    def rows(batches):
        tree = shared.value
        for batch in batches:
            which, distance, _ = tree.nearest(whole_vectors.matrix(batch.column("v"), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(which, pa.int32()), pa.array(distance, pa.int64())], ["key", "cluster", "distance"]
            )

    return rows


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds one after the other."""
    floor_mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """cells AS MATERIALIZED (SELECT id, unnest(v) AS x, unnest(range(len(v))) AS p FROM kept)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM
  (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {CLUSTERS}))""",
    ]
    distance = "list_sum(list_transform(list_zip(k.v, o.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT id, d, c FROM (SELECT k.id, o.c, {distance} AS d,
    row_number() OVER (PARTITION BY k.id ORDER BY {distance}, o.c) AS nth FROM kept k, c{r} o) WHERE nth = 1)""")
        if r < ROUNDS:
            parts.append(f"""m{r} AS (SELECT c, p, sum(x) AS s, count(*) AS n FROM cells JOIN a{r} USING (id) GROUP BY c, p)""")
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(any_value(l.v), any_value(o.v)) AS v FROM c{r} o
  LEFT JOIN (SELECT c, list({floor_mean} ORDER BY p) AS v FROM m{r} GROUP BY c) l USING (c) GROUP BY o.c)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(o.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (id) JOIN c{ROUNDS} o USING (c)"""


SQL = _sql()

"""Connected components by alternating large-star and small-star."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    others = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return others.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of the edges (``a``, ``b``); the component is its smallest node.

    Edges may repeat, point either way or lead from a node to itself. Each round is written to the
    shared folder; the rounds end when they no longer change the edges.
    """
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        r = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("s"), F.sum("a").alias("t")).first()
        if r["n"] == 0 or tuple(r) == state:
            break
        state = tuple(r)
        now = stored(_small_star(_large_star(now)), "stars")
    ends = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.join(ends, "node", "left").select("node", F.coalesce("component", "node").alias("component"))

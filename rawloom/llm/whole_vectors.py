"""Vectors as whole numbers, for operators whose distances must be exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest whole number of a component: squared distances of 256 components then fit into 64 bits.
LARGEST = 1 << 26


def whole(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, as array<bigint>."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def usable(vector: Column, scale: int) -> Column:
    """Whether a vector is there, has no NULL and no component that isn't finite or whose whole number is over ``LARGEST``."""
    bound = F.lit(float(LARGEST))  # NaN is larger than any number
    inside = F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & (F.abs(x * F.lit(float(scale))) <= bound))
    return F.coalesce(vector.isNotNull() & inside, F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A batch's vectors, all of one size, as (rows, size)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), size)


class Sums:
    """Counts and component sums of the vectors given to each of ``n`` cells."""

    SCHEMA = "cell int, position int, total long"

    def __init__(self, n: int, size: int):
        self.counts, self.totals = np.zeros(n, np.int64), np.zeros((n, size), np.int64)

    def add(self, cells: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(cells, kind="stable")
        ordered = cells[order]
        heads = np.flatnonzero(np.diff(ordered, prepend=-1))
        if len(heads):
            self.totals[ordered[heads]] += np.add.reduceat(vectors[order], heads, axis=0)
            self.counts[ordered[heads]] += np.diff(np.append(heads, len(order)))

    def batch(self) -> pa.RecordBatch:
        """The used cells: a row for each component, and the count at position -1."""
        used = np.flatnonzero(self.counts)
        size = self.totals.shape[1]
        rows = np.concatenate([self.counts[used, None], self.totals[used]], axis=1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, size + 1), pa.int32()),
                pa.array(np.tile(np.arange(-1, size), len(used)), pa.int32()),
                pa.array(rows.reshape(-1), pa.int64()),
            ],
            ["cell", "position", "total"],
        )


def moved(centres: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Centres at the floor of their vectors' means; those without vectors stay. The driver gets a row for each component of a centre."""
    rows = sums.groupBy("cell", "position").agg(F.sum("total").alias("total")).toArrow()
    cell, position, total = (rows.column(c).to_numpy() for c in ("cell", "position", "total"))
    out = centres.copy()
    counts = np.ones(len(centres), np.int64)
    counts[cell[position < 0]] = total[position < 0]
    inner = position >= 0
    out[cell[inner], position[inner]] = total[inner] // counts[cell[inner]]
    return out

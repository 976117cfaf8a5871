"""Operators over ordered rows that hold up when one group has most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

FILE, BLOCK, POSITION = "_file", "_block", "_position"


def running_total(
    df: DataFrame,
    group: Sequence[str],
    block: str,
    order: Sequence[str],
    value: Column,
    out: str,
    inclusive: bool = True,
) -> DataFrame:
    """Running sum of ``value`` per group, in two levels.

    ``block`` cuts each group into consecutive stretches that one task can hold. Block
    totals are summed map-side, and only these totals are run through a window per
    group; rows are windowed within their block. The join and the inner window share
    the partitioning by (group, block). NULL keys are groups like any other.
    """
    # One struct as key: NULLs in it are equal to each other, in joins as in windows.
    keyed = df.withColumn("_key", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate([*group, block])]))
    totals = keyed.groupBy("_key").agg(F.sum(value).alias("_total"))
    earlier = (
        Window.partitionBy(*[F.col(f"_key.k{i}") for i in range(len(group))])
        .orderBy(f"_key.k{len(group)}")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = totals.select("_key", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    within = (
        Window.partitionBy("_key")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    no_block = F.raise_error(F.lit("running_total: a row has no block total")).cast("bigint")
    running = F.coalesce("_before", no_block) + F.coalesce(F.sum(value).over(within), F.lit(0))
    return keyed.join(before, "_key", "left").withColumn(out, running).drop("_before", "_key")


def row_index(
    df: DataFrame, group: Sequence[str], block: str, order: Sequence[str], out: str = "row_index"
) -> DataFrame:
    """Zero-based position of each row in its group."""
    return running_total(df, group, block, order, F.lit(1), out, inclusive=False)


def positioned_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines with file, start of the split they lie in, and an order within the split."""
    load = paths if isinstance(paths, str) else list(paths)
    return spark.read.text(load, lineSep="\n", recursiveFileLookup=True).select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POSITION),
    )


def indexed_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines with their zero-based number in the file, however large the file is."""
    lines = positioned_lines(spark, paths)
    return row_index(lines, [FILE], BLOCK, [POSITION]).drop(BLOCK, POSITION)


def row_slice(
    df: DataFrame, start_row: int, num_rows: int | None = None, index: str = "row_index"
) -> DataFrame:
    """Skip ``start_row`` rows of each group and take the next ``num_rows``."""
    kept = df.filter(F.col(index) >= start_row)
    return kept if num_rows is None else kept.filter(F.col(index) < start_row + num_rows)


def part_number(index: Column, chunk_rows: int) -> Column:
    """One-based number of the chunk a row belongs to."""
    return (F.floor(index / F.lit(chunk_rows)) + 1).cast("bigint")


def take_while(df: DataFrame, key: Sequence[str], position: str, stop: Column) -> DataFrame:
    """Rows of each group before the first one that meets ``stop``.

    One stop position per group, found with map-side aggregation and joined back. NULL
    keys are groups like any other.
    """
    names = [f"_key_{i}" for i in range(len(key))]
    stops = (
        df.filter(stop)
        .groupBy(*[F.col(k).alias(n) for k, n in zip(key, names)])
        .agg(F.min(position).alias("_stop"))
    )
    same = F.lit(True)
    for k, n in zip(key, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return (
        df.join(stops, same, "left")
        .filter(F.col("_stop").isNull() | (F.col(position) < F.col("_stop")))
        .drop("_stop", *names)
    )


def first_match(value: Column, position: Column, test: Column) -> Column:
    """Aggregate: value at the lowest position that passes the test."""
    return F.min_by(value, F.when(test, position))


def last_match(value: Column, position: Column, test: Column) -> Column:
    """Aggregate: value at the highest position that passes the test."""
    return F.max_by(value, F.when(test, position))


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group. ``order`` has to be total.

    The limit on the row number lets Spark cut every group to ``k`` rows in each task
    before the shuffle (WindowGroupLimit), so no group is gathered whole.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def offsets(layout: DataFrame, block_size: int = 4096) -> DataFrame:
    """Add ``offset``: the summed widths before each field; negative widths count 0."""
    blocked = layout.withColumn("_fields", F.floor(F.col("ord") / block_size))
    width = F.greatest(F.coalesce(F.col("width"), F.lit(0)), F.lit(0))
    return running_total(
        blocked, ["layout_file"], "_fields", ["ord"], width, "offset", inclusive=False
    ).drop("_fields")


def width_fallback(layout: DataFrame, width: Column) -> DataFrame:
    """Add ``width``: the parsed one, else the distance to the next start, else 0.

    The next field is found by an equi-join on its ordinal, whose key is unique.
    """
    following = layout.select(
        "layout_file", (F.col("ord") - 1).alias("ord"), F.col("start").alias("_next")
    )
    return (
        layout.join(following, ["layout_file", "ord"], "left")
        .withColumn("width", F.coalesce(width, F.col("_next") - F.col("start"), F.lit(0)))
        .drop("_next")
    )

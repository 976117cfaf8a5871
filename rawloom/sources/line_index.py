"""A stored index of lines: slices of large files that read only the blocks they need."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawloom.operators.ordered import FILE

#: Bytes that a task takes from a file at a time.
READ_BYTES = 1 << 20
PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|xz)$"


def _load(paths: str | Sequence[str]) -> str | list[str]:
    return paths if isinstance(paths, str) else list(paths)


def _refuse(bad: Column, message: Column) -> Column:
    """A filter, so that the check survives whatever columns are selected later."""
    return F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def count_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row for each block in which a line begins: ``_file``, ``block_start``, ``block_length``,
    ``first_line`` (lines of the file before it), ``n_lines``, and the file's ``length`` and ``modified``.

    A line belongs to the block in which Spark reads it. Blocks are as large as the session's
    ``spark.sql.files.maxPartitionBytes`` makes them. Only block totals are shuffled.
    Compressed files, which have no blocks of their own, raise.
    """
    place = F.col("_metadata.file_path")
    counted = (
        spark.read.text(_load(paths), lineSep="\n", recursiveFileLookup=True)
        .where(_refuse(place.rlike(PACKED), F.concat(F.lit("a compressed file has no line index: "), place)))
        .groupBy(
            place.alias(FILE),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.col("_metadata.file_block_length").alias("block_length"),
            F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    earlier = Window.partitionBy(FILE).orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_lines").over(earlier), F.lit(0))
    return counted.select(FILE, "block_start", "block_length", before.alias("first_line"), "n_lines", "length", "modified")


def write_line_index(spark: SparkSession, paths: str | Sequence[str], out: str) -> DataFrame:
    """Count the lines of all blocks once and keep the result, a Parquet table, in ``out``."""
    count_lines(spark, paths).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def slice_blocks(
    spark: SparkSession, paths: str | Sequence[str], line_index: str | DataFrame, start_row: int = 0, num_rows: int | None = None
) -> DataFrame:
    """Blocks that hold lines of the slice, with ``skip`` and ``take``: lines to leave out and to keep in each.

    Files are listed, not read. A file that the index doesn't know, or that has changed since, raises.
    """
    index = spark.read.parquet(line_index) if isinstance(line_index, str) else line_index
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_load(paths))
        .select(
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_size").alias("_size"),
            F.col("_metadata.file_modification_time").alias("_changed"),
        )
    )
    known = index.where("first_line = 0").select(FILE, "length", "modified")
    same = F.coalesce((F.col("length") == F.col("_size")) & (F.col("modified") == F.col("_changed")), F.lit(False))
    trouble = F.concat(F.lit("not in the line index, or changed since: "), F.col(FILE))
    current = listed.join(known, FILE, "left").where("_size > 0").where(_refuse(~same, trouble)).select(FILE)
    first, end = F.col("first_line"), F.col("first_line") + F.col("n_lines")
    needed = index.where(end > start_row)
    last = end
    if num_rows is not None:
        needed = needed.where(first < start_row + num_rows)
        last = F.least(end, F.lit(start_row + num_rows))
    skip = F.greatest(F.lit(start_row) - first, F.lit(0))
    return (
        needed.join(current, FILE)
        .select(FILE, "block_start", "block_length", "first_line", skip.cast("long").alias("skip"), (last - first - skip).cast("long").alias("take"))
        .where("take > 0")
    )


def _own_lines(file, start: int, end: int, skip: int, take: int) -> Iterator[list[bytes]]:
    """Lines that begin after ``start`` (or with the file) and not after ``end``, some at a time."""
    file.seek(start)
    parts, at = [], start
    skip += start > 0  # what a block begins with is the end of a line of an earlier one
    while take > 0 and at <= end:
        data = file.read(READ_BYTES)
        cut = data.rfind(b"\n") + 1
        if data and not cut:
            parts.append(data)
            continue
        whole = b"".join([*parts, data[:cut]])
        parts = [data[cut:]]
        if not whole:
            return
        lines = whole.split(b"\n")
        if whole.endswith(b"\n"):
            lines.pop()
        at += len(whole)
        kept = lines[skip : skip + take]
        skip -= min(skip, len(lines))
        take -= len(kept)
        if kept:
            yield kept


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    for batch in batches:
        for row in batch.to_pylist():
            system, path = FileSystem.from_uri(row[FILE])
            number = row["first_line"] + row["skip"]
            with system.open_input_file(path) as file:
                start = row["block_start"]
                for lines in _own_lines(file, start, start + row["block_length"], row["skip"], row["take"]):
                    numbers = pa.array(range(number, number + len(lines)), pa.int64())
                    number += len(lines)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lines, pa.binary()), pa.array([row[FILE]] * len(lines)), numbers], ["value", FILE, "row_index"]
                    )
            missing = row["first_line"] + row["skip"] + row["take"] - number
            if missing:
                raise ValueError(f"{row[FILE]}: {missing} lines fewer than its line index says")


def read_line_slice(
    spark: SparkSession, paths: str | Sequence[str], line_index: str | DataFrame, start_row: int = 0, num_rows: int | None = None
) -> DataFrame:
    """Lines ``start_row`` to ``start_row + num_rows`` of each file: ``value``, ``_file``, ``row_index``.

    Each block that the slice meets is a task of its own, which reads that block alone, up to the last line
    wanted; no line is counted again or shuffled. These tasks open files by pyarrow's file systems, which
    therefore have to know the paths' scheme; what follows stays in the JVM.
    """
    blocks = slice_blocks(spark, paths, line_index, start_row, num_rows)
    tasks = max(blocks.count(), 1)  # a row for each block, none for a line
    lines = blocks.repartition(tasks).mapInArrow(_read, f"value binary, {FILE} string, row_index long")
    return lines.withColumn("value", F.col("value").cast("string"))

"""Incremental intake: each new raw file is read once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rawloom.functions.casting import cast_by_layout
from rawloom.layout import DELIMITED, Layout
from rawloom.operators.profile import column_profile
from rawloom.sources.delimited import split_delimited
from rawloom.sources.fixedwidth import slice_fixed


def stream_rows(
    spark: SparkSession,
    source: str,
    layout: Layout,
    mode: str = "failfast",
    glob: str | None = None,
    files_per_batch: int | None = None,
    tags: dict[str, Column] | None = None,
    **splitting,
) -> DataFrame:
    """Typed rows of the files that arrive in a folder; the batch plan, on a stream."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if layout.style != DELIMITED:
        reader = reader.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(source)
    if tags:
        lines = lines.select("value", *[c.alias(n) for n, c in tags.items()])
    if layout.style == DELIMITED:
        rows = split_delimited(lines, layout, mode=mode, stripped=True, **splitting)
    else:
        rows = slice_fixed(lines, layout, mode=mode, **splitting)
    return cast_by_layout(rows, layout, mode, stripped=True)


def stream_intake(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append everything new to a Parquet dataset, then stop.

    The checkpoint remembers the files already read, so a second run takes only new ones.
    """
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(out)


def stream_profiles(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Profile each arriving batch.

    A batch that is repeated after a failure replaces its own folder, so every batch is
    profiled exactly once. The raw text of a batch is parsed once and its typed rows are
    kept for the passes of the profile.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            column_profile(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_profiles(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint"))

"""Small helpers on DataFrames that the operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Rows that Spark hands to Python at a time: its default suits short rows, not whole documents.
_BATCH_KEY, _BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def bounded_batches(spark: SparkSession) -> None:
    """Make batches of documents smaller, unless the session has its own setting."""
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(key: Column, of: int) -> Column:
    """crc32 of a key written as text, modulo ``of``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(of)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared one; a temporary folder only for local sessions without any."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="rawloom-llm-")
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts its lineage."""
    bounded_batches(df.sparkSession)
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant that none of the columns has."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def vocabulary(name: str) -> str:
    """The file of a public tokenizer that is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def broadcastable(table: DataFrame, rows: int) -> bool:
    """Whether a stored table has at most so many rows, by its files' footers."""
    return table.count() <= rows


def released() -> None:
    """Give memory that a worker no longer uses back to the machine: workers outlive their tasks, one for each core and Python step."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(work):
    """A function on batches that releases memory when its task has ended."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            released()

    return run


__all__ = ["broadcastable", "free_name", "released", "remainder", "scratch", "stored", "table", "tidy", "vocabulary"]

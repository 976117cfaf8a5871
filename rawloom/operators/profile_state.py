"""Profiles that add up: each batch leaves a small state, and the states of all batches give the profile of all rows.

A state has two tables, both far smaller than the rows: the moments of each column, and a row for each
distinct value, by a hash of 128 bits. Old rows are never read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rawloom.functions.text import column
from rawloom.operators.profile import _by_type, _long, _per_column, countable_columns, numeric_columns, profiled_columns

_SALT = 0x5EED


def moments(df: DataFrame) -> DataFrame:
    """A row for each column: NULLs, and of numbers their count, mean, sum of squared distances from it, least and largest."""
    names, types = profiled_columns(df, ()), {f.name: f.dataType for f in df.schema.fields}
    numeric, countable = set(numeric_columns(df, ())), set(countable_columns(df, ()))
    measures, rows = [], []
    none = F.lit(None).cast("double")
    for i, n in enumerate(names):
        c = column(n)
        measures.append(F.count_if(c.isNull()).alias(f"m{i}"))
        if n in numeric:
            x = c.cast("double")
            measures += [
                F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"square{i}"),
                F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}"),
            ]
        pick = (lambda m, i=i: F.col(f"{m}{i}")) if n in numeric else (lambda m: none)
        error = F.lit(None) if n in countable else F.lit("values of this type cannot be grouped")
        rows.append(
            F.struct(
                F.lit(n).alias("column"), F.lit(i + 1).alias("ord"), F.lit(types[n].simpleString()).alias("data_type"),
                F.col(f"m{i}").alias("missing_values"), pick("n").cast("bigint").alias("n"),
                *[pick(m).alias(m) for m in ("mean", "square", "min", "max")], error.cast("string").alias("error"),
            )
        )
    return df.groupBy().agg(*measures).select(*_per_column((), rows))


def value_hashes(df: DataFrame) -> DataFrame:
    """(``column``, ``h1``, ``h2``, ``n``): how often each value that is not NULL occurs, values by their hashes."""
    out = None
    for group in _by_type(df, countable_columns(df, ())):
        hashes = F.xxhash64("value").alias("h1"), F.xxhash64(F.lit(_SALT), "value").alias("h2")
        part = _long(df, (), group).where("value IS NOT NULL").select("column", *hashes)
        out = part if out is None else out.unionAll(part)
    if out is None:
        return df.sparkSession.createDataFrame([], "column string, h1 bigint, h2 bigint, n bigint")
    return out.groupBy("column", "h1", "h2").agg(F.count("*").alias("n"))


def write_state(df: DataFrame, path: str, batch: int) -> None:
    """Store the state of a batch; the state of a batch that is repeated replaces the earlier one."""
    for name, state in (("moments", moments(df)), ("values", value_hashes(df))):
        state.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")


def merged_profile(spark: SparkSession, path: str) -> DataFrame:
    """``column_profile`` of the rows of all batches, from their states.

    Columns that a batch lacks count there as absent, not as NULL. Of a column whose type changes the last type by name is told.
    """
    states = spark.read.parquet(f"{path}/moments")
    total = states.groupBy("column").agg(
        F.min("ord").alias("ord"),
        F.max("data_type").alias("data_type"),
        F.sum("missing_values").alias("missing_values"),
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.max("error").alias("error"),
    )
    # distances from the common mean, so that nothing large cancels out
    apart = F.col("square") + F.col("n") * (F.col("own") - F.col("mean")) * (F.col("own") - F.col("mean"))
    squares = (
        states.select("column", "n", "square", F.col("mean").alias("own"))
        .join(total.select("column", "mean"), "column")
        .groupBy("column")
        .agg(F.sum(apart).alias("square"))
    )
    unique = spark.read.parquet(f"{path}/values").groupBy("column", "h1", "h2").agg(F.lit(1).alias("one"))
    unique = unique.groupBy("column").agg(F.count("*").alias("unique_values"))
    return total.join(squares, "column").join(unique, "column", "left").select(
        "column",
        "ord",
        "data_type",
        "missing_values",
        F.coalesce("unique_values", F.when(F.col("error").isNull(), 0)).alias("unique_values"),
        "min",
        "max",
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("square") / F.col("n"))).alias("stddev"),
        "error",
    )


def stream_states(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The state of each arriving batch; ``merged_profile`` of ``out`` is the profile of all that ever arrived."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_state(batch, out, batch_id)
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Value counts of long text in two levels: short keys first, texts only for the few that are reported.

The operators of ``profile`` group whole values, so that what they shuffle grows with the length of the texts.
Here a text of 32 bytes or more is represented by its SHA-256, anything shorter by itself, and
the length of a key tells which it is. Equal keys therefore mean equal texts, and no key needs a proof.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawloom.functions.text import column, ident
from rawloom.operators.ordered import top_per_group
from rawloom.operators.profile import _long, profiled_columns, string_columns
from rawloom.session import scratch_dir

#: Bytes of a digest; shorter texts are their own keys.
DIGEST = 32
#: Characters of a text that its key carries, for the order of equal counts.
START = 16


def _key(value: Column) -> Column:
    whole = value.cast("binary")
    return F.when(F.octet_length(value) < DIGEST, whole).otherwise(F.unhex(F.sha2(whole, 256)))


def _keyed(df: DataFrame, names: Sequence[str] | None, by: Sequence[str]) -> DataFrame:
    profiled_columns(df, by)
    names = string_columns(df, by) if names is None else list(names)
    return _long(df, by, names).withColumn("key", _key(F.col("value")))


def long_value_counts(df: DataFrame, names: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """How often each value of each string column occurs, by ``key`` (at most 32 bytes) with the text's ``start``.

    NULL is a value here, with neither key nor start. After map-side aggregation a distinct value
    costs the shuffle at most 100 bytes, however long the texts are.
    """
    keyed = _keyed(df, names, by).withColumn("start", F.substring("value", 1, START))
    return keyed.groupBy(*[column(b) for b in by], "column", "key", "start").agg(F.count(F.lit(1)).alias("n"))


def unique_long_values(df: DataFrame, names: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``unique_values`` of string columns; shares its shuffle with ``top_long_values``."""
    counts = long_value_counts(df, names, by)
    return counts.groupBy(*[column(b) for b in by], "column").agg(F.count(F.when(F.col("n") > 0, F.col("key"))).alias("unique_values"))


def top_long_values(
    df: DataFrame, k: int = 5, by: Sequence[str] = (), names: Sequence[str] | None = None, exclude_null_first: bool = False
) -> DataFrame:
    """The rows of ``top_values``, without a shuffle of whole texts.

    Keys are ranked by count and start of the text. Those that may be among the first ``k`` (ties
    included) are written to scratch at once, when this is called, so that the planner knows
    their size and broadcasts them if they are small; the texts are then looked up in a second pass over the
    data. Only where many texts of equal count begin alike are candidates many.
    """
    own = [column(b) for b in by]
    counts = long_value_counts(df, names, by)
    if exclude_null_first:
        counts = counts.filter(F.col("key").isNotNull())
    ranking = Window.partitionBy(*own, "column").orderBy(F.desc("n"), F.asc_nulls_last("start"))
    path = scratch_dir(df.sparkSession, "top_values")
    counts.withColumn("_rank", F.rank().over(ranking)).filter(F.col("_rank") <= k).drop("_rank", "start").write.parquet(path)
    candidates = df.sparkSession.read.parquet(path)

    short = F.col("key").isNull() | (F.octet_length("key") < DIGEST)
    known = candidates.filter(short).withColumn("value", F.col("key").cast("string"))
    long = candidates.filter(~short)
    texts = _keyed(df, names, by).filter(F.octet_length("value") >= DIGEST).alias("t")
    same = [F.col(f"t.{ident(b)}").eqNullSafe(F.col(f"c.{ident(b)}")) for b in by]
    same += [F.col("t.column") == F.col("c.column"), F.col("t.key") == F.col("c.key")]
    found = long.alias("c").join(texts, reduce(Column.__and__, same)).select("c.*", "t.value").distinct()
    order = [F.desc("n"), F.asc_nulls_last("value")]
    ranked = top_per_group(known.unionByName(found), [*by, "column"], order, k).filter(F.col("value").isNotNull())
    return ranked.select(*own, "column", "value", "n", "rank")

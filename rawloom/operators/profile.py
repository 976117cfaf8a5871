"""Column and dataset profiles.

All functions accept ``by``: columns that name a dataset, so that many datasets are
profiled in the same pass. Results are as small as the number of datasets and columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawloom.functions.text import column, ident
from rawloom.operators.ordered import top_per_group


def profiled_columns(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    if df.isStreaming:
        raise ValueError("profile a stream batch by batch, inside foreachBatch")
    return [c for c in df.columns if c not in by]


def numeric_columns(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in by
    ]


def string_columns(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in by
    ]


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t.fields)


def _groupable(c: Column, t: T.DataType) -> Column:
    """A value that can be grouped: maps become entries in the order of their keys."""
    if not _has_map(t):
        return c
    if isinstance(t, T.MapType):
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.struct(
                _groupable(e["key"], t.keyType).alias("key"),
                _groupable(e["value"], t.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries, lambda a, b: _order(a["key"], b["key"]))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda e: _groupable(e, t.elementType))
    if isinstance(t, T.StructType):
        parts = [_groupable(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    return F.to_json(c)  # variants: their text


def _order(a: Column, b: Column) -> Column:
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def countable_columns(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    """Columns whose values can be grouped; maps cannot."""
    return [f.name for f in df.schema.fields if f.name not in by and not _has_map(f.dataType)]


def _per_column(by: Sequence[str], rows: list[Column]) -> list[Column]:
    return [*[column(b) for b in by], F.inline(F.array(*rows))]


def row_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("actual_rows"))


def column_list(df: DataFrame) -> DataFrame:
    """Names, types and places of the columns as a table."""
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "column string, data_type string, ord int")


def missing_values(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    names = profiled_columns(df, by)
    counted = df.groupBy(*by).agg(
        *[F.count_if(column(n).isNull()).alias(f"m{i}") for i, n in enumerate(names)]
    )
    rows = [
        F.struct(F.lit(n).alias("column"), F.col(f"m{i}").alias("missing_values"))
        for i, n in enumerate(names)
    ]
    return counted.select(*_per_column(by, rows))


def _by_type(df: DataFrame, names: Sequence[str]) -> list[list[str]]:
    groups: dict[str, list[str]] = {}
    wanted = set(names)
    for f in df.schema.fields:
        if f.name in wanted:
            groups.setdefault(f.dataType.simpleString(), []).append(f.name)
    return list(groups.values())


def _long(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    narrow = df.select(*[column(b) for b in by], *[column(n) for n in names])
    if not names:  # a table without such columns has no values
        return narrow.filter(F.lit(False)).withColumns(
            {"column": F.lit(""), "value": F.lit(None).cast("string")}
        )
    return narrow.unpivot(
        [ident(b) for b in by], [ident(n) for n in names], "column", "value"
    )


def value_counts(
    df: DataFrame, names: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """How often each value occurs in each string column; NULL is a value here."""
    profiled_columns(df, by)
    names = string_columns(df, by) if names is None else list(names)
    return _long(df, by, names).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def unique_values(df: DataFrame, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column.

    Per data type, columns are unpivoted and grouped by (column, value): what is
    shuffled is a two-column key after map-side aggregation, so neither the table's
    width nor a frequent value matters. String columns go through ``value_counts``,
    whose shuffle a report shares with ``top_values``. ``approx`` gives estimates
    without that shuffle.
    """
    names = countable_columns(df, by)
    profiled_columns(df, by)
    if approx:
        counted = df.groupBy(*by).agg(
            *[F.approx_count_distinct(column(n)).alias(f"u{i}") for i, n in enumerate(names)]
        )
        rows = [
            F.struct(F.lit(n).alias("column"), F.col(f"u{i}").alias("unique_values"))
            for i, n in enumerate(names)
        ]
        return counted.select(*_per_column(by, rows))
    out = None
    for group in _by_type(df, names):
        if isinstance(df.schema[group[0]].dataType, T.StringType):
            # Using n keeps this shuffle equal to that of top_values, so it can be reused.
            values = value_counts(df, group, by)
            unique = F.count(F.when(F.col("n") > 0, F.col("value")))
        else:
            values, unique = _long(df, by, group), F.count_distinct("value")
        part = values.groupBy(*by, "column").agg(unique.alias("unique_values"))
        out = part if out is None else out.unionAll(part)
    return out


def top_values(
    df: DataFrame,
    k: int = 5,
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    exclude_null_first: bool = False,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` most frequent values of each string column.

    Equal counts are ordered by value. NULL takes part in the ranking and is dropped
    afterwards, so fewer than ``k`` values may remain; ``exclude_null_first`` ranks
    without it.
    """
    counts = value_counts(df, names, by) if counts is None else counts
    if exclude_null_first:
        counts = counts.filter(F.col("value").isNotNull())
    order = [F.desc("n"), F.asc_nulls_last("value")]
    return top_per_group(counts, [*by, "column"], order, k).filter(F.col("value").isNotNull())


def top_of_column(df: DataFrame, name: str, k: int = 5) -> DataFrame:
    """Single-column form; each task keeps ``k`` rows."""
    counts = df.groupBy(column(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(k)


def _surplus(groups: DataFrame, by: Sequence[str]) -> DataFrame:
    repeated = groups.filter(F.col("_copies") > 1)
    return repeated.groupBy(*by).agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows")
    )


def duplicate_rows(
    df: DataFrame, by: Sequence[str] = (), prefilter: bool = False
) -> DataFrame:
    """Surplus copies of whole rows (NULLs equal).

    Without ``by`` the result is one row, 0 when there are none; with ``by`` only
    datasets that have duplicates appear.

    ``prefilter`` suits long rows with few copies: a first pass shuffles only a 64-bit
    hash and a count per row, and a second pass groups, exactly, just the rows whose
    hash occurs more than once. The planner broadcasts these hashes if they are few.

    Maps are equal if they hold the same entries, in whatever order.
    """
    names = profiled_columns(df, by)
    df = df.select(*[column(b) for b in by], *[_groupable(column(f.name), f.dataType).alias(f.name)
                                               for f in df.schema.fields if f.name not in by])
    if prefilter:
        keyed = df.withColumn("_hash", F.xxhash64(*[column(n) for n in [*by, *names]]))
        hashes = keyed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
        repeated = hashes.filter(F.col("_n") > 1).select("_hash")
        df = keyed.join(repeated, "_hash", "left_semi").drop("_hash")
    groups = df.groupBy(*[column(n) for n in [*by, *names]]).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    return _surplus(groups, by)


def numeric_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Minimum, maximum, mean and population deviation, all columns in one pass."""
    profiled_columns(df, by)
    names = numeric_columns(df, by)
    if not names:
        none = [F.lit(None).cast("double").alias(m) for m in ("min", "max", "mean", "stddev")]
        empty = df.filter(F.lit(False))
        return empty.select(*[column(b) for b in by], F.lit("").alias("column"), *none)
    measures = []
    for i, n in enumerate(names):
        c = column(n)
        measures += [
            F.min(c).cast("double").alias(f"min{i}"),
            F.max(c).cast("double").alias(f"max{i}"),
            F.avg(c).cast("double").alias(f"mean{i}"),
            F.when(F.count(c) > 1, F.stddev_pop(c)).alias(f"sd{i}"),
        ]
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.col(f"min{i}").alias("min"),
            F.col(f"max{i}").alias("max"),
            F.col(f"mean{i}").alias("mean"),
            F.col(f"sd{i}").alias("stddev"),
        )
        for i, n in enumerate(names)
    ]
    return df.groupBy(*by).agg(*measures).select(*_per_column(by, rows))


def column_profile(df: DataFrame, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """One row per column: type, missing, unique, and the numeric measures."""
    names = profiled_columns(df, by)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = set(numeric_columns(df, by))
    countable = set(countable_columns(df, by))
    measures, rows = [], []
    null = F.lit(None).cast("double")
    for i, n in enumerate(names):
        c = column(n)
        measures.append(F.count_if(c.isNull()).alias(f"m{i}"))
        if n in numeric:
            measures += [
                F.min(c).cast("double").alias(f"min{i}"),
                F.max(c).cast("double").alias(f"max{i}"),
                F.avg(c).cast("double").alias(f"mean{i}"),
                F.when(F.count(c) > 1, F.stddev_pop(c)).alias(f"sd{i}"),
            ]
        pick = (lambda m, i=i: F.col(f"{m}{i}")) if n in numeric else (lambda m: null)
        error = F.lit(None) if n in countable else F.lit("values of this type cannot be grouped")
        rows.append(
            F.struct(
                F.lit(n).alias("column"),
                F.lit(i + 1).alias("ord"),
                F.lit(types[n].simpleString()).alias("data_type"),
                F.col(f"m{i}").alias("missing_values"),
                pick("min").alias("min"),
                pick("max").alias("max"),
                pick("mean").alias("mean"),
                pick("sd").alias("stddev"),
                error.cast("string").alias("error"),
            )
        )
    measured = df.groupBy(*by).agg(*measures).select(*_per_column(by, rows))
    unique = unique_values(df, by, approx)
    if by:
        keys = F.lit(True)
        left, right = measured.alias("l"), unique.alias("r")
        for k in [*by, "column"]:
            keys = keys & F.col(f"l.{ident(k)}").eqNullSafe(F.col(f"r.{ident(k)}"))
        joined = left.join(right, keys, "left").select("l.*", "r.unique_values")
    else:
        joined = measured.join(unique, "column", "left")
    return joined.select(
        *by,
        "column",
        "ord",
        "data_type",
        "missing_values",
        F.coalesce("unique_values", F.when(F.col("error").isNull(), 0)).alias("unique_values"),
        "min",
        "max",
        "mean",
        "stddev",
        "error",
    )


@dataclass(frozen=True)
class Profile:
    """Lazy parts of a dataset's profile."""

    shape: DataFrame
    columns: DataFrame
    top: DataFrame
    duplicates: DataFrame | None
    by: tuple[str, ...] = ()


def profile(
    df: DataFrame, by: Sequence[str] = (), k: int = 5, approx: bool = False,
    prefilter_duplicates: bool = False, duplicates: bool = True,
) -> Profile:
    """All parts of a profile; without ``duplicates`` nothing shuffles whole rows."""
    names = profiled_columns(df, by)
    shape = row_count(df, by).withColumn("actual_columns", F.lit(len(names)))
    return Profile(
        shape=shape,
        columns=column_profile(df, by, approx),
        top=top_values(df, k, by),
        duplicates=duplicate_rows(df, by, prefilter_duplicates) if duplicates else None,
        by=tuple(by),
    )

"""The quality report: profile and reconciliation as one JSON text per dataset."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawloom.functions.text import column
from rawloom.operators.profile import Profile, numeric_columns, profile, profiled_columns


def _by_name(entries: Column) -> Column:
    """(ord, column, body) entries as one map in column order."""
    ordered = F.array_sort(entries, lambda a, b: (a["ord"] - b["ord"]).cast("int"))
    return F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["column"], e["body"])))


def _name_array(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def _json(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def _json_object(name: str) -> Column:
    return F.coalesce(_json(F.col(name)), F.lit("{}"))


def report(
    df: DataFrame,
    expected: DataFrame | None = None,
    by: Sequence[str] = (),
    result: Profile | None = None,
) -> DataFrame:
    """One ``report`` text per dataset.

    ``expected`` has ``by`` and expected_rows, expected_columns, expected_names; without
    ``by`` it is one row. All pieces grow with the number of columns only; they are
    put side by side by a union and a grouping, so no join is needed.
    """
    result = result or profile(df, by)
    names = profiled_columns(df, by)
    numeric = numeric_columns(df, by)

    checked = F.struct("missing_values", "unique_values").alias("body")
    measured = F.struct("min", "max", "mean", "stddev").alias("body")
    columns = result.columns.groupBy(*by).agg(
        _by_name(F.collect_list(F.struct("ord", "column", checked))).alias("column_checks"),
        _by_name(
            F.collect_list(
                F.when(F.col("column").isin(numeric), F.struct("ord", "column", measured))
            )
        ).alias("numeric_summary"),
    )
    top = (
        result.top.groupBy(*by, "column")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("ranked"))
        .select(
            *by,
            F.array_position(_name_array(names), F.col("column")).alias("ord"),
            "column",
            F.map_from_entries(
                F.transform("ranked", lambda r: F.struct(r["value"], r["n"]))
            ).alias("body"),
        )
    )
    pieces = [
        result.shape,
        columns,
        top.groupBy(*by).agg(
            _by_name(F.collect_list(F.struct("ord", "column", "body"))).alias("top_categories")
        ),
    ]
    if result.duplicates is not None:
        pieces.append(result.duplicates)
    told_schema = T.StructType(
        [
            T.StructField("expected_rows", T.LongType()),
            T.StructField("expected_columns", T.IntegerType()),
            T.StructField("expected_names", T.ArrayType(T.StringType())),
        ]
    )
    if expected is None:
        pieces.append(df.sparkSession.createDataFrame([], told_schema))
    else:
        pieces.append(expected.select(*by, *told_schema.names))
    side_by_side = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    values = [c for c in side_by_side.columns if c not in by]
    out = side_by_side.groupBy(*by).agg(*[F.first(c, True).alias(c) for c in values])
    out = out.filter(F.col("actual_rows").isNotNull())

    actual, told = _name_array(names), F.col("expected_names")
    rows, columns_told = F.col("expected_rows"), F.col("expected_columns")
    # Fixed format: the report's keys, in the order readers of it know. Expectations that
    # do not exist are absent from shape_check; elsewhere they are null.
    shape = F.to_json(
        F.struct(
            "actual_rows",
            "actual_columns",
            "expected_rows",
            F.when(rows.isNotNull(), F.col("actual_rows") != rows).alias("row_mismatch"),
            "expected_columns",
            F.when(columns_told.isNotNull(), F.col("actual_columns") != columns_told).alias(
                "column_mismatch"
            ),
        )
    )
    names_part = _json(
        F.struct(
            actual.alias("actual_columns"),
            told.alias("expected_columns"),
            F.filter(told, lambda n: ~F.array_contains(actual, n)).alias("missing_columns"),
            F.when(
                told.isNotNull(), F.filter(actual, lambda n: ~F.array_contains(told, n))
            ).alias("unexpected_columns"),
            told.isNotNull().alias("fts_used_for_schema"),
        )
    )
    text = F.concat(
        F.lit('{"shape_check":'),
        shape,
        F.lit(","),
        F.substring(names_part, F.lit(2), F.length(names_part) - 2),
        F.lit(',"column_checks":'),
        _json_object("column_checks"),
        F.lit(',"duplicate_rows":'),
        F.lit("null") if result.duplicates is None else F.coalesce("duplicate_rows", F.lit(0)).cast("string"),
        F.lit(',"numeric_summary":'),
        _json_object("numeric_summary"),
        F.lit(',"top_categories":'),
        _json_object("top_categories"),
        F.lit("}"),
    )
    return out.select(*[column(b) for b in by], text.alias("report"))

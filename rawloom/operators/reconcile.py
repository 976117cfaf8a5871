"""Comparing what is there with what the layout declares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Status of each (dataset, column): missing, unexpected or matched.

    Names compare exactly. ``ord`` gives the expected place, or the actual one for
    unexpected columns.
    """
    here = actual.select("dataset", "column", F.col("ord").alias("_actual"))
    told = expected.select("dataset", "column", F.col("ord").alias("_expected"))
    return here.join(told, ["dataset", "column"], "full").select(
        "dataset",
        "column",
        F.when(F.col("_actual").isNull(), "missing")
        .when(F.col("_expected").isNull(), "unexpected")
        .otherwise("matched")
        .alias("status"),
        F.coalesce("_expected", "_actual").alias("ord"),
    )


def missing_columns(actual: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.join(actual, ["dataset", "column"], "left_anti")


def unexpected_columns(actual: DataFrame, expected: DataFrame) -> DataFrame:
    return actual.join(expected, ["dataset", "column"], "left_anti")


def name_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference of names."""
    return left.select("dataset", "column").subtract(right.select("dataset", "column"))


def shape_check(actual: DataFrame, expected: DataFrame, key: Sequence[str] = ("dataset",)):
    """Add expectations and mismatch flags; without an expectation they stay NULL."""
    rows, columns = F.col("expected_rows"), F.col("expected_columns")
    return actual.join(expected, list(key), "left").select(
        *key,
        "actual_rows",
        "actual_columns",
        "expected_rows",
        F.when(rows.isNotNull(), F.col("actual_rows") != rows).alias("row_mismatch"),
        "expected_columns",
        F.when(columns.isNotNull(), F.col("actual_columns") != columns).alias("column_mismatch"),
    )

"""Shared helpers of the query catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.functions.text import WHITESPACE

# The same white space as an SQL expression.
SQL_WHITESPACE = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_char(expression: str) -> str:
    """SQL for CHAR: strip white space, blank is NULL."""
    return f"nullif(trim({expression}, {SQL_WHITESPACE}), '')"


def money(name: str) -> Column:
    """A two-decimal amount in plain notation."""
    return F.col(name).cast("decimal(18,2)").cast("string")


class Catalog:
    """Collects a module's queries and their SQL."""

    def __init__(self) -> None:
        self.queries = {}
        self.oracles = {}

    def add(self, name: str, sql: str | None = None):
        def keep(run):
            self.queries[name] = run
            if sql is not None:
                self.oracles[name] = sql
            return run

        return keep

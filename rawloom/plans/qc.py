"""Checking a Parquet folder that is there already against a layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.functions.names import base_name
from rawloom.plans.report import report
from rawloom.sources.dataset import write_report
from rawloom.sources.layouts import layout_file_rows, layout_shapes, parsed_layouts, read_layout_texts

REPORT_FOLDER = "_qc_report"


def declared(
    spark: SparkSession, layout: str | DataFrame, data_file: str | None = None, parity: bool = False
) -> DataFrame:
    """What one layout declares: expected_rows, expected_columns and expected_names, one row.

    ``layout`` is the path of a layout file, or a table (layout_file, text) with one row.
    With ``data_file``, rows declared for that file count before the layout's total.
    """
    texts = read_layout_texts(spark, layout, "*") if isinstance(layout, str) else layout
    parsed = parsed_layouts(texts, parity=parity)
    shapes = layout_shapes(parsed).select("layout_file", "expected_rows", "expected_columns", "expected_names")
    if data_file is not None:
        own = layout_file_rows(parsed).where(F.col("data_file") == base_name(F.lit(data_file)))
        own = own.select("layout_file", F.col("expected_rows").alias("_own"))
        shapes = shapes.join(own, "layout_file", "left").withColumn("expected_rows", F.coalesce("_own", "expected_rows"))
    return shapes.select("expected_rows", "expected_columns", "expected_names")


def qc_folder(
    spark: SparkSession, folder: str, layout: str | DataFrame | None = None, data_file: str | None = None,
    parity: bool = False, out: str | None = "auto",
) -> DataFrame:
    """Profile a Parquet folder and compare it with a layout: one ``report`` text.

    Without a layout the expectations are absent. The report is also stored: in ``out``, by default in the
    folder's ``_qc_report``, which readers of the folder pass over; None stores nothing.
    """
    if out == "auto":
        out = f"{folder.rstrip('/')}/{REPORT_FOLDER}"
    rows = spark.read.parquet(folder)
    told = None if layout is None else declared(spark, layout, data_file, parity)
    if told is not None:  # one row, computed once
        told = spark.createDataFrame(told.collect(), told.schema)
    found = report(rows, told)
    if out is not None:
        write_report(found, out)
        return spark.read.text(out).withColumnRenamed("value", "report")
    return found

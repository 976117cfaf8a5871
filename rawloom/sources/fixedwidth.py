"""Fixed-width records: slicing lines by a layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.functions.casting import REASON, cast_by_layout, check_mode
from rawloom.functions.text import (
    column,
    decode_bytes,
    is_utf8,
    printable,
    strip_fields,
    without_return,
)
from rawloom.layout import Layout
from rawloom.operators.ordered import indexed_lines, row_slice
from rawloom.sources.line_index import read_line_slice
from rawloom.sources.tags import tagged


_PLAIN, _DATA, _TEXT, _HERE = "_printable", "_bytes", "_text", "_here"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines ended by a line feed only, their bytes untouched, files split freely."""
    return spark.read.text(
        paths if isinstance(paths, str) else list(paths), lineSep="\n", recursiveFileLookup=True
    )


def _byte_fields(layout: Layout, starts: list[int], encoding: str) -> list[Column]:
    """Fields cut from bytes. A printable line has one byte a character, so that its bytes are its
    text; only other lines are checked and repaired."""
    data, plain = F.col(_DATA), F.col(_PLAIN)
    out = []
    for f, start in zip(layout.fields, starts):
        if f.name:
            raw = F.substring(data, start + 1, max(f.width, 0))
            out.append(F.when(plain, raw.cast("string")).otherwise(decode_bytes(raw, encoding)).alias(f.name))
    return out


def _char_fields(layout: Layout, starts: list[int], encoding: str) -> list[Column]:
    line = F.when(F.col(_PLAIN), F.col(_TEXT)).otherwise(decode_bytes(F.col(_DATA), encoding))
    rest_of_line = 2**31 - 1
    last = len(layout.fields) - 1
    return [
        F.substring(line, start + 1, rest_of_line if i == last else max(f.width, 0)).alias(f.name)
        for i, (f, start) in enumerate(zip(layout.fields, starts))
        if f.name
    ]


def slice_fixed(
    df: DataFrame,
    layout: Layout,
    value_col: str = "value",
    unit: str | None = None,
    mode: str = "failfast",
    encoding: str = "utf-8",
    offsets: str = "cumulative",
    count_newline: bool = False,
    stored_lines: bool = False,
) -> DataFrame:
    """Cut each line into the layout's fields, as strings without outer white space.

    ``unit="byte"`` cuts bytes and wants complete records: a short one fails
    (``failfast``), is marked in ``_corrupt_reason`` (``permissive``) or removed
    (``drop``). ``unit="char"`` cuts characters, gives the last field the rest of the
    line and lets short lines end in empty fields. By default the unit is bytes unless
    the layout leaves a width open. ``count_newline`` lets the line feed stand in for
    one missing byte. Other columns of ``df`` follow unchanged. ``stored_lines`` says that lines are read
    as they are; else they are computed in one place, before the checks, which would compute them again.
    """
    check_mode(mode)
    unit = unit or layout.default_unit
    starts = layout.offsets(offsets)
    value = column(value_col)
    others = [column(c) for c in df.columns if c != value_col]
    if unit not in ("byte", "char"):
        raise ValueError("unit must be 'byte' or 'char'")
    if not stored_lines:
        # filters are not pushed below a column like this
        df = df.select(*others, value.alias(value_col), F.spark_partition_id().alias(_HERE))
    seen = F.lit(True) if stored_lines else F.col(_HERE) >= 0
    marks = []
    if unit == "byte":
        needed = max(start + max(f.width, 0) for f, start in zip(layout.fields, starts))
        found = F.octet_length(value) + (1 if count_newline else 0)
        short = found < needed
        message = F.concat(F.lit(f"record shorter than {needed} bytes: "), found.cast("string"))
        if mode == "failfast":
            # A filter, so that the check survives whatever columns are selected later.
            complaint = F.raise_error(message).cast("boolean")
            df = df.filter(F.when(short, complaint).otherwise(seen))
        elif mode == "drop":
            df = df.filter(~short & seen)
        else:
            marks = [F.when(short, message).alias(REASON)]
        fields = _byte_fields(layout, starts, encoding)
    else:
        if mode == "permissive":
            marks = [F.lit(None).cast("string").alias(REASON)]
        fields = _char_fields(layout, starts, encoding)

    # Looking for rare white space once per line spares looking for it in every field.
    marked = [F.col(REASON)] if marks else []
    text = F.col(_DATA).cast("string") if is_utf8(encoding) else F.decode(_DATA, encoding)
    lines = df.select(*others, *marks, without_return(value).alias(_DATA))
    lines = lines.withColumn(_TEXT, text).withColumn(_PLAIN, printable(F.col(_TEXT)))
    cut = lines.select(*fields, *others, *marked, _PLAIN)
    return cut.select(*strip_fields(layout.names, F.col(_PLAIN)), *others, *marked)


def read_fixed_width(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: Layout,
    mode: str = "failfast",
    tags: dict[str, Column] | None = None,
    start_row: int = 0,
    num_rows: int | None = None,
    line_index: str | DataFrame | None = None,
    tags_per_file: bool = False,
    **slicing,
) -> DataFrame:
    """Typed table of fixed-width files. ``tags`` adds columns, e.g. from the path; with
    ``tags_per_file`` they follow from the path alone and are computed once a file.

    ``start_row`` and ``num_rows`` take a slice of each file. Lines have to be counted
    and shuffled for that; reading whole files needs neither. With a ``line_index`` (see
    ``write_line_index``) they were counted before, and a slice reads only its blocks.
    """
    if start_row or num_rows is not None:
        if tags:
            raise ValueError("a slice of rows carries no tags")
        if line_index is not None:
            lines = read_line_slice(spark, paths, line_index, start_row, num_rows)
        else:
            lines = row_slice(indexed_lines(spark, paths), start_row, num_rows)
        lines = lines.select("value")
    else:
        lines = read_lines(spark, paths)
    if tags:
        lines = tagged(lines, tags, tags_per_file)
    cut = slice_fixed(lines, layout, mode=mode, stored_lines=True, **slicing)
    return cast_by_layout(cut, layout, mode, stripped=True)

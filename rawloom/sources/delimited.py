"""Delimited text without a header row, columns named by a layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.functions.casting import REASON, cast_by_layout, check_mode, string_schema
from rawloom.functions.text import column, ident, is_utf8, printable, strip_fields
from rawloom.layout import Layout
from rawloom.sources.tags import tagged

_RECORD = "_parsed_record"
_BAD = "_bad_record"
_PLAIN = "_printable"


def _csv_options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def split_delimited(
    df: DataFrame,
    layout: Layout,
    value_col: str = "value",
    mode: str = "failfast",
    encoding_errors: str = "fail",
    sep: str = ",",
    stripped: bool = False,
    encoding: str = "utf-8",
) -> DataFrame:
    """Split each line into the layout's columns, all strings.

    ``stripped`` removes outer white space from the fields.

    Empty lines are skipped. A line with too few or too many fields, or (with
    ``encoding_errors="fail"``) with bytes that are not UTF-8, is malformed: it fails,
    is marked or is removed according to ``mode``.
    """
    check_mode(mode)
    if encoding_errors not in ("fail", "replace"):
        raise ValueError("encoding_errors must be 'fail' or 'replace'")
    value = column(value_col)
    others = [c for c in df.columns if c != value_col]
    rest = [column(c) for c in others]
    lines = df.filter(F.octet_length(value) > 0)
    if not is_utf8(encoding):
        line = F.decode(value.cast("binary"), encoding)
    else:
        line = value if encoding_errors == "fail" else F.make_valid_utf8(value)
    options = _csv_options(sep)
    record = F.col(_RECORD)
    fields = [F.col(f"{_RECORD}.{ident(n)}").alias(n) for n in layout.names]
    plain = printable(line).alias(_PLAIN)

    def finish(rows: DataFrame, *marks: Column) -> DataFrame:
        if not stripped:
            return rows.select(*fields, *rest, *marks)
        named = rows.select(*fields, *rest, *marks, _PLAIN)
        marked = [F.col(REASON)] if marks else []
        return named.select(*strip_fields(layout.names, F.col(_PLAIN)), *rest, *marked)

    schema = string_schema(layout.names).add(_BAD, "string").toDDL()
    parsed = F.from_csv(line, schema, options | {"columnNameOfCorruptRecord": _BAD})
    if mode == "failfast":
        # Filters, so that the checks survive whatever columns are selected later. The
        # outer explode of one record keeps the second one above the parsing.
        bad_text = F.raise_error(F.lit("line is not valid UTF-8")).cast("boolean")
        lines = lines.filter(F.when(~F.is_valid_utf8(line), bad_text).otherwise(True))
        once = lines.select(F.explode_outer(F.array(parsed)).alias(_RECORD), plain, *rest)
        found = F.concat(F.lit(f"malformed line, expected {len(layout.names)} fields: "), record[_BAD])
        ragged = F.raise_error(found).cast("boolean")
        return finish(once.filter(F.when(record[_BAD].isNotNull(), ragged).otherwise(True)))
    if mode == "drop":
        once = lines.filter(F.is_valid_utf8(line)).select(
            F.explode_outer(F.array(parsed)).alias(_RECORD), plain, *rest
        )
        return finish(once.filter(record[_BAD].isNull()))
    reason = F.when(~F.col("_valid_text"), F.lit("not valid UTF-8")).when(
        record[_BAD].isNotNull(),
        F.concat(F.lit(f"expected {len(layout.names)} fields: "), record[_BAD]),
    )
    once = lines.select(
        parsed.alias(_RECORD), F.is_valid_utf8(line).alias("_valid_text"), plain, *rest
    )
    return finish(once, reason.alias(REASON))


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: Layout,
    mode: str = "failfast",
    header: bool = False,
    multiline: bool = False,
    encoding_errors: str = "fail",
    sep: str = ",",
    tags: dict[str, Column] | None = None,
    encoding: str = "utf-8",
    tags_per_file: bool = False,
) -> DataFrame:
    """Typed table of delimited files. ``tags`` adds columns, e.g. from the path; with ``tags_per_file`` they follow from
    the path alone and are computed once a file.

    Lines are read as text first, because only there bad bytes can still be seen.
    ``header=True`` (skip the first line of each file) and ``multiline=True`` (line
    breaks inside quotes, which makes files unsplittable) use Spark's CSV reader, which
    replaces bad bytes instead; they need ``encoding_errors="replace"``.
    """
    check_mode(mode)
    load = paths if isinstance(paths, str) else list(paths)
    tags = tags or {}
    if not header and not multiline:
        lines = tagged(spark.read.text(load, recursiveFileLookup=True), tags, tags_per_file)
        rows = split_delimited(
            lines, layout, "value", mode, encoding_errors, sep, stripped=True, encoding=encoding
        )
        return cast_by_layout(rows, layout, mode, stripped=True)

    if encoding_errors != "replace":
        raise ValueError("header and multiline need encoding_errors='replace'")
    schema = string_schema(layout.names)
    options = _csv_options(sep) | {"encoding": encoding}
    if mode == "failfast":
        options["mode"] = "FAILFAST"
    elif mode == "drop":
        options["mode"] = "DROPMALFORMED"
    else:
        schema = schema.add(_BAD, "string")
        options["columnNameOfCorruptRecord"] = _BAD
    rows = (
        spark.read.schema(schema)
        .options(**options)
        .csv(load, header=header, multiLine=multiline, recursiveFileLookup=True)
    )
    rows = tagged(rows, tags, tags_per_file)
    tag_columns = [column(n) for n in tags]
    if mode == "permissive":
        reason = F.when(F.col(_BAD).isNotNull(), F.lit("malformed record")).alias(REASON)
        rows = rows.select(*[column(n) for n in layout.names], *tag_columns, reason)
    else:
        rows = rows.select(*[column(n) for n in layout.names], *tag_columns)
    return cast_by_layout(rows, layout, mode)

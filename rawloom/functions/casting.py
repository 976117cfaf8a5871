"""Casts declared by a layout: CHAR, NUM and DATE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawloom.functions.text import blank_to_null, column, strip
from rawloom.layout import Layout

MODES = ("failfast", "permissive", "drop")
REASON = "_corrupt_reason"

# What counts as a number or a date in a raw field.
NUM_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
DATE_PATTERN = r"^(?!0000)[0-9]{8}$"
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode


def char(c: Column) -> Column:
    return blank_to_null(c)


def _num_of(text: Column) -> Column:
    return F.when(text.rlike(NUM_PATTERN), text.cast("double"))


def _date_of(text: Column) -> Column:
    dashed = F.concat(
        F.substring(text, 1, 4),
        F.lit("-"),
        F.substring(text, 5, 2),
        F.lit("-"),
        F.substring(text, 7, 2),
    )
    return F.when(text.rlike(DATE_PATTERN), dashed.try_cast("date"))


def _date_or_fail(text: Column) -> Column:
    complaint = F.raise_error(F.concat(F.lit("not a yyyyMMdd date: "), text)).cast("date")
    return F.coalesce(_date_of(text), F.when(text != "", complaint))


def num(c: Column) -> Column:
    """Plain decimal notation only; ``+5``, ``.5``, ``1e5``, ``NaN`` give NULL."""
    return _num_of(strip(c))


def date(c: Column, mode: str = "failfast") -> Column:
    """Eight digits, year first. Blank is NULL; anything else fails or gives NULL."""
    text = strip(c)
    return _date_or_fail(text) if check_mode(mode) == "failfast" else _date_of(text)


def bad_date(c: Column) -> Column:
    text = strip(c)
    return (text != "") & _date_of(text).isNull()


def float_text(c: Column) -> Column:
    """Any usual float notation; NULL instead of an error."""
    text = strip(c)
    return F.when(text.rlike(FLOAT_PATTERN), text.try_cast("double"))


def truncated_int(c: Column) -> Column:
    """Float text cut towards zero; NULL for NaN, infinities and non-numbers."""
    return float_text(c).try_cast("int")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_day(c: Column) -> Column:
    """Timestamp to calendar day, always rounding down."""
    return c.cast("date")


def _cast_text(text: Column, type_name: str) -> Column:
    """Cast stripped text. Type names are exact; every other name means CHAR."""
    if type_name == "NUM":
        return _num_of(text)
    if type_name == "DATE":
        return _date_of(text)
    return F.when(text != "", text)


def cast_by_layout(
    df: DataFrame, layout: Layout, mode: str = "failfast", stripped: bool = False
) -> DataFrame:
    """Cast the layout's columns, in layout order; other columns follow unchanged.

    ``permissive`` adds ``_corrupt_reason``; ``drop`` removes the rows that have one.
    ``stripped`` says that the columns carry no outer white space any more. Stripping is
    a projection of its own, so that it is done once however often a cast looks at it.
    """
    check_mode(mode)
    fields = layout.output_fields
    names = {f.name for f in fields}
    others = [column(c) for c in df.columns if c not in names and c != REASON]
    reason = [F.col(REASON)] if REASON in df.columns else []
    if not stripped:
        df = df.select(*[strip(column(f.name)).alias(f.name) for f in fields], *others, *reason)
    dates = [f.name for f in fields if f.type == "DATE"]
    if mode == "failfast" and dates:
        # A filter, so that the check survives whatever columns are selected later.
        wrong = [F.when((column(n) != "") & _date_of(column(n)).isNull(), column(n)) for n in dates]
        bad = F.coalesce(*wrong, F.lit(None).cast("string"))
        complaint = F.raise_error(F.concat(F.lit("not a yyyyMMdd date: "), bad)).cast("boolean")
        df = df.filter(F.when(bad.isNotNull(), complaint).otherwise(True))
    casts = [_cast_text(column(f.name), f.type).alias(f.name) for f in fields]
    if mode == "failfast":
        return df.select(*casts, *others)

    kept = [column(n).alias(f"_text_{i}") for i, n in enumerate(dates)]
    out = df.select(*casts, *others, *reason, *kept)
    complaints = reason + [
        F.when((F.col(f"_text_{i}") != "") & column(n).isNull(), F.lit(f"not a date: {n}"))
        for i, n in enumerate(dates)
    ]
    all_reasons = F.nullif(F.concat_ws("; ", *complaints), F.lit(""))
    out = out.withColumn(REASON, all_reasons if complaints else F.lit(None).cast("string"))
    out = out.select(*[column(f.name) for f in fields], *others, REASON)
    return out.filter(F.col(REASON).isNull()).drop(REASON) if mode == "drop" else out


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])

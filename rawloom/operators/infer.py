"""Types for tables that come without a layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawloom.functions.casting import FLOAT_PATTERN, nan_to_null, to_day
from rawloom.functions.text import blank_to_null, column, ident
from rawloom.operators.ordered import top_per_group

DATE, NUMERIC, STRING = "date", "numeric", "string"
# Codes that look like numbers; dates, optionally with a time of day.
CODE_PATTERN = r"^[+-]?(0[0-9]|[0-9]{16,}$)"
DAY_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"


def text_value(c: Column) -> Column:
    """The value to judge; blanks and NaN count as missing."""
    text = blank_to_null(c)
    return F.when(F.lower(text) != "nan", text)


def is_day(text: Column) -> Column:
    return text.rlike(DAY_PATTERN) & F.substring(text, 1, 10).try_cast("date").isNotNull()


def is_number(text: Column) -> Column:
    """Float notation, but no code: leading zeros and integers too long for a double stay text."""
    return text.rlike(FLOAT_PATTERN) & ~text.rlike(CODE_PATTERN)


def _kind_bit(text: Column) -> Column:
    """1 for a day, 2 for a number, 4 for other text; the cheap tests come first."""
    first = F.substring(text, 1, 1)
    like_day = (F.substring(text, 5, 1) == "-") & is_day(text)
    like_number = first.isin(*"0123456789+-.") & is_number(text)
    return F.when(text.isNotNull(), F.when(like_day, 1).when(like_number, 2).otherwise(4))


def _kind_of_bits(bits: Column) -> Column:
    """Kind of a column from the kinds of its values; one without values is text."""
    return F.when(bits == 1, DATE).when(bits == 2, NUMERIC).otherwise(STRING)


def _kind_of_type(data_type: T.DataType) -> str | None:
    if isinstance(data_type, T.StringType):
        return None
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    return STRING


def first_values(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` non-missing values of each text column, in a given row order."""
    names = [c for c, t in df.dtypes if c not in order or t == "string"]
    keys = [column(c).alias(f"_order_{i}") for i, c in enumerate(order)]
    texts = df.select(*keys, *[column(c).cast("string") for c in names])
    ordering = [f"_order_{i}" for i in range(len(order))]
    long = texts.unpivot(ordering, [ident(c) for c in names], "column", "value")
    present = long.filter(text_value(F.col("value")).isNotNull())
    picked = top_per_group(present, ["column"], [F.col(o) for o in ordering], n)
    return picked.select(*[F.col(o).alias(c) for o, c in zip(ordering, order)], "column", "value", "rank")


def detect_kinds(df: DataFrame) -> DataFrame:
    """Kind of each column: date, numeric or string.

    Text columns are judged by all their values, in one aggregation that looks at each
    value once; a column without values is text. Other columns are judged by their type.
    """
    given = {f.name: _kind_of_type(f.dataType) for f in df.schema.fields}
    texts = [n for n, kind in given.items() if kind is None]
    typed = [F.struct(F.lit(n).alias("column"), F.lit(k).alias("kind"))
             for n, k in given.items() if k is not None]
    # Stripped in one projection, judged in the next: no value is stripped twice.
    values = df.select(*[text_value(column(n)).alias(f"v{i}") for i, n in enumerate(texts)])
    bits = [F.bit_or(_kind_bit(F.col(f"v{i}"))).alias(f"b{i}") for i in range(len(texts))]
    judged = [
        F.struct(F.lit(n).alias("column"), _kind_of_bits(F.col(f"b{i}")).alias("kind"))
        for i, n in enumerate(texts)
    ]
    one_row = values.agg(*bits) if bits else df.sparkSession.range(1)
    return one_row.select(F.inline(F.array(*judged, *typed)))


def sampled_kinds(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """Kind of each text column by its first ``n`` values, and how many values do not fit it.

    The sample judges, the whole table is checked: ``misfits`` counts every value of the
    column, early or late, that is not of the kind.
    """
    texts = [f.name for f in df.schema.fields if _kind_of_type(f.dataType) is None]
    picked = first_values(df.select(*dict.fromkeys([*order, *texts])), order, n)
    judged = picked.groupBy("column").agg(F.bit_or(_kind_bit(text_value(F.col("value")))).alias("bits"))
    kinds = {r["column"]: r["kind"] for r in judged.select("column", _kind_of_bits(F.col("bits")).alias("kind")).collect()}
    bit = {DATE: 1, NUMERIC: 2}
    values = df.select(*[text_value(column(c)).alias(f"v{i}") for i, c in enumerate(texts)])
    misfits = [
        F.count_if(_kind_bit(F.col(f"v{i}")) != bit[kinds[c]] if kinds.get(c) in bit else F.lit(False)).alias(f"m{i}")
        for i, c in enumerate(texts)
    ]
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(kinds.get(c, STRING)).alias("kind"), F.col(f"m{i}").alias("misfits"))
        for i, c in enumerate(texts)
    ]
    return values.agg(*misfits).select(F.inline(F.array(*rows)))


def _cast_by_kind(c: Column, kind: str, data_type: T.DataType) -> Column:
    """A value that does not fit the kind becomes NULL. Text comes stripped."""
    is_text = isinstance(data_type, T.StringType)
    if kind == DATE:
        return F.when(is_day(c), F.substring(c, 1, 10).try_cast("date")) if is_text else to_day(c)
    if kind == NUMERIC:
        if is_text:
            return F.when(is_number(c), c.try_cast("double"))
        number = c.cast("double")
        return nan_to_null(number) if isinstance(data_type, (T.DoubleType, T.FloatType)) else number
    return c if is_text else blank_to_null(c.cast("string"))


def infer_and_cast(df: DataFrame, text: str = "detect") -> DataFrame:
    """Typed copy of a decoded table; no value is lost to a type that does not fit it.

    A text column becomes dates or numbers only if all its values are, and none is a code
    with leading zeros or more digits than a double holds. ``text="keep"`` leaves text
    columns as text, for sources that already tell numbers and dates from text. Only the
    verdicts (one per column) come to the driver; the table is read once for them.
    """
    if text not in ("detect", "keep"):
        raise ValueError("text must be 'detect' or 'keep'")
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds = {n: _kind_of_type(t) for n, t in types.items()}
    unknown = [n for n, kind in kinds.items() if kind is None]
    if unknown and text == "detect":
        verdicts = detect_kinds(df.select(*[column(n) for n in unknown]))
        kinds |= {r["column"]: r["kind"] for r in verdicts.collect()}
    stripped = {
        n: blank_to_null(column(n)).alias(n) if isinstance(t, T.StringType) else column(n)
        for n, t in types.items()
    }
    return df.select(*stripped.values()).select(
        *[_cast_by_kind(column(n), kinds[n] or STRING, t).alias(n) for n, t in types.items()]
    )

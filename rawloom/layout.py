"""The driver-side description of one raw file's columns."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIXED = "fixed"
DELIMITED = "delimited"


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "CHAR"
    width: int | None = None
    start: int | None = None
    label: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        if self.type == "NUM":
            return T.DoubleType()
        if self.type == "DATE":
            return T.DateType()
        return T.StringType()


@dataclass(frozen=True)
class Layout:
    fields: tuple[Field, ...]
    style: str = FIXED
    name: str | None = field(default=None, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "fields", tuple(self.fields))
        if self.style not in (FIXED, DELIMITED):
            raise ValueError(f"unknown layout style {self.style!r}")
        if not self.fields:
            raise ValueError(f"layout {self.name or ''} has no fields")
        if self.style == FIXED and any(f.width is None for f in self.fields):
            raise ValueError("a fixed-width layout needs a width for every field")
        if self.style == DELIMITED and any(not f.name for f in self.fields):
            raise ValueError("a delimited layout needs a name for every field")
        repeated = [n for n, k in Counter(f.name for f in self.output_fields).items() if k > 1]
        if repeated:
            raise ValueError(f"duplicate column names in layout: {repeated}")

    @property
    def output_fields(self) -> tuple[Field, ...]:
        """Fields that become columns; nameless ones only occupy space."""
        return tuple(f for f in self.fields if f.name)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.output_fields]

    @property
    def record_length(self) -> int:
        return sum(f.width for f in self.fields if f.width and f.width > 0)

    @property
    def default_unit(self) -> str:
        """Bytes, unless some width is unknown."""
        return "char" if any(f.width == 0 for f in self.fields) else "byte"

    def offsets(self, source: str = "cumulative") -> list[int]:
        """Zero-based field offsets, from running widths or from declared starts."""
        if source == "declared":
            if any(f.start is None for f in self.fields):
                raise ValueError("the layout declares no start for some fields")
            return [f.start - 1 for f in self.fields]
        if source != "cumulative":
            raise ValueError("offsets must be 'cumulative' or 'declared'")
        out, position = [], 0
        for f in self.fields:
            out.append(position)
            position += max(f.width or 0, 0)
        return out

    def declared_starts_differ(self) -> list[str]:
        """Names of fields whose declared start is not where the widths put them."""
        return [
            f.name
            for f, offset in zip(self.fields, self.offsets())
            if f.start is not None and f.start - 1 != offset
        ]

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.output_fields])

    def fingerprint(self) -> str:
        """Equal for layouts that read files in the same way."""
        shape = repr((self.style, [(f.name, f.type, f.width, f.start) for f in self.fields]))
        return hashlib.sha256(shape.encode()).hexdigest()

    @classmethod
    def from_rows(
        cls, rows: Iterable, style: str | None = None, name: str | None = None
    ) -> Layout:
        """Rows of the ``layout`` table that belong to one layout file."""
        ordered = sorted(rows, key=lambda r: r["ord"])
        if not ordered:
            raise ValueError(f"no layout rows for {name!r}")
        style = style or ordered[0]["style"]
        if style == FIXED and any(r["start"] is None for r in ordered):
            raise ValueError(f"layout {name!r}: a declared start is not a number")
        return cls(
            tuple(
                Field(r["name"], r["type"], r["width"], r["start"], r["label"]) for r in ordered
            ),
            style,
            name,
        )

    @classmethod
    def from_dataframe(cls, df: DataFrame, layout_file: str) -> Layout:
        """Collects one layout's rows: as many as the raw file has columns."""
        rows = df.filter(F.col("layout_file").endswith(layout_file)).collect()
        files = {r["layout_file"] for r in rows}
        if len(files) > 1:
            raise ValueError(f"{layout_file!r} is ambiguous: {sorted(files)}")
        return cls.from_rows(rows, name=layout_file)

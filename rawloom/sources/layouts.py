"""Layout files: text tables that describe the columns of raw files.

A layout file is a small text with a heading block, a line of dash runs and one body
line per column. Each file is one row holding an array of lines, and everything is
computed inside that row: no shuffle, and as many files at a time as there are tasks.
Rows are filtered only after the final (outer) explode, because a filter on a derived
column would be pushed down through the whole chain with every expression copied into it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.functions.casting import truncated_int
from rawloom.functions.names import base_name, name_stem, source_path
from rawloom.functions.text import (
    extract,
    first_where,
    is_blank,
    normalise_heading,
    strip,
    whole_number,
)
from rawloom.layout import DELIMITED, FIXED

# Markers and patterns of the layout format.
DELIMITER_PATTERN = "-{4,}"
FOOTER = "end of file transfer summary"
COLUMNS_PATTERN = r"Columns in File:\s*([0-9]+)"
ROWS_PATTERN = r"\(([0-9,]+)\s+Rows\)"
EXACT_ROWS_PATTERN = r"Exact File Quantity \(Rows\):\s*([0-9,]+)"
# A data file's name may hold single blanks; two of them, a tab or "Rows:" end it.
DATA_FILE_PATTERN = r"Data File:\s*(\S(?:(?!\s\s|\t|\s+Rows:).)*?\S|\S)(?:\s\s|\t|\s+Rows:)"
DATA_FILE_ROWS_PATTERN = r"Data File:\s*\S.*?Rows:\s*([0-9,]+)"
NAME_HEADINGS = ("field short name", "field name", "column", "field")
NAME_WORDS = (("short", "name"), ("field", "name"), ("column",))
# Zero-based span numbers of a fixed-width layout.
NAME_SPAN, TYPE_SPAN, START_SPAN, WIDTH_SPAN = 2, 3, 4, 5


class LayoutTables(NamedTuple):
    layout: DataFrame
    shape: DataFrame
    file_rows: DataFrame


def split_lines(text: Column) -> Column:
    return F.split(text, "\r\n|\n|\r")


def first_position(lines: Column, test) -> Column:
    """One-based position of the first line that passes; 0 when none does."""
    return F.array_position(F.transform(lines, test), F.lit(True)).cast("int")


def with_dash_spans(
    df: DataFrame, line: str, out: str = "spans", from_previous_end: bool = False
) -> DataFrame:
    """Add the start (zero-based) and width of each dash run of a text column.

    ``from_previous_end`` assumes a gap of one blank: a span then starts one after the
    end of the run before it, the first one at 0.
    """
    # The first dash of each run alone, one byte for each character, so that bytes can be looked at by their place.
    firsts = F.regexp_replace(F.col(line), "[^-]|(?<=-)-", " ").cast("binary")
    dash = F.lit("-").cast("binary")

    def places(data):
        positions = F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1)))
        return F.filter(positions, lambda i: F.substring(data, i, F.lit(1)) == dash)

    def after_previous(runs):
        def start(k):
            before = F.get(runs, k - 1)
            return F.when(k == 0, F.lit(0)).otherwise(before["start"] + before["width"] + 1)

        return F.transform(runs, lambda s, k: F.struct(start(k).alias("start"), s["width"].alias("width")))

    runs = F.zip_with(
        _once(firsts, places),
        F.regexp_extract_all(F.col(line), F.lit("-+"), F.lit(0)),
        lambda place, run: F.struct((place - 1).alias("start"), F.length(run).alias("width")),
    )
    return df.withColumn(out, _once(runs, after_previous) if from_previous_end else runs)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once for each row, however often a loop over its items looks at it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_heading_block(
    df: DataFrame, lines: str, delimiter: str, out: str = "block", size: int = 3
) -> DataFrame:
    """Add up to ``size`` non-empty lines directly above the delimiter, top first.

    If the line above is empty: the nearest ``size`` non-empty lines. ``delimiter`` is
    the one-based position of the delimiter line.
    """
    upwards, gap = F.col(f"{out}_upwards"), F.col(f"{out}_gap")
    above = F.slice(lines, F.lit(1), F.greatest(F.col(delimiter) - 1, F.lit(0)))
    df = df.withColumn(f"{out}_upwards", F.reverse(above))
    df = df.withColumn(f"{out}_gap", first_position(upwards, is_blank))
    near = (
        F.when(gap == 0, F.slice(upwards, 1, size))
        .when(gap > 1, F.slice(upwards, F.lit(1), F.least(gap - 1, F.lit(size))))
        .otherwise(F.slice(F.filter(upwards, lambda line: ~is_blank(line)), 1, size))
    )
    return df.withColumn(out, F.reverse(near)).drop(f"{out}_upwards", f"{out}_gap")


def cut(line: Column, span: Column) -> Column:
    return strip(F.substring(line, span["start"] + 1, span["width"]))


def _heading(block: Column, span: Column, delimiter_line: Column) -> Column:
    pieces = F.filter(F.transform(block, lambda line: cut(line, span)), lambda p: p != "")
    leftover = strip(F.btrim(cut(delimiter_line, span), F.lit("-")))
    return F.when(F.size(pieces) > 0, F.array_join(pieces, " ")).otherwise(leftover)


def _ends_body(line: Column, spans: Column, stop_words: bool) -> Column:
    first = cut(line, F.get(spans, F.lit(0)))
    not_numbered = ~first.rlike("^[0-9]+$")
    if not stop_words:
        return not_numbered
    low = F.lower(line)
    return (
        not_numbered
        | F.contains(low, F.lit(FOOTER))
        | (F.contains(low, F.lit("end of")) & F.contains(low, F.lit("summary")))
        | (F.contains(low, F.lit("note")) & F.contains(low, F.lit(":")))
    )


def _last_index(items: Column, test) -> Column:
    return F.array_max(
        F.filter(F.transform(items, lambda h, i: F.when(test(h), i)), lambda i: i.isNotNull())
    )


def _first_index(items: Column, test) -> Column:
    return F.array_min(
        F.filter(F.transform(items, lambda h, i: F.when(test(h), i)), lambda i: i.isNotNull())
    )


def _has_words(*words: str):
    def test(heading: Column) -> Column:
        out = F.contains(heading, F.lit(words[0]))
        for word in words[1:]:
            out = out & F.contains(heading, F.lit(word))
        return out

    return test


def heading_index(headings: Column, hint: str, fallback_words: tuple[str, ...], position: int):
    """Last heading that contains the hint, else the first with all fallback words, else
    a usual position if there are at least three headings."""
    return F.coalesce(
        _last_index(headings, _has_words(hint)),
        _first_index(headings, _has_words(*fallback_words)),
        F.when(F.size(headings) >= 3, F.lit(position)),
    )


def name_heading_index(headings: Column) -> Column:
    """Which heading holds the data set's column names; NULL when none looks like it."""
    exact = [_last_index(headings, lambda h, n=n: h == n) for n in NAME_HEADINGS]
    fuzzy = [_first_index(headings, _has_words(*words)) for words in NAME_WORDS]
    return F.coalesce(*exact, *fuzzy)


def located_tables(texts: DataFrame, header_lines: int = 3, parity: bool = False) -> DataFrame:
    """Lines, delimiter, spans, headings and body cells of each layout text."""
    bad_text = F.raise_error(F.concat(F.lit("layout is not UTF-8: "), F.col("layout_file")))
    text = F.when(F.is_valid_utf8("text"), F.col("text")).otherwise(bad_text.cast("string"))
    df = texts.select(
        "layout_file",
        name_stem(base_name(F.col("layout_file"))).alias("layout_stem"),
        split_lines(text).alias("lines"),
    )
    df = df.withColumn(
        "delimiter", first_position(F.col("lines"), lambda line: line.rlike(DELIMITER_PATTERN))
    )
    df = df.withColumn("delimiter_line", F.get("lines", F.col("delimiter") - 1))
    df = with_dash_spans(df, "delimiter_line", "spans", from_previous_end=parity)
    df = with_heading_block(df, "lines", "delimiter", "block", header_lines)
    spans = F.col("spans")
    df = df.withColumn(
        "headings",
        F.transform(spans, lambda s: _heading(F.col("block"), s, F.col("delimiter_line"))),
    )
    below = F.slice("lines", F.col("delimiter") + 1, F.size("lines"))
    df = df.withColumn("body", F.when(F.col("delimiter") > 0, below))
    df = df.withColumn(
        "stop", first_position(F.col("body"), lambda line: _ends_body(line, spans, parity))
    )
    kept = F.when(F.col("stop") == 0, F.col("body")).otherwise(
        F.slice("body", F.lit(1), F.greatest(F.col("stop") - 1, F.lit(0)))
    )
    df = df.withColumn(
        "cells", F.transform(kept, lambda line: F.transform(spans, lambda s: cut(line, s)))
    )
    df = df.withColumn("norm", F.transform("headings", normalise_heading))
    return df.drop("delimiter_line", "spans", "block", "body", "stop")


def parsed_layouts(
    texts: DataFrame | None,
    header_lines: int = 3,
    parity: bool = False,
    style: str = "auto",
    name_hint: str = "Column",
    type_hint: str = "SAS Type",
    located: DataFrame | None = None,
) -> DataFrame:
    """One row per layout file: its lines, headings, cells, and which cell means what.

    ``located`` is the result of ``located_tables`` where it is at hand already.
    """
    if style not in ("auto", FIXED, DELIMITED):
        raise ValueError(f"style must be 'auto', {FIXED!r} or {DELIMITED!r}")

    def norm_hint(hint: str) -> str:
        return " ".join("".join(c if c.isalpha() else " " for c in hint.lower()).split())

    df = located_tables(texts, header_lines, parity) if located is None else located
    norm = F.col("norm")
    wide = F.size("headings") > WIDTH_SPAN
    first_start = F.get(F.get("cells", F.lit(0)), F.lit(START_SPAN))
    guessed = F.when(wide & truncated_int(first_start).isNotNull(), FIXED).otherwise(DELIMITED)
    df = df.withColumn("style", guessed if style == "auto" else F.lit(style))
    fixed = F.col("style") == FIXED
    by_name = heading_index(norm, norm_hint(name_hint), ("column",), 1)
    by_type = heading_index(norm, norm_hint(type_hint), ("sas", "type"), 2)
    return df.withColumns(
        {
            "name_at": F.when(~fixed, by_name).when(wide, F.lit(NAME_SPAN)),
            "type_at": F.when(~fixed, by_type).when(wide, F.lit(TYPE_SPAN)),
            "label_at": F.coalesce(
                _first_index(norm, _has_words("long", "name")),
                _first_index(norm, _has_words("description")),
                _first_index(norm, _has_words("label")),
            ),
            "declared_at": name_heading_index(norm),
        }
    )


def layout_fields(parsed: DataFrame) -> DataFrame:
    """The ``layout`` table: one row per column of each described raw file."""
    fixed = F.col("style") == FIXED
    df = parsed.select(
        "layout_file",
        "layout_stem",
        "style",
        "cells",
        "name_at",
        "type_at",
        "label_at",
        F.transform("cells", lambda r: truncated_int(F.get(r, F.lit(START_SPAN)))).alias("starts"),
        F.transform("cells", lambda r: truncated_int(F.get(r, F.lit(WIDTH_SPAN)))).alias("given"),
    )
    # A width that is no number reaches to the next start; the last one stays open (0).
    df = df.withColumn(
        "widths",
        F.transform(
            "given",
            lambda w, i: F.coalesce(w, F.get("starts", i + 1) - F.get("starts", i), F.lit(0)),
        ),
    )
    df = df.withColumn(
        "rows",
        F.transform(
            "cells",
            lambda r, i: F.struct(
                (i + 1).alias("ord"),
                F.get(r, F.col("name_at")).alias("name"),
                F.get(r, F.col("label_at")).alias("label"),
                F.coalesce(F.nullif(F.get(r, F.col("type_at")), F.lit("")), F.lit("CHAR")).alias(
                    "type"
                ),
                F.when(fixed, F.get("starts", i)).alias("start"),
                F.when(fixed, F.get("widths", i)).alias("width"),
            ),
        ),
    )
    # Delimited: a repeated name keeps its first place and takes its last type.
    df = df.withColumn("named", F.filter("rows", lambda r: r["name"] != ""))
    df = df.withColumn("names", F.array_distinct(F.transform("named", lambda r: r["name"])))
    df = df.withColumn("backwards", F.reverse("named"))
    df = df.withColumn("from_last", F.transform("backwards", lambda r: r["name"]))
    df = df.withColumn(
        "lasts",
        F.transform(
            "names",
            lambda n: F.get("backwards", (F.array_position("from_last", n) - 1).cast("int")),
        ),
    )
    unique = F.transform(
        "lasts",
        lambda r, i: F.struct(
            (i + 1).alias("ord"),
            *[r[c].alias(c) for c in ("name", "label", "type", "start", "width")],
        ),
    )
    usable = F.col("name_at").isNotNull() & F.col("type_at").isNotNull()
    df = df.withColumn("fields", F.when(usable & fixed, F.col("rows")).when(usable, unique))
    running = F.aggregate(
        "widths",
        F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before")),
        lambda done, w: F.struct(
            (done["total"] + F.greatest(w, F.lit(0))).alias("total"),
            F.concat(done["before"], F.array(done["total"])).alias("before"),
        ),
        lambda done: done["before"],
    )
    df = df.withColumn("offsets", running)
    offset = F.get("offsets", F.col("f.ord") - 1)
    exploded = df.select(
        "layout_file",
        "layout_stem",
        "style",
        "offsets",
        F.size("fields").alias("n"),
        F.explode_outer("fields").alias("f"),
    )
    return exploded.filter(F.col("f").isNotNull()).select(
        "layout_file",
        "layout_stem",
        "style",
        "f.ord",
        "f.name",
        "f.label",
        "f.type",
        "f.start",
        "f.width",
        F.when(fixed, offset).alias("offset"),
        (F.col("f.ord") == F.col("n")).alias("is_last"),
    )


def layout_shapes(parsed: DataFrame) -> DataFrame:
    """What each layout file says about the size and columns of its data."""
    lines = F.col("lines")
    columns = whole_number(first_where(lines, COLUMNS_PATTERN)).cast("int")
    header_rows = whole_number(first_where(lines, ROWS_PATTERN, F.col("layout_stem")))
    exact_rows = whole_number(first_where(lines, EXACT_ROWS_PATTERN))
    names = F.filter(
        F.transform("cells", lambda r: F.get(r, F.col("declared_at"))), lambda n: n != ""
    )
    return (
        parsed.withColumn(
            "expected_names", F.when(F.col("declared_at").isNotNull() & (F.size(names) > 0), names)
        )
        .withColumn("declared_columns", columns)
        .select(
            "layout_file",
            "layout_stem",
            F.coalesce(header_rows, exact_rows).alias("expected_rows"),
            F.coalesce("declared_columns", F.size("expected_names")).alias("expected_columns"),
            F.when(header_rows.isNotNull(), "header")
            .when(exact_rows.isNotNull(), "exact quantity")
            .alias("rows_source"),
            "expected_names",
            (F.col("delimiter") > 0).alias("has_table"),
        )
    )


def layout_file_rows(parsed: DataFrame) -> DataFrame:
    """Rows declared per data file; the first mention of a file counts."""
    mentions = parsed.select("layout_file", F.posexplode_outer("lines").alias("pos", "line")).select(
        "layout_file",
        "pos",
        base_name(extract(F.col("line"), DATA_FILE_PATTERN)).alias("data_file"),
        whole_number(extract(F.col("line"), DATA_FILE_ROWS_PATTERN)).alias("expected_rows"),
    )
    return (
        mentions.filter(F.col("data_file").isNotNull() & F.col("expected_rows").isNotNull())
        .groupBy("layout_file", "data_file")
        .agg(F.min_by("expected_rows", "pos").alias("expected_rows"))
    )


def read_layout_texts(spark: SparkSession, path, glob: str = "*.fts") -> DataFrame:
    return spark.read.text(
        path if isinstance(path, str) else list(path),
        wholetext=True,
        recursiveFileLookup=True,
        pathGlobFilter=glob,
    ).select(source_path().alias("layout_file"), F.col("value").alias("text"))


def scan_layouts(
    spark: SparkSession,
    path,
    header_lines: int = 3,
    parity: bool = False,
    style: str = "auto",
    glob: str = "*.fts",
    **hints: str,
) -> LayoutTables:
    """Parse every layout file below ``path``.

    ``parity=True`` keeps two historical habits: spans are placed by the run before
    them, and stop words end the body even on numbered lines.
    """
    texts = read_layout_texts(spark, path, glob)
    parsed = parsed_layouts(texts, header_lines, parity, style, **hints)
    return LayoutTables(layout_fields(parsed), layout_shapes(parsed), layout_file_rows(parsed))

"""Layout files, rendered from the tables and parsed again.

A rendered layout describes a bounded range of keys, so no text grows with the data;
their number does.
"""

from __future__ import annotations

from catalog.common import SQL_WHITESPACE, Catalog, table
from pyspark.sql import functions as F

from rawloom.sources import layouts as lay

_c = Catalog()
QUERIES, ORACLES = _c.queries, _c.oracles

_FIXED_HEAD = (
    "Order Field Long     Field Short          SAS  Start  Field\n"
    "      Name           Name                 Type        Width\n"
    "----- -------------- -------------------- ---- ------ -----\n"
)
_DELIMITED_HEAD = (
    "Order Column               SAS  Description\n"
    "      Name                 Type\n"
    "----- -------------------- ---- --------------------\n"
)


def _cells(*cells):
    """One body line; each cell is (column, width)."""
    return F.concat_ws(" ", *[F.rpad(c.cast("string"), w, " ") for c, w in cells])


def _texts(lines, head, foot):
    """Put (layout_file, ord, line) rows together; a layout has a fixed number of them."""
    return lines.groupBy("layout_file").agg(
        F.concat(
            F.lit(head),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda s: s["line"]
                ),
                "\n",
            ),
            F.lit(foot),
        ).alias("text")
    )


def part_layouts(spark, sf_dir):
    """Fixed-width layouts of up to 40 fields, some with blank types or odd widths."""
    size, key = F.col("p_size"), F.col("p_partkey")
    order = F.col("ord")
    rows = table(spark, sf_dir, "part").withColumn("ord", key % 40 + 1)
    kind = F.when(size % 9 == 0, "").otherwise(
        F.element_at(F.array(F.lit("CHAR"), F.lit("NUM"), F.lit("DATE")), (key % 3 + 1).cast("int"))
    )
    width = (
        F.when(size % 10 == 0, "x")
        .when(size % 7 == 0, F.concat(size.cast("string"), F.lit(".9")))
        .otherwise(size.cast("string"))
    )
    line = _cells(
        (order, 5),
        (F.col("p_name"), 14),
        (F.concat(F.lit("F_"), key.cast("string")), 20),
        (kind, 4),
        ((order - 1) * 60 + 1, 6),
        (width, 5),
    )
    lines = rows.select(
        F.concat(F.lit("/in/2016/parts"), F.expr("p_partkey div 40"), F.lit("_2016.fts")).alias(
            "layout_file"
        ),
        "ord",
        line.alias("line"),
    )
    return _texts(
        lines, "parts listing\n\n" + _FIXED_HEAD, "\n\n-- End of File Transfer Summary\n"
    )


@_c.add(
    "a5_layout_scan",
    """
    SELECT layout_stem, 'fixed' AS style, CAST(ord AS INTEGER) AS ord, name, label, type,
           CAST(start AS INTEGER) AS start, width, is_last,
           CAST(coalesce(sum(width) OVER (PARTITION BY layout_stem ORDER BY ord
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS "offset"
    FROM (SELECT *, CAST(CASE WHEN p_size % 10 <> 0 THEN p_size WHEN is_last THEN 0 ELSE 60 END
                         AS INTEGER) AS width
          FROM (SELECT 'parts' || (p_partkey // 40) || '_2016' AS layout_stem,
                       p_partkey % 40 + 1 AS ord, 'F_' || p_partkey AS name, p_name AS label,
                       CASE WHEN p_size % 9 = 0 OR p_partkey % 3 = 0 THEN 'CHAR'
                            WHEN p_partkey % 3 = 1 THEN 'NUM' ELSE 'DATE' END AS type,
                       (p_partkey % 40) * 60 + 1 AS start, p_size,
                       p_partkey = max(p_partkey) OVER (PARTITION BY p_partkey // 40) AS is_last
                FROM part))""",
)
def layout_scan(spark, sf_dir):
    return lay.layout_fields(lay.parsed_layouts(part_layouts(spark, sf_dir))).drop("layout_file")


@_c.add(
    "b10_layout_cleanup",
    """
    SELECT layout_stem, name, type,
           CAST(row_number() OVER (PARTITION BY layout_stem ORDER BY first_ord) AS INTEGER) AS ord
    FROM (SELECT 'list' || (p_partkey // 20) AS layout_stem, p_name AS name,
                 min(p_partkey) AS first_ord,
                 arg_max(CASE WHEN p_size % 5 = 0 THEN 'CHAR' WHEN p_size % 2 = 0 THEN 'NUM'
                              ELSE 'DATE' END, p_partkey) AS type
          FROM part WHERE p_size % 13 <> 0 GROUP BY 1, 2)""",
)
def layout_cleanup(spark, sf_dir):
    """Delimited layouts with blank names, blank types and repeated names."""
    size = F.col("p_size")
    kind = F.when(size % 5 == 0, "").when(size % 2 == 0, "NUM").otherwise("DATE")
    order = F.col("p_partkey") % 20 + 1
    lines = table(spark, sf_dir, "part").select(
        F.concat(F.lit("/in/list"), F.expr("p_partkey div 20"), F.lit(".fts")).alias("layout_file"),
        order.alias("ord"),
        _cells(
            (order, 5),
            (F.when(size % 13 == 0, "").otherwise(F.col("p_name")), 20),
            (kind, 4),
            (F.col("p_type"), 20),
        ).alias("line"),
    )
    parsed = lay.parsed_layouts(_texts(lines, _DELIMITED_HEAD, "\n\nNote: made up\n"))
    return lay.layout_fields(parsed).select("layout_stem", "ord", "name", "type")


def _one_row_layouts(df, heading, cells):
    """A layout per row: a heading line chosen per row, and one body line."""
    rule = " ".join(["-" * 14] * 4)
    return df.select(
        F.concat(F.lit("/in/l"), F.col("key").cast("string"), F.lit(".fts")).alias("layout_file"),
        F.concat(heading, F.lit(f"\n{rule}\n"), _cells(*[(c, 14) for c in cells])).alias("text"),
    )


def _heading(*words):
    return " ".join(w.ljust(14) for w in words)


@_c.add(
    "b12_heading_choice",
    """
    SELECT 'l' || c_custkey AS layout_stem,
           CASE c_custkey % 4 WHEN 2 THEN c_mktsegment WHEN 3 THEN 'C' || c_nationkey
                ELSE 'A' || c_custkey END AS name,
           CASE c_custkey % 4 WHEN 2 THEN 'A' || c_custkey WHEN 3 THEN c_mktsegment
                ELSE 'C' || c_nationkey END AS type
    FROM customer""",
)
def heading_choice(spark, sf_dir):
    """By hint, by position, last of two hints, and by looser words."""
    customer = table(spark, sf_dir, "customer").withColumn("key", F.col("c_custkey"))
    heading = F.element_at(
        F.array(
            F.lit(_heading("Order", "Column Name", "SAS Type", "Remark")),
            F.lit(_heading("Order", "Variable", "Kind", "Remark")),
            F.lit(_heading("Column Order", "Type of SAS", "Remark", "COLUMN (id)")),
            F.lit(_heading("Order", "Remark", "Column", "SAS  Type")),
        ),
        (F.col("c_custkey") % 4 + 1).cast("int"),
    )
    cells = [
        F.lit(1),
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")),
        F.col("c_mktsegment"),
    ]
    parsed = lay.parsed_layouts(_one_row_layouts(customer, heading, cells), style="delimited")
    return lay.layout_fields(parsed).select("layout_stem", "name", "type")


@_c.add(
    "b13_expected_names",
    """
    SELECT 'l' || c_custkey AS layout_stem,
           CASE c_custkey % 5 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'A' || c_custkey
                WHEN 2 THEN 'C' || c_nationkey WHEN 3 THEN 'A' || c_custkey END AS name
    FROM customer""",
)
def expected_names(spark, sf_dir):
    """Short name before name, exact before fuzzy, none without a likely heading."""
    customer = table(spark, sf_dir, "customer").withColumn("key", F.col("c_custkey"))
    heading = F.element_at(
        F.array(
            F.lit(_heading("Order", "Field Name", "Field", "Fld Short Nam")),
            F.lit(_heading("Order", "Field-Name", "Column", "Remark")),
            F.lit(_heading("Order", "Columns here", "Short: name", "Remark")),
            F.lit(_heading("Order", "Any column", "Kind", "Remark")),
            F.lit(_heading("Order", "Variable", "Kind", "Remark")),
        ),
        (F.col("c_custkey") % 5 + 1).cast("int"),
    )
    heading = F.when(
        F.col("c_custkey") % 5 == 0, _heading("Order", "Field Long", "Field Type", "FieldShortName")
    ).otherwise(heading)
    cells = [
        F.lit(1),
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")),
        F.col("c_mktsegment"),
    ]
    parsed = lay.parsed_layouts(_one_row_layouts(customer, heading, cells), style="delimited")
    return lay.layout_shapes(parsed).select(
        "layout_stem", F.get("expected_names", F.lit(0)).alias("name")
    )


@_c.add(
    "a6_shape_scan",
    """
    SELECT 'cust' || c_custkey AS layout_stem,
           CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE CAST(abs(round(c_acctbal * 100)) AS BIGINT) END
               AS expected_rows,
           CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey END AS expected_columns,
           CASE c_custkey % 3 WHEN 0 THEN 'header' WHEN 1 THEN 'exact quantity' END AS rows_source
    FROM customer""",
)
def shape_scan(spark, sf_dir):
    number = F.format_number(F.abs(F.round(F.col("c_acctbal") * 100)), 0)
    stem = F.concat(F.lit("cust"), F.col("c_custkey").cast("string"))
    first = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat(stem, F.lit(" ("), number, F.lit(" Rows)\n")))
        .when(
            F.col("c_custkey") % 3 == 1,
            F.concat(F.lit("Exact File Quantity (Rows): "), number, F.lit("\nother (5 Rows)\n")),
        )
        .otherwise("another (1,234 Rows)\n")
    )
    columns = F.when(
        F.col("c_nationkey") % 2 == 0,
        F.concat(F.lit("Columns in File:  "), F.col("c_nationkey").cast("string"), F.lit("\n")),
    ).otherwise("")
    texts = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/in/"), stem, F.lit(".fts")).alias("layout_file"),
        F.concat(first, columns).alias("text"),
    )
    return lay.layout_shapes(lay.parsed_layouts(texts)).select(
        "layout_stem", "expected_rows", "expected_columns", "rows_source"
    )


@_c.add(
    "a7_file_rows",
    """
    SELECT '/in/l' || c_custkey || '.fts' AS layout_file, 'visits' || v || '.csv' AS data_file,
           CAST(CASE v WHEN '_ak' THEN c_custkey * 1000 ELSE c_nationkey END AS BIGINT)
               AS expected_rows
    FROM customer, (VALUES ('_ak'), (' co 1')) s(v)""",
)
def file_rows(spark, sf_dir):
    texts = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("/in/l"), F.col("c_custkey").cast("string"), F.lit(".fts")).alias(
            "layout_file"
        ),
        F.concat(
            F.lit("Data File: visits_ak.csv  Rows:     "),
            F.format_number(F.col("c_custkey") * 1000, 0),
            F.lit("  Size(Bytes): 60\nData File: visits co 1.csv  Rows: "),
            F.col("c_nationkey").cast("string"),
            F.lit("\nData File: visits_ak.csv  Rows: 1\nRows: 77\n"),
        ).alias("text"),
    )
    return lay.layout_file_rows(lay.parsed_layouts(texts))


_SQL_BLANK = f"trim(x, {SQL_WHITESPACE}) = ''"


@_c.add(
    "e6_heading_block",
    rf"""
    SELECT doc_id, d AS delimiter, array_to_string(list_reverse(
             CASE WHEN gap = 0 THEN up[1:3] WHEN gap > 1 THEN up[1:least(gap - 1, 3)]
                  ELSE list_filter(up, lambda x: NOT ({_SQL_BLANK}))[1:3] END), ' / ') AS block
    FROM (SELECT *, CAST(coalesce(list_position(list_transform(up, lambda x: {_SQL_BLANK}), true), 0)
                         AS INTEGER) AS gap
          FROM (SELECT *, list_reverse(lines[1:greatest(d - 1, 0)]) AS up
                FROM (SELECT *, CAST(coalesce(list_position(list_transform(lines,
                             lambda x: regexp_matches(x, '[0-9]{{2,}}')), true), 0) AS INTEGER) AS d
                      FROM (SELECT doc_id, string_split_regex(text, '\r\n|\n|\r') AS lines
                            FROM documents))))""",
)
def heading_block(spark, sf_dir):
    """Lines above the first line that holds a number of two or more digits."""
    df = table(spark, sf_dir, "documents").select(
        "doc_id", lay.split_lines(F.col("text")).alias("lines")
    )
    df = df.withColumn(
        "delimiter", lay.first_position(F.col("lines"), lambda line: line.rlike("[0-9]{2,}"))
    )
    df = lay.with_heading_block(df, "lines", "delimiter")
    return df.select("doc_id", "delimiter", F.array_join("block", " / ").alias("block"))


@_c.add(
    "e7_span_starts",
    """
    SELECT p_partkey, CAST(k AS INTEGER) AS k,
           CAST(CASE k WHEN 0 THEN 1 WHEN 1 THEN a + 3 ELSE a + s + 4 END AS INTEGER) AS start,
           CAST(CASE k WHEN 0 THEN 0 WHEN 1 THEN a + 2 ELSE a + s + 4 END AS INTEGER)
               AS start_by_gap,
           CAST(CASE k WHEN 0 THEN a WHEN 1 THEN s ELSE length(p_type) END AS INTEGER) AS width
    FROM (SELECT p_partkey, greatest(p_size, 0) + 1 AS s, p_type, length(p_name) AS a FROM part),
         (VALUES (0), (1), (2)) v(k)""",
)
def span_starts(spark, sf_dir):
    """Dash runs after a leading blank, with gaps of two blanks and of one."""

    def run(length):
        return F.repeat(F.lit("-"), length)

    df = table(spark, sf_dir, "part")
    df = df.select(
        "p_partkey",
        F.concat(
            F.lit(" "),
            run(F.length("p_name")),
            F.lit("  "),
            run(F.greatest("p_size", F.lit(0)) + 1),
            F.lit(" "),
            run(F.length("p_type")),
        ).alias("line"),
    )
    df = lay.with_dash_spans(df, "line", "spans")
    df = lay.with_dash_spans(df, "line", "gapped", from_previous_end=True)
    exploded = df.select("p_partkey", F.posexplode_outer("spans").alias("k", "span"), "gapped")
    return exploded.filter(F.col("span").isNotNull()).select(
        "p_partkey",
        "k",
        F.col("span.start").alias("start"),
        F.get("gapped", F.col("k"))["start"].alias("start_by_gap"),
        F.col("span.width").alias("width"),
    )

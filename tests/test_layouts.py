import pytest
from samples import DELIMITED_LAYOUT, FIXED_LAYOUT

from rawloom import Layout, scan_layouts
from rawloom.sources.layouts import layout_fields, layout_file_rows, layout_shapes, parsed_layouts, with_dash_spans


def parse(spark, text, name="/in/x.fts", **options):
    df = spark.createDataFrame([(name, text)], "layout_file string, text string")
    return parsed_layouts(df, **options)


def fields(spark, text, *columns, **options):
    rows = layout_fields(parse(spark, text, **options)).sort("ord").collect()
    return [tuple(r[c] for c in columns) for r in rows]


def test_scan_of_a_folder(spark, tmp_path):
    (tmp_path / "2016").mkdir()
    (tmp_path / "2016" / "claims_2016.fts").write_text(FIXED_LAYOUT)
    (tmp_path / "visits_ip_2007.fts").write_text(DELIMITED_LAYOUT.replace("\n", "\r\n"))
    (tmp_path / "readme.txt").write_text("no layout")
    layout, shape, file_rows = scan_layouts(spark, str(tmp_path))
    claims = Layout.from_dataframe(layout, "claims_2016.fts")
    assert [(f.name, f.type, f.start, f.width) for f in claims.fields] == [
        ("BENE_ID", "CHAR", 1, 5),
        ("STATE_CD", "CHAR", 6, 2),
        ("PMT_AMT", "NUM", 8, 8),
        ("SRVC_DT", "DATE", 16, 8),
        ("REMARK", "CHAR", 24, 6),
    ]
    assert claims.offsets() == [0, 5, 7, 15, 23] and claims.record_length == 29
    offsets = layout.filter("layout_stem = 'claims_2016'").sort("ord").select("offset").collect()
    assert [r.offset for r in offsets] == claims.offsets()
    assert Layout.from_dataframe(layout, "visits_ip_2007.fts").names == ["BENE_ID", "PMT_AMT", "SRVC_DT"]
    shapes = {r.layout_stem: r for r in shape.collect()}
    assert shapes["claims_2016"].expected_rows == 6 and shapes["claims_2016"].expected_columns == 5
    assert shapes["claims_2016"].rows_source == "header"
    assert shapes["visits_ip_2007"].expected_rows is None
    assert shapes["visits_ip_2007"].expected_columns == 3
    assert {(r.data_file, r.expected_rows) for r in file_rows.collect()} == {
        ("visits_ak_ip_2007.csv", 3),
        ("visits_co_ip_2007.csv", 12840),
    }
    with pytest.raises(ValueError, match="no layout rows"):
        Layout.from_dataframe(layout, "nothing.fts")


def test_headings(spark):
    row = parse(spark, FIXED_LAYOUT).first()
    assert row.headings == ["Order", "Field Long Name", "Field Short Name", "SAS Type", "Start", "Field Width"]
    apart = FIXED_LAYOUT.replace("----- -------------", "\n----- -------------", 1)
    nearest = parse(spark, apart).first().headings
    assert nearest[0] == "Colum Order" and nearest[2:] == row.headings[2:]
    one_line = parse(spark, FIXED_LAYOUT, header_lines=1).first().headings
    assert one_line == ["", "Name", "Name", "Type", "", "Width"]


def test_widths(spark):
    odd = FIXED_LAYOUT.replace("24    6", "24    x").replace("CHAR 6     2", "CHAR 6     x")
    assert [w for (w,) in fields(spark, odd, "width")] == [5, 2, 8, 8, 0]
    assert Layout.from_rows(layout_fields(parse(spark, odd)).collect()).default_unit == "char"
    for text in ("inf", "nan", "5d"):
        assert fields(spark, FIXED_LAYOUT.replace("CHAR 6     2", f"CHAR 6     {text}"), "width")[1] == (2,)
    assert fields(spark, FIXED_LAYOUT.replace("CHAR 6     2", "CHAR 6     2.9"), "width")[1] == (2,)
    bad = FIXED_LAYOUT.replace("CHAR 6     2", "CHAR x     2")
    with pytest.raises(ValueError, match="start is not a number"):
        Layout.from_rows(layout_fields(parse(spark, bad)).collect())


def test_end_of_body(spark):
    note = FIXED_LAYOUT.replace("Paid amount  ", "A note: paid ")
    assert len(fields(spark, note, "name")) == 5
    assert len(fields(spark, note, "name", parity=True)) == 2
    summary = FIXED_LAYOUT.replace("Service date ", "end of summar").replace("SRVC_DT     DATE", "summary     DATE")
    assert len(fields(spark, summary, "name", parity=True)) == 3
    broken = FIXED_LAYOUT.replace("3     Paid", "x     Paid")
    assert len(fields(spark, broken, "name")) == 2
    blank = FIXED_LAYOUT.replace("4     Service", "\n4     Service")
    assert len(fields(spark, blank, "name")) == 3
    unfinished = FIXED_LAYOUT.split("\n\n-- End")[0]
    assert len(fields(spark, unfinished, "name")) == 5


def test_wide_gaps(spark):
    text = "Order  Name  Type\n-----  ----  ----\n1      abcd  CHAR\n2      efgh  NUM \n"
    assert fields(spark, text, "name", "type") == [("abcd", "CHAR"), ("efgh", "NUM")]
    assert fields(spark, text, "name", "type", parity=True) == [("abc", "CHA"), ("efg", "NUM")]


def test_names_and_types(spark):
    text = DELIMITED_LAYOUT.replace(
        "3     SRVC_DT     DATE     Service",
        "3                 DATE     nameless\n4     BENE_ID     NUM      again\n5     Z                    untyped",
    )
    assert fields(spark, text, "ord", "name", "type", "is_last") == [
        (1, "BENE_ID", "NUM", False),
        (2, "PMT_AMT", "NUM", False),
        (3, "Z", "CHAR", True),
    ]


def test_no_table(spark):
    parsed = parse(spark, "just text -- and short dashes ---\nExact File Quantity (Rows): 1,234\n")
    assert layout_fields(parsed).count() == 0
    shape = layout_shapes(parsed).first()
    assert (shape.expected_rows, shape.rows_source, shape.has_table) == (1234, "exact quantity", False)
    assert shape.expected_columns is None and shape.expected_names is None
    assert layout_file_rows(parsed).count() == 0
    two = parse(spark, "Name Kind\n---- ----\n1    b\n", style="delimited")
    assert layout_fields(two).count() == 0


def test_declared_rows_of_files(spark):
    text = (
        "Data File: /out/a.csv  Rows: 1,000  Size(Bytes): 60\nData File: a.csv Rows: 2\n"
        "Data File: b.csv  Size(Bytes): 5  Rows: 7\nData File: c.csv\nRows: 9\n"
    )
    rows = layout_file_rows(parse(spark, text)).collect()
    assert {(r.data_file, r.expected_rows) for r in rows} == {("a.csv", 1000), ("b.csv", 7)}


def test_bad_text(spark, tmp_path):
    (tmp_path / "x.fts").write_bytes(b"Order Name\n----- ----\n1     \xff\n")
    with pytest.raises(Exception, match="layout is not UTF-8"):
        scan_layouts(spark, str(tmp_path)).layout.collect()


def test_plan_stays_small(spark):
    """No filter may be copied down through the chain of derived columns."""
    for df in (layout_fields(parse(spark, FIXED_LAYOUT)), layout_shapes(parse(spark, FIXED_LAYOUT))):
        assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 40_000


def test_dash_spans(spark):
    lines = [(0, " -- ---"), (1, "ä-\U0001f600--\n-"), (2, "--"), (3, "abc"), (4, ""), (5, None)]
    df = spark.createDataFrame(lines, "i int, line string")

    def spans(**options):
        found = with_dash_spans(df, "line", "spans", **options).orderBy("i").collect()
        return [r.spans and [tuple(s) for s in r.spans] for r in found]

    assert spans() == [[(1, 2), (4, 3)], [(1, 1), (3, 2), (6, 1)], [(0, 2)], [], [], None]
    assert spans(from_previous_end=True) == [[(0, 2), (4, 3)], [(0, 1), (3, 2), (6, 1)], [(0, 2)], [], [], None]


def test_dash_spans_are_found_once_a_line(spark, tmp_path):
    from catalog.layouts import span_starts

    rows = [(1, "ab", "c", 3), (2, "", "d", -5), (3, None, "e", 1)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = span_starts(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp" in line]
    assert sorted(map(tuple, found.where("p_partkey = 1").collect())) == [(1, 0, 1, 0, 2), (1, 1, 5, 4, 4), (1, 2, 10, 10, 1)]
    assert found.where("p_partkey = 3").count() == 0

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rawloom import Field, Layout, cast_by_layout, char, date, num
from rawloom.functions.casting import truncated_int
from rawloom.functions.text import decode_bytes, normalise_heading, whole_number, zero_pad


def values(spark, expression, texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).sort("i").collect()]


def test_num(spark):
    good = {"1": 1.0, "-1.5": -1.5, "007": 7.0, " 12 ": 12.0, " 8 ": 8.0}
    bad = ["+5", ".5", "5.", "1e5", "1,000", "NaN", "1d", "", "  ", None, "--1", "1 2", "٣"]
    assert values(spark, num, [*good, *bad]) == [*good.values(), *[None] * len(bad)]


def test_date(spark):
    good = {"20160101": dt.date(2016, 1, 1), " 20160229\t": dt.date(2016, 2, 29), "00010101": dt.date(1, 1, 1)}
    blank = ["", "   ", "　", None]
    bad = ["20160230", "00000000", "00000101", "2016-01-01", "2016115", "201611", "020160101", "2016010x"]
    assert values(spark, lambda c: date(c, "permissive"), [*good, *blank, *bad]) == [
        *good.values(),
        *[None] * (len(blank) + len(bad)),
    ]
    assert values(spark, date, [*good, *blank]) == [*good.values(), *[None] * 4]
    for text in bad:
        with pytest.raises(Exception, match="not a yyyyMMdd date"):
            values(spark, date, [text])


def test_date_fails_without_ansi_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a yyyyMMdd date"):
            values(spark, date, ["20160230"])
        assert values(spark, num, ["x", "2"]) == [None, 2.0]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_char_strips_like_python(spark):
    samples = [c + "x" + c for c in map(chr, [*range(1, 0x100), 0x1680, 0x180E, 0x200B, 0x2028, 0x3000])]
    samples += ["", " ", "\t ", "0", " a b ", "\x1f"]
    assert values(spark, char, samples) == [s.strip() or None for s in samples]


def test_decode_drops_bad_bytes(spark):
    samples = [
        b"plain",
        "hé € \U0001f600 �".encode(),
        b"a\xffb",
        b"\xe2\x82A\xef\xbf\xbd",
        b"\xed\xa0\x80x",
        b"\xc0\xaf\xf5\x80\x80\x80ok",
        b"\xf0\x9f\x98",
        b"\x80\xbf",
        b"",
    ]
    found = values(spark, decode_bytes, [bytearray(s) for s in samples], "binary")
    assert found == [s.decode("utf-8", errors="ignore") for s in samples]
    latin = values(spark, lambda c: decode_bytes(c, "ISO-8859-1"), [bytearray(b"\xe9")], "binary")
    assert latin == ["é"]


def test_small_text_functions(spark):
    assert values(spark, truncated_int, ["5", "5.9", "-1.5", "1e3", "nan", "inf", "x", "5d", ""]) == [
        5, 5, -1, 1000, None, None, None, None, None,
    ]
    assert values(spark, whole_number, ["12,840", "7", ",", ""]) == [12840, 7, None, None]
    assert values(spark, zero_pad, ["7", "77", "777"]) == ["07", "77", "777"]
    assert values(spark, normalise_heading, ["Field  Short-Name (1)", "  ", "SAS\tType"]) == [
        "field short name", "", "sas type",
    ]


def test_type_names_are_exact(spark):
    layout = Layout(
        (Field("a", "NUM"), Field("b", "num"), Field("c", "DATETIME"), Field("d.e", ""), Field("f", "DATE")),
        "delimited",
    )
    df = spark.createDataFrame(
        [(9, "1", " 1 ", "20160101", "x", "20160101")],
        "`extra` int, a string, b string, c string, `d.e` string, f string",
    )
    out = cast_by_layout(df, layout)
    assert out.dtypes == [
        ("a", "double"), ("b", "string"), ("c", "string"), ("d.e", "string"), ("f", "date"), ("extra", "int"),
    ]
    assert out.first() == (1.0, "1", "20160101", "x", dt.date(2016, 1, 1), 9)


def test_modes(spark):
    layout = Layout((Field("a", "DATE"), Field("b", "DATE")), "delimited")
    df = spark.createDataFrame([("20160101", "x"), ("y", "x"), (" ", "20160101")], "a string, b string")
    marked = cast_by_layout(df, layout, "permissive").collect()
    assert [r._corrupt_reason for r in marked] == [
        "not a date: b", "not a date: a; not a date: b", None,
    ]
    assert cast_by_layout(df, layout, "drop").collect() == [(None, dt.date(2016, 1, 1))]
    with pytest.raises(ValueError):
        cast_by_layout(df, layout, "ignore")


def test_layout_checks():
    with pytest.raises(ValueError, match="duplicate"):
        Layout((Field("a", "NUM", 1), Field("a", "NUM", 1)))
    with pytest.raises(ValueError, match="width"):
        Layout((Field("a"),))
    with pytest.raises(ValueError, match="no fields"):
        Layout(())
    layout = Layout((Field("a", "NUM", 3, 1), Field("", "CHAR", -2, 4), Field("b", "CHAR", 0, 9)))
    assert layout.offsets() == [0, 3, 3] and layout.offsets("declared") == [0, 3, 8]
    assert layout.record_length == 3 and layout.default_unit == "char"
    assert layout.names == ["a", "b"] and layout.declared_starts_differ() == ["b"]
    same = Layout((Field("a", "NUM", 3, 1), Field("", "CHAR", -2, 4), Field("b", "CHAR", 0, 9)), name="z")
    assert layout.fingerprint() == same.fingerprint()

import datetime as dt
import gzip
import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F
from samples import CSV_TEXT, FIXED_RECORDS

from rawloom import (
    Field,
    Layout,
    read_delimited,
    read_fixed_width,
    read_line_slice,
    slice_blocks,
    slice_fixed,
    write_line_index,
)
from rawloom.operators.ordered import indexed_lines, positioned_lines, row_slice

CLAIMS = Layout(
    (
        Field("BENE_ID", "CHAR", 5, 1),
        Field("STATE_CD", "CHAR", 2, 6),
        Field("PMT_AMT", "NUM", 8, 8),
        Field("SRVC_DT", "DATE", 8, 16),
        Field("REMARK", "CHAR", 6, 24),
    )
)
IP = Layout((Field("BENE_ID"), Field("PMT_AMT", "NUM"), Field("SRVC_DT", "DATE")), "delimited")


def write(tmp_path, content, name="x.dat"):
    path = tmp_path / name
    path.write_bytes(content)
    return str(path)


def test_fixed_width_records(spark, tmp_path):
    rows = read_fixed_width(spark, write(tmp_path, FIXED_RECORDS), CLAIMS).collect()
    assert rows == [
        ("A0001", "MA", 12.5, dt.date(2016, 1, 5), "ok"),
        ("A0002", None, None, None, None),
        ("é001", "RI", 7.0, dt.date(2016, 12, 31), "last"),
        ("A0004", "CT", None, dt.date(2016, 2, 29), "ab"),
        ("A0005", "NH", -0.5, dt.date(1960, 5, 5), "x"),
        ("A0005", "NH", -0.5, dt.date(1960, 5, 5), "x"),
    ]


@pytest.mark.parametrize("record", [b"A0001MA   12.50201601", b"", b"A0001MA   12.5020160105ok   "])
def test_short_records(spark, tmp_path, record):
    path = write(tmp_path, FIXED_RECORDS + record + b"\n")
    with pytest.raises(Exception, match="record shorter than 29 bytes"):
        read_fixed_width(spark, path, CLAIMS).select("PMT_AMT").collect()
    with pytest.raises(Exception, match="record shorter"):
        read_fixed_width(spark, path, CLAIMS).count()
    marked = read_fixed_width(spark, path, CLAIMS, mode="permissive").collect()
    assert len(marked) == 7 and [r._corrupt_reason is None for r in marked] == [True] * 6 + [False]
    assert read_fixed_width(spark, path, CLAIMS, mode="drop").count() == 6


def test_one_missing_byte_and_surplus(spark, tmp_path):
    path = write(tmp_path, b"A0001MA   12.5020160105ok   \nA0001MA   12.5020160105ok    and more text")
    rows = read_fixed_width(spark, path, CLAIMS, count_newline=True).collect()
    assert rows[0] == rows[1] and rows[0].REMARK == "ok"


def test_bad_date_modes(spark, tmp_path):
    path = write(tmp_path, b"A0001MA   12.5020160230ok    \n")
    with pytest.raises(Exception, match="not a yyyyMMdd date: 20160230"):
        read_fixed_width(spark, path, CLAIMS).collect()
    assert read_fixed_width(spark, path, CLAIMS, mode="drop").count() == 0
    row = read_fixed_width(spark, path, CLAIMS, mode="permissive").first()
    assert row.SRVC_DT is None and row._corrupt_reason == "not a date: SRVC_DT"


def test_lenient_slicing(spark, tmp_path):
    layout = Layout(
        (Field("a", "CHAR", 3), Field("none", "CHAR", 0), Field("b", "NUM", 4), Field("rest", "CHAR", 2))
    )
    path = write(tmp_path, "ééé  12long tail \nab\n\nabc7\n".encode() + b"\xffabc  1 t")
    assert read_fixed_width(spark, path, layout).collect() == [
        ("ééé", None, 12.0, "long tail"),
        ("ab", None, None, None),
        (None, None, None, None),
        ("abc", None, 7.0, None),
        ("abc", None, 1.0, "t"),
    ]


def test_declared_offsets_and_fillers(spark):
    layout = Layout((Field("a", "CHAR", 2, 1), Field("", "CHAR", 1, 3), Field("b", "CHAR", 2, 6)))
    df = spark.createDataFrame([(7, "ab-..cd")], "k int, value string")
    assert slice_fixed(df, layout).collect() == [("ab", "..", 7)]
    assert slice_fixed(df, layout, offsets="declared").collect() == [("ab", "cd", 7)]


def test_other_encoding(spark, tmp_path):
    layout = Layout((Field("a", "CHAR", 2), Field("b", "CHAR", 2)))
    path = write(tmp_path, b"\xe9a\xfcb\n")
    assert read_fixed_width(spark, path, layout, encoding="ISO-8859-1").collect() == [
        ("éa", "üb")
    ]


def test_row_slices(spark, tmp_path):
    path = write(tmp_path, FIXED_RECORDS)
    whole = read_fixed_width(spark, path, CLAIMS).collect()
    parts = [read_fixed_width(spark, path, CLAIMS, start_row=k, num_rows=4).collect() for k in (0, 4, 8)]
    assert sorted(map(str, parts[0] + parts[1])) == sorted(map(str, whole))
    assert len(parts[0]) == 4 and parts[2] == []
    assert read_fixed_width(spark, path, CLAIMS, start_row=5).count() == 1


def test_csv_in_another_encoding(spark, tmp_path):
    path = write(tmp_path, "é,1,\nü\xa0,2,\n".encode("latin-1"), "m.csv")
    rows = read_delimited(spark, path, IP, encoding="ISO-8859-1").collect()
    assert [r.BENE_ID for r in rows] == ["é", "ü"]


def test_carriage_returns_and_rare_white_space(spark, tmp_path):
    layout = Layout((Field("a", "CHAR", 4), Field("b", "NUM", 4)))
    lines = ["ab     1\r", "a\tb\t  2 ", "\u2003a\t\t  3", "    \x85\x85  ", " a b  4 "]
    path = write(tmp_path, "\n".join(lines).encode())
    rows = read_fixed_width(spark, path, layout, unit="char").collect()
    fields = [(x[:4].strip() or None, x[4:].strip()) for x in lines]
    assert rows == [(a, float(b) if b else None) for a, b in fields]


def test_csv(spark, tmp_path):
    rows = read_delimited(spark, write(tmp_path, CSV_TEXT, "m.csv"), IP).collect()
    assert rows == [
        ("A1", 12.5, dt.date(2007, 1, 1)),
        ('x "q", y', 7.0, None),
        ("NA", None, dt.date(2007, 12, 31)),
    ]


@pytest.mark.parametrize("line", [b"A1,2", b"A1,2,20070101,x", b"A\xff,2,20070101"])
def test_malformed_csv(spark, tmp_path, line):
    path = write(tmp_path, CSV_TEXT + line + b"\r\n", "m.csv")
    with pytest.raises(Exception, match="expected 3 fields|not valid UTF-8"):
        read_delimited(spark, path, IP).collect()
    with pytest.raises(Exception, match="expected 3 fields|not valid UTF-8"):
        read_delimited(spark, path, IP).count()
    marked = read_delimited(spark, path, IP, mode="permissive").collect()
    assert [r._corrupt_reason is None for r in marked] == [True] * 3 + [False]
    assert read_delimited(spark, path, IP, mode="drop").count() == 3


def test_csv_options(spark, tmp_path):
    path = write(tmp_path, b'H1,H2,H3\nA1,2,20070101\n"two\nlines",3,\n', "m.csv")
    as_data = read_delimited(spark, path, IP, mode="permissive").first()
    assert as_data.BENE_ID == "H1" and as_data._corrupt_reason == "not a date: SRVC_DT"
    rows = read_delimited(
        spark, path, IP, header=True, multiline=True, encoding_errors="replace"
    ).collect()
    assert [r.BENE_ID for r in rows] == ["A1", "two\nlines"]
    with pytest.raises(ValueError, match="encoding_errors"):
        read_delimited(spark, path, IP, header=True)
    empty = write(tmp_path, b"", "empty.csv")
    assert read_delimited(spark, empty, IP).count() == 0


def test_line_numbers_across_splits(spark, tmp_path):
    """Files cut into many splits; numbers must be those of a plain reader."""
    contents = {}
    for name, n in (("a.dat", 5000), ("b.dat", 3000), ("c.dat", 1)):
        lines = [f"{name}-{i:06d}" + "x" * (i % 50) for i in range(n)]
        write(tmp_path, "\n".join(lines).encode(), name)
        contents.update({line: i for i, line in enumerate(lines)})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert positioned_lines(spark, str(tmp_path)).select("_block").distinct().count() > 5
        numbered = indexed_lines(spark, str(tmp_path))
        assert {r.value: r.row_index for r in numbered.collect()} == contents
        cut = {r.value for r in row_slice(numbered, 2990, 100).collect()}
        assert cut == {v for v, i in contents.items() if 2990 <= i < 3090}
        assert row_slice(numbered, 5000, 10).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("block", [97, 1000, 1 << 20])
def test_slices_by_a_stored_line_index(spark, tmp_path, block):
    """Each slice is what a plain reader gives, whatever the blocks; lines may be empty, long, or unended."""
    raw = tmp_path / "raw files"
    raw.mkdir()
    contents = {
        "a.dat": b"\n".join(b"%06d" % i + b"x" * (i % 50) for i in range(300)),
        "b c.dat": b"\n\n\xff\xc3\r\n" + b"y" * 900 + b"\n\nlast\n",
        "empty.dat": b"",
        "one.dat": b"z",
    }
    for name, content in contents.items():
        write(raw, content, name)
    lines = {n: c.split(b"\n")[: -1 if c.endswith(b"\n") or not c else None] for n, c in contents.items()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        index = write_line_index(spark, str(raw), str(tmp_path / "index")).cache()
        for start, n in ((0, None), (2, 3), (3, 150), (299, 5), (400, 2)):
            found = {}
            for r in read_line_slice(spark, str(raw), index, start, n).select("_file", "row_index", F.col("value").cast("binary")).collect():
                found.setdefault(unquote(r._file).split("/")[-1], []).append((r.row_index, bytes(r.value)))
            wanted = {f: list(enumerate(all_))[start : None if n is None else start + n] for f, all_ in lines.items()}
            assert {f: sorted(v) for f, v in found.items()} == {f: v for f, v in wanted.items() if v}
        # only the blocks of the slice are looked at: the rest of a file may be anything
        if block == 1000:
            blocks = slice_blocks(spark, str(raw), index, 200, 3).collect()
            assert sum(b.block_length for b in blocks) < sum(map(len, contents.values())) / 3
            kept = os.stat(raw / "a.dat")
            spoilt = bytearray(b"?" * len(contents["a.dat"]))
            lower, upper = min(b.block_start for b in blocks), max(b.block_start + b.block_length for b in blocks) + 60
            spoilt[lower:upper] = contents["a.dat"][lower:upper]
            (raw / "a.dat").write_bytes(bytes(spoilt))
            os.utime(raw / "a.dat", ns=(kept.st_atime_ns, kept.st_mtime_ns))
            assert {r.value.encode() for r in read_line_slice(spark, str(raw), index, 200, 3).collect()} == set(lines["a.dat"][200:203])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_line_index_must_be_current(spark, tmp_path):
    raw, index = tmp_path / "raw", str(tmp_path / "index")
    raw.mkdir()
    path = write(raw, FIXED_RECORDS)
    write_line_index(spark, path, index)
    whole = read_fixed_width(spark, path, CLAIMS).collect()
    assert read_fixed_width(spark, path, CLAIMS, start_row=1, num_rows=3, line_index=index).collect() == whole[1:4]
    write(raw, FIXED_RECORDS, "new.dat")
    with pytest.raises(Exception, match="not in the line index"):
        read_line_slice(spark, str(raw), index, 1, 3).collect()
    write(raw, FIXED_RECORDS[30:])
    with pytest.raises(Exception, match="not in the line index"):
        read_line_slice(spark, path, index, 1, 3).collect()
    packed = write(raw, gzip.compress(FIXED_RECORDS), "x.dat.gz")
    with pytest.raises(Exception, match="compressed"):
        write_line_index(spark, packed, index)

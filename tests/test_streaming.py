import pytest
from pyspark.sql import functions as F
from test_readers import CLAIMS, IP, write
from samples import CSV_TEXT, FIXED_LAYOUT, FIXED_RECORDS

from rawloom import column_profile, read_fixed_width, read_tree, stream_intake, stream_profiles, stream_rows, stream_tree, tree_files
from rawloom.functions import names
from rawloom.streaming.incremental import read_profiles


def run(query):
    query.awaitTermination()


def test_only_new_files_are_read(spark, tmp_path):
    source, out, memory = (str(tmp_path / n) for n in ("in", "out", "memory"))
    (tmp_path / "in").mkdir()
    tags = {"year": names.year_of_name(names.base_name(names.source_path()), F.lit("dat"))}

    def again():
        rows = stream_rows(spark, source, CLAIMS, glob="*.dat", tags=tags)
        run(stream_intake(rows, out, memory, partition_by=["year"]))
        return spark.read.parquet(out)

    write(tmp_path / "in", FIXED_RECORDS, "claims_2016.dat")
    write(tmp_path / "in", b"not data", "notes.txt")
    assert again().count() == 6
    write(tmp_path / "in", FIXED_RECORDS, "claims_2017.dat")
    assert again().count() == 12
    assert again().count() == 12
    whole = read_fixed_width(spark, [source + "/claims_2016.dat"], CLAIMS)
    stored = spark.read.parquet(out).filter("year = 2016").drop("year")
    assert sorted(map(str, stored.collect())) == sorted(map(str, whole.collect()))


def test_delimited_stream_in_small_batches(spark, tmp_path):
    source, out, memory = (str(tmp_path / n) for n in ("in", "out", "memory"))
    (tmp_path / "in").mkdir()
    for i in range(4):
        write(tmp_path / "in", CSV_TEXT, f"m{i}.csv")
    rows = stream_rows(spark, source, IP, files_per_batch=1)
    run(stream_profiles(rows, out, memory))
    profiles = read_profiles(spark, out)
    assert profiles.select("batch_id").distinct().count() == 4
    assert profiles.filter("column = 'PMT_AMT'").groupBy().sum("missing_values").first()[0] == 4
    # Nothing new: no batch is added.
    run(stream_profiles(stream_rows(spark, source, IP, files_per_batch=1), out, memory))
    assert read_profiles(spark, out).select("batch_id").distinct().count() == 4


def test_streams_are_profiled_in_batches_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="foreachBatch"):
        column_profile(stream_rows(spark, str(tmp_path / "in"), CLAIMS))


def test_tree_of_kinds_and_layouts(spark, tmp_path):
    """Two kinds and two layouts arrive mixed; three runs take each row in once, and odd files are told."""
    from test_intake import LAYOUT, put

    root, out, memory = (str(tmp_path / n) for n in ("in", "out", "memory"))
    put(root, "2016/claims_2016.dat", FIXED_RECORDS)
    put(root, "2016/claims_2016.fts", FIXED_LAYOUT)
    put(root, "2016/a_2016.csv", "1,x\r\n2,y\n")
    put(root, "2016/a_2016.fts", LAYOUT)
    put(root, "2016/lost_2016.csv", "1,x\n")
    put(root, "2016/notes.txt", "text")
    run(stream_tree(spark, root, out, memory))
    put(root, "2017/a_2017.csv", "3,z\n")
    put(root, "2017/a_2017.fts", LAYOUT)
    put(root, "2017/b_2017.csv", "4,w\n")
    put(root, "2017/b_2017.fts", LAYOUT.replace("b      CHAR", "c      CHAR"))
    put(root, "2017/clash_2017.csv", "4,w\n")
    put(root, "2017/clash_2017.fts", LAYOUT.replace("b      CHAR", "Stem   CHAR"))
    run(stream_tree(spark, root, out, memory))
    run(stream_tree(spark, root, out, memory))
    assert sorted((r.year, r.a, r.b) for r in read_tree(spark, out, "a").collect()) == [("2016", 1.0, "x"), ("2016", 2.0, "y"), ("2017", 3.0, "z")]
    assert [(r.year, r.a, r.b, r.c) for r in read_tree(spark, out, "b").collect()] == [("2017", 4.0, None, "w")]
    assert read_tree(spark, out, "claims").count() == len(FIXED_RECORDS.splitlines())
    status = {r.path.rsplit("/", 1)[1]: (r.batch, r.status) for r in tree_files(spark, out).collect()}
    assert status == {
        "claims_2016.dat": (0, "parsed"), "a_2016.csv": (0, "parsed"), "lost_2016.csv": (0, "no layout"), "notes.txt": (0, "unsupported kind"),
        "a_2017.csv": (1, "parsed"), "b_2017.csv": (1, "parsed"), "clash_2017.csv": (1, "bad layout"),
    }


def test_plans_of_a_tree_read_their_own_files(spark, tmp_path, monkeypatch):
    from rawloom.streaming import tree
    from test_intake import LAYOUT, put

    read, seen = tree.read_lines, []

    def reading(session, paths):
        seen.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return read(session, paths)

    monkeypatch.setattr(tree, "read_lines", reading)
    root, out, memory = (str(tmp_path / n) for n in ("in", "out", "memory"))
    for stem, text in (("a b", LAYOUT), ("c+%20", LAYOUT), ("d", LAYOUT.replace("b      CHAR", "c      CHAR"))):
        put(root, f"2016/{stem}_2016.csv", f"1,{stem}\r\n")
        put(root, f"2016/{stem}_2016.fts", text)
    put(root, "2016/parts_2016.csv/part-0.csv", "2,x\n")
    put(root, "2016/parts_2016.fts", LAYOUT)
    run(stream_tree(spark, root, out, memory))
    put(root, "2016/parts_2016.csv/part-1.csv", "3,y\n")
    run(stream_tree(spark, root, out, memory))
    assert sorted(seen) == [["a b_2016.csv", "c+%20_2016.csv", "part-0.csv"], ["d_2016.csv"], ["part-1.csv"]]
    assert sorted((r.year, r.stem, r.a, r.b, r.c) for r in read_tree(spark, out).collect()) == [
        ("2016", "a b", 1.0, "a b", None), ("2016", "c+%20", 1.0, "c+%20", None), ("2016", "d", 1.0, None, "d"),
        ("2016", "parts", 2.0, "x", None), ("2016", "parts", 3.0, "y", None),
    ]

"""Runs that take in only what changed, and staged ones."""

import os

from pyspark.sql import Row
from pyspark.sql import functions as F
from test_intake import LAYOUT, put

from rawloom import folder_log, intake, read_dataset, remove_superseded


def files_below(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def by_name(manifest):
    return {r.file_name: r.status for r in manifest.collect()}


def tree(root):
    for year in (2015, 2016):
        for stem in ("a", "b"):
            put(root, f"{year}/{stem}_{year}.csv", f"{year},{stem}\n1,x\n")
            put(root, f"{year}/{stem}_{year}.fts", LAYOUT)
    return root


def rows_of(spark, out, **how):
    return sorted((r.year, r.stem, r.a, r.b) for r in read_dataset(spark, out, **how).collect())


def test_only_what_changed(spark, tmp_path):
    root, out = tree(str(tmp_path / "in")), str(tmp_path / "out")
    first = intake(spark, root, out, only_changed=True)
    assert set(by_name(first).values()) == {"parsed"} and "modified" not in first.columns
    data, before = f"{out}/year=2015", files_below(out + "/year=2015") + files_below(out + "/year=2016")
    assert set(by_name(intake(spark, root, out, only_changed=True)).values()) == {"unchanged"}
    assert files_below(data) + files_below(out + "/year=2016") == before

    put(root, "2015/a_2015.csv", "7,changed\n")
    put(root, "2016/b_2016.fts", LAYOUT.replace("b      CHAR", "c      CHAR"))
    put(root, "2016/n_2016.csv", "1,new\n")
    put(root, "2016/n_2016.fts", LAYOUT)
    got = by_name(intake(spark, root, out, only_changed=True))
    assert got == {"a_2015.csv": "parsed", "b_2015.csv": "unchanged", "a_2016.csv": "unchanged", "b_2016.csv": "parsed", "n_2016.csv": "parsed"}
    assert [r.b for r in read_dataset(spark, out, "a").where("year = 2015").collect()] == ["changed"]
    assert set(by_name(intake(spark, root, out, only_changed=True)).values()) == {"unchanged"}
    # other options read all again
    assert set(by_name(intake(spark, root, out, only_changed=True, mode="drop")).values()) == {"parsed"}


def test_failed_files_are_tried_again_and_folders_are_whole(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ("_001", "_002"):
        put(root, f"2016/a_2016{part}.csv", f"1,{part}\n")
    put(root, "2016/a_2016.fts", LAYOUT)
    put(root, "2016/bad_2016.csv", "1\n")
    put(root, "2016/bad_2016.fts", LAYOUT)
    got = by_name(intake(spark, root, out, only_changed=True))
    assert got == {"a_2016_001.csv": "parsed", "a_2016_002.csv": "parsed", "bad_2016.csv": "failed"}
    got = by_name(intake(spark, root, out, only_changed=True))
    assert got == {"a_2016_001.csv": "unchanged", "a_2016_002.csv": "unchanged", "bad_2016.csv": "failed"}
    put(root, "2016/bad_2016.csv", "1,mended\n")
    os.remove(f"{root}/2016/a_2016_001.csv")
    shared = {r.stem for r in read_dataset(spark, out).collect()}
    got = by_name(intake(spark, root, out, only_changed=True))
    assert got["bad_2016.csv"] == "parsed"
    assert got["a_2016_002.csv"] == ("parsed" if shared == {"a"} else "unchanged")


def test_staged_runs(spark, tmp_path):
    root, out = tree(str(tmp_path / "in")), str(tmp_path / "out")
    intake(spark, root, out, staged=True, only_changed=True)
    assert len(rows_of(spark, out)) == 8 and not os.path.exists(f"{out}/year=2015")
    # a file breaks: its folder is no longer served as current, and the report says so
    put(root, "2015/a_2015.csv", "1\n")
    put(root, "2016/a_2016.csv", "9,again\n")
    got = by_name(intake(spark, root, out, staged=True, only_changed=True))
    assert got == {"a_2015.csv": "failed", "b_2015.csv": "unchanged", "a_2016.csv": "parsed", "b_2016.csv": "unchanged"}
    assert [r for r in rows_of(spark, out) if r[1] == "a"] == [("2016", "a", 9.0, "again")]
    assert [r for r in rows_of(spark, out, last_good=True) if r[:2] == ("2015", "a")] == [("2015", "a", 1.0, "x"), ("2015", "a", 2015.0, "a")]
    assert {(r.year, r.stem): r.status for r in folder_log(spark, out).collect()}["2015", "a"] == "failed"
    report = "".join(r.value for r in spark.read.text(f"{out}/_reports/year=2015/stem=a").collect())
    assert "failed" in report
    assert len(rows_of(spark, out, stem="b")) == 4
    # places that the last entries or the last good ones need stay
    served, good = rows_of(spark, out), rows_of(spark, out, last_good=True)
    remove_superseded(spark, out)
    assert rows_of(spark, out) == served and rows_of(spark, out, last_good=True) == good
    put(root, "2015/a_2015.csv", "3,mended\n")
    intake(spark, root, out, staged=True, only_changed=True)
    assert [r for r in rows_of(spark, out) if r[:2] == ("2015", "a")] == [("2015", "a", 3.0, "mended")]


def test_unpublished_rows_are_invisible(spark, tmp_path):
    root, out = tree(str(tmp_path / "in")), str(tmp_path / "out")
    intake(spark, root, out, staged=True)
    served = rows_of(spark, out)
    # what a run that died has left
    spark.createDataFrame([(5.0, "half", "2015", "a")], "a double, b string, year string, stem string").write.partitionBy("year", "stem").parquet(f"{out}/_runs/_place=9-0")
    assert rows_of(spark, out) == served
    assert remove_superseded(spark, out) == 1
    assert rows_of(spark, out) == served


def test_small_files_are_packed(spark, tmp_path):
    """500 small files and one large: one Parquet file for each folder of small ones, the large one split as read."""
    root, out, plain = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "plain")
    for part in range(250):
        for stem in ("s", "t"):
            put(root, f"2016/{stem}_2016_{part:03}.csv", f"{part},{stem}\n" * (part % 3 + 1))
    put(root, "2016/s_2016_999.csv", "".join(f"{i},large\n" for i in range(50_000)))
    put(root, "2016/u_2016.csv", "1,alone\n")
    for stem in ("s", "t", "u"):
        put(root, f"2016/{stem}_2016.fts", LAYOUT)
    assert set(by_name(intake(spark, root, out, pack_rows=1000, run_qc=False)).values()) == {"parsed"}
    intake(spark, root, plain, run_qc=False)
    assert rows_of(spark, out) == rows_of(spark, plain) and len(rows_of(spark, out)) == 2 * 499 + 50_001
    count = lambda base, stem: len(files_below(f"{base}/year=2016/stem={stem}"))
    assert count(plain, "t") > 8 and count(out, "t") == 1 and count(out, "s") <= 1 + count(plain, "s") // 2 and count(out, "u") == 1
    large = read_dataset(spark, out, "s").where("b = 'large'").select(F.input_file_name().alias("f")).distinct().count()
    assert count(out, "s") == large + 1


def test_packing_by_estimates():
    from rawloom.plans.intake import _packed

    files = [Row(path=p, year=y, stem="s") for p, y in (("a", "1"), ("b", "1"), ("c", "1"), ("d", "2"), ("e", "3"), ("f", "3"), ("g", "3"))]
    sizes = {"a": 60, "b": 60, "c": 100, "d": 1, "e": 0, "f": 5}
    assert _packed(files, sizes, 100) == ({"a", "b", "e", "f"}, 3)
    assert _packed(files, {}, 100) == _packed(files, sizes, None) == (set(), 0)

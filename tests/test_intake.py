import json
import os

import pytest
from samples import CSV_TEXT, DELIMITED_LAYOUT, FIXED_LAYOUT, FIXED_RECORDS

from rawloom import intake, qc_folder, read_dataset
from rawloom.sources.manifest import build_manifest, collisions, rejected_files


def put(root, path, content):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def tree(tmp_path):
    root = str(tmp_path / "in")
    put(root, "2016/claims_2016.dat", FIXED_RECORDS)
    put(root, "2016/claims_2016.fts", FIXED_LAYOUT)
    put(root, "2017/claims_2017_001.dat", FIXED_RECORDS)
    put(root, "2017/claims_2017_002.dat", FIXED_RECORDS + FIXED_RECORDS)
    put(root, "2017/claims_2017.fts", FIXED_LAYOUT.replace("claims_2016", "claims_2017"))
    put(root, "2007/visits_ak_ip_2007.csv", CSV_TEXT)
    put(root, "2007/visits_CO_ip_2007.csv", CSV_TEXT)
    put(root, "2007/visits_ip_2007.fts", DELIMITED_LAYOUT)
    put(root, "2007/den2007.sas7bdat", b"x")
    put(root, "2008/den2008.sas7bdat", b"x")
    put(root, "2008/nothing.txt", b"x")
    put(root, "20x6/claims_2016.dat", b"x")
    put(root, "2009/other_2009.dat", b"x")
    return root


def test_manifest(spark, tree):
    rows = build_manifest(spark, tree).collect()
    assert [(r.year, r.file_name, r.kind, r.stem, r.part) for r in rows] == [
        ("2007", "visits_CO_ip_2007.csv", "csv", "visits_CO_ip", None),
        ("2007", "visits_ak_ip_2007.csv", "csv", "visits_ak_ip", None),
        ("2008", "den2008.sas7bdat", "sas", "den", None),
        ("2009", "other_2009.dat", "dat", "other", None),
        ("2016", "claims_2016.dat", "dat", "claims", None),
        ("2017", "claims_2017_001.dat", "dat", "claims__001", "001"),
        ("2017", "claims_2017_002.dat", "dat", "claims__002", "002"),
    ]
    assert {r.file_name for r in build_manifest(spark, tree, kinds="sas").collect()} == {
        "den2007.sas7bdat",
        "den2008.sas7bdat",
    }
    assert build_manifest(spark, tree, years=["2007", ""], stems=["visits_a"]).count() == 1
    assert build_manifest(spark, tree, years=[], stems=[" "]).count() == 7
    assert build_manifest(spark, tree, years=[1999]).count() == 0
    by_glob = build_manifest(spark, tree, globs=["{year}/claims*.dat", "{year}/*_001.dat"])
    assert by_glob.count() == 3
    assert collisions(build_manifest(spark, tree)).count() == 0
    assert {r.file_name for r in rejected_files(spark, tree).collect()} == {"nothing.txt"}


def test_collision(spark, tree):
    put(tree, "2016/claims.dat", b"x")
    with pytest.raises(ValueError, match="claims.dat and .*claims_2016.dat"):
        intake(spark, tree, tree + "-out")


def test_intake(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    status = {r.file_name: r.status for r in intake(spark, tree, out).collect()}
    assert status == {
        "visits_CO_ip_2007.csv": "parsed",
        "visits_ak_ip_2007.csv": "parsed",
        "den2008.sas7bdat": "not read",
        "other_2009.dat": "no layout",
        "claims_2016.dat": "parsed",
        "claims_2017_001.dat": "parsed",
        "claims_2017_002.dat": "parsed",
    }
    claims = read_dataset(spark, out, "claims")
    assert claims.groupBy("year", "stem").count().sort("year", "stem").collect() == [
        ("2016", "claims", 6),
        ("2017", "claims__001", 6),
        ("2017", "claims__002", 12),
    ]
    assert claims.dtypes[:5] == [
        ("BENE_ID", "string"),
        ("STATE_CD", "string"),
        ("PMT_AMT", "double"),
        ("SRVC_DT", "date"),
        ("REMARK", "string"),
    ]
    reports = {}
    for line in spark.read.option("recursiveFileLookup", True).text(out + "/_reports").collect():
        entry = json.loads(line.value)
        reports[entry["year"], entry["stem"]] = json.loads(entry["report"])
    assert len(reports) == 5
    claims16 = reports["2016", "claims"]
    assert claims16["shape_check"] == {
        "actual_rows": 6,
        "actual_columns": 5,
        "expected_rows": 6,
        "row_mismatch": False,
        "expected_columns": 5,
        "column_mismatch": False,
    }
    assert claims16["missing_columns"] == [] and claims16["unexpected_columns"] == []
    assert claims16["duplicate_rows"] == 1
    assert "expected_rows" not in reports["2017", "claims__001"]["shape_check"]
    assert reports["2007", "visits_ak_ip"]["shape_check"]["row_mismatch"] is False
    assert "expected_rows" not in reports["2007", "visits_CO_ip"]["shape_check"]

    totals = [json.loads(r.value) for r in spark.read.text(out + "/_totals").collect()]
    found = {t["layout_file"].rsplit("/")[-1]: t for t in totals}
    assert found["claims_2017.fts"] | {"layout_file": ""} == {
        "layout_file": "", "actual_rows": 18, "expected_rows": 6, "row_mismatch": True,
    }
    assert found["claims_2016.fts"]["row_mismatch"] is False
    assert found["visits_ip_2007.fts"].get("row_mismatch") is None

    # A second run replaces the same folders.
    intake(spark, tree, out, run_qc=False)
    assert read_dataset(spark, out, "claims").count() == 24


def test_intake_stem_first_and_sas(spark, tree, tmp_path):
    out = str(tmp_path / "out")

    def decoded(session, paths):
        return session.createDataFrame(
            [("7", 1.5, None), (" ", float("nan"), None)], "code string, amount double, d date"
        )

    result = intake(
        spark,
        tree,
        out,
        years=[2008, 2016],
        structure="file_stem/year",
        sas_reader=decoded,
        rows_per_file=4,
    )
    assert {r.status for r in result.collect()} == {"parsed"}
    den = read_dataset(spark, out, "den", "file_stem/year")
    assert den.select("code", "amount", "d").sort("code").collect() == [
        (None, None, None),
        ("7", 1.5, None),
    ]
    assert len([f for f in os.listdir(out + "/stem=claims/year=2016") if f.endswith(".parquet")]) == 2


def test_data_with_a_year_column(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(root, "2016/a b+c_2016.csv", "1999,x\n2000,y\n")
    put(
        root,
        "2016/a b+c_2016.fts",
        "Order Column Type\n----- ------ ----\n1     YEAR   NUM\n2     Stem   CHAR\n",
    )
    [refused] = intake(spark, root, out).collect()
    assert refused.status == "bad layout" and "choose other keys" in refused.note
    intake(spark, root, out, keys=("file_year", "file_stem"))
    rows = read_dataset(spark, out, "a b+c", keys=("file_year", "file_stem")).sort("YEAR").collect()
    assert [tuple(r) for r in rows] == [(1999.0, "x", "2016", "a b+c"), (2000.0, "y", "2016", "a b+c")]


LAYOUT = "Order Column Type\n----- ------ ----\n1     a      NUM\n2     b      CHAR\n"


def told(spark, out):
    found = {}
    for line in spark.read.option("recursiveFileLookup", True).text(out + "/_reports").collect():
        entry = json.loads(line.value)
        found[entry["year"], entry["stem"]] = json.loads(entry["report"])["shape_check"]
    return found


def test_folders_of_several_jobs(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part, layout in (("001", LAYOUT), ("002", LAYOUT.replace("CHAR", "NUM "))):
        put(root, f"2016/cl_2016_{part}.csv", "1,2\n")
        put(root, f"2016/cl_2016_{part}.fts", layout)
    with pytest.raises(ValueError, match="^1 output folders"):
        intake(spark, root, out, loose=True)
    mixed = str(tmp_path / "mixed")
    put(mixed, "2016/cl_2016.dat", b"1    x\n")
    put(mixed, "2016/cl_2016_001.csv", "1,2\n")
    put(mixed, "2016/cl_2016.fts", "Order L N    T    S W\n----- ---- ---- ---- ---- ----\n1     A    a    NUM  1    5\n")
    with pytest.raises(ValueError, match="several kinds or layouts"):
        intake(spark, mixed, out, kinds="all")
    assert not os.path.exists(out)


def test_shared_folder_numeric_stem_and_later_runs(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    for year in ("2016", "2017"):
        put(root, f"{year}/007_{year}_001.csv", "1,x\n2,y\n")
        put(root, f"{year}/007_{year}_002.csv", "3,x\n4,y\n5,z\n")
        mentions = f"Data File: 007_{year}_001.csv  Rows: 2\nData File: 007_{year}_002.csv  Rows: 3\n"
        put(root, f"{year}/007_{year}.fts", f"Exact File Quantity (Rows): 5\n{mentions}{LAYOUT}")
    for year in ("2016", "2017"):
        assert {r.status for r in intake(spark, root, out, years=[year]).collect()} == {"parsed"}
    shapes = told(spark, out)
    assert {k: (s["actual_rows"], s["expected_rows"], s["row_mismatch"]) for k, s in shapes.items()} == {
        (y, "007"): (5, 5, False) for y in ("2016", "2017")
    }
    totals = [json.loads(r.value) for r in spark.read.option("recursiveFileLookup", True).text(out + "/_totals").collect()]
    assert [(t["actual_rows"], t["expected_rows"]) for t in totals] == [(5, 5), (5, 5)]
    assert {(r.year, r.stem) for r in read_dataset(spark, out).collect()} == {("2016", "007"), ("2017", "007")}
    # a part number of four digits is read and found
    put(root, "2017/007_2017_1000.csv", "6,x\n")
    intake(spark, root, out, years=["2017"])
    assert read_dataset(spark, out, "007").filter("year = 2017").count() == 6
    # rows that are gone from the source go from their folder
    put(root, "2016/007_2016_001.csv", "1,2,3\n")
    put(root, "2016/007_2016_002.csv", "1,2,3\n")
    intake(spark, root, out, years=["2016"], mode="drop")
    assert read_dataset(spark, out).filter("year = 2016").count() == 0


def test_trouble_with_some_files(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    for name in ("good", "c[x]", "ragged", "latin"):
        put(root, f"2016/{name}_2016.fts", LAYOUT)
        put(root, f"2016/{name}_2016.csv", "1,x\n2,y\n")
    put(root, "2016/ragged_2016.csv", "1,x\n2\n")
    put(root, "2016/latin_2016.csv", "1,é\n".encode("latin-1"))
    put(root, "2016/_x_2016.csv", "1,x\n")
    put(root, "2016/y_2015.csv", "1,x\n")
    put(root, "2016/y_2015.fts", b"Order Column\xff\n----- ------\n")
    put(root, "2010/z_2010.fts", b"\xff\n")
    found = {r.file_name: (r.status, r.note) for r in intake(spark, root, out, years=[2016]).collect()}
    assert {f: s for f, (s, _) in found.items()} == {
        "good_2016.csv": "parsed", "c[x]_2016.csv": "parsed", "ragged_2016.csv": "failed",
        "latin_2016.csv": "failed", "y_2015.csv": "bad layout",
    }
    assert "expected 2 fields" in found["ragged_2016.csv"][1] and "UTF-8" in found["latin_2016.csv"][1]
    assert found["y_2015.csv"][1].startswith("folder of 2016, name of 2015; ")
    assert read_dataset(spark, out, "c[x]").count() == 2 and read_dataset(spark, out).count() == 4
    rejects = [json.loads(r.value) for r in spark.read.text(out + "/_rejects").collect()]
    assert [(r["path"].rsplit("/")[-1], r["reason"]) for r in rejects] == [("_x_2016.csv", "hidden name")]
    fixed = intake(spark, root, str(tmp_path / "again"), stems=["latin"], csv_options={"encoding": "ISO-8859-1"})
    assert fixed.first().status == "parsed"
    assert read_dataset(spark, str(tmp_path / "again"), "latin").first().b == "é"


def test_no_files(spark, tmp_path):
    os.makedirs(tmp_path / "in" / "2016")
    with pytest.raises(ValueError, match="no raw files"):
        intake(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_hidden_names_at_any_depth(spark, tmp_path):
    root = str(tmp_path / "in")
    for name in ("2016/_a_2016.dat", "2016/sub/_b_2016.dat", "2016/sub/c_2016.csv", "2016/sub/more/.d_2016.csv", "2016/e_2016.dat/part-0",
                 "2016/e_2016.dat/_SUCCESS", "2016/_notes.txt"):
        put(root, name, "x\n")
    found = rejected_files(spark, root).where("reason = 'hidden name'").collect()
    assert {r.path[len(root) + 1 :] for r in found} == {"2016/_a_2016.dat", "2016/sub/_b_2016.dat", "2016/sub/more/.d_2016.csv"}


def test_qc_report_beside_the_data(spark, tmp_path):
    folder = str(tmp_path / "rows")
    spark.range(3).write.parquet(folder)
    told = qc_folder(spark, folder).first().report
    assert spark.read.text(folder + "/_qc_report").first().value == told and spark.read.parquet(folder).count() == 3
    assert qc_folder(spark, folder, out=None).first().report == told


def test_paths_are_taken_apart_once_a_file(spark, tmp_path):
    from rawloom.functions import names
    from rawloom.plans.intake import path_tags
    from rawloom.sources.tags import tagged

    stems = ("a b", "a+b", "a%20b", "\u00e4#?x", "a{1}", "[q]*")
    for stem in stems:
        put(str(tmp_path), f"{stem}_2016.dat", "x\ny\n")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        lines = spark.read.text([names.literal_path(f"{root}/{s}_2016.dat") for s in stems])
        each, once = (tagged(lines, path_tags("dat", root), per_file) for per_file in (False, True))
        assert once.columns == ["value", "year", "stem"]
        assert sorted(once.collect()) == sorted(each.collect()) == sorted((v, "2016", s) for s in stems for v in "xy")
        plan = once._jdf.queryExecution().optimizedPlan().toString()
        of_rows = [line for line in plan.splitlines() if line.lstrip().startswith(":")]
        assert of_rows and "regexp" in plan and not [line for line in of_rows if "regexp" in line]


def test_given_layouts_are_computed_once(spark, tmp_path, monkeypatch):
    """What is asked of layout names stays above them; it is not pushed to the rows they are made of."""
    from pyspark.sql import functions as F
    from rawloom.plans import intake as plan

    seen = []

    def attach(files, texts):
        seen.append(texts._jdf.queryExecution().optimizedPlan().toString())
        return attached(files, texts)

    attached = plan.attach_layouts
    monkeypatch.setattr(plan, "attach_layouts", attach)
    root = str(tmp_path / "in")
    put(root, "2016/a_2016.csv", "1,x\n")
    rows = spark.createDataFrame([("2016", i) for i in range(9)], "year string, i int")
    texts = rows.select("year").distinct().select(F.concat(F.lit(f"{root}/"), "year", F.lit("/a_2016.fts")).alias("layout_file"), F.lit(LAYOUT).alias("text"))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    intake(spark, root, str(tmp_path / "out"), layout_texts=texts)
    plan.describe_layouts(spark, root, plan.select_files(spark, root), texts)
    assert len(seen) == 2 and all("InMemoryRelation" in p for p in seen)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert [(r.a, r.b) for r in read_dataset(spark, str(tmp_path / "out"), "a").collect()] == [(1.0, "x")]

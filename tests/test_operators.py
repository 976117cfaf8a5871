import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F
from test_readers import CLAIMS, write
from samples import FIXED_RECORDS

from rawloom import (
    column_profile,
    detect_kinds,
    duplicate_rows,
    infer_and_cast,
    sampled_kinds,
    merged_profile,
    missing_values,
    numeric_summary,
    read_fixed_width,
    report,
    schema_diff,
    shape_check,
    top_values,
    unique_values,
    value_counts,
    write_report,
    write_state,
)
from rawloom.operators import long_values, ordered, profile


@pytest.fixture(scope="module")
def claims(spark, tmp_path_factory):
    return read_fixed_width(spark, write(tmp_path_factory.mktemp("c"), FIXED_RECORDS), CLAIMS)


def test_profile_of_claims(claims):
    rows = {r.column: r for r in column_profile(claims).collect()}
    assert {c: r.missing_values for c, r in rows.items()} == {
        "BENE_ID": 0, "STATE_CD": 1, "PMT_AMT": 2, "SRVC_DT": 1, "REMARK": 1,
    }
    assert {c: r.unique_values for c, r in rows.items()} == {
        "BENE_ID": 5, "STATE_CD": 4, "PMT_AMT": 3, "SRVC_DT": 4, "REMARK": 4,
    }
    amount = rows["PMT_AMT"]
    assert (amount.min, amount.max, amount.mean) == (-0.5, 12.5, 4.625)
    assert rows["SRVC_DT"].min is None
    assert duplicate_rows(claims).first().duplicate_rows == 1
    assert duplicate_rows(claims, prefilter=True).first().duplicate_rows == 1
    state = top_values(claims.select("STATE_CD")).sort("rank").collect()
    assert [(r.value, r.n) for r in state] == [("NH", 2), ("CT", 1), ("MA", 1), ("RI", 1)]


def test_report_of_claims(spark, claims, tmp_path):
    expected = spark.createDataFrame(
        [(7, 5, ["BENE_ID", "OTHER"])],
        "expected_rows bigint, expected_columns int, expected_names array<string>",
    )
    write_report(report(claims, expected), str(tmp_path / "r"))
    found = json.loads(spark.read.text(str(tmp_path / "r")).first().value)
    assert list(found) == [
        "shape_check", "actual_columns", "expected_columns", "missing_columns",
        "unexpected_columns", "fts_used_for_schema", "column_checks", "duplicate_rows",
        "numeric_summary", "top_categories",
    ]
    assert found["shape_check"]["row_mismatch"] is True
    assert found["shape_check"]["column_mismatch"] is False
    assert found["missing_columns"] == ["OTHER"]
    assert found["unexpected_columns"] == ["STATE_CD", "PMT_AMT", "SRVC_DT", "REMARK"]
    assert found["column_checks"]["STATE_CD"] == {"missing_values": 1, "unique_values": 4}
    assert list(found["column_checks"]) == CLAIMS.names
    assert found["numeric_summary"]["PMT_AMT"]["mean"] == 4.625
    assert found["top_categories"]["STATE_CD"] == {"NH": 2, "CT": 1, "MA": 1, "RI": 1}
    bare = json.loads(report(claims).first().report)
    assert bare["expected_columns"] is None and bare["missing_columns"] is None
    assert "row_mismatch" not in bare["shape_check"] and not bare["fts_used_for_schema"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b double")
    assert duplicate_rows(empty).first().duplicate_rows == 0
    rows = column_profile(empty).collect()
    assert [(r.missing_values, r.unique_values) for r in rows] == [(0, 0), (0, 0)]
    assert json.loads(report(empty).first().report)["top_categories"] == {}


def test_no_numeric_columns(spark):
    df = spark.createDataFrame([("x", "y")], "ds string, s string")
    found = numeric_summary(df, ["ds"])
    assert found.columns == ["ds", "column", "min", "max", "mean", "stddev"] and found.count() == 0
    assert json.loads(report(df, by=["ds"]).first().report)["numeric_summary"] == {}


def test_odd_values(spark):
    df = spark.createDataFrame(
        [(0.0, "", {"k": 1}), (-0.0, None, None), (math.nan, "", None), (math.nan, "a", None), (None, "A", None)],
        "d double, s string, m map<string,int>",
    )
    rows = {r.column: r for r in column_profile(df).collect()}
    assert rows["d"].unique_values == 2 and rows["d"].missing_values == 1
    assert rows["s"].unique_values == 3
    assert rows["m"].unique_values is None and rows["m"].error
    assert rows["m"].missing_values == 4
    assert duplicate_rows(df).first().duplicate_rows == 0
    assert duplicate_rows(df.select("d")).first().duplicate_rows == 2


def test_awkward_names(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2)], "`a.b` string, `c ``d` int")
    assert {r.column: r.unique_values for r in unique_values(df).collect()} == {"a.b": 1, "c `d": 2}
    assert {r.column: r.missing_values for r in missing_values(df).collect()} == {"a.b": 0, "c `d": 0}
    assert numeric_summary(df).first().max == 2.0
    assert value_counts(df).first().n == 2
    assert duplicate_rows(df).first().duplicate_rows == 0


def test_all_numeric_types(spark):
    df = spark.sql(
        "SELECT CAST(1 AS TINYINT) a, CAST(2 AS SMALLINT) b, 3 c, 4L d, CAST(5 AS FLOAT) e, 6D f, "
        "CAST(7.25 AS DECIMAL(18,3)) g, 'x' h, DATE '2020-01-01' i"
    )
    assert {r.column: (r.max, r.stddev) for r in numeric_summary(df).collect()} == {
        "a": (1.0, None), "b": (2.0, None), "c": (3.0, None), "d": (4.0, None),
        "e": (5.0, None), "f": (6.0, None), "g": (7.25, None),
    }


def test_top_values_and_null(spark):
    data = [(v,) for v, n in (("a", 5), (None, 9), ("b", 4), ("c", 3), ("d", 3), ("e", 3)) for _ in range(n)]
    df = spark.createDataFrame(data, "s string")
    assert [r.value for r in top_values(df).sort("rank").collect()] == ["a", "b", "c", "d"]
    kept = top_values(df, exclude_null_first=True).sort("rank").collect()
    assert [r.value for r in kept] == ["a", "b", "c", "d", "e"]
    single = profile.top_of_column(df, "s", 3).collect()
    assert [(r.value, r.n) for r in single] == [(None, 9), ("a", 5), ("b", 4)]


def test_hot_values_against_brute_force(spark):
    """A third of the rows share one value, one dataset, one key."""
    rows = [(i % 3 and i % 7, "hot" if i % 3 == 0 else f"v{i % 50}", i % 3 and i) for i in range(3000)]
    df = spark.createDataFrame(rows, "ds int, s string, x int")
    by = {}
    for ds, s, x in rows:
        by.setdefault(ds, []).append((s, x))
    found = {(r.ds, r.column): r.unique_values for r in unique_values(df, ["ds"]).collect()}
    assert found == {
        (ds, c): len({v[i] for v in vs}) for ds, vs in by.items() for i, c in enumerate(("s", "x"))
    }
    surplus = {r.ds: r.duplicate_rows for r in duplicate_rows(df, ["ds"]).collect()}
    assert surplus == {ds: len(v) - len(set(v)) for ds, v in by.items() if len(v) > len(set(v))}
    assert duplicate_rows(df, prefilter=True).first().duplicate_rows == len(rows) - len(set(rows))


def test_running_total_and_take_while(spark):
    rows = [("hot", i, i // 10, i % 7) for i in range(500)] + [("b", 3, 0, 1)]
    df = spark.createDataFrame(rows, "g string, i int, block int, v int")
    out = ordered.running_total(df, ["g"], "block", ["i"], F.col("v"), "t").collect()
    total, expected = 0, {("b", 3): 1}
    for g, i, _, v in rows[:500]:
        total += v
        expected[g, i] = total
    assert {(r.g, r.i): r.t for r in out} == expected
    none = df.withColumns({"block": F.lit(None).cast("int"), "g": F.nullif("g", F.lit("hot"))})
    assert {(r.g, r.i): r.row_index for r in ordered.row_index(none, ["g"], "block", ["i"]).collect()} == {
        ("b", 3): 0, **{(None, i): i for i in range(500)},
    }
    stopped = ordered.take_while(none, ["g"], "i", F.col("v") == 5).collect()
    assert {(r.g, r.i) for r in stopped} == {("b", 3), *[(None, i) for i in range(5)]}
    kept = ordered.take_while(df, ["g"], "i", F.col("v") == 5).collect()
    assert {(r.g, r.i) for r in kept} == {("b", 3), *[("hot", i) for i in range(5)]}


def test_reconcile(spark):
    def names(*columns):
        rows = [("x", c, i) for i, c in enumerate(columns)]
        return spark.createDataFrame(rows, "dataset string, column string, ord int")

    diff = schema_diff(names("B", "C", "D"), names("A", "B", "C", "d")).collect()
    assert {(r.column, r.status) for r in diff} == {
        ("A", "missing"), ("B", "matched"), ("C", "matched"), ("d", "missing"), ("D", "unexpected"),
    }
    actual = spark.createDataFrame([("x", 5, 2), ("y", 6, 2)], "dataset string, actual_rows int, actual_columns int")
    told = spark.createDataFrame([("x", None, 3)], "dataset string, expected_rows int, expected_columns int")
    rows = {r.dataset: r for r in shape_check(actual, told).collect()}
    assert rows["x"].row_mismatch is None and rows["x"].column_mismatch is True
    assert rows["y"].row_mismatch is None and rows["y"].column_mismatch is None


def test_report_without_text_columns(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, None)], "a int, b double")
    found = json.loads(report(df).first().report)
    assert found["duplicate_rows"] == 1 and found["top_categories"] == {}
    assert found["column_checks"]["b"]["missing_values"] == 1


def test_kinds(spark):
    df = spark.createDataFrame(
        [
            ("2016-01-01", "1", "a", None, "10:30:00", "1960-05-05 13:00:00", 1.5, 1),
            (None, "2.5", "1", None, "11:00:00", None, math.nan, 2),
            (" 2016-02-30"[:0] or None, "NaN", " ", None, None, "2001-01-01", None, 3),
        ],
        "day string, number string, text string, nothing string, time string, stamp string, f double, row int",
    )
    kinds = {
        "day": "date", "number": "numeric", "text": "string", "nothing": "string",
        "time": "string", "stamp": "date", "f": "numeric", "row": "numeric",
    }
    assert {r.column: r.kind for r in detect_kinds(df).collect()} == kinds
    sampled = {r.column: (r.kind, r.misfits) for r in sampled_kinds(df, ["row"]).collect()}
    assert sampled == {c: (k, 0) for c, k in kinds.items() if c not in ("row", "f")}
    late = spark.createDataFrame([(i, str(i) if i < 12 else "late") for i in range(20)], "row int, v string")
    assert sampled_kinds(late, ["row"]).collect() == [("v", "numeric", 8)]
    assert infer_and_cast(late).dtypes[1] == ("v", "string")
    codes = spark.createDataFrame([("00501", "12345678901234567", "0.5", "-07"), ("1", "2", "10", "3")], "a string, b string, c string, d string")
    assert [r.kind for r in detect_kinds(codes).collect()] == ["string", "string", "numeric", "string"]
    cast = infer_and_cast(df).sort("row").collect()
    assert cast[0] == (dt.date(2016, 1, 1), 1.0, "a", None, "10:30:00", dt.date(1960, 5, 5), 1.5, 1.0)
    assert cast[2] == (None, None, None, None, None, dt.date(2001, 1, 1), None, 3.0)
    assert cast[1].f is None
    kept = infer_and_cast(df, text="keep")
    assert dict(kept.dtypes) == {
        "day": "string", "number": "string", "text": "string", "nothing": "string",
        "time": "string", "stamp": "string", "f": "double", "row": "double",
    }
    bad_day = spark.createDataFrame([("2016-02-30",)], "d string")
    assert detect_kinds(bad_day).first().kind == "string"


def test_early_timestamps_round_down(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '1960-05-05 13:00:00' AS t")
    assert infer_and_cast(df).first().t == dt.date(1960, 5, 5)


def test_states_add_up_to_the_profile(spark, tmp_path):
    """Batches of unlike size, with NULLs, a batch repeated, a column of NULLs and one that cannot be grouped."""
    rows = [(i, None if i % 7 == 0 else f"v{i % 13}", 1e9 + i / 8, None, {"a": i}) for i in range(200)] + [(None, "", -5.0, None, None), (1, "", float("nan"), None, None)]
    df = spark.createDataFrame(rows, "a bigint, `b c` string, d double, e int, m map<string,int>")
    out = str(tmp_path / "states")
    numbered = [spark.createDataFrame(rows[lo:hi], df.schema) for lo, hi in ((0, 1), (1, 150), (150, 202))]
    write_state(numbered[2], out, 0)
    for k, batch in enumerate(numbered):
        write_state(batch, out, k)
    want = {r["column"]: r for r in column_profile(df).collect()}
    got = merged_profile(spark, out)
    assert got.columns == column_profile(df).columns
    for r in got.collect():
        for name, value in r.asDict().items():
            other = want[r["column"]][name]
            if isinstance(value, float):
                assert value == pytest.approx(other, rel=1e-9, nan_ok=True), (r["column"], name)
            else:
                assert value == other, (r["column"], name)
    assert len(want) == got.count()


def test_long_values_as_whole_values(spark):
    """Texts round the length of a digest, common beginnings, ties, NULLs, odd names."""
    long = "the same beginning of all of these texts "
    texts = [None, None, None, "", "a", "a", "x" * 31, "x" * 32, "x" * 32, "é" * 16, "é" * 15 + "e", *[long + str(i % 9) for i in range(15)], long + "z" * 5000]
    rows = [(g, t, None if i % 4 else t, i) for g in ("p", None) for i, t in enumerate(texts)] + [("q", None, None, 0)]
    df = spark.createDataFrame(rows, "`the key` string, `a.b` string, value string, i int")
    for by in ([], ["the key"]):
        for k in (1, 3, 5, 100):
            for nulls in (False, True):
                want = profile.top_values(df, k, by, exclude_null_first=nulls)
                got = long_values.top_long_values(df, k, by, exclude_null_first=nulls)
                assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        plain = profile.unique_values(df.drop("i"), by)
        assert sorted(map(str, long_values.unique_long_values(df, by=by).select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert long_values.top_long_values(df.limit(0)).count() == long_values.unique_long_values(df.select("i")).count() == 0


def test_long_values_shuffle_no_texts(spark, tmp_path):
    spark.range(3000).select(F.repeat(F.col("id").cast("string"), 500).alias("t")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    counts = long_values.long_value_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(column" in counts and not any("value" in line for line in counts.split("\n") if "Exchange" in line)
    top = long_values.top_long_values(df)
    rows = top.collect()
    assert [r.value for r in rows] == sorted(str(i) * 500 for i in range(3000))[:5]
    assert "BroadcastHashJoin" in top._jdf.queryExecution().executedPlan().toString()

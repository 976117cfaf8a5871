"""Every registered query against its SQL, on the smallest tables; and its plan."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import ORACLES as OWN, QUERIES as CATALOG
from check import rows_of

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in OWN}
PYTHON_NODES = "BatchEvalPython|ArrowEvalPython|InPandas|InArrow|PythonUDF"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) == set(CATALOG)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF)
    mine = [tuple(r) for r in df.collect()]
    found = sql.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, mine) == rows_of(columns, found.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(PYTHON_NODES, plan)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "SinglePartition" not in plan or name in SMALL_ENDS


# Plans that end in one task, which then holds one row per task or per column, a sorted
# top-k of each task, or per-task group limits.
SMALL_ENDS = {
    "a3_failfast", "b4_failfast", "d5_duplicates_maps", "g4_sampled_kinds", "k5_collisions",
    "a13_report_json", "d15_column_profile", "d3_nulls", "d4_distinct", "d12_detect_kind",
    "d5_duplicates", "d5_duplicates_all_columns", "d5_duplicates_prefiltered",
    "d6_d8_numeric_profile", "f1_top_of_column", "f2_offset_limit", "k4_profile",
}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 6 and df.columns[0] == "column"

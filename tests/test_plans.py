"""The plans behind the main operators are the ones intended."""

from catalog.common import table
from catalog.scans import ORDERS_LAYOUT, PART_LAYOUT, order_lines, part_lines
from pyspark.sql import functions as F

from rawloom import (
    read_delimited,
    read_fixed_width,
    split_delimited,
    top_values,
    unique_values,
)
from rawloom.operators import ordered
from rawloom.plans.report import report

SF = "/root/testdata/sf0.001"


def plan(df):
    """The final plan without AQE's initial copy."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_scans_do_not_shuffle(spark, tmp_path):
    raw, csv = str(tmp_path / "raw"), str(tmp_path / "csv")
    order_lines(table(spark, SF, "orders")).write.text(raw)
    part_lines(table(spark, SF, "part")).write.text(csv)
    for mode in ("failfast", "permissive", "drop"):
        fixed = plan(read_fixed_width(spark, raw, ORDERS_LAYOUT, mode=mode))
        delimited = plan(read_delimited(spark, csv, PART_LAYOUT, mode=mode))
        assert "Exchange" not in fixed and "Exchange" not in delimited


def test_unused_fields_are_not_cut(spark, tmp_path):
    raw = str(tmp_path / "raw")
    order_lines(table(spark, SF, "orders")).write.text(raw)
    text = plan(read_fixed_width(spark, raw, ORDERS_LAYOUT, "permissive").select("o_totalprice"))
    assert ", 29, 16)" in text
    assert ", 45, 8)" not in text and ", 53, 16)" not in text


def test_each_line_is_parsed_once(spark):
    lines = part_lines(table(spark, SF, "part"))
    for mode in ("failfast", "permissive", "drop"):
        assert plan(split_delimited(lines, PART_LAYOUT, mode=mode)).count("from_csv(") == 1


def test_top_values_are_cut_before_the_shuffle(spark):
    text = plan(top_values(table(spark, SF, "events"), by=["user_id"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_distinct_counts_read_only_what_they_count(spark):
    counted = unique_values(table(spark, SF, "lineitem").select("l_tax", "l_returnflag", "l_discount"))
    text = plan(counted)
    assert "ReadSchema: struct<l_tax:double,l_discount:double>" in text.replace(
        "l_discount:double,l_tax:double", "l_tax:double,l_discount:double"
    )
    assert "ReadSchema: struct<l_returnflag:string>" in text
    assert "l_comment" not in text and "l_shipdate" not in text


def test_row_index_shuffles_rows_once(spark):
    files = table(spark, SF, "orders").select(
        F.year("o_orderdate").alias("file"),
        "o_orderkey",
        F.floor(F.col("o_orderkey") / 100).alias("split"),
        "o_totalprice",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ordered.row_index(files, ["file"], "split", ["o_orderkey"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The rows, to be joined and windowed by (file, split); and three of split totals.
    assert text.count("Exchange hashpartitioning") == text.count("Exchange ") == 4


def test_report_shares_the_shuffle_of_values(spark):
    df = report(table(spark, SF, "events"))
    df.collect()
    assert "ReusedExchange" in plan(df)

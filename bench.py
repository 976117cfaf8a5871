"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables' folder, ``BENCH_CPUS`` the cores. Each query is run
once to warm up and then timed; the time is that of the faster of two runs, from
building the plan to having written every row (a sink that drops the rows).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402

from rawloom.session import local_session  # noqa: E402

HEADLINE = (
    "a1_fixed_width_strict",
    "a2_fixed_width_lenient",
    "a3_delimited",
    "a5_layout_scan",
    "a11_manifest",
    "b2_char",
    "b3_num",
    "b4_date",
    "c3_c4_schema_diff",
    "c5_shape",
    "d4_distinct",
    "d5_duplicates",
    "d5_duplicates_all_columns",
    "d6_d8_numeric_profile",
    "d9_value_counts",
    "d12_detect_kind",
    "d15_column_profile",
    "e1_top5_by",
    "e8_part_number",
    "k1_fixed_width_files",
    "k2_delimited_files",
    "k3_infer_cast",
    "k4_profile",
    "k5_intake",
    "i1_incremental",
)


def timed(spark, sf_dir, name) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "rawloom-bench")
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        timed(spark, sf_dir, name)
        seconds[name] = round(min(timed(spark, sf_dir, name) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

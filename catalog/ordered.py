"""Operators that depend on a row order."""

from __future__ import annotations

from catalog.common import Catalog, table
from pyspark.sql import functions as F

from rawloom.functions.casting import truncated_int
from rawloom.operators import infer, profile
from rawloom.operators import ordered as o

_c = Catalog()
QUERIES, ORACLES = _c.queries, _c.oracles

_ORDER_FILES = "SELECT CAST(year(o_orderdate) AS INTEGER) AS file, o_orderkey, o_totalprice FROM orders"
_INDEXED = f"""
    SELECT file, o_orderkey, CAST(row_number() OVER (PARTITION BY file ORDER BY o_orderkey) - 1
           AS BIGINT) AS row_index FROM ({_ORDER_FILES})"""


def indexed_orders(spark, sf_dir):
    """Orders as the rows of one file per year, in key order, split by key range."""
    files = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("file"),
        "o_orderkey",
        F.floor(F.col("o_orderkey") / 4096).alias("split"),
    )
    return o.row_index(files, ["file"], "split", ["o_orderkey"]).drop("split")


@_c.add("e9_row_index", _INDEXED)
def row_index(spark, sf_dir):
    return indexed_orders(spark, sf_dir)


@_c.add(
    "e9_row_slice",
    f"SELECT * FROM ({_INDEXED}) WHERE row_index >= 200 AND row_index < 200 + 1000",
)
def row_slice(spark, sf_dir):
    """Skip 200 rows of every file, take the next 1000."""
    return o.row_slice(indexed_orders(spark, sf_dir), 200, 1000)


@_c.add(
    "e8_part_number",
    f"""
    SELECT file, row_index // 1000 + 1 AS part, count(*) AS n_rows, min(o_orderkey) AS first_key,
           max(o_orderkey) AS last_key FROM ({_INDEXED}) GROUP BY 1, 2""",
)
def part_number(spark, sf_dir):
    part = o.part_number(F.col("row_index"), 1000).alias("part")
    return (
        indexed_orders(spark, sf_dir)
        .groupBy("file", part)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@_c.add(
    "f2_offset_limit",
    "SELECT p_partkey, p_name FROM part ORDER BY p_retailprice, p_partkey LIMIT 500 OFFSET 100",
)
def offset_limit(spark, sf_dir):
    """Rows 100 to 599 of one ordering, numbered in two levels so that no task sorts them all."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        "p_retailprice",
        F.lit(1).alias("all"),
        F.floor(F.col("p_retailprice") / 50).alias("stretch"),
    )
    numbered = o.row_index(part, ["all"], "stretch", ["p_retailprice", "p_partkey"])
    return o.row_slice(numbered, 100, 500).select("p_partkey", "p_name")


@_c.add(
    "e5_null_group",
    """
    SELECT grp, o_orderkey FROM (
        SELECT CASE WHEN o_custkey % 4 > 0 THEN CAST(o_custkey % 4 AS BIGINT) END AS grp, o_orderkey,
               min(o_orderkey) FILTER (WHERE o_orderstatus = 'P')
                   OVER (PARTITION BY CASE WHEN o_custkey % 4 > 0 THEN o_custkey % 4 END) AS stop
        FROM orders)
    WHERE stop IS NULL OR o_orderkey < stop""",
)
def take_while_null_group(spark, sf_dir):
    """Rows before the first pending order; the NULL group stops like the others."""
    customer = F.col("o_custkey") % 4
    rows = table(spark, sf_dir, "orders").select(
        F.when(customer > 0, customer).alias("grp"), "o_orderkey", "o_orderstatus"
    )
    kept = o.take_while(rows, ["grp"], "o_orderkey", F.col("o_orderstatus") == "P")
    return kept.select("grp", "o_orderkey")


_LAYOUT_SQL = """SELECT 'f' || (p_partkey // 100) AS layout_file,
                        CAST(p_partkey % 100 + 1 AS BIGINT) AS ord, p_size - 4 AS w FROM part"""


@_c.add(
    "e2_offsets",
    f"""
    SELECT layout_file, ord, w AS width,
           CAST(coalesce(sum(greatest(w, 0)) OVER (PARTITION BY layout_file ORDER BY ord
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
    FROM ({_LAYOUT_SQL})""",
)
def offsets(spark, sf_dir):
    layout = table(spark, sf_dir, "part").select(
        F.concat(F.lit("f"), F.expr("p_partkey div 100")).alias("layout_file"),
        (F.col("p_partkey") % 100 + 1).alias("ord"),
        (F.col("p_size") - 4).alias("width"),
    )
    return o.offsets(layout, block_size=16)


@_c.add(
    "e4_width_fallback",
    f"""
    SELECT layout_file, ord, CAST(CASE WHEN w % 3 = 0 THEN coalesce(lead(start) OVER (
               PARTITION BY layout_file ORDER BY ord) - start, 0) ELSE w END AS INTEGER) AS width
    FROM (SELECT *, ord * ord + w AS start FROM ({_LAYOUT_SQL}))""",
)
def width_fallback(spark, sf_dir):
    layout = table(spark, sf_dir, "part").select(
        F.concat(F.lit("f"), F.expr("p_partkey div 100")).alias("layout_file"),
        (F.col("p_partkey") % 100 + 1).alias("ord"),
        (F.col("p_size") - 4).alias("w"),
    )
    layout = layout.withColumn("start", (F.col("ord") * F.col("ord") + F.col("w")).cast("int"))
    layout = layout.withColumn(
        "raw", F.when(F.col("w") % 3 == 0, "unknown").otherwise(F.concat(F.col("w"), F.lit(".0")))
    )
    return o.width_fallback(layout, truncated_int(F.col("raw"))).select("layout_file", "ord", "width")


@_c.add(
    "e5_take_while",
    """
    SELECT conv_id, turn, role FROM conversations c
    WHERE turn < coalesce((SELECT min(turn) FROM conversations s WHERE s.conv_id = c.conv_id
                           AND length(s.text) > 400), 1000000000)""",
)
def take_while(spark, sf_dir):
    """Turns of a conversation before the first long one."""
    turns = table(spark, sf_dir, "conversations")
    kept = o.take_while(turns, ["conv_id"], "turn", F.length("text") > 400)
    return kept.select("conv_id", "turn", "role")


@_c.add(
    "d13_first_last_match",
    """
    SELECT l_partkey, arg_min(l_extendedprice, pos) FILTER (WHERE l_returnflag = 'R') AS first_price,
           arg_max(l_extendedprice, pos) FILTER (WHERE l_quantity > 25) AS last_price
    FROM (SELECT *, l_orderkey * 1000000000 + l_suppkey * 10000 + l_linenumber * 1000 + l_quantity
                 AS pos FROM (SELECT DISTINCT * FROM lineitem)) GROUP BY l_partkey""",
)
def first_last_match(spark, sf_dir):
    position = (
        F.col("l_orderkey") * 1000000000
        + F.col("l_suppkey") * 10000
        + F.col("l_linenumber") * 1000
        + F.col("l_quantity")
    )
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            o.first_match(price, position, F.col("l_returnflag") == "R").alias("first_price"),
            o.last_match(price, position, F.col("l_quantity") > 25).alias("last_price"),
        )
    )


_SAMPLE_SQL = """
    SELECT "column", value, c_custkey, CAST(row_number() OVER (PARTITION BY "column" ORDER BY c_custkey)
           AS INTEGER) AS rank
    FROM (SELECT c_custkey, 'c_name' AS "column", CASE WHEN c_custkey % 3 > 0 THEN c_name END AS value
          FROM customer UNION ALL
          SELECT c_custkey, 'c_nationkey', CASE WHEN c_nationkey > 4
                 THEN CAST(c_nationkey AS VARCHAR) ELSE 'NaN' END FROM customer UNION ALL
          SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer)
    WHERE value IS NOT NULL AND value <> 'NaN'"""


@_c.add("e3_first_values", f"SELECT * FROM ({_SAMPLE_SQL}) WHERE rank <= 10")
def first_values(spark, sf_dir):
    """The first ten present values of each column, in key order."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey").cast("string"))
        .otherwise("NaN")
        .alias("c_nationkey"),
        "c_mktsegment",
    )
    return infer.first_values(customer, ["c_custkey"], 10)


@_c.add(
    "f1_top_of_column",
    "SELECT props AS value, count(*) AS n FROM events GROUP BY props ORDER BY n DESC, props LIMIT 5",
)
def top_of_column(spark, sf_dir):
    return profile.top_of_column(table(spark, sf_dir, "events"), "props")

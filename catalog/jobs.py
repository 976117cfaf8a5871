"""Whole jobs: files are written to the scratch folder and read back."""

from __future__ import annotations

from catalog.common import Catalog, money, table
from catalog.scans import (
    ORDERS_LAYOUT,
    ORDERS_SQL,
    PART_LAYOUT,
    PART_SQL,
    order_lines,
    order_line,
    part_lines,
)
from pyspark.sql import functions as F

from rawloom import (
    intake,
    merged_profile,
    qc_folder,
    read_dataset,
    read_delimited,
    read_fixed_width,
    report,
    stream_intake,
    stream_profiles,
    stream_rows,
    stream_states,
    write_dataset,
    write_line_index,
    write_report,
)
from rawloom.operators.ordered import indexed_lines
from rawloom.session import scratch_dir
from rawloom.streaming.incremental import read_profiles
from rawloom.streaming.tree import read_tree, stream_tree

_c = Catalog()
QUERIES, ORACLES = _c.queries, _c.oracles


@_c.add("k1_fixed_width_files", ORDERS_SQL)
def fixed_width_files(spark, sf_dir):
    raw = scratch_dir(spark, "dat")
    order_lines(table(spark, sf_dir, "orders")).write.text(raw)
    return read_fixed_width(spark, raw, ORDERS_LAYOUT)


@_c.add("k2_delimited_files", PART_SQL)
def delimited_files(spark, sf_dir):
    raw = scratch_dir(spark, "csv")
    part_lines(table(spark, sf_dir, "part")).write.text(raw)
    return read_delimited(spark, raw, PART_LAYOUT)


@_c.add("e9_stored_slices", ORDERS_SQL)
def stored_slices(spark, sf_dir):
    """Slices of every file by one stored line index, each written as a part: together they are all rows."""
    raw, index, out = (scratch_dir(spark, n) for n in ("dat", "line_index", "typed"))
    order_lines(table(spark, sf_dir, "orders")).write.text(raw)
    write_line_index(spark, raw, index)
    for part, (start, rows) in enumerate([(0, 500), (500, 1500), (2000, None)], 1):
        some = read_fixed_width(spark, raw, ORDERS_LAYOUT, start_row=start, num_rows=rows, line_index=index)
        some.write.parquet(f"{out}/part={part}")
    return spark.read.parquet(out).drop("part")


_BY_YEAR = """
    SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS year, 'orders__00' || o_orderpriority[1:1] AS stem
    FROM orders"""


def _orders_by_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "*",
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("orders__00"), F.substring("o_orderpriority", 1, 1)).alias("stem"),
    )


@_c.add("a8_write_read", _BY_YEAR)
def write_read(spark, sf_dir):
    out = scratch_dir(spark, "typed")
    write_dataset(_orders_by_year(spark, sf_dir), out, rows_per_file=5000)
    return read_dataset(spark, out)


@_c.add("a10_logical_table", _BY_YEAR)
def logical_table(spark, sf_dir):
    """All numbered parts of one stem, stored stem first; a repeated write changes nothing."""
    out = scratch_dir(spark, "typed")
    for _ in range(2):
        write_dataset(_orders_by_year(spark, sf_dir), out, "file_stem/year")
    return read_dataset(spark, out, "orders", "file_stem/year")


@_c.add(
    "a9_directory_view",
    "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1",
)
def directory_view(spark, sf_dir):
    out = scratch_dir(spark, "flat")
    table(spark, sf_dir, "orders").write.parquet(out)
    spark.read.parquet(out).createOrReplaceTempView("df")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM df GROUP BY 1"
    )


@_c.add(
    "e9_indexed_lines",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_lines, count(*) AS n_indexes,
           CAST(0 AS BIGINT) AS out_of_order FROM orders GROUP BY 1""",
)
def lines_with_index(spark, sf_dir):
    """Line numbers within written files: dense, and in the order of the lines."""
    raw = scratch_dir(spark, "lines")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    keys = F.lpad(F.col("o_orderkey").cast("string"), 18, "0").alias("value")
    orders.sortWithinPartitions("year", "o_orderkey").select(keys, "year").write.partitionBy(
        "year"
    ).text(raw)
    per_file = (
        indexed_lines(spark, raw)
        .groupBy("_file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.max("row_index") + 1).alias("last"),
            F.count_distinct("row_index").alias("indexes"),
            F.min_by("value", "row_index").alias("first_line"),
            F.min("value").alias("least"),
            F.max_by("value", "row_index").alias("last_line"),
            F.max("value").alias("most"),
        )
    )
    ordered = (
        (F.col("first_line") == F.col("least"))
        & (F.col("last_line") == F.col("most"))
        & (F.col("last") == F.col("indexes"))
    )
    return per_file.groupBy(
        F.regexp_extract("_file", "/year=([0-9]+)/", 1).cast("int").alias("year")
    ).agg(
        F.sum("n").alias("n_lines"),
        F.sum("indexes").alias("n_indexes"),
        F.count_if(~ordered).alias("out_of_order"),
    )


@_c.add(
    "a13_report_json",
    """
    SELECT count(*) AS actual_rows, 6 AS actual_columns, count(DISTINCT user_id) AS users,
           CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS BIGINT)
               AS duplicate_rows,
           max(value) AS top_value, count(*) FILTER (WHERE event_type = 'signup') AS signups,
           true AS row_mismatch
    FROM events""",
)
def report_json(spark, sf_dir):
    """The stored report, read back and taken apart."""
    out = scratch_dir(spark, "report")
    expected = spark.createDataFrame(
        [(1, 6, ["event_id"])],
        "expected_rows bigint, expected_columns int, expected_names array<string>",
    )
    write_report(report(table(spark, sf_dir, "events"), expected), out)

    def item(path, kind):
        return F.get_json_object("value", path).cast(kind)

    return spark.read.text(out).select(
        item("$.shape_check.actual_rows", "bigint").alias("actual_rows"),
        item("$.shape_check.actual_columns", "int").alias("actual_columns"),
        item("$.column_checks.user_id.unique_values", "bigint").alias("users"),
        item("$.duplicate_rows", "bigint").alias("duplicate_rows"),
        item("$.numeric_summary.value.max", "double").alias("top_value"),
        item("$.top_categories.event_type.signup", "bigint").alias("signups"),
        item("$.shape_check.row_mismatch", "boolean").alias("row_mismatch"),
    )


_LAYOUT_TEXT = """Columns in File: 6

Order Field Long  Field Short     SAS  Start Field
      Name        Name            Type       Width
----- ----------- --------------- ---- ----- -----
1     Key         o_orderkey      NUM  1     14
2     Customer    o_custkey       NUM  15    12
3     Status      o_orderstatus   CHAR 27    2
4     Price       o_totalprice    NUM  29    16
5     Date        o_orderdate     DATE 45    8
6     Priority    o_orderpriority CHAR 53    16

-- End of File Transfer Summary"""


@_c.add(
    "k5_intake",
    f"SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS year, 'orders' AS stem FROM ({ORDERS_SQL})",
)
def whole_intake(spark, sf_dir):
    """A tree with one raw file per year, each written as a folder of parts."""
    root, out = scratch_dir(spark, "tree"), scratch_dir(spark, "typed")
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    file = F.concat(F.lit("orders_"), year, F.lit(".dat"))
    rendered = orders.select(order_line().alias("value"), year.alias("folder"), file.alias("file"))
    rendered.write.partitionBy("folder", "file").text(root)
    path = F.concat(F.lit(f"{root}/folder="), "year", F.lit("/orders_"), "year", F.lit(".fts"))
    layouts = orders.select(year.alias("year")).distinct().select(
        path.alias("layout_file"), F.lit(_LAYOUT_TEXT).alias("text")
    )
    intake(spark, root, out, layout_texts=layouts)
    return read_dataset(spark, out, "orders")


_CSV_LAYOUT = """
Order Column        SAS      Description
      Name          Type
----- ------------- -------- -------------
1     o_orderkey    NUM      Key
2     {second} {type}     Second

Note: declared by the sender"""
_SECOND = {"price": ("o_totalprice", "NUM "), "state": ("o_orderstatus", "CHAR")}


def _csv_text(second: str = "price"):
    name, kind = _SECOND[second]
    return F.lit(_CSV_LAYOUT.replace("{second}", name.ljust(13)).replace("{type}", kind))


def _csv_line(second: str = "price"):
    value = money("o_totalprice") if second == "price" else F.col("o_orderstatus")
    return F.concat(F.col("o_orderkey").cast("string"), F.lit(","), value)


def _tree(root, rows, folder, file, line):
    """Raw files, each a folder of parts, from rows that name their folder and file."""
    rows.select(line.alias("value"), folder.alias("folder"), file.alias("file")).write.mode(
        "append"
    ).partitionBy("folder", "file").text(root)


def _told(error: str) -> str:
    """``raised`` and how many folders the error names."""
    return error.split(" ", 1)[0]


@_c.add(
    "k5_collisions",
    """
    SELECT k AS "case", 'raised' AS outcome, CAST(n AS VARCHAR) AS n_folders
    FROM (SELECT count(DISTINCT c_nationkey) AS n FROM customer), (SELECT unnest(['kinds', 'parts']) AS k)""",
)
def collisions(spark, sf_dir):
    """Parts with layouts of their own, and two kinds of file, that would share folders."""
    nation = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("n"))
    found = []
    for case in ("parts", "kinds"):
        root, out = scratch_dir(spark, "tree"), scratch_dir(spark, "typed")
        stem = F.concat(F.lit("cl"), "n", F.lit("_2016"))
        files = ("_001.csv", "_002.csv") if case == "parts" else (".dat", "_001.csv")
        for file in files:
            _tree(root, nation, F.lit("2016"), F.concat(stem, F.lit(file)), F.lit("1,2"))
        path = F.concat(F.lit(f"{root}/folder=2016/"), stem)
        names = nation.distinct()
        if case == "parts":
            layouts = names.select(F.concat(path, F.lit("_001.fts")).alias("layout_file"), _csv_text().alias("text")).unionByName(
                names.select(F.concat(path, F.lit("_002.fts")).alias("layout_file"), _csv_text("state").alias("text"))
            )
        else:
            layouts = names.select(F.concat(path, F.lit(".fts")).alias("layout_file"), F.lit(_LAYOUT_TEXT).alias("text"))
        try:
            intake(spark, root, out, kinds="csv" if case == "parts" else "all", loose=case == "parts", layout_texts=layouts)
            found.append((case, "read", ""))
        except ValueError as e:
            found.append((case, "raised", _told(str(e))))
    rows = [F.struct(F.lit(a).alias("case"), F.lit(b).alias("outcome"), F.lit(c).alias("n_folders")) for a, b, c in found]
    return nation.limit(1).select(F.inline(F.array(*rows)))


def _shared_tree(spark, sf_dir, stem: str, root: str):
    """Two csv parts a year in one folder, with declared rows; odd years declare one too many."""
    orders = table(spark, sf_dir, "orders")
    year, part = F.year("o_orderdate").cast("string"), F.col("o_orderkey") % 2 + 1
    file = F.concat(F.lit(f"{stem}_"), year, F.lit("_00"), part.cast("string"), F.lit(".csv"))
    _tree(root, orders, year, file, _csv_line())
    per_year = orders.groupBy(year.alias("year")).agg(
        F.count_if(part == 1).alias("first"), F.count_if(part == 2).alias("second")
    )
    more = F.col("year").cast("int") % 2

    def mention(number: int, rows) -> list:
        head = F.concat(F.lit(f"\nData File: {stem}_"), "year", F.lit(f"_00{number}.csv  Rows: "))
        return [head, rows.cast("string"), F.lit("  Size(Bytes): 1")]

    total = F.concat(F.lit(f"{stem}_"), "year", F.lit(" ("), (F.col("first") + F.col("second")).cast("string"), F.lit(" Rows)"))
    text = F.concat(total, *mention(1, F.col("first")), *mention(2, F.col("second") + more), F.lit("\n"), _csv_text())
    path = F.concat(F.lit(f"{root}/folder="), "year", F.lit(f"/{stem}_"), "year", F.lit(".fts"))
    return per_year.select(path.alias("layout_file"), text.alias("text"))


def _stored_reports(spark, out):
    def item(path, kind):
        return F.get_json_object(F.get_json_object("value", "$.report"), path).cast(kind)

    lines = spark.read.option("recursiveFileLookup", True).text(f"{out}/_reports")
    return lines.select(
        F.get_json_object("value", "$.year").alias("year"),
        F.get_json_object("value", "$.stem").alias("stem"),
        item("$.shape_check.actual_rows", "bigint").alias("actual_rows"),
        item("$.shape_check.expected_rows", "bigint").alias("expected_rows"),
        item("$.shape_check.row_mismatch", "boolean").alias("row_mismatch"),
        item("$.duplicate_rows", "bigint").alias("duplicate_rows"),
    )


def _stored_totals(spark, out):
    lines = spark.read.option("recursiveFileLookup", True).text(f"{out}/_totals")
    return lines.select(
        F.regexp_extract(F.get_json_object("value", "$.layout_file"), "([0-9]{4})[.]fts", 1).alias("year"),
        F.regexp_extract(F.get_json_object("value", "$.layout_file"), "/([a-z0-9]+)_[0-9]{4}[.]fts", 1).alias("stem"),
        F.get_json_object("value", "$.actual_rows").cast("bigint").alias("total_rows"),
        F.get_json_object("value", "$.expected_rows").cast("bigint").alias("total_expected"),
    )


_FOLDERS = """
    SELECT y AS year, stem, n AS actual_rows, n + CAST(y AS INTEGER) % 2 AS expected_rows,
           CAST(y AS INTEGER) % 2 = 1 AS row_mismatch, CAST(0 AS BIGINT) AS duplicate_rows,
           n AS total_rows, n AS total_expected
    FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS y, count(*) AS n FROM orders GROUP BY 1)"""


@_c.add("k5_shared_folder", _FOLDERS.replace("stem,", "'sales' AS stem,"))
def shared_folder(spark, sf_dir):
    """Parts that share a folder: rows of both, the sum of what is declared, the total once."""
    root, out = scratch_dir(spark, "tree"), scratch_dir(spark, "typed")
    layouts = _shared_tree(spark, sf_dir, "sales", root)
    intake(spark, root, out, layout_texts=layouts)
    return _stored_reports(spark, out).join(_stored_totals(spark, out), ["year", "stem"])


@_c.add("k5_reports", _FOLDERS.replace(") GROUP BY 1)", ")").replace("stem,", "unnest(['007', 'a']) AS stem,"))
def reports_of_runs(spark, sf_dir):
    """A run for each half of the years: numeric and other stems, all reports and totals are kept."""
    root, out = scratch_dir(spark, "tree"), scratch_dir(spark, "typed")
    layouts = _shared_tree(spark, sf_dir, "007", root).unionByName(_shared_tree(spark, sf_dir, "a", root))
    years = [str(y) for y in range(1990, 2003)]
    for some in (years[::2], years[1::2]):
        intake(spark, root, out, years=some, layout_texts=layouts)
    return _stored_reports(spark, out).join(_stored_totals(spark, out), ["year", "stem"])


@_c.add(
    "k5_packed",
    """
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, TRUE AS packed
    FROM orders GROUP BY 1""",
)
def packed(spark, sf_dir):
    """Forty raw files a year, brought together by estimated rows: fewer Parquet files than raw ones, all rows."""
    root, out = scratch_dir(spark, "tree"), scratch_dir(spark, "typed")
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    part = F.lpad((F.col("o_orderkey") % 40).cast("string"), 3, "0")
    _tree(root, orders, year, F.concat(F.lit("orders_"), year, F.lit("_"), part, F.lit(".csv")), _csv_line())
    path = F.concat(F.lit(f"{root}/folder="), "year", F.lit("/orders_"), "year", F.lit(".fts"))
    layouts = orders.select(year.alias("year")).distinct().select(path.alias("layout_file"), _csv_text().alias("text"))
    taken = intake(spark, root, out, layout_texts=layouts, pack_rows=1_000_000, run_qc=False)
    raw = taken.where("status = 'parsed'").groupBy("year").agg(F.count("*").alias("raw"))
    rows = read_dataset(spark, out, "orders").withColumn("file", F.input_file_name())
    found = rows.groupBy("year").agg(
        F.count("*").alias("n_rows"), F.sum("o_orderkey").cast("long").alias("keys"), F.count_distinct("file").alias("files")
    )
    return found.join(raw, "year").select("year", "n_rows", "keys", (F.col("files") < F.col("raw")).alias("packed"))


@_c.add(
    "k5_rerun",
    """
    SELECT y AS year, 'parsed' AS first, CASE y WHEN '1995' THEN 'parsed' WHEN '1996' THEN 'failed' ELSE 'unchanged' END AS second,
           CASE y WHEN '1995' THEN 2 * n WHEN '1996' THEN NULL ELSE n END AS n_rows, n * (1 + CAST(y = '1995' AS INTEGER)) AS last_good
    FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS y, count(*) AS n FROM orders GROUP BY 1)""",
)
def rerun(spark, sf_dir):
    """Two staged runs over a file a year: one file grows between them, one breaks, the others are not read again."""
    root, out = scratch_dir(spark, "tree"), scratch_dir(spark, "typed")
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    file = F.concat(F.lit("orders_"), year, F.lit(".csv"))
    _tree(root, orders, year, file, _csv_line())
    path = F.concat(F.lit(f"{root}/folder="), "year", F.lit("/orders_"), "year", F.lit(".fts"))
    layouts = orders.select(year.alias("year")).distinct().select(path.alias("layout_file"), _csv_text().alias("text"))
    first = intake(spark, root, out, layout_texts=layouts, only_changed=True, staged=True).select("year", F.col("status").alias("first"))
    first = spark.createDataFrame(first.collect(), first.schema)
    _tree(root, orders.where(year == "1995"), year, file, _csv_line())
    _tree(root, orders.where(year == "1996"), year, file, F.col("o_orderkey").cast("string"))
    second = intake(spark, root, out, layout_texts=layouts, only_changed=True, staged=True).select("year", F.col("status").alias("second"))
    served = read_dataset(spark, out, "orders").groupBy("year").agg(F.count("*").alias("n_rows"))
    good = read_dataset(spark, out, "orders", last_good=True).groupBy("year").agg(F.count("*").alias("last_good"))
    return first.join(second, "year").join(served, "year", "left").join(good, "year", "left")


def _put(spark, path: str, content: bytes) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(content))
    stream.close()


@_c.add(
    "k5_status",
    """
    SELECT file_name, status, note, CASE status WHEN 'parsed' THEN n END AS n_rows,
           CASE status WHEN 'parsed' THEN first END AS first_name, CASE status WHEN 'parsed' THEN last END AS last_name
    FROM (VALUES
        ('good_2016.dat', 'parsed', NULL), ('late_2015.dat', 'parsed', 'folder of 2016, name of 2015'),
        ('short_2016.dat', 'failed', 'record shorter than 20 bytes: 3'), ('code_2016.dat', 'bad layout', 'layout is not UTF-8'),
        ('keyed_2016.dat', 'bad layout', 'has columns [''Stem'']: choose other keys than (''year'', ''stem'')'),
        ('_hidden_2016.dat', 'rejected', 'hidden name'), ('notes.txt', 'rejected', 'unsupported kind')) AS t(file_name, status, note),
        (SELECT count(*) AS n, min(c_name) AS first, max(c_name) AS last FROM customer)""",
)
def statuses(spark, sf_dir):
    """All customers in files with every kind of trouble: each file has its status, and what can be read is."""
    root, out = scratch_dir(spark, "tree"), scratch_dir(spark, "typed")
    customer = table(spark, sf_dir, "customer")
    stems = ("good_2016", "late_2015", "short_2016", "code_2016", "keyed_2016")
    each = customer.select(F.rpad("c_name", 20, " ").alias("line"), F.explode(F.array(*[F.lit(s) for s in stems])).alias("file"))
    _tree(root, each, F.lit("2016"), F.concat("file", F.lit(".dat")), F.col("line"))
    _tree(root, customer.where("c_custkey = 1"), F.lit("2016"), F.lit("short_2016.dat"), F.lit("abc"))
    for name in ("_hidden_2016.dat", "notes.txt"):
        _put(spark, f"{root}/folder=2016/{name}", b"x")
    text = _LAYOUT_TEXT.split("\n1     Key")[0].replace("Columns in File: 6", "Columns in File: 1") + "\n1     Name        {}            CHAR 1     20\n"
    layouts = spark.createDataFrame(
        [(f"{root}/folder=2016/{s}.fts", text.format("Stem" if s[0] == "k" else "name").encode() + (b"\xe4" if s[0] == "c" else b"")) for s in stems],
        "layout_file string, text binary",
    ).withColumn("text", F.col("text").cast("string"))
    found = intake(spark, root, out, layout_texts=layouts).select("file_name", "stem", "status", "note")
    gone = spark.read.text(f"{out}/_rejects").select(
        F.regexp_extract(F.get_json_object("value", "$.path"), "([^/]*)$", 1).alias("file_name"),
        F.lit(None).cast("string").alias("stem"),
        F.lit("rejected").alias("status"),
        F.get_json_object("value", "$.reason").alias("note"),
    )
    written = read_dataset(spark, out).groupBy("stem").agg(
        F.count("*").alias("n_rows"), F.min("name").alias("first_name"), F.max("name").alias("last_name")
    )
    return found.unionByName(gone).join(written, "stem", "left").drop("stem")


@_c.add(
    "k4_qc_folder",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
    s AS (SELECT o_orderstatus AS v, count(*) AS n FROM o GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)
    SELECT count(*) AS actual_rows, 5 AS actual_columns, count(*) + 1 AS expected_rows, true AS row_mismatch,
           6 AS expected_columns, true AS column_mismatch, '["o_orderdate"]' AS missing_columns,
           '[]' AS unexpected_columns, count(DISTINCT o_custkey) AS customers, count(*) - count(o_orderstatus) AS missing,
           CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM o)) AS BIGINT) AS duplicate_rows,
           min(o_totalprice) AS least, max(o_totalprice) AS most, round(avg(o_totalprice), 4) AS mean,
           round(stddev_pop(o_totalprice), 4) AS stddev, any_value(s.v) AS top, any_value(s.n) AS top_n
    FROM o, s""",
)
def qc_of_folder(spark, sf_dir):
    """A Parquet folder against a layout that declares a row and a column too many."""
    folder, place = scratch_dir(spark, "parquet"), scratch_dir(spark, "report")
    orders = table(spark, sf_dir, "orders")
    orders.drop("o_orderdate").write.parquet(folder)
    text = F.concat(F.lit("Data File: orders.dat  Rows: "), (F.count("*") + 1).cast("string"), F.lit("  Size: 1\n" + _LAYOUT_TEXT))
    layout = orders.agg(text.alias("text")).select(F.lit("/in/orders.fts").alias("layout_file"), "text")
    found = qc_folder(spark, folder, layout, "/in/orders.dat", out=place)

    def item(path, kind):
        return F.get_json_object("report", path).cast(kind)

    price = "$.numeric_summary.o_totalprice"
    top = F.from_json(F.get_json_object("report", "$.top_categories.o_orderstatus"), "map<string,bigint>")
    return found.select(
        *[item(f"$.shape_check.{c}", k).alias(c) for c, k in (
            ("actual_rows", "bigint"), ("actual_columns", "int"), ("expected_rows", "bigint"), ("row_mismatch", "boolean"),
            ("expected_columns", "int"), ("column_mismatch", "boolean"))],
        *[item(f"$.{c}", "string").alias(c) for c in ("missing_columns", "unexpected_columns")],
        item("$.column_checks.o_custkey.unique_values", "bigint").alias("customers"),
        item("$.column_checks.o_orderstatus.missing_values", "bigint").alias("missing"),
        item("$.duplicate_rows", "bigint").alias("duplicate_rows"),
        item(f"{price}.min", "double").alias("least"),
        item(f"{price}.max", "double").alias("most"),
        F.round(item(f"{price}.mean", "double"), 4).alias("mean"),
        F.round(item(f"{price}.stddev", "double"), 4).alias("stddev"),
        F.get(F.map_keys(top), F.lit(0)).alias("top"),
        F.get(F.map_values(top), F.lit(0)).alias("top_n"),
    )


@_c.add("i1_incremental", ORDERS_SQL)
def incremental(spark, sf_dir):
    """Two arrivals and three runs: every file is read once."""
    raw, out, memory = (scratch_dir(spark, n) for n in ("arrivals", "typed", "checkpoint"))
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    for arrival in (orders.filter(early), orders.filter(~early)):
        order_lines(arrival).write.mode("append").text(raw)
        stream_intake(stream_rows(spark, raw, ORDERS_LAYOUT), out, memory).awaitTermination()
    stream_intake(stream_rows(spark, raw, ORDERS_LAYOUT), out, memory).awaitTermination()
    return spark.read.parquet(out)


@_c.add(
    "i1_tree",
    """
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, stem, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
           CASE stem WHEN 'states' THEN count(DISTINCT o_orderstatus) ELSE 0 END AS states,
           CAST(CASE stem WHEN 'states' THEN 0 ELSE sum(CAST(o_totalprice AS DECIMAL(18, 2))) END AS DOUBLE) AS total
    FROM orders, (SELECT unnest(['fixed', 'prices', 'states']) AS stem) GROUP BY 1, 2""",
)
def incremental_tree(spark, sf_dir):
    """Fixed-width and delimited files of three layouts arrive mixed, in two arrivals and three runs."""
    root, out, memory = (scratch_dir(spark, n) for n in ("tree", "typed", "checkpoint"))
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    early = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz")
    kinds = (("fixed", "dat", order_line(), F.lit(_LAYOUT_TEXT)), ("prices", "csv", _csv_line(), _csv_text()), ("states", "csv", _csv_line("state"), _csv_text("state")))
    layouts = None
    for stem, _, _, text in kinds:
        path = F.concat(F.lit(f"{root}/folder="), "year", F.lit(f"/{stem}_"), "year", F.lit(".fts"))
        own = orders.select(year.alias("year")).distinct().select(path.alias("layout_file"), text.alias("text"))
        layouts = own if layouts is None else layouts.unionByName(own)
    for arrival in (orders.where(early), orders.where(~early), None):
        for stem, ext, line, _ in kinds if arrival is not None else ():
            _tree(root, arrival, year, F.concat(F.lit(f"{stem}_"), year, F.lit(f".{ext}")), line)
        stream_tree(spark, root, out, memory, layouts).awaitTermination()
    return read_tree(spark, out).groupBy("year", "stem").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("o_orderkey").alias("n_keys"),
        F.count_distinct(F.when(F.col("stem") == "states", F.col("o_orderstatus"))).alias("states"),
        F.coalesce(F.sum(F.when(F.col("stem") != "states", F.col("o_totalprice").cast("decimal(18,2)"))).cast("double"), F.lit(0.0)).alias("total"),
    )


@_c.add(
    "i2_batch_profiles",
    """
    SELECT CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN CAST(0 AS BIGINT) ELSE 1 END AS batch_id,
           'o_custkey' AS "column", count(DISTINCT o_custkey) AS unique_values,
           CAST(max(o_custkey) AS DOUBLE) AS max FROM orders GROUP BY 1
    UNION ALL
    SELECT CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 0 ELSE 1 END, 'o_orderpriority',
           count(DISTINCT o_orderpriority), NULL FROM orders GROUP BY 1""",
)
def batch_profiles(spark, sf_dir):
    raw, out, memory = (scratch_dir(spark, n) for n in ("arrivals", "profiles", "checkpoint"))
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    for arrival in (orders.filter(early), orders.filter(~early)):
        order_lines(arrival).write.mode("append").text(raw)
        stream_profiles(stream_rows(spark, raw, ORDERS_LAYOUT), out, memory).awaitTermination()
    wanted = F.col("column").isin("o_custkey", "o_orderpriority")
    return read_profiles(spark, out).filter(wanted).select(
        "batch_id", "column", "unique_values", "max"
    )


@_c.add(
    "i2_merged_profile",
    """
    SELECT 'o_custkey' AS "column", count(*) - count(o_custkey) AS missing_values, count(DISTINCT o_custkey) AS unique_values,
           CAST(min(o_custkey) AS DOUBLE) AS min, CAST(max(o_custkey) AS DOUBLE) AS max, round(avg(o_custkey), 4) AS mean,
           round(stddev_pop(o_custkey), 4) AS stddev FROM orders
    UNION ALL
    SELECT 'o_totalprice', count(*) - count(o_totalprice), count(DISTINCT o_totalprice), min(o_totalprice), max(o_totalprice),
           round(avg(o_totalprice), 4), round(stddev_pop(o_totalprice), 4) FROM orders
    UNION ALL
    SELECT 'o_orderpriority', count(*) - count(o_orderpriority), count(DISTINCT o_orderpriority), NULL, NULL, NULL, NULL FROM orders""",
)
def merged_profiles(spark, sf_dir):
    """The profile of all orders from the states of three batches of raw lines, whose rows are read once."""
    raw, out, memory = (scratch_dir(spark, n) for n in ("arrivals", "states", "checkpoint"))
    orders = table(spark, sf_dir, "orders")
    for k in range(3):
        order_lines(orders.filter(F.month("o_orderdate") % 3 == k)).write.mode("append").text(raw)
        stream_states(stream_rows(spark, raw, ORDERS_LAYOUT), out, memory).awaitTermination()
    wanted = F.col("column").isin("o_custkey", "o_totalprice", "o_orderpriority")
    return merged_profile(spark, out).filter(wanted).select(
        "column", "missing_values", "unique_values", "min", "max", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev")
    )

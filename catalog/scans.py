"""Raw record scans and casts: tables are rendered as raw lines and read back."""

from __future__ import annotations

from catalog.common import Catalog, money, sql_char, table
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawloom import Field, Layout, cast_by_layout, slice_fixed, split_delimited
from rawloom.functions import casting, text

_c = Catalog()
QUERIES, ORACLES = _c.queries, _c.oracles

ORDERS_LAYOUT = Layout(
    (
        Field("o_orderkey", "NUM", 14, 1),
        Field("o_custkey", "NUM", 12, 15),
        Field("o_orderstatus", "CHAR", 2, 27),
        Field("o_totalprice", "NUM", 16, 29),
        Field("o_orderdate", "DATE", 8, 45),
        Field("o_orderpriority", "CHAR", 16, 53),
    )
)
ORDERS_SQL = """
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
       o_orderstatus, round(o_totalprice, 2) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders"""


def order_line() -> Column:
    """An order as a fixed-width line of 68 bytes."""
    return F.concat(
        F.lpad(F.col("o_orderkey").cast("string"), 14, " "),
        F.lpad(F.col("o_custkey").cast("string"), 12, " "),
        F.rpad("o_orderstatus", 2, " "),
        F.lpad(money("o_totalprice"), 16, " "),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.rpad("o_orderpriority", 16, " "),
    )


def order_lines(orders: DataFrame) -> DataFrame:
    return orders.select(order_line().alias("value"))


@_c.add("a1_fixed_width_strict", ORDERS_SQL)
def fixed_width_strict(spark, sf_dir):
    lines = order_lines(table(spark, sf_dir, "orders"))
    return cast_by_layout(slice_fixed(lines, ORDERS_LAYOUT), ORDERS_LAYOUT, stripped=True)


_FLAT_SQL = r"regexp_replace(text, '[\r\n]+', ' ', 'g')"


@_c.add(
    "a2_fixed_width_lenient",
    f"""
    SELECT CAST(doc_id AS DOUBLE) AS doc_id, {sql_char("lang")} AS lang,
           {sql_char("substring(flat, 1, 30)")} AS head, CAST(NULL AS VARCHAR) AS nothing,
           {sql_char("substring(flat, 31)")} AS tail
    FROM (SELECT doc_id, lang, {_FLAT_SQL} AS flat FROM documents)""",
)
def fixed_width_lenient(spark, sf_dir):
    layout = Layout(
        (
            Field("doc_id", "NUM", 14),
            Field("lang", "CHAR", 8),
            Field("head", "CHAR", 30),
            Field("nothing", "CHAR", 0),
            Field("tail", "CHAR", 0),
        )
    )
    lines = table(spark, sf_dir, "documents").select(
        F.concat(
            F.lpad(F.col("doc_id").cast("string"), 14, " "),
            F.rpad("lang", 8, " "),
            F.regexp_replace("text", "[\r\n]+", " "),
        ).alias("value")
    )
    return cast_by_layout(slice_fixed(lines, layout), layout, stripped=True)


PART_LAYOUT = Layout(
    (
        Field("p_partkey", "NUM"),
        Field("p_name", "CHAR"),
        Field("p_type", "CHAR"),
        Field("p_size", "NUM"),
        Field("p_retailprice", "NUM"),
    ),
    "delimited",
)
PART_SQL = """
SELECT CAST(p_partkey AS DOUBLE) AS p_partkey,
       p_name || ' "' || p_brand || '", new' AS p_name, p_type,
       CAST(p_size AS DOUBLE) AS p_size, round(p_retailprice, 2) AS p_retailprice
FROM part"""


def part_lines(part: DataFrame) -> DataFrame:
    """Parts as CSV lines with quotes and commas inside a quoted field."""
    return part.select(
        F.concat(
            F.col("p_partkey").cast("string"),
            F.lit(',"'),
            F.col("p_name"),
            F.lit(' ""'),
            F.col("p_brand"),
            F.lit('"", new",'),
            F.col("p_type"),
            F.lit(", "),
            F.col("p_size").cast("string"),
            F.lit(" ,"),
            money("p_retailprice"),
        ).alias("value")
    )


@_c.add("a3_delimited", PART_SQL)
def delimited(spark, sf_dir):
    rows = split_delimited(part_lines(table(spark, sf_dir, "part")), PART_LAYOUT)
    return cast_by_layout(rows, PART_LAYOUT)


@_c.add(
    "a3_delimited_malformed",
    """
    SELECT p_size % 3 AS variant, count(*) AS n,
           CASE p_size % 3 WHEN 0 THEN 'well-formed' ELSE 'malformed' END AS verdict
    FROM part GROUP BY p_size % 3""",
)
def delimited_malformed(spark, sf_dir):
    """Lines with a field too few or too many are marked, not lost."""
    layout = Layout((Field("variant", "NUM"), Field("p_name"), Field("p_type")), "delimited")
    variant = F.col("p_size") % 3
    lines = table(spark, sf_dir, "part").select(
        F.concat_ws(
            ",",
            variant.cast("string"),
            "p_name",
            F.when(variant != 1, F.col("p_type")),
            F.when(variant == 2, F.col("p_brand")),
        ).alias("value")
    )
    rows = split_delimited(lines, layout, mode="permissive")
    bad = F.col(casting.REASON).isNotNull()
    return (
        rows.select(F.col("variant").cast("int").alias("variant"), bad.alias("bad"))
        .groupBy("variant", F.when(F.col("bad"), "malformed").otherwise("well-formed").alias("verdict"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@_c.add(
    "a1_short_records",
    """
    SELECT o_orderstatus, count(*) AS n, CAST(sum(CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END)
           AS BIGINT) AS short
    FROM orders GROUP BY o_orderstatus""",
)
def short_records(spark, sf_dir):
    """Records cut short in permissive mode: marked, with the leading fields kept."""
    orders = table(spark, sf_dir, "orders")
    lines = orders.select(
        F.when(F.col("o_custkey") % 5 == 0, F.rpad("o_orderstatus", 3, " "))
        .otherwise(F.rpad("o_orderstatus", 9, "x"))
        .alias("value")
    )
    layout = Layout((Field("o_orderstatus", "CHAR", 1), Field("rest", "CHAR", 8)))
    rows = cast_by_layout(slice_fixed(lines, layout, mode="permissive"), layout, "permissive")
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(casting.REASON).isNotNull()).alias("short")
    )


@_c.add(
    "b2_char",
    f"""
    SELECT doc_id, {sql_char("chr(9) || ' ' || text || chr(160) || chr(8195) || ' '")} AS value,
           {sql_char("CASE WHEN n_chars % 2 = 0 THEN chr(9) || chr(12288) ELSE lang END")} AS lang
    FROM documents""",
)
def char(spark, sf_dir):
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit("\u00a0\u2003 "))
    lang = F.when(F.col("n_chars") % 2 == 0, "\t\u3000").otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", casting.char(padded).alias("value"), casting.char(lang).alias("lang")
    )


_NUM_FORMS = ("'-' || v", "'+' || v", "v || '.50'", "v || '.'", "'.' || v", "v || 'e2'",
              "' 00' || v || ' '", "v || ',000'", "'NaN'", "' '", "v || 'd'")


@_c.add(
    "b3_num",
    f"""
    SELECT event_id, CASE WHEN regexp_matches(trim(raw), '^-?[0-9]+(\\.[0-9]+)?$')
                          THEN CAST(trim(raw) AS DOUBLE) END AS value
    FROM (SELECT event_id, CASE event_id % {len(_NUM_FORMS)}
          {" ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(_NUM_FORMS))} END AS raw
          FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS v FROM events))""",
)
def num(spark, sf_dir):
    chosen = "CASE event_id % {} {} END".format(
        len(_NUM_FORMS), " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_NUM_FORMS))
    )
    events = table(spark, sf_dir, "events").withColumn("v", F.col("user_id").cast("string"))
    return events.select("event_id", casting.num(F.expr(chosen)).alias("value"))


@_c.add(
    "b4_date",
    """
    SELECT o_orderkey, CASE WHEN o_custkey % 6 IN (0, 1) THEN CAST(o_orderdate AS DATE) END AS day,
           o_custkey % 6 IN (2, 3, 4) AS bad
    FROM orders""",
)
def date(spark, sf_dir):
    form = F.col("o_custkey") % 6
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    raw = (
        F.when(form == 0, compact)
        .when(form == 1, F.concat(F.lit("\t"), compact, F.lit("  ")))
        .when(form == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(form == 3, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("0230")))
        .when(form == 4, F.date_format("o_orderdate", "yyyyMM"))
        .otherwise("   ")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        casting.date(raw, "permissive").alias("day"),
        casting.bad_date(raw).alias("bad"),
    )


@_c.add(
    "b5_type_dispatch",
    """
    SELECT CAST(c_custkey AS DOUBLE) AS key_num, CAST(c_custkey AS VARCHAR) AS key_lower,
           CAST(c_custkey AS VARCHAR) AS key_none, DATE '2016-02-29' AS day,
           '20160229' AS day_time, c_name AS name, c_nationkey AS extra
    FROM customer""",
)
def type_dispatch(spark, sf_dir):
    layout = Layout(
        (
            Field("key_num", "NUM"),
            Field("key_lower", "num"),
            Field("key_none", ""),
            Field("day", "DATE"),
            Field("day_time", "DATETIME"),
            Field("name", "CHAR"),
        ),
        "delimited",
    )
    key = F.col("c_custkey").cast("string")
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("extra"),
        F.concat(F.lit(" "), F.col("c_name")).alias("name"),
        key.alias("key_num"),
        key.alias("key_lower"),
        key.alias("key_none"),
        F.lit("20160229").alias("day"),
        F.lit("20160229 ").alias("day_time"),
    )
    return cast_by_layout(raw, layout)


@_c.add(
    "h11_decode",
    "SELECT doc_id, text || lang AS utf8, source || chr(233) AS latin1 FROM documents",
)
def decode(spark, sf_dir):
    """Stray bytes inside whole texts are dropped, all else survives."""
    broken = F.concat(
        F.lit(b"\xff\xe2\x82"), F.encode("text", "UTF-8"), F.lit(b"\xc3"), F.encode("lang", "UTF-8")
    )
    latin = F.encode(F.concat("source", F.lit("\u00e9")), "ISO-8859-1")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.decode_bytes(broken).alias("utf8"),
        text.decode_bytes(latin, "ISO-8859-1").alias("latin1"),
    )


@_c.add(
    "h8_normalise_heading",
    """
    SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')) AS heading
    FROM documents""",
)
def normalise_heading(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.normalise_heading(F.col("text")).alias("heading")
    )


@_c.add(
    "h12_whole_number",
    "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders",
)
def whole_number(spark, sf_dir):
    printed = F.format_number(F.round(F.col("o_totalprice") * 100), 0)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.whole_number(printed).alias("cents")
    )


@_c.add(
    "h13_truncated_int",
    """
    SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN l_linenumber % 3 = 0 THEN NULL
                ELSE CAST(trunc(round(l_extendedprice, 2)) AS INTEGER) END AS whole
    FROM lineitem""",
)
def truncated_int(spark, sf_dir):
    form = F.when(F.col("l_linenumber") % 3 == 0, "inf").otherwise(money("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", casting.truncated_int(form).alias("whole")
    )


@_c.add(
    "h15_h16_day_and_nan",
    """
    SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts - INTERVAL 80 YEAR AS DATE) AS early_day,
           CASE WHEN user_id % 4 = 0 THEN NULL ELSE value END AS value
    FROM events""",
)
def day_and_nan(spark, sf_dir):
    value = F.when(F.col("user_id") % 4 == 0, float("nan")).otherwise(F.col("value"))
    early = F.col("ts") - F.expr("INTERVAL 80 YEAR")
    return table(spark, sf_dir, "events").select(
        "event_id",
        casting.to_day(F.col("ts")).alias("day"),
        casting.to_day(early).alias("early_day"),
        casting.nan_to_null(value).alias("value"),
    )


@_c.add(
    "h17_h19_numbers",
    """
    SELECT o_orderkey, CAST(greatest(1, (o_custkey + 6) // 7) AS INTEGER) AS parts,
           CASE WHEN o_orderkey < 10 THEN '0' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END
               AS padded
    FROM orders""",
)
def numbers(spark, sf_dir):
    from rawloom.sources.manifest import part_count

    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        part_count(F.col("o_custkey"), 7).alias("parts"),
        text.zero_pad(F.col("o_orderkey")).alias("padded"),
    )


def outcomes(spark, read) -> list[tuple[str, str]]:
    """How three looks at a table end: its count, one column, all columns."""
    out = []
    for look in ("count", "one column", "all columns"):
        frame = read()
        frame = frame.select(frame.columns[0]) if look == "one column" else frame
        try:
            frame.count() if look == "count" else frame.write.format("noop").mode("overwrite").save()
            out.append((look, "read"))
        except Exception as e:  # noqa: BLE001
            out.append((look, "failed" if "USER_RAISED_EXCEPTION" in str(e) else "broke"))
    return out


def _with_outcomes(counted: DataFrame, found: list[tuple[str, str]]) -> DataFrame:
    """A row for each look, beside what one pass has counted."""
    looks = [F.struct(F.lit(look).alias("look"), F.lit(end).alias("outcome")) for look, end in found]
    return counted.select(F.inline(F.array(*looks)), *counted.columns)


_LOOKS = "unnest(['count', 'one column', 'all columns']) AS look, 'failed' AS outcome"


@_c.add(
    "a3_failfast",
    f"SELECT {_LOOKS}, n_bad, n_lines FROM (SELECT count(*) FILTER (WHERE p_size % 10 = 3) AS n_bad, "
    "count(*) AS n_lines FROM part)",
)
def delimited_failfast(spark, sf_dir):
    """Lines with a field too many fail every look, and ``permissive`` marks exactly these."""
    part = table(spark, sf_dir, "part")
    extra = F.when(F.col("p_size") % 10 == 3, F.lit(",more")).otherwise("")
    lines = part.select(
        F.concat(F.col("p_partkey").cast("string"), F.lit(","), F.col("p_brand"), extra).alias("value")
    )
    layout = Layout((Field("key", "NUM"), Field("brand", "CHAR")), "delimited")
    marked = split_delimited(lines, layout, mode="permissive")
    counted = marked.agg(F.count(casting.REASON).alias("n_bad"), F.count(F.lit(1)).alias("n_lines"))
    return _with_outcomes(counted, outcomes(spark, lambda: split_delimited(lines, layout)))


@_c.add(
    "b4_failfast",
    f"SELECT {_LOOKS}, n_bad, n_lines FROM (SELECT count(*) FILTER (WHERE o_custkey % 7 = 0) AS n_bad, "
    "count(*) AS n_lines FROM orders)",
)
def date_failfast(spark, sf_dir):
    """Impossible dates fail every look, and ``permissive`` marks exactly these."""
    bad = F.col("o_custkey") % 7 == 0
    day = F.when(bad, F.lit("20169999")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    lines = table(spark, sf_dir, "orders").select(
        F.concat(F.lpad(F.col("o_orderkey").cast("string"), 14, " "), day).alias("value")
    )
    layout = Layout((Field("key", "NUM", 14), Field("day", "DATE", 8)))

    def read(mode="failfast"):
        return cast_by_layout(slice_fixed(lines, layout, mode=mode), layout, mode, stripped=True)

    counted = read("permissive").agg(
        F.count(casting.REASON).alias("n_bad"), F.count(F.lit(1)).alias("n_lines")
    )
    return _with_outcomes(counted, outcomes(spark, read))


@_c.add(
    "a2_crlf_short_lines",
    """
    SELECT CAST(o_orderkey AS DOUBLE) AS key,
           CASE WHEN n >= 2 THEN o_orderstatus END AS status,
           CASE WHEN n >= 3 THEN round(o_totalprice, 2) END AS price,
           CASE WHEN n >= 4 THEN CAST(o_orderdate AS DATE) END AS day,
           CASE WHEN n >= 5 THEN o_orderpriority END AS priority
    FROM (SELECT *, 1 + o_custkey % 5 AS n FROM orders)""",
)
def crlf_short_lines(spark, sf_dir):
    """Lines that end early, in a carriage return: fields of every type are NULL from there on."""
    layout = Layout(
        (
            Field("key", "NUM", 14),
            Field("status", "CHAR", 2),
            Field("price", "NUM", 16),
            Field("day", "DATE", 8),
            Field("priority", "CHAR", 0),
        )
    )
    n = F.col("o_custkey") % 5
    fields = [
        F.lpad(F.col("o_orderkey").cast("string"), 14, " "),
        F.when(n >= 1, F.rpad("o_orderstatus", 2, " ")),
        F.when(n >= 2, F.lpad(money("o_totalprice"), 16, " ")),
        F.when(n >= 3, F.date_format("o_orderdate", "yyyyMMdd")),
        F.when(n >= 4, F.col("o_orderpriority")),
    ]
    line = F.concat(F.concat_ws("", *fields), F.lit("\r"))
    lines = table(spark, sf_dir, "orders").select(line.alias("value"))
    return cast_by_layout(slice_fixed(lines, layout), layout, stripped=True)

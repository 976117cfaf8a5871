"""Profiles, reconciliation and type detection."""

from __future__ import annotations

from catalog.common import Catalog, table
from pyspark.sql import functions as F

from rawloom.operators import infer, long_values, profile, reconcile
from rawloom.sources.dataset import union_parts

_c = Catalog()
QUERIES, ORACLES = _c.queries, _c.oracles

LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
LINEITEM_NUMERIC = LINEITEM[:8]


def _each(names, select, source, by=""):
    """One SELECT per column, glued together."""
    return " UNION ALL ".join(
        f"SELECT {by}'{n}' AS \"column\", {select.format(c=n)} FROM {source}" for n in names
    )


@_c.add(
    "d1_row_count",
    """SELECT l_returnflag, l_linestatus, count(*) AS actual_rows FROM lineitem GROUP BY ALL""",
)
def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


# lineitem and events have no NULLs; some are made.
_SQL_GAPS = """(SELECT l_orderkey, nullif(l_linenumber, 3) AS l_linenumber,
                       nullif(l_discount, 0.05) AS l_discount, nullif(l_returnflag, 'R') AS l_returnflag,
                       CASE WHEN l_quantity > 30 THEN l_shipdate END AS l_shipdate,
                       CAST(NULL AS VARCHAR) AS nothing FROM lineitem)"""
_GAPS = ["l_orderkey", "l_linenumber", "l_discount", "l_returnflag", "l_shipdate", "nothing"]


def gappy_lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif("l_linenumber", F.lit(3)).alias("l_linenumber"),
        F.nullif("l_discount", F.lit(0.05)).alias("l_discount"),
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        F.when(F.col("l_quantity") > 30, F.col("l_shipdate")).alias("l_shipdate"),
        F.lit(None).cast("string").alias("nothing"),
    )


@_c.add(
    "d3_nulls", _each(_GAPS, "count(*) FILTER (WHERE {c} IS NULL) AS missing_values", _SQL_GAPS)
)
def nulls(spark, sf_dir):
    return profile.missing_values(gappy_lineitem(spark, sf_dir))


@_c.add("d4_distinct", _each(LINEITEM, "count(DISTINCT {c}) AS unique_values", "lineitem"))
def distinct(spark, sf_dir):
    return profile.unique_values(table(spark, sf_dir, "lineitem"))


@_c.add(
    "d4_distinct_by",
    " UNION ALL ".join(
        f"""SELECT event_type, '{c}' AS "column", count(DISTINCT {c}) AS unique_values
            FROM events GROUP BY event_type"""
        for c in ("event_id", "ts", "user_id", "value", "props")
    ),
)
def distinct_by(spark, sf_dir):
    return profile.unique_values(table(spark, sf_dir, "events"), ["event_type"])


_DUPLICATES_SQL = """
    SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)"""


@_c.add("d5_duplicates", _DUPLICATES_SQL)
def duplicates(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "documents").select("text"))


@_c.add("d5_duplicates_prefiltered", _DUPLICATES_SQL)
def duplicates_prefiltered(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "documents").select("text"), prefilter=True)


@_c.add(
    "d5_duplicates_all_columns",
    f"""
    SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS n FROM {_SQL_GAPS} GROUP BY ALL,
          l_orderkey, l_linenumber, l_discount, l_returnflag, l_shipdate, nothing
          HAVING count(*) > 1)""".replace("GROUP BY ALL,", "GROUP BY"),
)
def duplicates_all_columns(spark, sf_dir):
    """NULLs count as equal."""
    return profile.duplicate_rows(gappy_lineitem(spark, sf_dir))


_NUMBERS = (
    "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 4) AS mean, "
    "round(CASE WHEN count({c}) > 1 THEN stddev_pop({c}) END, 4) AS stddev"
)


@_c.add("d6_d8_numeric_profile", _each(LINEITEM_NUMERIC, _NUMBERS, "lineitem"))
def numeric_profile(spark, sf_dir):
    found = profile.numeric_summary(table(spark, sf_dir, "lineitem"))
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@_c.add(
    "d8_deviation_of_one",
    """
    SELECT l_suppkey % 100 AS l_linenumber, 'price' AS "column", min(p) AS min, max(p) AS max,
           round(avg(p), 4) AS mean, round(CASE WHEN count(p) > 1 THEN stddev_pop(p) END, 4) AS stddev
    FROM (SELECT l_suppkey, CASE WHEN l_quantity = 1 AND l_discount = 0.05 THEN l_extendedprice END
          AS p FROM lineitem) GROUP BY 1""",
)
def deviation_of_one(spark, sf_dir):
    """Datasets with no, one and several values."""
    price = F.when((F.col("l_quantity") == 1) & (F.col("l_discount") == 0.05), F.col("l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 100).alias("l_linenumber"), price.alias("price")
    )
    found = profile.numeric_summary(rows, ["l_linenumber"])
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


_EVENT_COUNTS = """
    SELECT 'event_type' AS "column", nullif(event_type, 'view') AS value, count(*) AS n
    FROM events GROUP BY 2 UNION ALL SELECT 'props', props, count(*) FROM events GROUP BY 2"""


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn(
        "event_type", F.nullif("event_type", F.lit("view"))
    )


@_c.add("d9_value_counts", _EVENT_COUNTS)
def value_counts(spark, sf_dir):
    return profile.value_counts(_events(spark, sf_dir))


@_c.add(
    "e1_top5",
    f"""
    SELECT "column", value, n, CAST(rank AS INTEGER) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS LAST) AS rank
          FROM ({_EVENT_COUNTS})) WHERE rank <= 5 AND value IS NOT NULL""",
)
def top5(spark, sf_dir):
    """NULL takes part in the ranking, then disappears."""
    return profile.top_values(_events(spark, sf_dir))


@_c.add(
    "e1_top5_by",
    """
    SELECT lang, "column", value, n, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, "column" ORDER BY n DESC, value) AS rank
        FROM (SELECT lang, 'source' AS "column", source AS value, count(*) AS n FROM documents
              GROUP BY lang, source UNION ALL
              SELECT lang, 'text', text, count(*) FROM documents GROUP BY lang, text))
    WHERE rank <= 5""",
)
def top5_by(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return profile.top_values(documents, by=["lang"])


@_c.add(
    "e1_top5_long_text",
    """
    SELECT lang, "column", value, n, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, "column" ORDER BY n DESC, value) AS rank
        FROM (SELECT lang, 'source' AS "column", source AS value, count(*) AS n FROM documents
              GROUP BY lang, source UNION ALL
              SELECT lang, 'text', text, count(*) FROM documents GROUP BY lang, text))
    WHERE rank <= 5 AND value IS NOT NULL""",
)
def top5_long_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return long_values.top_long_values(documents, by=["lang"])


@_c.add(
    "d4_distinct_long_text",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values FROM pages" for c in ("url", "html")),
)
def distinct_long_text(spark, sf_dir):
    return long_values.unique_long_values(table(spark, sf_dir, "pages"))


def _profile_sql(names, source):
    out = []
    for i, (n, kind) in enumerate(names):
        numbers = _NUMBERS if kind != "string" and not kind.startswith("timestamp") else (
            "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
            "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev"
        )
        out.append(
            f"SELECT '{n}' AS \"column\", {i + 1} AS ord, '{kind}' AS data_type, "
            f"count(*) FILTER (WHERE {n} IS NULL) AS missing_values, "
            f"count(DISTINCT {n}) AS unique_values, {numbers.format(c=n)} FROM {source}"
        )
    return " UNION ALL ".join(out)


_EVENT_COLUMNS = [
    ("event_id", "bigint"),
    ("ts", "timestamp_ntz"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("value", "double"),
    ("props", "string"),
]


def _rounded_profile(df):
    found = profile.column_profile(df).drop("error")
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@_c.add("k4_profile", _profile_sql(_EVENT_COLUMNS, "events"))
def full_profile(spark, sf_dir):
    return _rounded_profile(table(spark, sf_dir, "events"))


@_c.add(
    "d15_column_profile",
    _profile_sql(
        [(n, "bigint") for n in LINEITEM[:3]]
        + [("l_linenumber", "int")]
        + [(n, "double") for n in LINEITEM[4:8]]
        + [("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
        "lineitem",
    ),
)
def column_profile(spark, sf_dir):
    return _rounded_profile(table(spark, sf_dir, "lineitem"))


# Names of users as column names: events of small value declare and all others are found,
# for every fifth user the other way round.
_TOLD = """SELECT DISTINCT event_type AS dataset, 'U' || user_id AS "column" FROM events WHERE (value < 10) <> (user_id % 5 = 0)"""
_HERE = """SELECT DISTINCT event_type AS dataset, 'U' || user_id AS "column" FROM events WHERE ((value < 10) <> (user_id % 5 = 0)) IS NOT TRUE"""


def _told_and_here(spark, sf_dir):
    events = table(spark, sf_dir, "events")

    def names(test):
        return (
            events.filter(test)
            .groupBy(
                F.col("event_type").alias("dataset"),
                F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("column"),
            )
            .agg(F.min("user_id").alias("ord"))
        )

    told = (F.col("value") < 10) != (F.col("user_id") % 5 == 0)
    return names(told), names(~F.coalesce(told, F.lit(False)))


@_c.add(
    "c3_c4_schema_diff",
    f"""
    SELECT dataset, "column", CASE WHEN max(h) = 0 THEN 'missing' WHEN max(t) = 0 THEN 'unexpected'
                              ELSE 'matched' END AS status
    FROM (SELECT *, 1 AS t, 0 AS h FROM ({_TOLD}) UNION ALL SELECT *, 0, 1 FROM ({_HERE}))
    GROUP BY ALL""".replace("GROUP BY ALL", 'GROUP BY dataset, "column"'),
)
def schema_diff(spark, sf_dir):
    told, here = _told_and_here(spark, sf_dir)
    return reconcile.schema_diff(here, told).drop("ord")


@_c.add("c3_missing_columns", f"({_TOLD}) EXCEPT ({_HERE})")
def missing_columns(spark, sf_dir):
    told, here = _told_and_here(spark, sf_dir)
    return reconcile.missing_columns(here, told).drop("ord")


@_c.add("c4_unexpected_columns", f"({_HERE}) EXCEPT ({_TOLD})")
def unexpected_columns(spark, sf_dir):
    told, here = _told_and_here(spark, sf_dir)
    return reconcile.unexpected_columns(here, told).drop("ord")


@_c.add("g2_name_difference", f"({_TOLD}) EXCEPT ({_HERE})")
def name_difference(spark, sf_dir):
    told, here = _told_and_here(spark, sf_dir)
    return reconcile.name_difference(told, here)


@_c.add(
    "c5_shape",
    """
    SELECT a.dataset, actual_rows, 11 AS actual_columns, expected_rows,
           CASE WHEN expected_rows IS NOT NULL THEN actual_rows <> expected_rows END AS row_mismatch,
           expected_columns, CASE WHEN expected_columns IS NOT NULL THEN 11 <> expected_columns END
               AS column_mismatch
    FROM (SELECT l_orderkey AS dataset, count(*) AS actual_rows FROM lineitem GROUP BY 1) a
    LEFT JOIN (SELECT 2 * o_orderkey AS dataset,
                      CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 8 END AS expected_rows,
                      CAST(9 + o_custkey % 3 AS INTEGER) AS expected_columns
               FROM orders) e USING (dataset)""",
)
def shape(spark, sf_dir):
    """Rows per order against a declaration that is absent or partial for some."""
    lineitem = table(spark, sf_dir, "lineitem")
    actual = (
        lineitem.groupBy(F.col("l_orderkey").alias("dataset"))
        .agg(F.count(F.lit(1)).alias("actual_rows"))
        .withColumn("actual_columns", F.lit(len(lineitem.columns)))
    )
    expected = table(spark, sf_dir, "orders").select(
        (2 * F.col("o_orderkey")).alias("dataset"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 8).alias("expected_rows"),
        (F.col("o_custkey") % 3 + 9).cast("int").alias("expected_columns"),
    )
    return reconcile.shape_check(actual, expected)


def _as_text(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


_KINDS_SQL = """
    SELECT "column", CASE WHEN count(v) = 0 THEN 'string'
        WHEN bool_and(regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9:.]+)?$')) THEN 'date'
        WHEN bool_and(regexp_matches(v, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$'))
            THEN 'numeric' ELSE 'string' END AS kind
    FROM (SELECT 'o_orderkey' AS "column", CAST(o_orderkey AS VARCHAR) AS v FROM orders UNION ALL
          SELECT 'o_totalprice', CASE WHEN o_custkey % 4 > 0 THEN CAST(o_totalprice AS VARCHAR) END
              FROM orders UNION ALL
          SELECT 'o_orderdate', CAST(o_orderdate AS VARCHAR) FROM orders UNION ALL
          SELECT 'o_orderpriority', o_orderpriority FROM orders UNION ALL
          SELECT 'mixed', CASE WHEN o_orderkey % 100 = 7 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END
              FROM orders UNION ALL
          SELECT 'nothing', CAST(NULL AS VARCHAR) FROM orders)
    GROUP BY "column" """


def texted_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return _as_text(
        orders.select(
            "o_orderkey",
            F.when(F.col("o_custkey") % 4 > 0, F.col("o_totalprice"))
            .otherwise(float("nan"))
            .alias("o_totalprice"),
            "o_orderdate",
            "o_orderpriority",
            F.when(key % 100 == 7, "x").otherwise(F.col("o_custkey").cast("string")).alias("mixed"),
            F.lit(" ").alias("nothing"),
        )
    )


@_c.add("d12_detect_kind", _KINDS_SQL)
def detect_kind(spark, sf_dir):
    return infer.detect_kinds(texted_orders(spark, sf_dir))


@_c.add(
    "g4_sampled_kinds",
    """
    WITH v AS (
        SELECT c_custkey, 'c_name' AS "column", c_name AS value FROM customer UNION ALL
        SELECT c_custkey, 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer UNION ALL
        SELECT c_custkey, 'late_text', CASE WHEN c_custkey < 12 THEN CAST(c_custkey AS VARCHAR)
                                            ELSE c_name END FROM customer UNION ALL
        SELECT c_custkey, 'row', lpad(CAST(c_custkey AS VARCHAR), 18, '0') FROM customer),
    n AS (SELECT *, TRY_CAST(value AS DOUBLE) IS NOT NULL AND value NOT SIMILAR TO '0[0-9].*' AS number,
                 row_number() OVER (PARTITION BY "column" ORDER BY c_custkey) AS nth FROM v),
    k AS (SELECT "column", CASE WHEN bool_and(number) THEN 'numeric' ELSE 'string' END AS kind
          FROM n WHERE nth <= 10 GROUP BY 1)
    SELECT n."column", kind, count(*) FILTER (WHERE kind = 'numeric' AND NOT number) AS misfits
    FROM n JOIN k ON n."column" = k."column" GROUP BY 1, 2""",
)
def sampled_kinds(spark, sf_dir):
    """Kinds by the first ten values, and how many values of the whole table belie them."""
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    texts = _as_text(
        customer.select(
            "c_name",
            "c_acctbal",
            F.when(key < 12, key.cast("string")).otherwise(F.col("c_name")).alias("late_text"),
            F.lpad(key.cast("string"), 18, "0").alias("row"),
        )
    )
    return infer.sampled_kinds(texts, ["row"], 10)


@_c.add(
    "k3_infer_cast",
    """
    SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey,
           CASE WHEN o_custkey % 4 > 0 THEN o_totalprice END AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
           CASE WHEN o_orderkey % 100 = 7 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS mixed,
           CAST(NULL AS VARCHAR) AS nothing
    FROM orders""",
)
def infer_cast(spark, sf_dir):
    return infer.infer_and_cast(texted_orders(spark, sf_dir))


@_c.add(
    "k3_codes",
    """
    SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS zeros,
           CAST(10000000000000000 + o_orderkey AS VARCHAR) AS long_number,
           CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey AS DOUBLE) END AS gaps,
           CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) AS moment,
           CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS amount,
           CAST(o_custkey AS DOUBLE) AS whole, CAST(o_orderkey % 2 = 0 AS VARCHAR) AS flag
    FROM orders""",
)
def infer_codes(spark, sf_dir):
    """Text codes stay text; typed dates, timestamps, integers and NaN follow their types."""
    key = F.col("o_orderkey")
    return infer.infer_and_cast(
        table(spark, sf_dir, "orders").select(
            F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("zeros"),
            (key + 10**16).cast("string").alias("long_number"),
            F.when(key % 3 > 0, key.cast("string")).otherwise(F.lit(" ")).alias("gaps"),
            F.col("o_orderdate").cast("date").alias("day"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("moment"),
            F.when(key % 5 > 0, F.col("o_totalprice")).otherwise(float("nan")).alias("amount"),
            F.col("o_custkey").alias("whole"),
            (key % 2 == 0).alias("flag"),
        )
    )


@_c.add(
    "d2_column_list",
    """
    SELECT column_name AS "column",
           CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                          ELSE lower(data_type) END AS data_type,
           CAST(ordinal_position AS INTEGER) AS ord
    FROM information_schema.columns WHERE table_name = 'orders'""",
)
def column_list(spark, sf_dir):
    return profile.column_list(table(spark, sf_dir, "orders"))


@_c.add(
    "d5_duplicates_maps",
    """
    SELECT CAST(count(*) - count(DISTINCT (user_id % 50, event_type, user_id % 3)) AS BIGINT) AS duplicate_rows
    FROM events""",
)
def duplicates_maps(spark, sf_dir):
    """Rows with maps: equal if the entries are, whatever their order."""
    events = table(spark, sf_dir, "events")
    user, kind = F.col("user_id"), F.col("event_type")
    pairs = F.lit("user"), (user % 50).cast("string"), F.lit("kind"), kind
    turned = F.create_map(*pairs[2:], *pairs[:2])
    entries = F.when(F.col("event_id") % 2 == 0, F.create_map(*pairs)).otherwise(turned)
    nested = F.array(F.struct(F.create_map(F.lit("r"), user % 3).alias("inner")))
    return profile.duplicate_rows(events.select(entries.alias("entries"), nested.alias("nested")))


@_c.add(
    "g1_union_parts",
    """
    SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
           c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS price FROM customer UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, NULL FROM supplier UNION ALL
    SELECT p_partkey, p_name, NULL, NULL, NULL, p_retailprice FROM part""",
)
def union_of_parts(spark, sf_dir):
    """Parts with different columns as one table."""
    customer = table(spark, sf_dir, "customer").toDF("key", "name", "nation", "balance", "segment")
    supplier = table(spark, sf_dir, "supplier").toDF("key", "name", "nation", "balance")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )
    return union_parts(customer, supplier, part)

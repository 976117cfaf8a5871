"""File names, manifests and file selection, on paths made from the tables."""

from __future__ import annotations

from catalog.common import Catalog, table
from pyspark.sql import functions as F

from rawloom.functions import names
from rawloom.sources import manifest as m

_c = Catalog()
QUERIES, ORACLES = _c.queries, _c.oracles

# One raw file per order: /in/<year>/<name>; the name's form depends on the keys.
_PATH = """
concat('/in/', CASE WHEN o_custkey % 11 = 0 THEN 'misc' ELSE year END, '/',
    CASE o_orderkey % 6
        WHEN 0 THEN concat('claims', o_custkey, '_', year, '.dat')
        WHEN 1 THEN concat('claims', o_custkey, '_', year, '_00', o_custkey % 9 + 1, '.dat')
        WHEN 2 THEN concat('visits_', state, '_ip', o_custkey, '_', year, '.csv')
        WHEN 3 THEN concat('den', o_custkey, 'x', year, '.sas7bdat')
        WHEN 4 THEN concat('lot03827', o_custkey % 10, '_', o_custkey, '.CSV')
        ELSE concat('notes', o_custkey, '.txt') END)
"""
_SQL_PATHS = f"""
    SELECT o_orderkey, o_custkey, {_PATH} AS path, regexp_extract({_PATH}, '([^/]*)$', 1) AS name
    FROM (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS year,
                 chr(CAST(97 + o_custkey % 26 AS INTEGER)) || 'k' AS state FROM orders)"""


def order_paths(spark, sf_dir):
    state = F.concat(F.expr("chr(97 + o_custkey % 26)"), F.lit("k"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").cast("string").alias("year"),
        state.alias("state"),
    )
    paths = orders.select("o_orderkey", "o_custkey", F.expr(_PATH).alias("path"))
    return paths.withColumn("name", names.raw_name(F.col("path")))


_KIND = """CASE WHEN lower(name) LIKE '%.dat' THEN 'dat' WHEN lower(name) LIKE '%.csv' THEN 'csv'
           WHEN lower(name) LIKE '%.sas7bdat' OR lower(name) LIKE '%.sas' THEN 'sas' END"""
_STEM = r"regexp_replace(name, '\.[^.]*$', '')"


@_c.add("b9_kind_of_file", f"SELECT o_orderkey, {_KIND} AS kind FROM ({_SQL_PATHS})")
def kind_of_file(spark, sf_dir):
    return order_paths(spark, sf_dir).select("o_orderkey", names.kind_of(F.col("name")).alias("kind"))


@_c.add(
    "h20_path_parts",
    r"""
    SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base,
           regexp_replace(url, '/[^/]*$', '') AS dir,
           regexp_replace(regexp_extract(url, '([^/]*)$', 1), '([^.])\.[^.]*$', '\1') AS stem,
           lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '[^.]\.([^.]*)$', 1)) AS ext
    FROM pages""",
)
def path_parts(spark, sf_dir):
    base = names.base_name(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        base.alias("base"),
        names.dir_name(F.col("url")).alias("dir"),
        names.name_stem(base).alias("stem"),
        names.extension(base).alias("ext"),
    )


def _names(spark, sf_dir, kind, loose):
    rows = order_paths(spark, sf_dir).filter(names.kind_of(F.col("name")) == kind)
    return rows.select(
        "o_orderkey",
        names.year_of_name(F.col("name"), F.lit(kind), loose).alias("year"),
        names.stem_of_name(F.col("name"), F.lit(kind), loose).alias("stem"),
    )


@_c.add(
    "h21_dat_names",
    rf"""
    SELECT o_orderkey, coalesce(nullif(regexp_extract(s, '_([0-9]{{4}})(?:_[0-9]{{3}}|$)', 1), ''),
                                name) AS year,
           regexp_replace(regexp_replace(s, '_([0-9]{{4}})_([0-9]{{3}})$', '__\2'),
                          '_([0-9]{{4}})$', '') AS stem
    FROM (SELECT *, {_STEM} AS s FROM ({_SQL_PATHS}) WHERE {_KIND} = 'dat')""",
)
def dat_names(spark, sf_dir):
    return _names(spark, sf_dir, "dat", loose=True)


@_c.add(
    "h22_csv_names",
    rf"""
    SELECT o_orderkey, coalesce(nullif(regexp_extract(name, '_([0-9]{{4}})', 1), ''), 'unknown')
               AS year, regexp_replace(s, '_([0-9]{{4}})(?:_[0-9]{{3}})?$', '') AS stem
    FROM (SELECT *, {_STEM} AS s FROM ({_SQL_PATHS}) WHERE {_KIND} = 'csv')""",
)
def csv_names(spark, sf_dir):
    return _names(spark, sf_dir, "csv", loose=True)


@_c.add(
    "h23_sas_names",
    rf"""
    SELECT o_orderkey, coalesce(y, name) AS year,
           coalesce(nullif(rtrim(rtrim(CASE WHEN y IS NULL THEN s ELSE replace(s, y, '') END, '_'),
                                 '-'), ''), s) AS stem
    FROM (SELECT *, nullif(regexp_extract(s, '([0-9]{{4}})', 1), '') AS y
          FROM (SELECT *, {_STEM} AS s FROM ({_SQL_PATHS}) WHERE {_KIND} = 'sas'))""",
)
def sas_names(spark, sf_dir):
    return _names(spark, sf_dir, "sas", loose=True)


@_c.add(
    "h24_year_from_name",
    rf"""
    SELECT o_orderkey, coalesce(nullif(regexp_extract(name,
               '_?([0-9]{{4}})(?:_[0-9]+)?(?:\.|$)', 1), ''), 'unknown') AS loose_year,
           CASE WHEN regexp_matches({_STEM}, '(?:^|[^0-9])(?:19|20)[0-9]{{2}}(?:_[0-9]{{1,3}})?$')
                THEN regexp_extract({_STEM}, '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:_[0-9]{{1,3}})?$', 1)
           END AS end_year
    FROM ({_SQL_PATHS})""",
)
def year_from_name(spark, sf_dir):
    name = F.col("name")
    return order_paths(spark, sf_dir).select(
        "o_orderkey",
        names.loose_year_anywhere(name).alias("loose_year"),
        names.year_of_name(name, F.lit("dat")).alias("end_year"),
    )


def described(spark, sf_dir):
    files = order_paths(spark, sf_dir).select("path", (F.col("o_custkey") * 68).alias("length"))
    return m.describe_files(files, "/in")


_SQL_DESCRIBED = rf"""
    SELECT path, any_value(name) AS name, CAST(sum(o_custkey * 68) AS BIGINT) AS length,
           any_value({_KIND}) AS kind,
           any_value(nullif(regexp_extract(path, '^/in/([0-9]{{4}})/', 1), '')) AS dir_year
    FROM ({_SQL_PATHS}) GROUP BY path"""


@_c.add(
    "a11_manifest",
    rf"""
    SELECT path, name AS file_name, kind, dir_year, length,
           nullif(regexp_extract({_STEM}, '(?:^|[^0-9])(?:19|20)[0-9]{{2}}_([0-9]{{1,3}})$', 1), '')
               AS part
    FROM ({_SQL_DESCRIBED})""",
)
def manifest(spark, sf_dir):
    return described(spark, sf_dir).select("path", "file_name", "kind", "dir_year", "length", "part")


@_c.add(
    "b7_file_filter",
    f"""
    SELECT path, dir_year AS year FROM ({_SQL_DESCRIBED})
    WHERE kind IN ('dat', 'csv') AND dir_year IN ('1996', '1998', '2050')
      AND (name LIKE 'claims1%' OR name LIKE 'visits%')""",
)
def file_filter(spark, sf_dir):
    files = m.select_kinds(described(spark, sf_dir), ["dat", "csv"])
    files = m.select_years(files.filter(F.col("dir_year").isNotNull()), [1996, "1998", "", "2050"])
    return m.select_stems(files, ["claims1", "visits", " "]).select("path", "year")


# Folders that lack dat files in some years: the kind depends on the year.
_YEAR_KIND = """CASE WHEN CAST(dir_year AS INTEGER) % 3 = 0 AND kind = 'dat' THEN NULL
                     WHEN CAST(dir_year AS INTEGER) % 6 = 0 AND kind = 'csv' THEN NULL
                     ELSE kind END"""
_SQL_YEAR_KINDS = f"""SELECT path, dir_year AS year, {_YEAR_KIND} AS kind FROM ({_SQL_DESCRIBED})
                      WHERE dir_year IS NOT NULL AND {_YEAR_KIND} IS NOT NULL"""


def _year_kinds(spark, sf_dir):
    files = described(spark, sf_dir).withColumn("kind", F.expr(_YEAR_KIND))
    return files.filter(F.col("dir_year").isNotNull() & F.col("kind").isNotNull())


@_c.add(
    "b8_kind_preference",
    f"""
    SELECT path, year, kind FROM (
        SELECT *, CASE kind WHEN 'dat' THEN 0 WHEN 'csv' THEN 1 ELSE 2 END AS r,
               min(CASE kind WHEN 'dat' THEN 0 WHEN 'csv' THEN 1 ELSE 2 END)
                   OVER (PARTITION BY year) AS best
        FROM ({_SQL_YEAR_KINDS})) WHERE r = best""",
)
def kind_preference(spark, sf_dir):
    return m.select_kinds(_year_kinds(spark, sf_dir), "auto").select("path", "year", "kind")


@_c.add(
    "d11_kinds_per_year",
    f"""
    SELECT year, bool_or(kind = 'dat') AS has_dat, bool_or(kind = 'csv') AS has_csv,
           bool_or(kind = 'sas') AS has_sas FROM ({_SQL_YEAR_KINDS}) GROUP BY year""",
)
def kinds_per_year(spark, sf_dir):
    return m.kinds_per_year(_year_kinds(spark, sf_dir))


@_c.add(
    "d14_collisions",
    f"""
    SELECT year, stem, CAST(NULL AS VARCHAR) AS part, count(DISTINCT path) AS n_files,
           min(path) AS first_path, max(path) AS last_path
    FROM (SELECT year, o_orderpriority AS stem,
                 '/in/' || year || '/f' || (o_custkey % 97) || '.dat' AS path
          FROM (SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders))
    GROUP BY year, stem HAVING count(DISTINCT path) > 1""",
)
def collisions(spark, sf_dir):
    year = F.year("o_orderdate").cast("string")
    files = table(spark, sf_dir, "orders").select(
        year.alias("year"),
        F.col("o_orderpriority").alias("stem"),
        F.lit(None).cast("string").alias("part"),
        F.concat(
            F.lit("/in/"), year, F.lit("/f"), (F.col("o_custkey") % 97).cast("string"), F.lit(".dat")
        ).alias("path"),
    )
    return m.collisions(files)


@_c.add(
    "c1_layout_match",
    """
    SELECT path, CASE WHEN c_custkey % 2 = 0 THEN '/in/2007/' || base || '.fts' END AS layout_file
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 < 2
                 THEN 'claims' || c_custkey || '_2007' ELSE 'visits_ip' || c_custkey || '_2007' END
                 AS base,
                 CASE WHEN c_custkey % 4 < 2 THEN '/in/2007/claims' || c_custkey || '_2007_003.dat'
                 ELSE '/in/2007/visits_CO_ip' || c_custkey || '_2007.csv' END AS path
          FROM customer)""",
)
def layout_match(spark, sf_dir):
    key = F.col("c_custkey")
    keyed = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 4 < 2, F.concat(F.lit("claims"), key, F.lit("_2007_003.dat")))
        .otherwise(F.concat(F.lit("visits_CO_ip"), key, F.lit("_2007.csv")))
        .alias("name"),
        F.when(key % 4 < 2, F.concat(F.lit("claims"), key, F.lit("_2007")))
        .otherwise(F.concat(F.lit("visits_ip"), key, F.lit("_2007")))
        .alias("base"),
    )
    files = keyed.select(F.concat(F.lit("/in/2007/"), "name").alias("path"), F.lit(1).alias("length"))
    shapes = keyed.filter(key % 2 == 0).select(
        F.concat(F.lit("/in/2007/"), "base", F.lit(".fts")).alias("layout_file")
    )
    return m.attach_layouts(m.describe_files(files, "/in"), shapes).select("path", "layout_file")


@_c.add(
    "f3_sorted_listing",
    f"SELECT dir_year AS year, path FROM ({_SQL_DESCRIBED}) WHERE dir_year IS NOT NULL",
)
def sorted_listing(spark, sf_dir):
    files = described(spark, sf_dir).filter(F.col("dir_year").isNotNull())
    return files.select("year", "path").orderBy("year", "path")


@_c.add(
    "g3_glob_union",
    f"""
    SELECT path, dir_year AS year FROM ({_SQL_DESCRIBED}) WHERE dir_year IS NOT NULL
       AND (regexp_matches(name, '^claims[^/]*\\.dat$') OR regexp_matches(name, '_001\\.dat$')
            OR regexp_matches(name, '^den[1-4][^/]*\\.sas7bdat$'))""",
)
def glob_union(spark, sf_dir):
    globs = ["{year}/claims*.dat", "{year}/*_001.dat", "{year}/den[1-4]*.sas7bdat"]
    return m.select_globs(described(spark, sf_dir), "/in", globs).select("path", "year")


@_c.add(
    "a12_part_plan",
    """
    SELECT layout_file, n_rows_est, CAST(greatest(1, (n_rows_est + 999) // 1000) AS INTEGER) AS n_parts
    FROM (SELECT 'f' || y || '.fts' AS layout_file,
                 CASE WHEN y % 2 = 0 THEN n ELSE (n * 69 + 5) // 69 END AS n_rows_est
          FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS y, count(*) AS n FROM lineitem GROUP BY 1))
    """,
)
def part_plan(spark, sf_dir):
    """Files of 69-byte lines (line break included); even years declare their rows."""
    years = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.year("l_shipdate").alias("y"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("layout_file", F.concat(F.lit("f"), F.col("y").cast("string"), F.lit(".fts")))
    )
    files = years.select("layout_file", F.lit("dat").alias("kind"), (F.col("n") * 69 + 5).alias("length"))
    shapes = years.select(
        "layout_file", F.when(F.col("y") % 2 == 0, F.col("n")).alias("expected_rows")
    )
    widths = F.explode(F.array(*[F.lit(w) for w in (40, 0, 28, -3)]))
    layout = years.select("layout_file", widths.alias("width"))
    return m.plan_parts(files, layout, shapes, 1000).select("layout_file", "n_rows_est", "n_parts")


@_c.add(
    "d10_record_length",
    """
    SELECT p_brand AS layout_file, CAST(sum(CASE WHEN p_size - 5 > 0 THEN p_size - 5 END) AS BIGINT)
           AS record_length FROM part GROUP BY p_brand""",
)
def record_length(spark, sf_dir):
    layout = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("layout_file"), (F.col("p_size") - 5).alias("width")
    )
    return m.record_lengths(layout)

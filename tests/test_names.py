import pytest
from pyspark.sql import functions as F

from rawloom.functions import names

# file: (kind, year, stem, part, layout), then year and stem by the loose rules
FILES = {
    "claims_2016.dat": ("dat", "2016", "claims", None, "claims_2016", "2016", "claims"),
    "claims_2016_001.dat": ("dat", "2016", "claims__001", "001", "claims_2016", "2016", "claims__001"),
    "claims_res000004182_lot038279_2022.dat": (
        "dat", "2022", "claims_res000004182_lot038279", None,
        "claims_res000004182_lot038279_2022", "2022", "claims_res000004182_lot038279",
    ),
    "claims.dat": ("dat", None, "claims", None, "claims", "claims.dat", "claims"),
    "visits_ak_ip_2007.csv": (
        "csv", "2007", "visits_ak_ip", None, "visits_ip_2007", "2007", "visits_ak_ip",
    ),
    "visits_AK_ip_2007.CSV": (
        "csv", "2007", "visits_AK_ip", None, "visits_ip_2007", "2007", "visits_AK_ip",
    ),
    "claims_2011_002.csv": ("csv", "2011", "claims", "002", "claims_2011", "2011", "claims"),
    "claims.csv": ("csv", None, "claims", None, "claims", "unknown", "claims"),
    "x_12345_2016.csv": ("csv", "2016", "x_12345", None, "x_12345_2016", "1234", "x_12345"),
    "den2002.sas7bdat": ("sas", "2002", "den", None, None, "2002", "den"),
    "mp_2006_1.sas7bdat": ("sas", "2006", "mp__1", "1", None, "2006", "mp__1"),
    "2002.sas7bdat": ("sas", "2002", "2002", None, None, "2002", "2002"),
    "den_res000004182_2006.sas7bdat": (
        "sas", "2006", "den_res000004182", None, None, "0000", "den_res04182_2006",
    ),
    "cl_2016_1000.dat": ("dat", "2016", "cl__1000", "1000", "cl_2016", "2016", "cl_2016"),
    "plan_2016_2017.dat": (
        "dat", "2017", "plan_2016", None, "plan_2016_2017", "2016", "plan_2016",
    ),
    "notes.txt": (None,) * 7,
    "noext": (None,) * 7,
}


def test_names(spark):
    df = spark.createDataFrame([(n,) for n in FILES], "n string")
    n, kind = F.col("n"), names.kind_of(F.col("n"))
    rows = df.select(
        "n",
        kind.alias("kind"),
        F.when(kind.isNotNull(), names.year_of_name(n, kind)).alias("year"),
        names.stem_of_name(n, kind).alias("stem"),
        F.when(kind.isNotNull(), names.part_of_name(n)).alias("part"),
        names.layout_stem(n, kind).alias("layout"),
        names.year_of_name(n, kind, loose=True).alias("loose_year"),
        names.stem_of_name(n, kind, loose=True).alias("loose_stem"),
    ).collect()
    assert {r.n: tuple(r)[1:] for r in rows} == FILES


@pytest.mark.parametrize(
    "path, root, year",
    [
        ("/a/2016/x.dat", None, "2016"),
        ("/data/2020/in/2016/x.dat", None, "2016"),
        ("/data/2020/in/2016/0001/x.dat", "file:///data/2020/in/", "2016"),
        ("/a/year=2016/x.dat", "/a", "2016"),
        ("/a/20x6/x.dat", "/a", None),
        ("/a/b/2016/x.dat", "/a", None),
    ],
)
def test_folder_year(spark, path, root, year):
    row = spark.createDataFrame([(path,)], "p string").select(names.folder_year(F.col("p"), root)).first()
    assert row[0] == year


def test_path_pieces(spark):
    paths = ["/a/b.c/.hidden", "/a/x.tar.gz", "x", "/in/name=claims_2016.dat/part-0001.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    p = F.col("p")
    base = names.base_name(p)
    rows = df.select(
        base, names.name_stem(base), names.extension(base), names.raw_name(p)
    ).collect()
    assert [tuple(r) for r in rows] == [
        (".hidden", ".hidden", "", ".hidden"),
        ("x.tar.gz", "x.tar", "gz", "x.tar.gz"),
        ("x", "x", "", "x"),
        ("part-0001.txt", "part-0001", "txt", "claims_2016.dat"),
    ]

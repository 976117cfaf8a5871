"""What the runs of an intake did: a log of the files taken in, and of the folders published.

Both are small append-only Parquet tables below the dataset. A run that only takes in what changed
compares the tree with the log of files. A staged run writes its rows to places of their own, which nobody reads until its
log of folders is written, in one file; readers follow the last entry of each folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER, COMMITS, RUNS, PLACE = "_ledger", "_commits", "_runs", "_place"
FILES_SCHEMA = (
    "run bigint, path string, year string, stem string, length bigint, modified timestamp, "
    "described string, status string, note string"
)
FOLDERS_SCHEMA = "run bigint, year string, stem string, place string, status string, note string"
# A file with one of these needs no second look until it changes.
SETTLED = ("parsed", "empty")
UNCHANGED = "unchanged"


def _logged(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log; empty if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _append(rows: DataFrame, path: str) -> None:
    """One file, so that readers see all of it or nothing."""
    rows.coalesce(1).write.mode("append").parquet(path)


def file_log(spark: SparkSession, out: str) -> DataFrame:
    """The last entry of each file."""
    entries = _logged(spark, f"{out}/{LEDGER}", FILES_SCHEMA)
    last = F.max_by(F.struct(*[c for c in entries.columns if c != "path"]), "run").alias("last")
    return entries.groupBy("path").agg(last).select("path", "last.*")


def folder_log(spark: SparkSession, out: str, good: bool = False) -> DataFrame:
    """The last entry of each folder; with ``good`` the last that has rows, whatever came after."""
    entries = _logged(spark, f"{out}/{COMMITS}", FOLDERS_SCHEMA)
    entries = entries.where("place IS NOT NULL") if good else entries
    last = F.max_by(F.struct("run", "place", "status", "note"), "run").alias("last")
    return entries.groupBy("year", "stem").agg(last).select("year", "stem", "last.*")


def log_files(rows: DataFrame, out: str) -> None:
    _append(rows, f"{out}/{LEDGER}")


def log_folders(rows: DataFrame, out: str) -> None:
    _append(rows, f"{out}/{COMMITS}")


def next_run(spark: SparkSession, out: str) -> int:
    last = [
        _logged(spark, f"{out}/{name}", schema).agg(F.max("run")).first()[0]
        for name, schema in ((LEDGER, FILES_SCHEMA), (COMMITS, FOLDERS_SCHEMA))
    ]
    return max([0, *[n for n in last if n is not None]]) + 1


def mark_unchanged(files: DataFrame, log: DataFrame) -> DataFrame:
    """Adds ``unchanged``: the file's whole folder is as the log has it.

    A folder is written as a whole, so one new, changed or missing file makes all of its files count as changed.
    ``files`` have ``path``, ``year``, ``stem``, ``length``, ``modified`` and ``described``, what the layout
    and the options say.
    """
    facts = ["path", "year", "stem", "length", "modified", "described"]
    before = log.where(F.col("status").isin(*SETTLED)).select(*[F.col(c).alias(f"_{c}") for c in facts])
    same = F.lit(True)
    for c in facts:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    folder = [F.coalesce("year", "_year").alias("_y"), F.coalesce("stem", "_stem").alias("_s")]
    # a side that is missing differs in its path
    compared = files.select(*facts).join(before, F.col("path") == F.col("_path"), "full").select(*folder, same.alias("_same"))
    folders = compared.groupBy("_y", "_s").agg(F.bool_and("_same").alias("unchanged"))
    match = F.col("year").eqNullSafe(F.col("_y")) & F.col("stem").eqNullSafe(F.col("_s"))
    return files.join(folders, match, "left").drop("_y", "_s")


def is_staged(spark: SparkSession, out: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{COMMITS}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def published(rows: DataFrame, log: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """Of rows with a ``_place`` those of the places that the log of folders names.

    The log is small, so the join prunes the folders to read.
    """
    now = log.where("place IS NOT NULL").select(F.col("place").alias(PLACE), F.col("year").alias(keys[0]), F.col("stem").alias(keys[1]))
    return rows.join(now, [PLACE, *keys], "left_semi").drop(PLACE)


def remove_superseded(spark: SparkSession, out: str) -> int:
    """Delete the places that no folder needs any more, neither as its last entry nor as its last good one; returns their number.

    Not while a reader or another run is at work.
    """
    needed = {r["place"] for good in (False, True) for r in folder_log(spark, out, good).select("place").distinct().collect()}
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{RUNS}")
    system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in (system.listStatus(base) if system.exists(base) else []) if f.getPath().getName().removeprefix(f"{PLACE}=") not in needed]
    for path in old:
        system.delete(path, True)
    return len(old)


"""The Parquet side: datasets partitioned by year and stem, and JSON reports."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawloom.functions.names import literal_path
from rawloom.functions.text import column
from rawloom.sources import ledger

# Characters that Spark writes as %XX in the folders of partition values.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(1, 32)}
STRUCTURES = ("year/file_stem", "file_stem/year")
# Names of the partition columns for year and stem; choose others where the data has
# columns of these names.
Keys = tuple[str, str]
KEYS: Keys = ("year", "stem")


def partition_columns(structure: str, keys: Keys = KEYS) -> list[str]:
    if structure not in STRUCTURES:
        raise ValueError(f"structure must be one of {STRUCTURES}, got {structure!r}")
    return list(keys) if structure == "year/file_stem" else [keys[1], keys[0]]


def write_dataset(
    df: DataFrame,
    out: str,
    structure: str = "year/file_stem",
    rows_per_file: int | None = None,
    mode: str = "overwrite",
    keys: Keys = KEYS,
    folders: Iterable[tuple[str, str]] = (),
) -> None:
    """Write below ``out``, one folder per year and stem in the given order.

    Only the folders that receive rows are replaced; of ``folders``, the (year, stem)
    pairs that the rows are known to belong to, those without any row are removed.
    Nothing is shuffled: input splits follow the raw files, so a task writes to one or
    few folders.
    """
    known = set(folders)
    if known:
        seen = Observation()
        pair = F.struct(*[column(k).cast("string").alias(c) for k, c in zip(keys, KEYS)])
        df = df.observe(seen, F.collect_set(pair).alias("pairs"))
    writer = df.write.mode(mode).partitionBy(*partition_columns(structure, keys))
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if rows_per_file and rows_per_file > 0:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(out)
    if known:
        filled = {(r["year"], r["stem"]) for r in seen.get["pairs"]}
        for year, stem in sorted(known - filled):
            _remove(df.sparkSession, _folder(out, structure, keys, _escaped(year), _escaped(stem)))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _folder(out: str, structure: str, keys: Keys, year: str, stem: str) -> str:
    values = dict(zip(keys, (f"{keys[0]}={year}", f"{keys[1]}={stem}")))
    return "/".join([out, *[values[c] for c in partition_columns(structure, keys)]])


def read_dataset(
    spark: SparkSession,
    out: str,
    stem: str | None = None,
    structure: str = "year/file_stem",
    parts: bool = True,
    keys: Keys = KEYS,
    last_good: bool = False,
) -> DataFrame:
    """A logical table: all years of a stem, and of its numbered parts (``stem__001``).

    Of a staged dataset (``intake(staged=True)``) the folders that the last run of each published. A folder whose
    last run failed has no rows; with ``last_good`` it has those of its last run that succeeded.
    """
    if ledger.is_staged(spark, out):
        runs = f"{out}/{ledger.RUNS}"
        found = ledger.published(_read(spark, runs, [runs], (*keys, ledger.PLACE)), ledger.folder_log(spark, out, last_good), keys)
        exact = column(keys[1]) == stem
        numbered = column(keys[1]).rlike("^" + re.escape(stem or "") + "__[0-9]+$")
        return found if stem is None else found.filter(exact | numbered if parts else exact)
    if stem is None:
        return _read(spark, out, [out], keys)
    name = _escaped(stem)
    wanted = literal_path(name) + ("{,__[0-9]*}" if parts else "")
    found = _read(spark, out, [_folder(literal_path(out), structure, keys, "*", wanted)], keys)
    # The pattern lets through more than numbers; this prunes folders.
    return found.filter(column(keys[1]).rlike("^" + re.escape(stem) + "(__[0-9]+)?$"))


def read_folders(
    spark: SparkSession,
    out: str,
    folders: Iterable[tuple[str, str]],
    structure: str = "year/file_stem",
    keys: Keys = KEYS,
) -> DataFrame:
    """Only the folders of the given (year, stem) pairs, both columns as text."""
    paths = [
        literal_path(_folder(out, structure, keys, _escaped(year), _escaped(stem)))
        for year, stem in sorted(folders)
    ]
    return _read(spark, out, paths, keys)


def existing_folders(
    spark: SparkSession,
    out: str,
    folders: Iterable[tuple[str, str]],
    structure: str = "year/file_stem",
    keys: Keys = KEYS,
) -> set[tuple[str, str]]:
    """Those of the (year, stem) pairs that have a folder."""
    found = set()
    for year, stem in folders:
        folder = _folder(out, structure, keys, _escaped(year), _escaped(stem))
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            found.add((year, stem))
    return found


def read_folders_text(
    spark: SparkSession, out: str, folders: Iterable[tuple[str, str]], keys: Keys = KEYS
) -> DataFrame:
    """The reports of the given (year, stem) pairs: ``value`` and both keys as text."""
    paths = [
        literal_path(_folder(out, STRUCTURES[0], keys, _escaped(y), _escaped(s)))
        for y, s in sorted(folders)
    ]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("value", *keys)])
    return spark.read.schema(schema).option("basePath", out).text(paths)


def _escaped(value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def _read(spark: SparkSession, out: str, paths: list[str], keys: tuple[str, ...]) -> DataFrame:
    """Folders with year and stem as text: ``007`` is a stem, not the number 7."""
    reader = spark.read.option("basePath", out).option("mergeSchema", True)
    schema = T.StructType(
        [
            T.StructField(f.name, T.StringType()) if f.name in keys else f
            for f in reader.parquet(*paths).schema.fields
        ]
    )
    return reader.schema(schema).parquet(*paths)


def union_parts(*frames: DataFrame) -> DataFrame:
    """One longitudinal table; columns that a part lacks are NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def write_report(report: DataFrame, path: str) -> None:
    """Store a one-column JSON report. Reports grow with columns, not with rows."""
    report.select(F.col(report.columns[0]).alias("value")).write.mode("overwrite").text(path)


def write_reports(reports: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Store reports in a folder for each key; only folders of keys at hand are replaced.

    The reports' columns are the keys and one JSON text.
    """
    value = next(c for c in reports.columns if c not in keys)
    reports.select(column(value).alias("value"), *[column(k) for k in keys]).write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).text(path)

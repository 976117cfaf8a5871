"""Columns that tell which file a row comes from."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.functions.text import column

_FILE, _TAGS = "_tagged_file", "_tags_of_file"


def local_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """A row per file, whose ``_metadata.file_path`` is as readers tell it; expressions over that column fit both."""
    told = spark.createDataFrame([(p,) for p in sorted(set(paths))], "file_path string")
    return told.select(F.struct("file_path").alias("_metadata"))


def _spellings(paths: Iterable[str]) -> Iterable[str]:
    """Listings and rows may spell local paths differently."""
    return {re.sub("^file:/+", start, p) for p in paths for start in ("file:/", "file:///")}


def tagged(rows: DataFrame, tags: dict[str, Column], per_file: bool = False) -> DataFrame:
    """The rows of a reader with more columns. With ``per_file`` these follow from ``_metadata.file_path`` alone: they are
    computed once for each file and joined to its rows, as names are taken apart by many regular expressions."""
    named = [c.alias(n) for n, c in tags.items()]
    if not per_file or not named:
        return rows.select("*", *named)
    path = F.col("_metadata.file_path").alias(_FILE)
    of_files = local_files(rows.sparkSession, _spellings(rows.inputFiles())).select(path, F.struct(*named).alias(_TAGS))
    # An outer join, so that checks of the rows still run on all of them.
    joined = rows.select("*", path).join(F.broadcast(of_files), _FILE, "left")
    unknown = F.raise_error(F.concat(F.lit("a row of an unlisted file: "), _FILE))
    known = F.coalesce(_TAGS, unknown)
    return joined.select(*[column(c) for c in rows.columns], *[known[n].alias(n) for n in tags])

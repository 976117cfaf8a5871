"""Inventory of a raw-file tree: one row per raw file."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawloom.functions import names

# In a folder holding several kinds, only the first of these is read.
KIND_PREFERENCE = ("dat", "csv", "sas")
LISTING_SCHEMA = "path string, length bigint"
DATED_SCHEMA = LISTING_SCHEMA + ", modified timestamp"


def year_folders(root: str, years: Iterable | None) -> str:
    """The folders of the years below root as one pattern; root itself for all years."""
    wanted = sorted({str(y).strip() for y in years or [] if str(y).strip()})
    if not wanted:
        return root
    some = ",".join(f"{names.literal_path(y)},*={names.literal_path(y)}" for y in wanted)
    return f"{root.rstrip('/')}/{{{some}}}"


def list_files(spark: SparkSession, root: str | Sequence[str], dated: bool = False) -> DataFrame:
    """Path and size of every file, and with ``dated`` when it was ``modified``; contents are not read. Folders may be patterns."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(root if isinstance(root, str) else list(root))
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], DATED_SCHEMA if dated else LISTING_SCHEMA)
    when = [F.col("modificationTime").alias("modified")] if dated else []
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", *when)


def hidden_files(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """Files in year folders whose names begin with ``_`` or ``.``, which readers leave out.

    ``depth`` counts the levels of folders to look in, year folders being the first.
    """
    system, rows = None, []
    for level in range(depth):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*{'/[!_.]*' * level}/[_.]*")
        system = system or pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        rows += [
            (names.plain_path(f.getPath().toString()), f.getLen())
            for f in system.globStatus(pattern) or []
            if f.isFile() and not f.getPath().getName().endswith(".crc")
        ]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def describe_files(files: DataFrame, root: str | None = None, loose: bool = False) -> DataFrame:
    """Derive kind, years, stem, part and layout name from ``path`` and ``length``.

    The parts of a file written by a distributed job count as one file. The folder's
    year wins over the name's. Unsupported files have a NULL ``kind``. The time of the last
    change, if given, follows at the end.
    """
    dated = [c for c in ("modified",) if c in files.columns]
    whole = (
        files.select(names.raw_file(F.col("path")).alias("path"), "length", *dated)
        .groupBy("path")
        .agg(F.sum("length").alias("length"), *[F.max(c).alias(c) for c in dated])
    )
    named = whole.withColumn("file_name", names.raw_name(F.col("path"))).withColumn(
        "kind", names.kind_of(F.col("file_name"))
    )
    name, kind = F.col("file_name"), F.col("kind")
    return named.select(
        "path",
        "file_name",
        names.extension(name).alias("ext"),
        "kind",
        names.folder_year(F.col("path"), root).alias("dir_year"),
        names.year_of_name(name, kind, loose).alias("name_year"),
        names.stem_of_name(name, kind, loose).alias("stem"),
        names.part_of_name(name).alias("part"),
        "length",
        names.dir_name(F.col("path")).alias("dir"),
        names.layout_stem(name, kind, loose).alias("layout_stem"),
        *dated,
    ).withColumn("year", F.coalesce("dir_year", "name_year"))


def select_years(manifest: DataFrame, years: Iterable | None) -> DataFrame:
    """Blank entries are ignored; an empty list means all years."""
    wanted = [str(y).strip() for y in years or [] if str(y).strip()]
    return manifest.filter(F.col("year").isin(wanted)) if wanted else manifest


def select_stems(manifest: DataFrame, stems: Iterable | None) -> DataFrame:
    """Stems starting with any of the prefixes."""
    prefixes = [str(s).strip() for s in stems or [] if str(s).strip()]
    if not prefixes:
        return manifest
    test = F.lit(False)
    for prefix in prefixes:
        test = test | F.col("stem").startswith(prefix)
    return manifest.filter(test)


def _kind_rank(kind: Column) -> Column:
    rank = F.lit(None).cast("int")
    for i, k in enumerate(KIND_PREFERENCE):
        rank = F.when(kind == k, i).otherwise(rank)
    return rank


def kinds_per_year(manifest: DataFrame, year: str = "year") -> DataFrame:
    """Which kinds of file each year holds."""
    return manifest.groupBy(year).agg(
        *[F.bool_or(F.col("kind") == k).alias(f"has_{k}") for k in KIND_PREFERENCE]
    )


def select_kinds(manifest: DataFrame, kinds: str | Sequence[str] = "auto") -> DataFrame:
    """``auto``: per year dat files if there are any, else csv, else sas.

    The preference is one small row per four-digit year, computed with map-side
    aggregation and joined back, so a year with most of the files is no bottleneck.
    """
    supported = manifest.filter(F.col("kind").isNotNull())
    if kinds == "all":
        return supported
    if kinds != "auto":
        return supported.filter(F.col("kind").isin([kinds] if isinstance(kinds, str) else kinds))
    ranked = supported.withColumn("_rank", _kind_rank(F.col("kind")))
    best = ranked.groupBy(F.col("year").alias("_year")).agg(F.min("_rank").alias("_best"))
    return (
        ranked.join(best, F.col("year").eqNullSafe(F.col("_year")))
        .filter(F.col("_rank") == F.col("_best"))
        .drop("_year", "_rank", "_best")
    )


def collisions(manifest: DataFrame) -> DataFrame:
    """Output keys that several different files would write to."""
    key = ["year", "stem", "part"]
    return (
        manifest.groupBy(*key)
        .agg(
            F.count_distinct("path").alias("n_files"),
            F.min("path").alias("first_path"),
            F.max("path").alias("last_path"),
        )
        .filter(F.col("n_files") > 1)
    )


def require_no_collisions(manifest: DataFrame) -> None:
    """Raise if several files have one output key; every such key is named."""
    found = sorted(collisions(manifest).collect(), key=str)
    if found:
        listing = "\n".join(
            f"  {r.year}/{r.stem}: {r.n_files} files, e.g. {r.first_path} and {r.last_path}"
            for r in found
        )
        raise ValueError(f"{len(found)} outputs have several inputs each:\n{listing}")


def attach_layouts(manifest: DataFrame, layout_files: DataFrame) -> DataFrame:
    """Add ``layout_file``: the layout in the same folder, NULL when there is none."""
    path = F.col("layout_file")
    layouts = layout_files.select(
        names.dir_name(path).alias("_dir"),
        names.name_stem(names.base_name(path)).alias("_stem"),
        "layout_file",
    )
    return manifest.join(
        layouts,
        (F.col("dir") == F.col("_dir")) & (F.col("layout_stem") == F.col("_stem")),
        "left",
    ).drop("_dir", "_stem")


def record_lengths(layout: DataFrame) -> DataFrame:
    return layout.groupBy("layout_file").agg(
        F.sum(F.when(F.col("width") > 0, F.col("width"))).alias("record_length")
    )


def part_count(rows: Column, chunk_rows: int | None) -> Column:
    if not chunk_rows or chunk_rows <= 0:
        return F.lit(1)
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(chunk_rows)).cast("int"))


def plan_parts(
    manifest: DataFrame,
    layout: DataFrame,
    shapes: DataFrame,
    chunk_rows: int | None,
    line_break: int = 1,
) -> DataFrame:
    """Add ``n_rows_est`` and ``n_parts`` to a manifest with layouts attached.

    Declared rows count first, else file size by record length (with its line break).
    CSV files are one part.
    """
    declared = shapes.select("layout_file", F.col("expected_rows").alias("_declared"))
    joined = manifest.join(record_lengths(layout), "layout_file", "left").join(
        declared, "layout_file", "left"
    )
    by_size = F.floor(F.col("length") / (F.col("record_length") + line_break)).cast("bigint")
    rows = F.when(F.col("kind") == "dat", F.coalesce("_declared", by_size))
    estimated = joined.withColumn("n_rows_est", rows)
    parts = F.coalesce(part_count(F.col("n_rows_est"), chunk_rows), F.lit(1))
    return estimated.withColumn(
        "n_parts", F.when(F.col("kind") == "dat", parts).otherwise(F.lit(1))
    ).drop("_declared", "record_length")


def _glob_pattern(root: str, glob: str) -> str:
    """Regex for one glob below root; ``{year}`` becomes the first group."""
    if "{year}" not in glob:
        raise ValueError(f"input glob needs {{year}}: {glob!r}")
    out = ""
    for piece in re.split(r"(\{year\}|\*|\?|\[[^]]*\])", glob):
        if piece == "{year}":
            out += r"([0-9]{4})" if "(" not in out else r"\1"
        elif piece == "*":
            out += "[^/]*"
        elif piece == "?":
            out += "[^/]"
        elif piece.startswith("["):
            out += piece.replace("[!", "[^")
        else:
            out += re.escape(piece)
    return "^" + re.escape(names.plain_path(root)) + "/" + out + "$"


def select_globs(manifest: DataFrame, root: str, globs: Sequence[str]) -> DataFrame:
    """Files matched by any glob; the year comes from ``{year}``. Each file once."""
    year = F.coalesce(
        *[
            F.nullif(F.regexp_extract("path", _glob_pattern(root, g), 1), F.lit(""))
            for g in globs
        ]
    )
    return manifest.withColumn("dir_year", year).withColumn("year", year).filter(
        F.col("year").isNotNull()
    )


def select_files(
    spark: SparkSession,
    root: str,
    years: Iterable | None = None,
    stems: Iterable | None = None,
    kinds: str | Sequence[str] = "auto",
    globs: Sequence[str] | None = None,
    loose: bool = False,
    dated: bool = False,
) -> DataFrame:
    """Raw files to read, directly in the year folders below ``root`` or by globs."""
    listed = list_files(spark, root if globs else year_folders(root, years), dated)
    files = describe_files(listed, root, loose)
    if globs:
        candidates = select_globs(files, root, globs)
    else:
        directly = "^" + re.escape(names.plain_path(root)) + "/(?:[^/=]*=)?[0-9]{4}/[^/]+$"
        candidates = files.filter(F.col("path").rlike(directly))
    return select_stems(select_kinds(select_years(candidates, years), kinds), stems)


def build_manifest(spark: SparkSession, root: str, *args, **kwargs) -> DataFrame:
    """``select_files`` in year and path order."""
    return select_files(spark, root, *args, **kwargs).orderBy("year", "path")


def rejected_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of no supported kind, layout files aside, without a year, or with hidden names.

    Hidden names are looked for one level deeper than the deepest visible file lies.
    """
    files = describe_files(list_files(spark, root), root).withColumn("hidden", F.lit(False))
    below = F.substring("dir", len(names.plain_path(root)) + 1, 2**31 - 1)
    deepest = files.agg(F.max(F.length(below) - F.length(F.replace(below, F.lit("/"))))).first()[0]
    hidden = describe_files(hidden_files(spark, root, (deepest or 0) + 1), root).withColumn("hidden", F.lit(True))
    # what Spark's writers leave beside their output is no raw file
    hidden = hidden.filter(F.col("kind").isNotNull())
    unusable = F.col("hidden") | F.col("kind").isNull() | F.col("year").isNull()
    return (
        files.unionByName(hidden)
        .filter((F.col("ext") != "fts") & unusable)
        .withColumn(
            "reason",
            F.when(F.col("hidden"), "hidden name")
            .when(F.col("kind").isNull(), "unsupported kind")
            .otherwise("no year"),
        )
        .drop("hidden")
    )

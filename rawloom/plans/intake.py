"""From a raw-file tree to a typed, partitioned and checked Parquet dataset."""

from __future__ import annotations

import itertools
import json
import math
import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rawloom.functions import names
from rawloom.functions.text import column, ident
from rawloom.layout import DELIMITED, FIXED, Layout
from rawloom.operators.infer import infer_and_cast
from rawloom.operators.profile import profile
from rawloom.plans.report import report
from rawloom.session import tune
from rawloom.sources import ledger
from rawloom.sources.dataset import (
    KEYS,
    STRUCTURES,
    Keys,
    existing_folders,
    read_folders,
    read_folders_text,
    union_parts,
    write_dataset,
    write_report,
    write_reports,
)
from rawloom.sources.delimited import read_delimited
from rawloom.sources.fixedwidth import read_fixed_width
from rawloom.sources.layouts import (
    layout_fields,
    layout_file_rows,
    layout_shapes,
    located_tables,
    parsed_layouts,
    read_layout_texts,
)
from rawloom.sources.manifest import (
    attach_layouts,
    plan_parts,
    rejected_files,
    require_no_collisions,
    select_files,
    year_folders,
)

STYLES = {"dat": FIXED, "csv": DELIMITED}
#: Bytes that a delimited field takes, for estimates: their layouts need not tell widths.
FIELD_BYTES = 8


def path_tags(
    kind: str, root: str, loose: bool = False, keys: Keys = KEYS
) -> dict[str, Column]:
    """Year and stem of the file a row comes from, computed from its path."""
    return tags_of(names.raw_file(names.source_path()), kind, root, loose, keys)


def tags_of(path: Column, kind: str, root: str, loose: bool = False, keys: Keys = KEYS) -> dict[str, Column]:
    name = names.raw_name(path)
    year = F.coalesce(
        names.folder_year(path, root), names.year_of_name(name, F.lit(kind), loose)
    )
    return {keys[0]: year, keys[1]: names.stem_of_name(name, F.lit(kind), loose)}


def _layout_texts(spark: SparkSession, path: str) -> DataFrame:
    """Layout files below a folder or pattern; none if there are no such folders."""
    try:
        return read_layout_texts(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "layout_file string, text string")


def _layouts(
    located: DataFrame, layout_files: dict[str, set[str]], bad: dict[str, str]
) -> dict[tuple[str, str], Layout]:
    """Layouts per (kind, layout file): as many rows as the raw files have columns.

    What is wrong with a layout goes to ``bad`` and concerns its own files only.
    """
    out = {}
    for kind, files in layout_files.items():
        fields = layout_fields(parsed_layouts(None, style=STYLES[kind], located=located))
        rows = defaultdict(list)
        for row in fields.collect():
            if row["layout_file"] in files:
                rows[row["layout_file"]].append(row)
        for file, found in rows.items():
            try:
                out[kind, file] = Layout.from_rows(found, name=file)
            except ValueError as e:
                bad[file] = str(e)
    return out


def _computed_once(texts: DataFrame) -> DataFrame:
    """Given layout texts in a cache of their own: what is asked of their names is not pushed to the rows they are made of."""
    return texts.select("layout_file", "text", F.lit(uuid.uuid4().hex).alias("_own")).persist()


def describe_layouts(
    spark: SparkSession, root: str, files: DataFrame, layout_texts: DataFrame | None = None
) -> tuple[list[Row], dict[tuple[str, str], Layout], dict[str, str]]:
    """Files with their layout files, the layouts by (kind, layout file), and what is wrong with some."""
    given = None if layout_texts is None else _computed_once(layout_texts)
    try:
        texts = _layout_texts(spark, root) if given is None else given.drop("_own")
        listing = attach_layouts(files, texts).collect()
        wanted: dict[str, set[str]] = defaultdict(set)
        for f in listing:
            if f.kind in STYLES and f.layout_file:
                wanted[f.kind].add(f.layout_file)
        if not wanted:
            return listing, {}, {}
        used = spark.createDataFrame([(n,) for n in sorted(set().union(*wanted.values()))], "layout_file string")
        texts = texts.join(F.broadcast(used), "layout_file", "left_semi").persist()
        try:
            readable = F.is_valid_utf8("text")
            bad = {r["layout_file"]: "layout is not UTF-8" for r in texts.where(~readable).select("layout_file").collect()}
            return listing, _layouts(located_tables(texts.where(readable)), wanted, bad), bad
        finally:
            texts.unpersist()
    finally:
        if given is not None:
            given.unpersist()


def _expectations(manifest: DataFrame, shapes: DataFrame, file_rows: DataFrame) -> DataFrame:
    """Declared rows and columns per output folder (year, stem).

    A row count given for the data file itself counts first. A total for all files that
    share a layout says nothing about some of them, only about a folder that has them
    all. A folder's rows are the sum over its files, and unknown if any of them is.
    """
    folder = ["year", "stem"]
    per_layout = manifest.groupBy("layout_file").agg(F.count(F.lit(1)).alias("_sharing"))
    by_file = file_rows.select(
        "layout_file", F.col("data_file").alias("file_name"), F.col("expected_rows").alias("_own")
    )
    declared = (
        manifest.join(by_file, ["layout_file", "file_name"], "left")
        .groupBy(*folder, "layout_file")
        .agg(
            F.count(F.lit(1)).alias("_files"),
            F.when(F.count("_own") == F.count(F.lit(1)), F.sum("_own")).alias("_own"),
        )
        .join(per_layout, "layout_file")
        .join(shapes.drop("layout_stem"), "layout_file")
    )
    whole = F.when(F.col("_files") == F.col("_sharing"), F.col("expected_rows"))
    rows = F.coalesce("_own", whole)
    return declared.groupBy(*folder).agg(
        F.when(F.count(rows) == F.count(F.lit(1)), F.sum(rows)).alias("expected_rows"),
        F.max("expected_columns").alias("expected_columns"),
        F.max("expected_names").alias("expected_names"),
    )


def total_check(counts: DataFrame, manifest: DataFrame, shapes: DataFrame) -> DataFrame:
    """Rows written per layout, over all files that share it, against the declared total.

    A folder counts once however many of its files the layout describes. Rows of a folder
    that several layouts feed belong to none of them alone, so their totals are unknown.
    """
    feeds = manifest.filter(F.col("layout_file").isNotNull()).select("layout_file", "year", "stem").distinct()
    shared = feeds.groupBy("year", "stem").agg((F.count(F.lit(1)) > 1).alias("_shared"))
    per_layout = (
        feeds.join(shared, ["year", "stem"])
        .join(counts, ["year", "stem"])
        .groupBy("layout_file")
        .agg(F.when(~F.bool_or("_shared"), F.sum("actual_rows")).alias("actual_rows"))
    )
    expected = shapes.select("layout_file", "expected_rows")
    return per_layout.join(expected, "layout_file", "left").select(
        "layout_file",
        "actual_rows",
        "expected_rows",
        F.when(
            F.col("expected_rows").isNotNull(), F.col("actual_rows") != F.col("expected_rows")
        ).alias("row_mismatch"),
    )


def _local(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A small table computed once; the driver holds it."""
    return spark.createDataFrame(rows.collect(), rows.schema)


def intake(
    spark: SparkSession,
    root: str,
    out: str,
    years: Iterable | None = None,
    stems: Iterable | None = None,
    kinds: str | Sequence[str] = "auto",
    globs: Sequence[str] | None = None,
    structure: str = "year/file_stem",
    rows_per_file: int | None = None,
    mode: str = "failfast",
    run_qc: bool = True,
    loose: bool = False,
    parity: bool = False,
    layout_texts: DataFrame | None = None,
    sas_reader: Callable[[SparkSession, list[str]], DataFrame] | None = None,
    keys: Keys = KEYS,
    parallel_jobs: int = 4,
    dat_options: dict | None = None,
    csv_options: dict | None = None,
    check_duplicates: bool = True,
    only_changed: bool = False,
    staged: bool = False,
    pack_rows: int | None = None,
) -> DataFrame:
    """Read all raw files below ``root`` and write them typed below ``out``.

    Files whose layouts read alike are one job: their lines are cut, cast and written
    in one pass without a shuffle, tagged with year and stem from their paths. ``keys``
    names these two columns, for data that has a ``year`` or ``stem`` of its own. Up to
    ``parallel_jobs`` jobs run at a time, so that small ones do not leave a cluster idle.
    Files that one folder would get from several jobs raise an error before any is read;
    all such folders are named. With ``years`` only the folders of these are listed.
    ``dat_options`` and ``csv_options`` go to the readers (``encoding``, ``offsets``,
    ``count_newline``, ``sep``, ``header``, ``encoding_errors``).

    With ``run_qc`` each job's output is profiled once, grouped by year and stem, and
    compared with what the layouts declare. Reports go to ``out/_reports``, a folder for
    each year and stem; the rows of all files that share a layout, against its declared
    total, to ``out/_totals``; files that cannot be taken in to ``out/_rejects``. Later
    runs replace only what they have. ``check_duplicates=False`` leaves out the count of
    equal rows, the only part of a report that shuffles whole rows.

    Layouts are the ``.fts`` files below ``root``, or the rows (layout_file, text) of
    ``layout_texts`` for layouts kept elsewhere; ``layout_file`` then is the path where
    the file would lie.

    With ``only_changed`` a log of files is kept in ``out/_ledger``. Folders whose files, layouts and options
    are as an earlier run logged them are not read again; their files are ``unchanged``. A file that failed is
    tried again, and a folder with a new, changed or missing file is taken in as a whole.

    With ``staged`` rows are written to ``out/_runs`` and published together at the end, by ``out/_commits``:
    ``read_dataset`` sees a run's folders whole or not at all. A folder that failed is no longer served as current, and its
    report says so. ``remove_superseded`` deletes what no reader needs any more.

    With ``pack_rows`` estimated sizes deal out the writing: where a folder has several files whose lengths tell fewer
    rows, these are brought together in one exchange, into about so many rows a task, so that thousands of small files
    give few Parquet files. Rows of larger files are still written, in order, by the task that read them.

    SAS files need ``sas_reader``, a function that gives a decoded DataFrame for paths;
    its types are inferred. Returns the manifest with a ``status`` per file: ``parsed``,
    ``failed`` (its folder could not be read or written; the others are), ``bad layout``,
    ``no layout``, ``empty``, ``unchanged`` or ``not read``; and a ``note``: why a file failed, that its
    name tells another year than its folder, or that its layout declares other starts
    than the widths give. The driver sees file names and layouts only.
    """
    tune(spark)
    given = None if layout_texts is None else _computed_once(layout_texts)
    try:
        if given is None:
            layout_texts = _layout_texts(spark, root if globs else year_folders(root, years))
        else:
            layout_texts = given.drop("_own")
        logged = only_changed or staged
        found = attach_layouts(
            select_files(spark, root, years, stems, kinds, globs, loose, dated=logged), layout_texts
        )
        run_number = ledger.next_run(spark, out) if logged else 0
        if logged:
            options = repr((mode, structure, rows_per_file, run_qc, loose, parity, keys, dat_options, csv_options, check_duplicates, staged, names.plain_path(root)))
            told = layout_texts.select("layout_file", F.sha2("text", 256).alias("_text"))
            found = found.join(told, "layout_file", "left").withColumn("described", F.sha2(F.concat_ws("\n", F.lit(options), "_text"), 256)).drop("_text")
            log = ledger.file_log(spark, out) if only_changed else ledger.file_log(spark, out).limit(0)
            found = ledger.mark_unchanged(found, log)
        # One listing of the tree: file names, not data. Readers need the paths here anyway.
        listing = sorted(found.collect(), key=lambda f: (f.year, f.path))
        if not listing:
            raise ValueError(f"no raw files found below {root}")
        manifest = spark.createDataFrame(listing, found.schema)
        require_no_collisions(manifest)

        # Only layouts that describe some file are parsed, and these once.
        pending = manifest.where("NOT unchanged") if logged else manifest
        used = pending.select("layout_file").where("layout_file IS NOT NULL").distinct()
        texts = layout_texts.join(used, "layout_file", "left_semi").persist()
        readable = F.is_valid_utf8("text")
        bad = {r["layout_file"]: "layout is not UTF-8" for r in texts.where(~readable).select("layout_file").collect()}
        located = located_tables(texts.where(readable), parity=parity).persist()
        try:
            parsed = parsed_layouts(None, located=located)
            shapes, file_rows = _local(spark, layout_shapes(parsed)), _local(spark, layout_file_rows(parsed))
            wanted: dict[str, set[str]] = defaultdict(set)
            for f in listing:
                if f.kind in STYLES and f.layout_file and not (logged and f.unchanged):
                    wanted[f.kind].add(f.layout_file)
            layouts = _layouts(located, wanted, bad) if wanted else {}
        finally:
            located.unpersist()
            texts.unpersist()
    finally:
        if given is not None:
            given.unpersist()

    sizes = _estimated_rows(pending, layouts) if pack_rows and layouts else {}
    taken = {k.lower() for k in keys}
    for (_, file), layout in layouts.items():
        clash = [n for n in layout.names if n.lower() in taken]
        if clash:
            bad[file] = f"has columns {clash}: choose other keys than {keys}"

    offsets = (dat_options or {}).get("offsets", "cumulative")
    jobs: dict[tuple[str, str], tuple[Layout | None, list[Row]]] = {}
    status, notes = {}, defaultdict(list)
    for f in listing:
        layout = layouts.get((f.kind, f.layout_file))
        if f.dir_year and f.name_year and f.dir_year != f.name_year:
            notes[f.path].append(f"folder of {f.dir_year}, name of {f.name_year}")
        if logged and f.unchanged:
            status[f.path] = ledger.UNCHANGED
        elif f.length == 0:
            status[f.path] = "empty"
        elif f.kind == "sas" and sas_reader is None:
            status[f.path] = "not read"
        elif f.kind != "sas" and f.layout_file in bad:
            status[f.path] = "bad layout"
            notes[f.path].append(bad[f.layout_file])
        elif f.kind != "sas" and layout is None:
            status[f.path] = "no layout"
        else:
            status[f.path] = "parsed"
            if f.kind == "dat" and offsets == "cumulative":
                moved = layout.declared_starts_differ()
                if moved:
                    notes[f.path].append(f"declared starts differ: {', '.join(moved)}")
            alike = layout.fingerprint() if layout else f.path
            jobs.setdefault((f.kind, alike), (layout, []))[1].append(f)
    _require_own_folders(jobs)

    expected = None
    if run_qc:
        # One row per folder, computed once for all reports.
        told = _expectations(manifest, shapes, file_rows).collect()
        expected = spark.createDataFrame(
            told,
            f"{ident(keys[0])} string, {ident(keys[1])} string, expected_rows bigint, "
            "expected_columns int, expected_names array<string>",
        )

    commits: list[tuple] = []
    places = itertools.count()

    def take_in(kind: str, layout: Layout | None, files: list[Row]) -> list[Row]:
        """Write the files' rows; the count per (year, stem) from their reports."""
        place = f"{run_number}-{next(places)}"
        base = f"{out}/{ledger.RUNS}/{ledger.PLACE}={place}" if staged else out
        folders = {(f.year, f.stem) for f in files}
        if kind == "sas":
            own = [F.lit(files[0][c]).cast("string").alias(k) for c, k in zip(KEYS, keys)]
            rows = infer_and_cast(sas_reader(spark, [f.path for f in files]), text="keep").select("*", *own)
        else:
            read = read_fixed_width if kind == "dat" else read_delimited
            more = (dat_options if kind == "dat" else csv_options) or {}
            read_files = lambda paths: read(spark, paths, layout, mode, tags=path_tags(kind, root, loose, keys), tags_per_file=True, **more)
            small, packed = _packed(files, sizes, pack_rows)
            parts = [read_files([names.literal_path(f.path) for f in files if f.path not in small])] if len(small) < len(files) else []
            if small:
                brought = read_files([names.literal_path(p) for p in sorted(small)])
                parts.append(brought.hint("rebalance", packed, *[column(k) for k in keys]))
            rows = union_parts(*parts)
        write_dataset(rows, base, structure, rows_per_file, keys=keys, folders=folders)
        done = [(run_number, y, s, place, "parsed", None) for y, s in sorted(folders)]
        if not run_qc:
            commits.extend(done)
            return []
        there = existing_folders(spark, base, folders, structure, keys)
        if not there:
            commits.extend(done)
            return [Row(year=y, stem=s, actual_rows=0) for y, s in sorted(folders)]
        written = read_folders(spark, base, there, structure, keys)
        result = None if check_duplicates else profile(written, keys, duplicates=False)
        reports = report(written, expected, by=list(keys), result=result)
        as_json = F.to_json(F.struct(*[column(k) for k in keys], "report")).alias("value")
        write_reports(reports.select(as_json, *[column(k) for k in keys]), f"{out}/_reports", keys)
        commits.extend(done)
        return reported(there)

    def reported(folders) -> list[Row]:
        """The rows of folders, by their stored reports."""
        stored = read_folders_text(spark, f"{out}/_reports", folders, keys)
        inner = F.get_json_object("value", "$.report")
        return stored.select(
            *[column(k).alias(c) for k, c in zip(keys, KEYS)],
            F.get_json_object(inner, "$.shape_check.actual_rows").cast("bigint").alias("actual_rows"),
        ).collect()

    def run(job) -> list[Row]:
        """One job; if it fails, its folders one by one, so that only bad ones are left out."""
        (kind, _), (layout, files) = job
        try:
            return take_in(kind, layout, files)
        except Exception as e:  # noqa: BLE001
            by_folder: dict[tuple, list[Row]] = defaultdict(list)
            for f in files:
                by_folder[f.year, f.stem].append(f)
            if len(by_folder) == 1:
                for f in files:
                    status[f.path] = "failed"
                    notes[f.path].append(_reason(e))
                commits.extend((run_number, y, s, None, "failed", _reason(e)) for y, s in by_folder)
                return []
            return [row for own in by_folder.values() for row in run(((kind, ""), (layout, own)))]

    with ThreadPoolExecutor(max(1, parallel_jobs)) as pool:
        counts = [row for found in pool.map(run, sorted(jobs.items(), key=lambda j: j[0])) for row in found]
    if logged and run_qc and counts:
        # folders left as they are count in the totals of layouts that they share with others
        shared = {f.layout_file for f in listing if not f.unchanged} - {None}
        as_before = {(f.year, f.stem) for f in listing if f.unchanged and f.layout_file in shared}
        counts += reported(existing_folders(spark, f"{out}/_reports", as_before, STRUCTURES[0], keys)) if as_before else []
    if counts:
        counted = spark.createDataFrame(counts, "year string, stem string, actual_rows bigint")
        totals = total_check(counted, manifest, shapes)
        below = F.replace("layout_file", F.lit(names.plain_path(root) + "/"), F.lit(""))
        write_reports(totals.select(F.to_json(F.struct("*")).alias("value"), below.alias("layout")), f"{out}/_totals", ["layout"])
    rejects = rejected_files(spark, root).select(F.to_json(F.struct("path", "length", "reason")))
    write_report(rejects, f"{out}/_rejects")
    verdicts = spark.createDataFrame(
        [(p, s, "; ".join(notes[p]) or None) for p, s in status.items()], "path string, status string, note string"
    )
    result = manifest.join(verdicts, "path", "left")
    if staged:
        _publish(spark, out, commits, keys, run_qc)
    if logged:
        entries = result.where(F.col("status") != ledger.UNCHANGED).withColumn("run", F.lit(run_number).cast("bigint"))
        ledger.log_files(entries.select(*[c.split()[0] for c in ledger.FILES_SCHEMA.split(", ")]), out)
    return result.drop("modified", "described", "unchanged") if logged else result


def _estimated_rows(manifest: DataFrame, layouts: dict[tuple[str, str], Layout]) -> dict[str, int]:
    """Rows of each file by its length.

    What layouts declare is the total of all files that share them, so it tells nothing about one.
    """
    spark = manifest.sparkSession
    told = [(k, file, max(f.width, 0) if k == "dat" else FIELD_BYTES) for (k, file), layout in layouts.items() for f in layout.fields]
    widths = spark.createDataFrame(told, "kind string, layout_file string, width int")
    untold = spark.createDataFrame([], "layout_file string, expected_rows bigint")
    out = {}
    for kind in STYLES:
        files = manifest.where(F.col("kind") == kind).withColumn("kind", F.lit("dat"))
        found = plan_parts(files, widths.where(F.col("kind") == kind).drop("kind"), untold, None).select("path", "n_rows_est")
        out |= {r.path: r.n_rows_est for r in found.where("n_rows_est IS NOT NULL").collect()}
    return out


def _packed(files: list[Row], sizes: dict[str, int], pack_rows: int | None) -> tuple[set[str], int]:
    """Files to write together, where a folder has several small ones, and the number of tasks for them."""
    by_folder: dict[tuple, list[str]] = defaultdict(list)
    for f in files:
        if pack_rows and sizes.get(f.path, pack_rows) < pack_rows:
            by_folder[f.year, f.stem].append(f.path)
    several = [paths for paths in by_folder.values() if len(paths) > 1]
    tasks = sum(math.ceil(max(1, sum(sizes[p] for p in paths)) / pack_rows) for paths in several)
    return {p for paths in several for p in paths}, tasks


def _publish(spark: SparkSession, out: str, commits: list[tuple], keys: Keys, run_qc: bool) -> None:
    """Log a run's folders, which readers then see; reports of failed ones say so."""
    failed = [(json.dumps({keys[0]: y, keys[1]: s, "report": json.dumps({"status": "failed", "note": note})}), y, s) for _, y, s, place, _, note in commits if place is None]
    if failed and run_qc:
        write_reports(spark.createDataFrame(failed, f"value string, {ident(keys[0])} string, {ident(keys[1])} string"), f"{out}/_reports", keys)
    ledger.log_folders(spark.createDataFrame(commits, ledger.FOLDERS_SCHEMA), out)


def _reason(error: Exception) -> str:
    """The first line that tells what went wrong, for a note."""
    text = str(error)
    told = re.search(r"\[USER_RAISED_EXCEPTION\] ([^\n]*?)(?: SQLSTATE| JVM stacktrace|$)", text)
    return (told.group(1) if told else text.split("\n", 1)[0])[:300]


def _require_own_folders(jobs: dict) -> None:
    """Raise if several jobs write to one folder: each would replace the other's rows."""
    writers: dict[tuple, dict] = defaultdict(dict)
    for job, (_, files) in jobs.items():
        for f in files:
            writers[f.year, f.stem].setdefault(job, f.path)
    shared = {k: v for k, v in writers.items() if len(v) > 1}
    if shared:
        listing = "\n".join(f"  {y}/{s}: e.g. {' and '.join(sorted(v.values()))}" for (y, s), v in sorted(shared.items(), key=str))
        raise ValueError(f"{len(shared)} output folders have files of several kinds or layouts:\n{listing}")

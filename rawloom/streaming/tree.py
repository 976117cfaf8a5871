"""Incremental intake of a whole tree: files of several kinds and layouts arrive mixed, each is read once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rawloom.functions import names
from rawloom.functions.casting import cast_by_layout
from rawloom.functions.text import column
from rawloom.layout import DELIMITED, Layout
from rawloom.plans.intake import STYLES, describe_layouts, path_tags
from rawloom.session import tune
from rawloom.sources.dataset import KEYS, Keys
from rawloom.sources.delimited import split_delimited
from rawloom.sources.fixedwidth import read_lines, slice_fixed
from rawloom.sources.manifest import describe_files
from rawloom.sources.tags import local_files, tagged

PATH, FILES = "_path", "_files"


def stream_tree(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    layout_texts: DataFrame | Callable[[], DataFrame] | None = None,
    mode: str = "failfast",
    keys: Keys = KEYS,
    loose: bool = False,
    files_per_batch: int | None = None,
    dat_options: dict | None = None,
    csv_options: dict | None = None,
) -> StreamingQuery:
    """Take in all files that have arrived below ``root``, then stop; one checkpoint remembers them.

    A batch's files are joined with the layouts beside them, and files whose layouts read alike are read by one plan.
    Rows are written below ``out`` by batch and plan, so that a batch repeated after a failure replaces what it wrote.
    ``read_tree`` reads them, ``tree_files`` what became of each file: ``parsed``, ``no layout``, ``bad layout``, ``no year``
    or ``unsupported kind``. A file without a layout counts as seen; send it again, or use ``intake``, when its layout is there.
    A record that fails fast stops the stream before its batch counts as read.
    """
    tune(spark)
    reader = spark.readStream.option("recursiveFileLookup", True).option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(root).select("value", F.col("_metadata.file_path").alias(PATH))

    def take_in(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # names of the files of one batch; what they tell is found for each of them, not for each line
        arrived = local_files(session, [r[0] for r in batch.select(PATH).distinct().collect()])
        arrived = arrived.select(F.col("_metadata.file_path").alias(PATH), names.raw_file(names.source_path()).alias("path"))
        stored = defaultdict(list)
        for f in arrived.collect():
            stored[f.path].append(names.literal_path(unquote(f[PATH])))
        paths = arrived.select("path", F.lit(0).cast("bigint").alias("length")).distinct()
        described = describe_files(paths, root, loose).where("ext <> 'fts' OR ext IS NULL")
        texts = layout_texts() if callable(layout_texts) else layout_texts
        listing, layouts, bad = describe_layouts(session, root, described, texts)
        plans: dict[tuple[str, str], tuple[Layout, list]] = {}
        seen, taken = [], {k.lower() for k in keys}
        for f in listing:
            layout, status = layouts.get((f.kind, f.layout_file)), "parsed"
            if f.kind not in STYLES:
                status = "unsupported kind"
            elif f.year is None:
                status = "no year"
            elif f.layout_file in bad or layout and {n.lower() for n in layout.names} & taken:
                status = "bad layout"
            elif layout is None:
                status = "no layout"
            else:
                plans.setdefault((f.kind, layout.fingerprint()), (layout, []))[1].append(f)
            seen.append((f.path, status))
        for k, ((kind, _), (layout, files)) in enumerate(sorted(plans.items(), key=lambda p: p[0])):
            # a plan reads its own files only, not the lines of all plans
            rows = read_lines(session, [p for f in files for p in stored[f.path]])
            rows = tagged(rows, path_tags(kind, root, loose, keys), per_file=True)
            more = (dat_options if kind == "dat" else csv_options) or {}
            if layout.style == DELIMITED:
                rows = rows.withColumn("value", F.regexp_replace("value", "\r$", ""))
                rows = split_delimited(rows, layout, mode=mode, stripped=True, **more)
            else:
                rows = slice_fixed(rows, layout, mode=mode, stored_lines=True, **more)
            typed = cast_by_layout(rows, layout, mode, stripped=True)
            typed.write.mode("overwrite").partitionBy(*keys).parquet(f"{out}/_batch={batch_id}/_plan={k}")
        status = session.createDataFrame(seen, "path string, status string")
        status.coalesce(1).write.mode("overwrite").parquet(f"{out}/{FILES}/batch={batch_id}")

    return lines.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_tree(spark: SparkSession, out: str, stem: str | None = None, keys: Keys = KEYS) -> DataFrame:
    """The rows of all batches, or those of one stem, with the columns that any of its layouts has."""
    rows = spark.read.option("mergeSchema", True).option("basePath", out).parquet(f"{out}/_batch=*/_plan=*").drop("_batch", "_plan")
    rows = rows.withColumns({k: column(k).cast("string") for k in keys})
    return rows if stem is None else rows.where(column(keys[1]) == stem)


def tree_files(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{FILES}").withColumn("batch", F.col("batch").cast("bigint"))

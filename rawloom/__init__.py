"""Raw-file intake and profiling on Spark."""

from rawloom.layout import Field, Layout
from rawloom.functions.casting import cast_by_layout, char, date, num
from rawloom.operators.long_values import long_value_counts, top_long_values, unique_long_values
from rawloom.operators.infer import detect_kinds, infer_and_cast, sampled_kinds
from rawloom.operators.profile import (
    column_profile,
    duplicate_rows,
    missing_values,
    numeric_summary,
    profile,
    top_values,
    unique_values,
    value_counts,
)
from rawloom.operators.reconcile import schema_diff, shape_check
from rawloom.operators.profile_state import merged_profile, stream_states, write_state
from rawloom.plans.intake import intake
from rawloom.plans.qc import declared, qc_folder
from rawloom.plans.report import report
from rawloom.session import tune
from rawloom.sources.dataset import read_dataset, write_dataset, write_report
from rawloom.sources.delimited import read_delimited, split_delimited
from rawloom.sources.fixedwidth import read_fixed_width, slice_fixed
from rawloom.sources.layouts import scan_layouts
from rawloom.sources.ledger import file_log, folder_log, remove_superseded
from rawloom.sources.line_index import read_line_slice, slice_blocks, write_line_index
from rawloom.sources.manifest import build_manifest, collisions
from rawloom.streaming.incremental import stream_intake, stream_profiles, stream_rows
from rawloom.streaming.tree import read_tree, stream_tree, tree_files

__all__ = [
    "Field",
    "Layout",
    "build_manifest",
    "cast_by_layout",
    "char",
    "collisions",
    "column_profile",
    "date",
    "declared",
    "detect_kinds",
    "duplicate_rows",
    "file_log",
    "folder_log",
    "infer_and_cast",
    "sampled_kinds",
    "intake",
    "long_value_counts",
    "merged_profile",
    "missing_values",
    "num",
    "numeric_summary",
    "profile",
    "qc_folder",
    "read_dataset",
    "read_delimited",
    "read_fixed_width",
    "read_line_slice",
    "read_tree",
    "remove_superseded",
    "report",
    "scan_layouts",
    "schema_diff",
    "shape_check",
    "slice_blocks",
    "slice_fixed",
    "split_delimited",
    "stream_intake",
    "stream_profiles",
    "stream_rows",
    "stream_states",
    "stream_tree",
    "top_long_values",
    "top_values",
    "tree_files",
    "tune",
    "unique_long_values",
    "unique_values",
    "value_counts",
    "write_dataset",
    "write_line_index",
    "write_report",
    "write_state",
]

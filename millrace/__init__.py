"""Millrace: batch ETL and data-quality building blocks for Spark.

Every public function takes and returns DataFrames (or writes one); the session
is always the frame's own. Nothing here runs a Spark job unless its docstring
says so.
"""

from millrace.operators.asof import join_asof
from millrace.operators.columns import (
    add_audit_columns,
    cast_columns,
    drop_columns,
    fill_nulls,
    filter_rows,
    flatten_column,
    rename_columns,
)
from millrace.operators.dedup import drop_duplicates
from millrace.operators.documents import flatten_document
from millrace.operators.intervals import join_overlapping
from millrace.operators.merge import merge_frames
from millrace.operators.observe import count_rows
from millrace.operators.ordered import number_rows, running_totals, tiles
from millrace.operators.recipe import Recipe
from millrace.operators.rejects import find_problems, read_good, read_rejects, write_split
from millrace.operators.sinks import LoadResult, lay_out_by_curve, publish_stage, remove_old_versions, write_run_date, write_table
from millrace.operators.sql import (
    count_sql_steps,
    run_sql,
    run_sql_file,
    run_sql_steps,
    transform_sql,
)
from millrace.plans.differences import find_differences, write_digests
from millrace.plans.profiles import merge_profiles, profile, read_profiles
from millrace.plans.quality import (
    QualityGateError,
    allowed_values,
    enforce_quality,
    has_columns,
    no_nulls,
    not_empty,
    quality_report,
    quality_reports,
    unique,
    value_range,
)
from millrace.plans.reconcile import (
    ReconciliationError,
    aggregate,
    column_hash,
    enforce_reconciliation,
    reconciliation_report,
    reconciliation_reports,
    row_count,
)
from millrace.sources.files import read_files
from millrace.sources.jdbc import read_jdbc
from millrace.sources.tables import read_run_date, read_target
from millrace.storage import clear_scratch

__all__ = [
    "LoadResult",
    "QualityGateError",
    "Recipe",
    "ReconciliationError",
    "add_audit_columns",
    "aggregate",
    "allowed_values",
    "cast_columns",
    "clear_scratch",
    "column_hash",
    "count_rows",
    "count_sql_steps",
    "drop_columns",
    "drop_duplicates",
    "enforce_quality",
    "enforce_reconciliation",
    "fill_nulls",
    "filter_rows",
    "find_differences",
    "find_problems",
    "flatten_column",
    "flatten_document",
    "has_columns",
    "join_asof",
    "join_overlapping",
    "lay_out_by_curve",
    "merge_frames",
    "merge_profiles",
    "no_nulls",
    "not_empty",
    "number_rows",
    "profile",
    "publish_stage",
    "quality_report",
    "quality_reports",
    "read_files",
    "read_good",
    "read_jdbc",
    "read_profiles",
    "read_rejects",
    "read_run_date",
    "read_target",
    "reconciliation_report",
    "reconciliation_reports",
    "remove_old_versions",
    "rename_columns",
    "row_count",
    "run_sql",
    "run_sql_file",
    "run_sql_steps",
    "running_totals",
    "tiles",
    "transform_sql",
    "unique",
    "value_range",
    "write_digests",
    "write_run_date",
    "write_split",
    "write_table",
]

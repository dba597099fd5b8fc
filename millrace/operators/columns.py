"""Projections, casts, null filling and row filters.

Each function builds one projection for all the columns it touches, so a chain
of them collapses into a single codegen'd Project.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import lenient_cast
from millrace.functions.literals import sql_literal
from millrace.functions.names import Columns, name_key, quoted

log = logging.getLogger(__name__)

# Names and format of the audit columns.
LOADED_AT = "_etl_loaded_at"
BATCH_ID = "_batch_id"
SOURCE_SYSTEM = "_source_system"
BATCH_ID_FORMAT = "%Y%m%d%H%M%S"


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename all columns at once, so two names can be swapped; absent ones are skipped."""
    key = name_key(df.sparkSession)
    new_names = {key(old): new for old, new in mapping.items()}
    names = [new_names.get(key(c), c) for c in df.columns]
    if len({key(n) for n in names}) < len({key(c) for c in df.columns}):
        raise ValueError(f"renaming {dict(mapping)} would give two columns one name: {names}")
    return df.toDF(*names)


def cast_columns(
    df: DataFrame, mapping: Mapping[str, str | T.DataType], strict: bool = False
) -> DataFrame:
    """Cast by type name; absent columns are skipped, unreadable values become NULL.

    ``strict`` fails the job on an unreadable value instead.
    """
    own = Columns(df)
    casts = {}
    for name, target in mapping.items():
        actual = own.find(name)
        if actual is None:
            continue
        if strict:
            casts[actual] = df[quoted(actual)].cast(target)
        else:
            casts[actual] = F.expr(lenient_cast(quoted(actual), df.schema[actual].dataType, target))
    return df.withColumns(casts) if casts else df


def fill_nulls(df: DataFrame, mapping: Mapping[str, Any]) -> DataFrame:
    """Replace NULL (and NaN) by a constant per column; an unknown column raises."""
    return df.fillna(dict(mapping))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns; absent ones are skipped."""
    return df.drop(*columns)


def filter_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    """Keep rows for which the predicate is true; NULL counts as not true."""
    return df.filter(condition)


def add_audit_columns(
    df: DataFrame,
    batch_id: str | None = None,
    source: str | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Add the load time, batch id and, if given, source system as constants.

    The time is fixed when this is called, so every action on the frame and every
    retried task sees the same value. A ``loaded_at`` without a time zone is in
    the session's.
    """
    now = datetime.now(timezone.utc)
    audit = {
        LOADED_AT: F.expr(f"CAST({sql_literal(loaded_at or now)} AS timestamp)"),
        BATCH_ID: F.lit(batch_id or now.strftime(BATCH_ID_FORMAT)),
    }
    if source:
        audit[SOURCE_SYSTEM] = F.lit(source)
    return df.withColumns(audit)


def flatten_column(
    df: DataFrame, column: str, prefix: str | None = None, keys: Sequence[str] | None = None
) -> DataFrame:
    """Turn one struct level, or the given keys of a map, into top-level columns.

    The flattened column is dropped and a part wins over an existing column of
    the same name. A missing column and a map without ``keys`` log a warning; they
    and any other type leave the frame as it is.
    """
    own = Columns(df)
    actual = own.find(column)
    if actual is None:
        log.warning("no column %r to flatten among %s", column, own.names)
        return df
    data_type = df.schema[actual].dataType
    if isinstance(data_type, T.StructType):
        values = {name: f"{quoted(actual)}.{quoted(name)}" for name in data_type.fieldNames()}
    elif isinstance(data_type, T.MapType) and keys:
        values = {k: f"try_element_at({quoted(actual)}, {sql_literal(k)})" for k in keys}
    else:
        if isinstance(data_type, T.MapType):
            log.warning("map column %r needs keys to be flattened", column)
        return df

    parts = {f"{prefix}_{name}" if prefix else name: value for name, value in values.items()}
    arriving = {own.key(name): f"{value} AS {quoted(name)}" for name, value in parts.items()}
    kept = [c for c in own.names if c != actual]
    projected = [arriving.pop(own.key(c), quoted(c)) for c in kept]
    return df.selectExpr(*projected, *arriving.values())

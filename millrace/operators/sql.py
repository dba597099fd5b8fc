"""Spark SQL over a frame bound to a view name."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from millrace.functions.literals import sql_literal
from millrace.operators.observe import count_rows
from millrace.storage import scratch_path


def _temp_view(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        return spark.table(name) if spark.catalog.getTable(name).isTemporary else None
    except AnalysisException:
        return None


@contextmanager
def _bound_view(df: DataFrame, name: str) -> Iterator[None]:
    """Make ``df`` visible under ``name`` while a statement is analyzed.

    The analyzed plan holds the frame itself, so the view can go afterwards. A
    temp view the caller had under that name comes back. Views belong to the
    session, so threads that share one must not bind the same name at once.
    """
    spark = df.sparkSession
    previous = _temp_view(spark, name)
    df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        if previous is None:
            spark.catalog.dropTempView(name)
        else:
            previous.createOrReplaceTempView(name)


def run_sql(
    df: DataFrame, text: str, view: str = "src", params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Run one statement with ``df`` visible as ``view``.

    ``params`` are bound, not pasted in: write ``status = :p``, and for a table or
    column name ``IDENTIFIER(:t)``.
    """
    with _bound_view(df, view):
        return df.sparkSession.sql(text, args=dict(params or {}))


def run_sql_file(
    df: DataFrame, path: str | Path, view: str = "src", params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Like :func:`run_sql`, with the statement read from a driver-side text file."""
    file = Path(path)
    if not file.is_file():
        raise FileNotFoundError(f"no SQL file at {file}")
    return run_sql(df, file.read_text(encoding="utf-8"), view, params)


def run_sql_steps(
    df: DataFrame,
    steps: Sequence[tuple[str, str]],
    view: str = "src",
    params: Mapping[str, Any] | None = None,
    counts: dict[str, Observation] | None = None,
) -> DataFrame:
    """Run named statements in order; each sees the input and every earlier step.

    The result stays lazy: no step runs on its own. Pass a dict as ``counts`` to
    get an observation per step for the log, filled by the first action on the
    result; each one stops filters of later steps from moving below it. Exact
    counts come from :func:`count_sql_steps`.
    """
    return _step_frames(df, steps, view, params, counts)[-1]


def count_sql_steps(
    df: DataFrame,
    steps: Sequence[tuple[str, str]],
    view: str = "src",
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """``(step, n_rows)`` for every step, as one lazy frame.

    The input is written to scratch once, when this is called, and every step counts
    from there by the columns it needs: the source is scanned once, and a task that is
    repeated counts nothing twice.
    """
    place = scratch_path(df.sparkSession, "steps")
    df.write.parquet(place)
    df = df.sparkSession.read.schema(df.schema).parquet(place)
    frames = _step_frames(df, steps, view, params)
    counted = [
        frame.selectExpr(f"{sql_literal(name)} AS step", "count(1) AS n_rows")
        for frame, (name, _) in zip(frames, steps)
    ]
    return reduce(DataFrame.unionByName, counted)


def _step_frames(
    df: DataFrame,
    steps: Sequence[tuple[str, str]],
    view: str,
    params: Mapping[str, Any] | None,
    counts: dict[str, Observation] | None = None,
) -> list[DataFrame]:
    if not steps:
        raise ValueError("give at least one (name, statement) step")
    frames = []
    with ExitStack() as views:
        views.enter_context(_bound_view(df, view))
        for name, text in steps:
            frame = df.sparkSession.sql(text, args=dict(params or {}))
            if counts is not None:
                frame, counts[name] = count_rows(frame, f"step {name}")
            views.enter_context(_bound_view(frame, name))
            frames.append(frame)
    return frames


def transform_sql(
    df: DataFrame,
    sql: str | None = None,
    sql_file: str | Path | None = None,
    steps: Sequence[tuple[str, str]] | None = None,
    view: str = "src",
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """One entry for the three forms; steps win over a file, a file over a text."""
    if steps:
        return run_sql_steps(df, steps, view, params)
    if sql_file:
        return run_sql_file(df, sql_file, view, params)
    if sql:
        return run_sql(df, sql, view, params)
    raise ValueError("give one of sql, sql_file or steps")

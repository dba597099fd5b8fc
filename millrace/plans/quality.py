"""Data-quality checks evaluated together and reported as a DataFrame.

All checks that look at one row at a time share a single aggregation over the
frame, however many there are. Only a check that must group by a key (``unique``,
``allowed_values`` against a table) adds a pass of its own. Building a report
runs no job; :func:`enforce_quality` runs one.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.literals import sql_literal
from millrace.functions.names import Columns, quoted

log = logging.getLogger(__name__)

# Fixed value: the share of NULLs a column may have unless the caller says otherwise.
NULL_THRESHOLD = 0.05

ROWS = "n_rows"
MEASURE = "measure"


class QualityGateError(RuntimeError):
    """At least one check of a table failed."""


@dataclass(frozen=True)
class Verdict:
    """SQL expressions over the row count and a measure that fill one report row."""

    passed: str
    observed: str
    threshold: float = 0.0
    details: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Check:
    """A rule: what to measure on a frame and how to judge the measure.

    ``violation`` gives a per-row SQL predicate whose hits the shared aggregation
    counts; ``totals`` a one-row frame ``(n_rows, measure)`` for a check that needs
    its own pass; a check with neither is decided from the schema alone. ``judge``
    takes the name of the measure's column.
    """

    name: str
    columns: tuple[str, ...]
    violation: Callable[[Columns], str] | None = None
    totals: Callable[[DataFrame, Columns], DataFrame] | None = None
    judge: Callable[[str], Verdict] | None = None


def not_empty(table: str = "") -> Check:
    """The frame has at least one row."""
    details = {"row_count": ROWS, "table": sql_literal(table)}
    return Check(
        name="not_empty",
        columns=(),
        violation=lambda own: "false",
        judge=lambda _: Verdict(f"{ROWS} > 0", ROWS, details=details),
    )


def no_nulls(columns: Sequence[str], threshold: float = NULL_THRESHOLD) -> list[Check]:
    """Per column, the share of NULLs is at most ``threshold``; an empty frame passes."""
    limit = sql_literal(float(threshold))

    def judge(nulls: str) -> Verdict:
        rate = f"coalesce(try_divide({nulls}, {ROWS}), 0D)"
        details = {"null_count": nulls, "null_rate": f"round({rate}, 4)", "threshold": limit}
        return Verdict(f"{rate} <= {limit}", rate, threshold, details)

    return [
        Check(
            name=f"no_nulls:{c}",
            columns=(c,),
            violation=lambda own, c=c: f"{quoted(own.find(c))} IS NULL",
            judge=judge,
        )
        for c in columns
    ]


def unique(columns: Sequence[str]) -> Check:
    """No two rows share a key; NULL is a key value like any other."""

    def totals(df: DataFrame, own: Columns) -> DataFrame:
        per_key = df.groupBy(*map(quoted, own.require(columns))).count()
        return per_key.selectExpr(f"coalesce(sum(count), 0) AS {ROWS}", f"count(1) AS {MEASURE}")

    def judge(distinct: str) -> Verdict:
        duplicates = f"{ROWS} - {distinct}"
        details = {"total_rows": ROWS, "distinct_rows": distinct, "duplicates": duplicates}
        return Verdict(f"{duplicates} = 0", duplicates, details=details)

    return Check(f"unique:{','.join(columns)}", tuple(columns), totals=totals, judge=judge)


def value_range(column: str, min_value: Any = None, max_value: Any = None) -> Check:
    """No value below ``min_value`` or above ``max_value``; NULL passes.

    NaN sorts above every number: it passes a lower bound and fails an upper one.
    """
    bounds = {"min": min_value, "max": max_value}
    shown = {k: sql_literal(None if v is None else str(v)) for k, v in bounds.items()}

    def violation(own: Columns) -> str:
        value = quoted(own.find(column))
        low = f"{value} < {sql_literal(min_value)}" if min_value is not None else "false"
        high = f"{value} > {sql_literal(max_value)}" if max_value is not None else "false"
        return f"{low} OR {high}"

    return Check(
        name=f"value_range:{column}",
        columns=(column,),
        violation=violation,
        judge=lambda n: Verdict(f"{n} = 0", n, details={"out_of_range_count": n, **shown}),
    )


def allowed_values(column: str, allowed: Sequence[Any] | DataFrame) -> Check:
    """No value outside ``allowed``; NULL passes and a NULL in the list is ignored.

    ``allowed`` may be a one-column frame for lists too long to write down. The
    checked column is then reduced to its distinct values with counts before the
    join, so the join never carries a hot value twice, and Spark broadcasts the
    list only if it measures small enough.
    """
    if isinstance(allowed, DataFrame):
        shown = f"table({', '.join(allowed.columns)})"
        how = {"totals": lambda df, own: _unlisted(df, quoted(own.find(column)), allowed)}
    else:
        shown = str(list(allowed))
        listed = ", ".join(sql_literal(v) for v in allowed if v is not None)
        rule = f"NOT IN ({listed})" if listed else "IS NOT NULL"
        how = {"violation": lambda own: f"{quoted(own.find(column))} {rule}"}

    return Check(
        name=f"allowed_values:{column}",
        columns=(column,),
        judge=lambda n: Verdict(
            f"{n} = 0", n, details={"violation_count": n, "allowed": sql_literal(shown)}
        ),
        **how,
    )


def has_columns(expected: Sequence[str]) -> Check:
    """All expected names are present; other columns and all types are ignored."""
    return Check("schema_check", tuple(expected))


def quality_report(df: DataFrame, checks: Sequence[Check | Sequence[Check]]) -> DataFrame:
    """One row per check: number, name, verdict, observed value, threshold, details.

    A check on a column the frame does not have is a failed row, not an error.
    """
    flat = [c for item in checks for c in (item if isinstance(item, (list, tuple)) else [item])]
    if not flat:
        raise ValueError("give at least one check")

    own = Columns(df)
    verdicts, measures, parts = [], [], []
    for number, check in enumerate(flat, start=1):
        missing = [c for c in check.columns if own.find(c) is None]
        if check.violation is None and check.totals is None:
            verdicts.append(_schema_verdict(number, check, own, missing))
        elif missing:
            verdicts.append(_missing_verdict(number, check, missing))
        elif check.violation is not None:
            measure = f"m{number}"
            measures.append(f"count_if({check.violation(own)}) AS {measure}")
            verdicts.append(_report_row(number, check.name, check.judge(measure)))
        else:
            verdict = _report_row(number, check.name, check.judge(MEASURE))
            parts.append(check.totals(df, own).selectExpr(f"inline(array({verdict}))"))

    if verdicts:
        if measures:
            base = df.selectExpr(f"count(1) AS {ROWS}", *measures)
        else:
            base = df.sparkSession.range(0, 1, 1, 1)
        parts.insert(0, base.selectExpr(f"inline(array({', '.join(verdicts)}))"))
    return reduce(DataFrame.unionByName, parts)


def quality_reports(suites: Sequence[tuple[DataFrame, Sequence[Check | Sequence[Check]]]]) -> DataFrame:
    """The reports of several frames as one, numbered on from frame to frame; one gate can judge it."""
    reports, done = [], 0
    for df, checks in suites:
        reports.append(quality_report(df, checks).withColumn("check_no", F.col("check_no") + done))
        done += sum(len(item) if isinstance(item, (list, tuple)) else 1 for item in checks)
    if not reports:
        raise ValueError("give at least one frame")
    return reduce(DataFrame.unionByName, reports)


def enforce_quality(report: DataFrame, table: str, fail_on_error: bool = True) -> list[Row]:
    """Run the report, log each verdict, and raise if any check failed.

    Collects one row per check. Returns the rows in check order.
    """
    rows = sorted(report.collect(), key=lambda r: r.check_no)
    for row in rows:
        log.info("quality %s: %s", table, describe_check(row))
    failed = [row for row in rows if not row.passed]
    if failed and fail_on_error:
        lines = "\n".join(describe_check(row) for row in failed)
        raise QualityGateError(f"{len(failed)} quality check(s) failed on {table}:\n{lines}")
    return rows


def describe_check(row: Row) -> str:
    """A one-line text for a report row."""
    return f"{'PASS' if row.passed else 'FAIL'} [{row.check_name}] {dict(row.details)}"


def _unlisted(df: DataFrame, value: str, allowed: DataFrame) -> DataFrame:
    listed = allowed.toDF("value").where("value IS NOT NULL").distinct().selectExpr("value", "true AS listed")
    counts = df.selectExpr(f"{value} AS value").groupBy("value").count()
    return counts.join(listed, "value", "left").selectExpr(
        f"coalesce(sum(count), 0) AS {ROWS}",
        f"coalesce(sum(count) FILTER (WHERE value IS NOT NULL AND listed IS NULL), 0) AS {MEASURE}",
    )


def _missing_verdict(number: int, check: Check, missing: list[str]) -> str:
    details = {"error": sql_literal(f"missing column: {', '.join(missing)}")}
    return _report_row(number, check.name, Verdict("false", "NULL", None, details))


def _schema_verdict(number: int, check: Check, own: Columns, missing: list[str]) -> str:
    details = {
        "missing_columns": sql_literal(",".join(missing)),
        "actual_columns": sql_literal(",".join(own.names)),
    }
    verdict = Verdict(sql_literal(not missing), str(len(missing)), details=details)
    return _report_row(number, check.name, verdict)


def _report_row(number: int, name: str, verdict: Verdict) -> str:
    entries = ", ".join(f"{sql_literal(k)}, string({v})" for k, v in verdict.details.items())
    return (
        f"struct({number} AS check_no, {sql_literal(name)} AS check_name, {verdict.passed} AS passed, "
        f"double({verdict.observed}) AS observed, double({sql_literal(verdict.threshold)}) AS threshold, "
        f"map({entries}) AS details)"
    )

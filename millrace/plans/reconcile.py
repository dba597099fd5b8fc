"""Source-to-target reconciliation reported as a DataFrame.

Each side is aggregated once for all measures together; only the two one-row
results meet. Building a report runs no job; :func:`enforce_reconciliation` runs
one.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.digests import bag_digest, digest_as_double
from millrace.functions.literals import sql_literal
from millrace.functions.names import Columns, quoted

log = logging.getLogger(__name__)

# Fixed value: the relative difference allowed unless the caller says otherwise.
TOLERANCE = 0.001

# Aggregate functions a caller may ask for.
AGGREGATES = ("sum", "count", "avg")


class ReconciliationError(RuntimeError):
    """Source and target differ by more than a check allows."""


@dataclass(frozen=True)
class Measure:
    """An aggregate computed on both sides, and how the two results compare.

    ``compute`` gives the aggregate as SQL; ``shown`` and ``variance`` are SQL over
    its results.
    """

    name: str
    columns: tuple[str, ...]
    compute: Callable[[Columns], str]
    tolerance: float
    shown: Callable[[str], str] = lambda value: value
    variance: Callable[[str, str], str] = lambda source, target: _relative_gap(source, target)
    same_type: bool = False


def row_count(tolerance: float = TOLERANCE) -> Measure:
    """The number of rows."""
    return Measure("row_count", (), lambda own: "double(count(1))", tolerance)


def aggregate(column: str, function: str = "sum", tolerance: float = TOLERANCE) -> Measure:
    """The sum, count of non-NULL values or average of a column; NULL counts as 0.

    Decimals stay decimal inside the aggregate and narrow to double only for the
    comparison.
    """
    if function not in AGGREGATES:
        raise ValueError(f"cannot reconcile by {function!r}; known: {', '.join(AGGREGATES)}")

    def compute(own: Columns) -> str:
        return f"coalesce(double({function}({quoted(own.find(column))})), 0D)"

    return Measure(f"{function}:{column}", (column,), compute, tolerance)


def column_hash(columns: Sequence[str]) -> list[Measure]:
    """Per column, both sides hold the same values equally often, in any order.

    The variance is 0 when the digests agree and 1 when they do not.
    """
    return [
        Measure(
            name=f"hash:{c}",
            columns=(c,),
            compute=lambda own, c=c: bag_digest(quoted(own.find(c))),
            tolerance=0.0,
            shown=digest_as_double,
            variance=lambda source, target: f"if({source} = {target}, 0D, 1D)",
            same_type=True,
        )
        for c in columns
    ]


def reconciliation_report(
    source: DataFrame, target: DataFrame, measures: Sequence[Measure | Sequence[Measure]]
) -> DataFrame:
    """One row per measure: number, name, verdict, both values, variance, tolerance."""
    flat = [m for item in measures for m in (item if isinstance(item, (list, tuple)) else [item])]
    if not flat:
        raise ValueError("give at least one measure")
    own = {"source": Columns(source), "target": Columns(target)}
    for measure in flat:
        names = [own[side].require(measure.columns) for side in own]
        if measure.same_type:
            _require_same_type(source, target, *[n[0] for n in names])

    both = [
        df.selectExpr(
            f"'{side}' AS side", *[f"{m.compute(own[side])} AS m{i}" for i, m in enumerate(flat, start=1)]
        )
        for side, df in (("source", source), ("target", target))
    ]
    picked = [
        f"max(m{i}) FILTER (WHERE side = '{side}') AS {side}_{i}"
        for side in own
        for i in range(1, len(flat) + 1)
    ]
    rows = [_report_row(i, m, f"source_{i}", f"target_{i}") for i, m in enumerate(flat, start=1)]
    return both[0].unionByName(both[1]).selectExpr(*picked).selectExpr(f"inline(array({', '.join(rows)}))")


def reconciliation_reports(
    pairs: Sequence[tuple[DataFrame, DataFrame, Sequence[Measure | Sequence[Measure]]]],
) -> DataFrame:
    """The reports of several (source, target, measures) as one, numbered on from pair to pair."""
    reports, done = [], 0
    for source, target, measures in pairs:
        report = reconciliation_report(source, target, measures)
        reports.append(report.withColumn("check_no", F.col("check_no") + done))
        done += sum(len(item) if isinstance(item, (list, tuple)) else 1 for item in measures)
    if not reports:
        raise ValueError("give at least one pair")
    return reduce(DataFrame.unionByName, reports)


def enforce_reconciliation(report: DataFrame, table: str, fail_on_error: bool = True) -> list[Row]:
    """Run the report, log each verdict, and raise if any measure is off.

    Collects one row per measure. Returns the rows in measure order.
    """
    rows = sorted(report.collect(), key=lambda r: r.check_no)
    for row in rows:
        log.info("reconcile %s: %s", table, describe_measure(row))
    failed = [row for row in rows if not row.passed]
    if failed and fail_on_error:
        lines = "\n".join(describe_measure(row) for row in failed)
        raise ReconciliationError(f"{len(failed)} reconciliation check(s) failed on {table}:\n{lines}")
    return rows


def describe_measure(row: Row) -> str:
    """A one-line text for a report row."""
    return (
        f"{'PASS' if row.passed else 'FAIL'} [{row.check_name}] source {row.source_value:,.2f}, "
        f"target {row.target_value:,.2f}, off by {row.variance_pct:.4%} of at most {row.tolerance:.4%}"
    )


def _require_same_type(source: DataFrame, target: DataFrame, in_source: str, in_target: str) -> None:
    left, right = source.schema[in_source].dataType, target.schema[in_target].dataType
    if left != right:
        raise ValueError(f"{in_source!r} is {left} on one side and {right} on the other; cast one of them")


def _relative_gap(source: str, target: str) -> str:
    """``|s - t| / |s|``; from a zero source, 0 if the target is zero too, else infinite."""
    return (
        f"CASE WHEN {source} = 0 THEN if({target} = 0, 0D, double('Infinity')) "
        f"ELSE abs({source} - {target}) / abs({source}) END"
    )


def _report_row(number: int, measure: Measure, source: str, target: str) -> str:
    variance = measure.variance(source, target)
    tolerance = sql_literal(float(measure.tolerance))
    return (
        f"struct({number} AS check_no, {sql_literal(measure.name)} AS check_name, "
        f"{variance} <= {tolerance} AS passed, {measure.shown(source)} AS source_value, "
        f"{measure.shown(target)} AS target_value, {variance} AS variance_pct, {tolerance} AS tolerance)"
    )

"""The daily orders run: land, curate, check, merge, reconcile.

The stages hand over through Parquet, so each can be repeated on its own and no
stage recomputes an earlier one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.partitions import in_partitions, partition_tuples
from millrace.operators.columns import BATCH_ID, LOADED_AT, SOURCE_SYSTEM
from millrace.operators.recipe import Recipe
from millrace.operators.sinks import LoadResult, write_run_date, write_table
from millrace.operators.sql import run_sql_steps
from millrace.plans import quality as q
from millrace.plans import reconcile as r
from millrace.sources.files import read_files
from millrace.sources.tables import read_run_date, read_target

# Column names, types, fill values and tiers of the curated orders.
RENAMES = {"order_id": "id", "cust_id": "customer_id"}
CASTS = {"amount": "double", "order_date": "date", "qty": "integer"}
FILLS = {"status": "PENDING", "amount": 0.0}
SOURCE_NAME = "orders_csv"
REQUIRED_COLUMNS = ("id", "customer_id", "order_date", "amount", "status")
KEY_COLUMNS = ("id", "customer_id", "order_date")
CLUSTER_COLUMNS = ("customer_id", "status")
TIERS = {"HIGH": 1000, "MEDIUM": 100}
LOWEST_TIER = "LOW"
CURATED_COLUMNS = (
    "id", "customer_id", "order_date", "amount", "qty", "unit_price", "status", "amount_tier",
    LOADED_AT, BATCH_ID, SOURCE_SYSTEM,
)

TIER_SQL = " ".join(f"WHEN amount >= :{tier} THEN '{tier}'" for tier in TIERS)
ENRICH_STEPS = [
    (
        "priced",
        "SELECT *, round(amount / nullif(qty, 0), 2) AS unit_price, "
        f"CASE {TIER_SQL} ELSE '{LOWEST_TIER}' END AS amount_tier FROM src",
    ),
    ("dated", f"SELECT {', '.join(CURATED_COLUMNS)} FROM priced WHERE order_date IS NOT NULL"),
]

# Partition columns of the target by grain; a date grain coarser than the day is
# derived, because a directory per day is too many for a small history.
GRAINS = {"day": "order_date", "month": "order_month", "year": "order_year"}


@dataclass(frozen=True)
class OrdersRun:
    """Counts and verdicts of one run."""

    run_date: str
    raw_rows: int
    curated_rows: int
    load: LoadResult
    quality: list[Row]
    reconciliation: list[Row]


def clean_orders(
    run_date: str,
    source: str = SOURCE_NAME,
    loaded_at: datetime | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> Recipe:
    """Raw orders to typed, filled, deduplicated orders with audit columns.

    ``order_by`` decides which copy of an id survives; without it any may.
    """
    return (
        Recipe("orders_clean")
        .rename(RENAMES)
        .cast(CASTS)
        .fill(FILLS)
        .dedup(["id"], order_by)
        .audit(batch_id=run_date, source=source, loaded_at=loaded_at)
    )


def enrich_orders(clean: DataFrame) -> DataFrame:
    """Unit price and amount tier; orders without a date are left out."""
    return run_sql_steps(clean, ENRICH_STEPS, params=TIERS)


def orders_checks(table: str) -> list:
    """What curated orders must satisfy before they are loaded."""
    return [
        q.not_empty(table),
        q.has_columns(REQUIRED_COLUMNS),
        q.no_nulls(KEY_COLUMNS),
        q.unique(["id"]),
        q.value_range("amount", min_value=0),
    ]


def with_grain(orders: DataFrame, grain: str) -> DataFrame:
    """Add the partition column of a month or year grain."""
    if grain == "month":
        return orders.withColumn(GRAINS[grain], F.trunc("order_date", "month"))
    if grain == "year":
        return orders.withColumn(GRAINS[grain], F.year("order_date"))
    if grain == "day":
        return orders
    raise ValueError(f"unknown grain {grain!r}; known: {', '.join(GRAINS)}")


def load_orders(batch: DataFrame, target: str, grain: str = "day") -> LoadResult:
    """Merge curated orders, as read from their zone, into the target by id."""
    return write_table(
        with_grain(batch, grain),
        target,
        mode="merge",
        keys=["id"],
        partition_by=[GRAINS[grain]],
        cluster_by=CLUSTER_COLUMNS,
        at_rest=True,
    )


def reconcile_orders(batch: DataFrame, target: DataFrame, grain: str = "day") -> DataFrame:
    """Compare the batch with the target rows of the same ids.

    The target also holds orders of earlier days, which the batch says nothing
    about. A loaded order sits in the partition of its own date, so only the
    partitions of the batch's dates are read.
    """
    column = GRAINS[grain]
    if column in target.columns:
        dates = with_grain(batch, grain).select(F.col(column).cast(target.schema[column].dataType))
        target = in_partitions(target, partition_tuples(dates))
    loaded = target.select("id", "amount").join(batch.select("id"), "id", "left_semi")
    return r.reconciliation_report(batch, loaded, [r.row_count(), r.aggregate("amount", "sum")])


def run_orders(
    spark: SparkSession,
    run_date: str,
    raw_path: str,
    zone_root: str,
    target: str,
    raw_format: str = "csv",
    raw_schema: StructType | str | None = None,
    raw_options: Mapping[str, str] | None = None,
    grain: str = "day",
    loaded_at: datetime | None = None,
    order_by: Sequence[str | Column] | None = None,
    fail_on_error: bool = True,
) -> OrdersRun:
    """One logical date from raw files to the reconciled target.

    A failed quality check stops the run before anything is loaded; a failed
    reconciliation fails it afterwards. Give ``raw_schema`` for large CSV or JSON
    input: inferring one reads the files twice.
    """
    staging, curated = f"{zone_root}/staging/orders", f"{zone_root}/curated/orders"

    raw = read_files(spark, raw_path, raw_format, raw_schema, raw_options)
    raw_rows = write_run_date(raw, staging, run_date)

    landed = read_run_date(spark, staging, run_date, schema=raw.schema).drop("run_date")
    clean = clean_orders(run_date, loaded_at=loaded_at, order_by=order_by).apply(landed)
    enriched = enrich_orders(clean)
    curated_rows = write_run_date(enriched, curated, run_date)

    batch = read_run_date(spark, curated, run_date, schema=enriched.schema).drop("run_date")
    report = q.quality_report(batch, orders_checks("orders_curated"))
    verdicts = q.enforce_quality(report, "orders_curated", fail_on_error)

    load = load_orders(batch, target, grain)
    comparison = reconcile_orders(batch, read_target(spark, target), grain)
    gaps = r.enforce_reconciliation(comparison, "orders_curated", fail_on_error)
    return OrdersRun(run_date, raw_rows, curated_rows, load, verdicts, gaps)

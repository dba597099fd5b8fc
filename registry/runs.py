"""The daily orders run, end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from millrace.plans.orders import GRAINS, OrdersRun, run_orders
from millrace.storage import scratch_path
from registry import query
from registry.inputs import BATCH_START, HISTORY_END, LOADED_AT, RAW_ORDERS_SQL, day, raw_orders

RAW_SCHEMA = "order_id bigint, cust_id bigint, order_date string, amount string, qty string, status string"


def _curated_sql(amount: str, where: str, run_date: str) -> str:
    return f"""
SELECT order_id AS id, cust_id AS customer_id, order_date, amount, qty,
       round(amount / nullif(qty, 0), 2) AS unit_price, status,
       CASE WHEN amount >= 1000 THEN 'HIGH' WHEN amount >= 100 THEN 'MEDIUM' ELSE 'LOW' END AS amount_tier,
       '{run_date}' AS _batch_id, 'orders_csv' AS _source_system
FROM (SELECT order_id, cust_id, order_date, qty, coalesce({amount}, 0.0) AS amount,
             coalesce(status, 'PENDING') AS status FROM ({RAW_ORDERS_SQL}) WHERE {where})"""


@query(
    _curated_sql("amount", f"order_date < '{BATCH_START}'", "2024-01-01")
    + " UNION ALL "
    + _curated_sql("amount + 10", f"order_date >= '{BATCH_START}'", "2024-01-02")
)
def orders_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of CSV deliveries, every order delivered twice, merged into one target.

    The second day brings 1998 again, with higher amounts, and everything after it.
    """
    root = scratch_path(spark, "orders_run")
    raw = raw_orders(spark, sf_dir)
    _deliver(raw.where(F.col("order_date") < HISTORY_END), f"{root}/raw/2024-01-01")
    corrected = raw.withColumn("amount", F.col("amount") + 10)
    _deliver(corrected.where(F.col("order_date") >= BATCH_START), f"{root}/raw/2024-01-02")
    for run_date in ("2024-01-01", "2024-01-02"):
        _run(spark, root, run_date)
    target = m.read_target(spark, f"{root}/orders_curated")
    return target.withColumn("order_date", day("order_date")).drop("_etl_loaded_at", GRAINS["year"])


@query(f"""
WITH raw AS ({RAW_ORDERS_SQL})
SELECT 'raw_rows' AS metric, 2 * count(*) AS n FROM raw
UNION ALL SELECT 'curated_rows', count(DISTINCT order_id) FROM raw
UNION ALL SELECT 'inserted', count(DISTINCT order_id) FROM raw
UNION ALL SELECT 'updated', 0
UNION ALL SELECT 'failed_checks', 0""")
def orders_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "orders_run")
    _deliver(raw_orders(spark, sf_dir), f"{root}/raw/2024-01-01")
    done = _run(spark, root, "2024-01-01")
    failed = [row for row in (*done.quality, *done.reconciliation) if not row.passed]
    rows = [
        ("raw_rows", done.raw_rows),
        ("curated_rows", done.curated_rows),
        ("inserted", done.load.inserted),
        ("updated", done.load.updated),
        ("failed_checks", len(failed)),
    ]
    return spark.createDataFrame(rows, "metric string, n bigint")


@query(
    _curated_sql("amount", f"order_date < '{BATCH_START}'", "2024-01-01")
    + " UNION ALL "
    + _curated_sql("amount + 10", f"order_date >= '{BATCH_START}'", "2024-01-02")
)
def orders_daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two days into a table by month; copies of an order differ, and the dearest counts."""
    root, name = scratch_path(spark, "orders_table_run"), f"orders_curated_{uuid.uuid4().hex}"
    raw = raw_orders(spark, sf_dir)
    cheaper = raw.withColumns({"amount": F.col("amount") - 1000, "status": F.lit("F")})
    corrected = raw.withColumn("amount", F.col("amount") + 10)
    _write_csv(raw.where(F.col("order_date") < HISTORY_END), cheaper.where(F.col("order_date") < HISTORY_END), f"{root}/raw/2024-01-01")
    since = F.col("order_date") >= BATCH_START
    _write_csv(corrected.where(since), cheaper.where(since), f"{root}/raw/2024-01-02")
    best = [F.desc("amount"), F.desc(F.col("status") == "O"), F.desc(F.col("status") == "PENDING")]
    for run_date in ("2024-01-01", "2024-01-02"):
        _run(spark, root, run_date, name, "month", best)
    target = m.read_target(spark, name)
    return target.withColumn("order_date", day("order_date")).drop("_etl_loaded_at", GRAINS["month"])


def _deliver(raw: DataFrame, path: str) -> None:
    _write_csv(raw, raw, path)


def _write_csv(first: DataFrame, second: DataFrame, path: str) -> None:
    first.unionByName(second).write.csv(path, header=True, nullValue="NULL")


def _run(
    spark: SparkSession, root: str, run_date: str, target: str | None = None, grain: str = "year", order_by: list | None = None
) -> OrdersRun:
    return run_orders(
        spark,
        run_date,
        raw_path=f"{root}/raw/{run_date}",
        zone_root=root,
        target=target or f"{root}/orders_curated",
        raw_schema=RAW_SCHEMA,
        grain=grain,
        loaded_at=LOADED_AT,
        order_by=order_by,
    )

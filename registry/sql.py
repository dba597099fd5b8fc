"""The Spark SQL surface: one statement, a file, named steps, bound parameters.

Joins, windows, grouping sets, set operations and ordering reach Spark through
the same door; one query each shows that they do.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import millrace as m
from millrace.plans.orders import enrich_orders
from registry import query
from registry.inputs import LOADED_AT, LOADED_AT_TEXT, RAW_ORDERS_SQL, day, raw_orders, second, table

STEPS = [
    ("positive", "SELECT * FROM src WHERE amount > 100000"),
    ("marked", "SELECT *, 'run-1' AS run FROM positive"),
    ("per_status", "SELECT status, run, count(*) AS n, round(sum(amount), 2) AS total FROM marked GROUP BY status, run"),
]


@query(f"SELECT * FROM ({RAW_ORDERS_SQL}) WHERE amount > 250000")
def sql_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_sql(raw_orders(spark, sf_dir), "SELECT * FROM src WHERE amount > 250000")


@query(f"""
SELECT order_id, cust_id, order_date, amount, CASE WHEN amount >= 300000 THEN 'HIGH' ELSE 'LOW' END AS tier
FROM ({RAW_ORDERS_SQL}) WHERE amount IS NOT NULL""")
def sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = Path(__file__).with_name("enriched_orders.sql")
    return m.run_sql_file(raw_orders(spark, sf_dir), file, params={"high": 300000})


@query(f"""
WITH src AS ({RAW_ORDERS_SQL}), positive AS ({STEPS[0][1]}), marked AS ({STEPS[1][1]})
{STEPS[2][1]}""")
def sql_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_sql_steps(raw_orders(spark, sf_dir), STEPS)


@query(f"""
WITH src AS ({RAW_ORDERS_SQL}), positive AS ({STEPS[0][1]}), marked AS ({STEPS[1][1]}),
per_status AS ({STEPS[2][1]})
SELECT 'positive' AS step, count(*) AS n_rows FROM positive
UNION ALL SELECT 'marked', count(*) FROM marked
UNION ALL SELECT 'per_status', count(*) FROM per_status""")
def sql_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per step, in one job."""
    return m.count_sql_steps(raw_orders(spark, sf_dir), STEPS)


@query(f"SELECT * FROM ({RAW_ORDERS_SQL}) WHERE status = 'O' AND amount >= 200000")
def sql_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT * FROM IDENTIFIER(:source) WHERE status = :status AND amount >= :low"
    return m.run_sql(
        raw_orders(spark, sf_dir), text, params={"source": "src", "status": "O", "low": 200000}
    )


@query(f"""
SELECT cust_id, round(sum(amount), 2) AS total, count(*) AS n FROM ({RAW_ORDERS_SQL}) GROUP BY cust_id""")
def sql_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_sql(
        raw_orders(spark, sf_dir),
        "SELECT cust_id, round(sum(amount), 2) AS total, count(*) AS n FROM src GROUP BY cust_id",
    )


@query(f"""
SELECT order_id AS id, cust_id AS customer_id, order_date, amount, qty,
       round(amount / nullif(qty, 0), 2) AS unit_price, status,
       CASE WHEN amount >= 1000 THEN 'HIGH' WHEN amount >= 100 THEN 'MEDIUM' ELSE 'LOW' END AS amount_tier,
       '{LOADED_AT_TEXT}' AS _etl_loaded_at, '2024-01-02' AS _batch_id, 'orders_csv' AS _source_system
FROM ({RAW_ORDERS_SQL}) WHERE order_date IS NOT NULL""")
def orders_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection, guarded division, tiering and a not-null filter; amounts stay unfilled."""
    recipe = (
        m.Recipe("orders")
        .rename({"order_id": "id", "cust_id": "customer_id"})
        .cast({"order_date": "date"})
        .audit("2024-01-02", "orders_csv", LOADED_AT)
    )
    enriched = enrich_orders(recipe.apply(raw_orders(spark, sf_dir)))
    return enriched.withColumns({"order_date": day("order_date"), "_etl_loaded_at": second("_etl_loaded_at")})


JOIN = """
SELECT c.c_mktsegment AS segment, o.o_orderstatus AS status, count(*) AS n, round(sum(o.o_totalprice), 2) AS total
FROM {orders} o JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY c.c_mktsegment, o.o_orderstatus"""


@query(JOIN.format(orders="orders"))
def sql_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join to a second frame that the caller registered as a view."""
    return m.run_sql_steps(
        table(spark, sf_dir, "orders"),
        [("customer", f"SELECT * FROM parquet.`{sf_dir}/customer.parquet`"), ("joined", JOIN.format(orders="src"))],
    )


MONTH = "PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate, o_orderkey"
WINDOW = f"""
SELECT o_orderkey, o_custkey, CAST(row_number() OVER ({MONTH}) AS INTEGER) AS nth,
       round(sum(o_totalprice) OVER ({MONTH} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS last_three
FROM {{orders}}"""


@query(WINDOW.format(orders="orders"))
def sql_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows within a customer's month, so that a large customer spreads over many tasks."""
    return m.run_sql(table(spark, sf_dir, "orders"), WINDOW.format(orders="src"))


ROLLUP = """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity,
       count(DISTINCT l_suppkey) AS suppliers
FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)"""


@query(ROLLUP.format(lineitem="lineitem"))
def sql_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_sql(table(spark, sf_dir, "lineitem"), ROLLUP.format(lineitem="src"))


TOPK = "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"


@query(TOPK.format(orders="orders"))
def sql_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_sql(table(spark, sf_dir, "orders"), TOPK.format(orders="src"))


SETOPS = """
SELECT o_custkey AS custkey FROM {orders} WHERE o_orderstatus = 'F'
INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'O'
EXCEPT SELECT o_custkey FROM {orders} WHERE o_totalprice > 480000"""


@query(SETOPS.format(orders="orders"))
def sql_setops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_sql(table(spark, sf_dir, "orders"), SETOPS.format(orders="src"))

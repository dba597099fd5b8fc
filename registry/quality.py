"""Quality reports; each check's SQL counts its violations independently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from registry import query
from registry.inputs import RAW_ORDERS_SQL, raw_orders, table


SUITE = [
    m.not_empty("orders"),
    m.has_columns(["order_id", "cust_id", "order_date", "amount", "status"]),
    m.no_nulls(["order_id", "amount", "absent"]),
    m.unique(["order_id"]),
    m.value_range("amount", min_value=0),
    m.allowed_values("status", ["F", "O"]),
]


def _verdicts(report: DataFrame, *details: str) -> DataFrame:
    return report.select(
        "check_name", "passed", "observed", "threshold", *[F.col("details")[d].alias(d) for d in details]
    )


NOT_EMPTY_SQL = """
SELECT 'not_empty' AS check_name, count(*) > 0 AS passed, CAST(count(*) AS DOUBLE) AS observed,
       CAST(0 AS DOUBLE) AS threshold, CAST(count(*) AS VARCHAR) AS row_count
FROM orders"""


@query(NOT_EMPTY_SQL)
def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(m.quality_report(table(spark, sf_dir, "orders"), [m.not_empty("orders")]), "row_count")


def _null_rate_sql(column: str, threshold: float) -> str:
    missing = f"sum(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END)"
    return f"""
SELECT 'no_nulls:{column}' AS check_name, {missing} / count(*) <= {threshold} AS passed,
       CAST({missing} / count(*) AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold,
       CAST({missing} AS VARCHAR) AS null_count
FROM ({RAW_ORDERS_SQL})"""


@query(" UNION ALL ".join(_null_rate_sql(c, 0.25) for c in ("order_id", "amount", "status")))
def dq_null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = m.no_nulls(["order_id", "amount", "status"], threshold=0.25)
    return _verdicts(m.quality_report(raw_orders(spark, sf_dir), checks), "null_count")


UNIQUE_SQL = """
SELECT 'unique:{keys}' AS check_name, sum(n) = count(*) AS passed, CAST(sum(n) - count(*) AS DOUBLE) AS observed,
       CAST(0 AS DOUBLE) AS threshold, CAST(sum(n) AS VARCHAR) AS total_rows, CAST(count(*) AS VARCHAR) AS distinct_rows
FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"""


@query(
    UNIQUE_SQL.format(keys="l_orderkey,l_linenumber", table="lineitem")
    + " UNION ALL "
    + UNIQUE_SQL.format(keys="l_returnflag", table="lineitem")
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-column key, and a key whose few values each fill a large part of the table."""
    checks = [m.unique(["l_orderkey", "l_linenumber"]), m.unique(["l_returnflag"])]
    report = m.quality_report(table(spark, sf_dir, "lineitem"), checks)
    return _verdicts(report, "total_rows", "distinct_rows")


def _range_sql(column: str, outside: str) -> str:
    return f"""
SELECT 'value_range:{column}' AS check_name, count(*) FILTER ({outside}) = 0 AS passed,
       CAST(count(*) FILTER ({outside}) AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold
FROM ({RAW_ORDERS_SQL})"""


@query(_range_sql("amount", "amount < 5000 OR amount > 450000") + " UNION ALL " + _range_sql("qty", "qty < 0"))
def dq_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [m.value_range("amount", 5000, 450000), m.value_range("qty", min_value=0)]
    return _verdicts(m.quality_report(raw_orders(spark, sf_dir), checks))


ALLOWED_SQL = """
SELECT 'allowed_values:status' AS check_name, count(*) FILTER (status NOT IN ('F')) = 0 AS passed,
       CAST(count(*) FILTER (status NOT IN ('F')) AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold
FROM ({raw})
UNION ALL
SELECT 'allowed_values:cust_id', count(*) FILTER (cust_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) = 0,
       CAST(count(*) FILTER (cust_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS DOUBLE), 0
FROM ({raw})"""


@query(ALLOWED_SQL.format(raw=RAW_ORDERS_SQL))
def dq_allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short list with a NULL in it, and a list held in another table."""
    solvent = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    checks = [m.allowed_values("status", ["F", None]), m.allowed_values("cust_id", solvent)]
    return _verdicts(m.quality_report(raw_orders(spark, sf_dir), checks))


SCHEMA_SQL = """
WITH own AS (SELECT column_name FROM (DESCRIBE SELECT * FROM orders)),
wanted AS (SELECT unnest(['o_orderkey', 'o_custkey', 'o_currency']) AS name),
missing AS (SELECT name FROM wanted WHERE name NOT IN (SELECT column_name FROM own))
SELECT 'schema_check' AS check_name, count(*) = 0 AS passed, CAST(count(*) AS DOUBLE) AS observed,
       CAST(0 AS DOUBLE) AS threshold, string_agg(name, ',' ORDER BY name) AS missing_columns
FROM missing
UNION ALL
SELECT 'value_range:o_totalprice', count(*) FILTER (o_totalprice < 2000) = 0,
       CAST(count(*) FILTER (o_totalprice < 2000) AS DOUBLE), 0, NULL FROM orders"""


@query(SCHEMA_SQL)
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [m.has_columns(["o_orderkey", "o_custkey", "o_currency"]), m.value_range("o_totalprice", min_value=2000)]
    return _verdicts(m.quality_report(table(spark, sf_dir, "orders"), checks), "missing_columns")


@query(f"""
WITH raw AS ({RAW_ORDERS_SQL}), n AS (
  SELECT count(*) AS n_rows, count(DISTINCT order_id) AS ids,
         count(*) FILTER (order_id IS NULL) AS no_id, count(*) FILTER (amount IS NULL) AS no_amount,
         count(*) FILTER (amount < 0) AS negative, count(*) FILTER (status NOT IN ('F', 'O')) AS odd_status
  FROM raw)
SELECT 1 AS check_no, 'not_empty' AS check_name, n_rows > 0 AS passed, CAST(n_rows AS DOUBLE) AS observed,
       CAST(0 AS DOUBLE) AS threshold FROM n
UNION ALL SELECT 2, 'schema_check', true, 0, 0 FROM n
UNION ALL SELECT 3, 'no_nulls:order_id', no_id / n_rows <= 0.05, no_id / n_rows, 0.05 FROM n
UNION ALL SELECT 4, 'no_nulls:amount', no_amount / n_rows <= 0.05, no_amount / n_rows, 0.05 FROM n
UNION ALL SELECT 5, 'no_nulls:absent', false, NULL, NULL FROM n
UNION ALL SELECT 6, 'unique:order_id', n_rows = ids, n_rows - ids, 0 FROM n
UNION ALL SELECT 7, 'value_range:amount', negative = 0, negative, 0 FROM n
UNION ALL SELECT 8, 'allowed_values:status', odd_status = 0, odd_status, 0 FROM n""")
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight checks in two passes: one scan for the row-local ones, one shuffle for the key."""
    return m.quality_report(raw_orders(spark, sf_dir), SUITE).drop("details")


@query("""
WITH o AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders),
     c AS (SELECT count(*) AS n, count(*) FILTER (c_acctbal < 0) AS low FROM customer)
SELECT 1 AS check_no, 'not_empty' AS check_name, n > 0 AS passed, CAST(n AS DOUBLE) AS observed FROM o
UNION ALL SELECT 2, 'unique:o_orderkey', n = ids, n - ids FROM o
UNION ALL SELECT 3, 'not_empty', n > 0, n FROM c
UNION ALL SELECT 4, 'value_range:c_acctbal', low = 0, low FROM c""")
def dq_suite_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gate over two frames, numbered through."""
    orders = (table(spark, sf_dir, "orders"), [m.not_empty("orders"), m.unique(["o_orderkey"])])
    customers = (table(spark, sf_dir, "customer"), [m.not_empty("customer"), m.value_range("c_acctbal", min_value=0)])
    return m.quality_reports([orders, customers]).select("check_no", "check_name", "passed", "observed")

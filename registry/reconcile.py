"""Reconciliation of all orders with the orders that have line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import millrace as m
from millrace.storage import scratch_path
from registry import query
from registry.inputs import table

TARGET_SQL = "SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"


MEASURES = [
    m.row_count(0.05),
    m.aggregate("o_totalprice"),
    m.aggregate("o_orderstatus", "count"),
    m.aggregate("o_totalprice", "avg", 0.01),
]


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    ordered = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return orders, orders.join(ordered, orders.o_orderkey == ordered.l_orderkey, "left_semi")


def _rounded(report: DataFrame) -> DataFrame:
    return report.selectExpr(
        "check_no", "check_name", "passed", "round(source_value, 2) AS source_value",
        "round(target_value, 2) AS target_value", "round(variance_pct, 9) AS variance_pct", "tolerance",
    )


def _gap_sql(number: int, name: str, expression: str, tolerance: float) -> str:
    return f"""
SELECT {number} AS check_no, '{name}' AS check_name, abs(s - t) / abs(s) <= {tolerance} AS passed,
       round(s, 2) AS source_value, round(t, 2) AS target_value, round(abs(s - t) / abs(s), 9) AS variance_pct,
       CAST({tolerance} AS DOUBLE) AS tolerance
FROM (SELECT CAST((SELECT {expression} FROM orders) AS DOUBLE) AS s,
             CAST((SELECT {expression} FROM ({TARGET_SQL})) AS DOUBLE) AS t)"""


@query(_gap_sql(1, "row_count", "count(*)", 0.001))
def recon_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(m.reconciliation_report(*sides(spark, sf_dir), [m.row_count()]))


@query(_gap_sql(1, "sum:o_totalprice", "sum(o_totalprice)", 0.05))
def recon_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [m.aggregate("o_totalprice", "sum", tolerance=0.05)]
    return _rounded(m.reconciliation_report(*sides(spark, sf_dir), measures))


@query(_gap_sql(1, "count:o_custkey", "count(o_custkey)", 0.001))
def recon_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(m.reconciliation_report(*sides(spark, sf_dir), [m.aggregate("o_custkey", "count")]))


@query(_gap_sql(1, "avg:o_totalprice", "avg(o_totalprice)", 0.01))
def recon_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = [m.aggregate("o_totalprice", "avg", tolerance=0.01)]
    return _rounded(m.reconciliation_report(*sides(spark, sf_dir), measures))


def _hash_sql(column: str, target: str) -> str:
    return f"""
SELECT 'hash:{column}' AS check_name,
       NOT EXISTS (SELECT {column} FROM orders EXCEPT ALL SELECT {column} FROM {target})
       AND NOT EXISTS (SELECT {column} FROM {target} EXCEPT ALL SELECT {column} FROM orders) AS passed"""


STAMPED_SQL = """(
SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 499000 THEN o_totalprice + 0.01 ELSE o_totalprice END
       AS o_totalprice, o_orderstatus, upper(o_orderpriority) AS o_orderpriority
FROM orders)"""


@query(
    " UNION ALL ".join(
        _hash_sql(c, STAMPED_SQL)
        for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    )
)
def recon_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column digests of a copy in another row order, in which the largest prices are off by a cent."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    copy = orders.hint("rebalance").selectExpr(
        "o_orderkey", "o_custkey",
        "CASE WHEN o_totalprice > 499000 THEN o_totalprice + 0.01 ELSE o_totalprice END AS o_totalprice",
        "o_orderstatus", "upper(o_orderpriority) AS o_orderpriority",
    )
    report = m.reconciliation_report(orders, copy, [m.column_hash(columns)])
    return report.select("check_name", "passed")


@query(
    " UNION ALL ".join(
        [
            _gap_sql(1, "row_count", "count(*)", 0.05),
            _gap_sql(2, "sum:o_totalprice", "sum(o_totalprice)", 0.001),
            _gap_sql(3, "count:o_orderstatus", "count(o_orderstatus)", 0.001),
            _gap_sql(4, "avg:o_totalprice", "avg(o_totalprice)", 0.01),
        ]
    )
)
def recon_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four measures from one aggregation per side."""
    return _rounded(m.reconciliation_report(*sides(spark, sf_dir), MEASURES))


@query(
    _gap_sql(1, "row_count", "count(*)", 0.05)
    + " UNION ALL "
    + _gap_sql(2, "sum:o_totalprice", "sum(o_totalprice)", 0.001)
    + """
UNION ALL
SELECT 3, 'row_count', abs(s - t) / s <= 0.001, s, t, round(abs(s - t) / s, 9), CAST(0.001 AS DOUBLE)
FROM (SELECT CAST(count(*) AS DOUBLE) AS s, CAST(count(*) FILTER (c_acctbal >= 0) AS DOUBLE) AS t FROM customer)"""
)
def recon_suite_two_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gate over two pairs, numbered through."""
    customers = table(spark, sf_dir, "customer")
    orders = (*sides(spark, sf_dir), [m.row_count(0.05), m.aggregate("o_totalprice")])
    return _rounded(m.reconciliation_reports([orders, (customers, customers.where("c_acctbal >= 0"), [m.row_count()])]))


#: What went wrong on the way to the target: some lines lost, some with another price, some twice.
LOST, DEAR, TWICE = "l_orderkey % 997 = 5", "l_orderkey % 991 = 7", "l_orderkey % 983 = 11"
LINES = "l_orderkey, l_linenumber, l_partkey, l_extendedprice"
COPY_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN {DEAR} THEN l_extendedprice + 1 ELSE l_extendedprice END AS l_extendedprice
FROM {{lines}} WHERE NOT ({LOST})
UNION ALL SELECT {LINES} FROM {{lines}} WHERE {TWICE}
UNION ALL SELECT -l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM {{lines}} WHERE {TWICE}"""


@query(f"""
WITH s AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list((l_partkey, l_extendedprice))) AS held FROM lineitem GROUP BY ALL),
t AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list((l_partkey, l_extendedprice))) AS held FROM ({COPY_SQL.format(lines="lineitem")}) GROUP BY ALL)
SELECT CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra' ELSE 'changed' END AS difference,
       coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
       coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows
FROM s FULL JOIN t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber WHERE s.held IS DISTINCT FROM t.held""")
def recon_drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of every line that differs, from digest tables of both sides."""
    lines, place = table(spark, sf_dir, "lineitem").select(*LINES.split(", ")), scratch_path(spark, "digests")
    keys = ["l_orderkey", "l_linenumber"]
    m.write_digests(lines, f"{place}/source", keys, bits=6)
    m.write_digests(m.run_sql(lines, COPY_SQL.format(lines="src")), f"{place}/target", keys, bits=6)
    return m.find_differences(spark, f"{place}/source", f"{place}/target", f"{place}/unequal")

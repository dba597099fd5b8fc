"""Inputs shared by the queries, as Spark frames and as SQL of the same content.

The test tables hold no NULL, so ``raw_orders`` derives some from column values:
unspecified priority means no amount, status P means no status. Quantities are
odd or zero, because a cent amount divided by an odd number never falls exactly
between two cents, where engines round differently.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOADED_AT = datetime(2024, 1, 2, 3, 4, 5)
LOADED_AT_TEXT = "2024-01-02 03:04:05"

RAW_AMOUNT = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_totalprice END"
RAW_STATUS = "nullif(o_orderstatus, 'P')"
RAW_QTY = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 7 "
    "WHEN '4-NOT SPECIFIED' THEN 9 ELSE 0 END"
)

RAW_ORDERS_SQL = f"""
SELECT o_orderkey AS order_id, o_custkey AS cust_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       {RAW_AMOUNT} AS amount, CAST({RAW_QTY} AS INTEGER) AS qty, {RAW_STATUS} AS status
FROM orders"""

HISTORY_END, BATCH_START = "1999-01-01", "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a source system would deliver them: text dates, NULLs, zero quantities."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.expr(RAW_AMOUNT).alias("amount"),
        F.expr(RAW_QTY).alias("qty"),
        F.expr(RAW_STATUS).alias("status"),
    )


def day(column: str) -> Column:
    """A date or timestamp as text, which every engine compares alike."""
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def second(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)

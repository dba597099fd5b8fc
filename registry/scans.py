"""Scans: a whole table is written in the format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from millrace.storage import scratch_path
from registry import query
from registry.inputs import RAW_ORDERS_SQL, day, raw_orders, table

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
EVENTS_SQL = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events"""


@query(CUSTOMER_SQL)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.read_files(spark, f"{sf_dir}/customer.parquet", "parquet")


@query(CUSTOMER_SQL)
def scan_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer_orc")
    table(spark, sf_dir, "customer").write.orc(path)
    return m.read_files(spark, path, "orc")


@query(RAW_ORDERS_SQL)
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header, inferred types and the NULL token by default; the separator is an option."""
    path = scratch_path(spark, "orders_csv")
    raw_orders(spark, sf_dir).write.csv(path, header=True, nullValue="NULL", sep=";")
    found = m.read_files(spark, path, "csv", options={"sep": ";"})
    return found.select(
        F.col("order_id").cast("bigint"), F.col("cust_id").cast("bigint"), day("order_date"), "amount",
        "qty", "status",
    )


@query(RAW_ORDERS_SQL)
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file with its schema given: one pass instead of two."""
    path = scratch_path(spark, "orders_csv")
    raw = raw_orders(spark, sf_dir)
    raw.write.csv(path, header=True, nullValue="NULL")
    return m.read_files(spark, path, "csv", schema=raw.schema)


@query(EVENTS_SQL)
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested objects come back as structs."""
    path = scratch_path(spark, "events_json")
    _nested_events(spark, sf_dir).write.json(path)
    return _flat_events(m.read_files(spark, path, "json"))


@query(EVENTS_SQL)
def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events_jsonl")
    nested = _nested_events(spark, sf_dir)
    nested.write.json(path)
    return _flat_events(m.read_files(spark, path, "jsonl", schema=nested.schema))


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderstatus FROM orders""")
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob below the partition directories, with ``basePath`` keeping their column."""
    path = scratch_path(spark, "orders_by_status")
    m.write_table(table(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    found = m.read_files(spark, f"{path}/o_orderstatus=*/*.parquet", "parquet", options={"basePath": path})
    return found.withColumn("o_orderdate", day("o_orderdate"))


@query("SELECT 'orders' AS source_id, count(*) AS n_rows, 6 AS n_columns FROM orders")
def extract_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of an extract, counted by the write that stages it."""
    counted, seen = m.count_rows(m.read_files(spark, f"{sf_dir}/orders.parquet", "parquet"), "orders")
    counted.write.parquet(scratch_path(spark, "orders_staged"))
    return spark.createDataFrame(
        [("orders", seen.get["rows"], len(counted.columns))], "source_id string, n_rows bigint, n_columns int"
    )


def _nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type", "value",
        F.from_json("props", "k int").alias("props"),
    )


def _flat_events(nested: DataFrame) -> DataFrame:
    return nested.select(
        "event_id", "ts", "user_id", "event_type", "value", F.col("props.k").cast("int").alias("k")
    )

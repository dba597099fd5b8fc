"""Projections, casts, null handling, row filters, flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from registry import query
from registry.inputs import LOADED_AT, LOADED_AT_TEXT, RAW_ORDERS_SQL, day, raw_orders, second, table


@query("""
SELECT o_custkey AS o_orderkey, o_orderkey AS o_custkey, o_totalprice AS amount, o_orderstatus, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders""")
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two names swapped, one replaced, one absent."""
    renamed = m.rename_columns(
        table(spark, sf_dir, "orders"),
        {"o_orderkey": "o_custkey", "o_custkey": "o_orderkey", "o_totalprice": "amount", "absent": "x"},
    )
    return renamed.withColumn("o_orderdate", day("o_orderdate"))


@query("""
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS cust,
       TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS price,
       CAST(trunc(o_totalprice) AS INTEGER) AS whole,
       CAST(trunc(o_totalprice) AS BIGINT) AS text_whole,
       CAST(o_custkey AS VARCHAR) AS cust_text
FROM orders""")
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable text becomes NULL; a decimal point in whole-number text is cut off."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE string(o_custkey) END AS cust"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE string(o_totalprice) END AS price"),
        F.col("o_totalprice").alias("whole"),
        F.expr("string(CAST(o_totalprice AS decimal(18, 2))) AS text_whole"),
        F.col("o_custkey").alias("cust_text"),
    )
    return m.cast_columns(
        orders,
        {
            "cust": "integer", "price": "double", "whole": "integer", "text_whole": "bigint",
            "cust_text": "string", "absent": "date",
        },
    )


@query(f"""
SELECT order_id, cust_id, order_date, coalesce(amount, 0.0) AS amount, qty, coalesce(status, 'PENDING') AS status
FROM ({RAW_ORDERS_SQL})""")
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.fill_nulls(raw_orders(spark, sf_dir), {"amount": 0.0, "status": "PENDING"})


@query(f"SELECT order_id, order_date, amount, qty FROM ({RAW_ORDERS_SQL})")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.drop_columns(raw_orders(spark, sf_dir), ["cust_id", "status", "absent"])


@query(f"SELECT * FROM ({RAW_ORDERS_SQL}) WHERE amount > 100000 AND status <> 'F'")
def filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.filter_rows(raw_orders(spark, sf_dir), "amount > 100000 AND status <> 'F'")


@query(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderpriority, '{LOADED_AT_TEXT}' AS _etl_loaded_at, '2024-01-02' AS _batch_id,
       'orders_csv' AS _source_system
FROM orders""")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = m.add_audit_columns(table(spark, sf_dir, "orders"), "2024-01-02", "orders_csv", LOADED_AT)
    return audited.withColumns({"o_orderdate": day("o_orderdate"), "_etl_loaded_at": second("_etl_loaded_at")})


@query("""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k
FROM events""")
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k int").alias("props")
    )
    return m.flatten_column(events, "props", prefix="props")


@query("""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS other
FROM events""")
def flatten_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "map<string,int>").alias("props")
    )
    return m.flatten_column(events, "props", keys=["k", "other"])


@query(f"""
SELECT DISTINCT order_id AS id, cust_id AS customer_id, order_date, coalesce(amount, 0.0) AS amount,
       coalesce(status, 'UNKNOWN') AS status, '{LOADED_AT_TEXT}' AS _etl_loaded_at, '20240101' AS _batch_id
FROM ({RAW_ORDERS_SQL})
WHERE coalesce(amount, 0.0) < 400000""")
def transform_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order delivered twice, through one recipe."""
    raw = raw_orders(spark, sf_dir)
    recipe = (
        m.Recipe("orders_clean")
        .rename({"order_id": "id", "cust_id": "customer_id"})
        .fill({"amount": 0.0, "status": "UNKNOWN"})
        .filter("amount < 400000")
        .drop(["qty"])
        .dedup(["id"])
        .audit(batch_id="20240101", loaded_at=LOADED_AT)
    )
    return recipe.apply(raw.unionByName(raw)).withColumn("_etl_loaded_at", second("_etl_loaded_at"))


#: Documents of three shapes: ``k`` is a number in some and text in others, the rest is in some only.
MIXED = (
    "CASE event_id % 3 WHEN 0 THEN props "
    "WHEN 1 THEN concat('{{\"k\":\"', event_type, '\",\"at\":{{\"user\":', CAST(user_id AS {text}), ',\"big\":true}}}}') "
    "ELSE concat('{{\"only\":', CAST(event_id AS {text}), '.5,\"k\":[1,\"x\"]}}') END"
)


@query(f"""
WITH mixed AS (SELECT event_id, {MIXED.format(text="VARCHAR")} AS doc FROM events)
SELECT event_id, CAST(doc->>'$.at.user' AS BIGINT) AS doc_at_user, CAST(doc->>'$.at.big' AS BOOLEAN) AS doc_at_big, doc->>'$.k' AS doc_k,
       CAST(doc->>'$.only' AS DOUBLE) AS doc_only
FROM mixed""")
def flatten_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that nobody named, of documents whose types do not agree."""
    mixed = table(spark, sf_dir, "events").select("event_id", F.expr(MIXED.format(text="STRING")).alias("doc"))
    return m.flatten_document(mixed, "doc")

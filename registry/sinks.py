"""Loads: written, then read back whole.

The history is all orders before 1999, the batch all orders from 1998 on, so a
merge of the two updates 1998, inserts what follows and keeps the rest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from millrace.storage import scratch_path
from registry import query
from registry.inputs import BATCH_START, HISTORY_END, day, table

COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate"
SHIPPED = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END"

DAY_SQL = COLUMNS.replace("o_orderdate", "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate")

HISTORY_SQL = f"SELECT {DAY_SQL} FROM orders WHERE o_orderdate < TIMESTAMP '{HISTORY_END}'"
BATCH_SQL = f"""
SELECT o_orderkey, o_custkey, {SHIPPED} AS o_orderstatus, o_totalprice + 10 AS o_totalprice
FROM orders WHERE o_orderdate >= TIMESTAMP '{BATCH_START}'"""

MERGED_SQL = f"""
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       t.o_orderpriority, t.o_orderdate
FROM ({HISTORY_SQL}) t FULL OUTER JOIN ({BATCH_SQL}) s ON t.o_orderkey = s.o_orderkey"""


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(HISTORY_END).cast("timestamp_ntz"))
    return orders.select(*COLUMNS.split(", "))


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch brings no priority: a match keeps the one it has, an insert gets none."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit(BATCH_START).cast("timestamp_ntz"))
    return orders.select(
        "o_orderkey", "o_custkey", F.expr(SHIPPED).alias("o_orderstatus"),
        (F.col("o_totalprice") + 10).alias("o_totalprice"),
    )


def _with_days(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderdate", day("o_orderdate"))


@query(f"{HISTORY_SQL} UNION ALL {HISTORY_SQL.replace('<', '>=')}")
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "orders_append")
    later = F.col("o_orderdate") >= F.lit(HISTORY_END).cast("timestamp_ntz")
    rest = table(spark, sf_dir, "orders").where(later).select(*COLUMNS.split(", "))
    m.write_table(_history(spark, sf_dir), target, "append")
    m.write_table(rest, target, "append")
    return _with_days(m.read_target(spark, target))


@query(f"SELECT {DAY_SQL} FROM orders")
def load_append_after_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty overwrite leaves layout and schema, so what is appended is partitioned as before."""
    target = scratch_path(spark, "orders_emptied")
    orders = table(spark, sf_dir, "orders").select(*COLUMNS.split(", "))
    m.write_table(orders, target, "overwrite", partition_by=["o_orderstatus"])
    m.write_table(orders.limit(0), target, "overwrite")
    m.write_table(orders, target, "append", cluster_by=["o_custkey"])
    found = m.read_target(spark, target)
    if not found.where("_metadata.file_path NOT LIKE '%/o_orderstatus=%'").isEmpty():
        raise RuntimeError(f"{target} lost its layout")
    return _with_days(found)


@query(f"SELECT {DAY_SQL} FROM orders")
def load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "orders_overwrite")
    m.write_table(_batch(spark, sf_dir), target, "overwrite")
    m.write_table(table(spark, sf_dir, "orders").select(*COLUMNS.split(", ")), target, "overwrite")
    return _with_days(m.read_target(spark, target))


@query(f"SELECT {DAY_SQL} FROM orders")
def load_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three partitions, each with a third of the table."""
    target = scratch_path(spark, "orders_partitioned")
    orders = table(spark, sf_dir, "orders").select(*COLUMNS.split(", "))
    m.write_table(orders, target, "overwrite", partition_by=["o_orderstatus"])
    return _with_days(m.read_target(spark, target))


@query(f"SELECT {DAY_SQL} FROM orders")
def load_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "orders_clustered")
    orders = table(spark, sf_dir, "orders").select(*COLUMNS.split(", "))
    m.write_table(orders, target, "overwrite", cluster_by=["o_custkey", "o_orderstatus"])
    return _with_days(m.read_target(spark, target))


@query(f"SELECT {DAY_SQL} FROM orders")
def load_by_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that a filter on the customer skips as well as one on the price; tests read the footers."""
    target = scratch_path(spark, "orders_curve")
    orders = table(spark, sf_dir, "orders").select(*COLUMNS.split(", "))
    m.write_table(m.lay_out_by_curve(orders, ["o_custkey", "o_totalprice"]), target, "overwrite")
    return _with_days(m.read_target(spark, target))


@query(MERGED_SQL)
def load_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "orders_merge")
    m.write_table(_history(spark, sf_dir), target, "overwrite")
    m.write_table(_batch(spark, sf_dir), target, "merge", keys=["o_orderkey"], at_rest=True)
    return _with_days(m.read_target(spark, target))


@query(MERGED_SQL)
def load_merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged rows that change their status move to another partition."""
    target = scratch_path(spark, "orders_merge_partitioned")
    layout = {"partition_by": ["o_orderstatus"], "cluster_by": ["o_custkey"]}
    m.write_table(_history(spark, sf_dir), target, "overwrite", **layout)
    m.write_table(_batch(spark, sf_dir), target, "merge", keys=["o_orderkey"], **layout)
    return _with_days(m.read_target(spark, target))


@query(f"""
WITH t AS ({HISTORY_SQL}), s AS ({BATCH_SQL})
SELECT (SELECT count(*) FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)) AS inserted,
       (SELECT count(*) FROM t WHERE o_orderkey IN (SELECT o_orderkey FROM s)) AS updated,
       (SELECT count(*) FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)) AS kept""")
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merge did, counted over the merged rows it staged."""
    target = scratch_path(spark, "orders_merge")
    m.write_table(_history(spark, sf_dir), target, "overwrite")
    done = m.write_table(_batch(spark, sf_dir), target, "merge", keys=["o_orderkey"])
    row = (done.inserted, done.updated, done.kept)
    return spark.createDataFrame([row], "inserted bigint, updated bigint, kept bigint")


@query(f"""
SELECT *, '2024-01-01' AS run_date FROM ({HISTORY_SQL.replace('o_totalprice,', 'o_totalprice + 10 AS o_totalprice,')})
UNION ALL SELECT *, '2024-01-02' FROM ({HISTORY_SQL.replace('<', '>=')})""")
def write_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates, the first of them run again with corrected prices."""
    zone = scratch_path(spark, "orders_zone")
    later = F.col("o_orderdate") >= F.lit(HISTORY_END).cast("timestamp_ntz")
    rest = table(spark, sf_dir, "orders").where(later).select(*COLUMNS.split(", "))
    history = _history(spark, sf_dir)
    m.write_run_date(history, zone, "2024-01-01")
    m.write_run_date(rest, zone, "2024-01-02")
    m.write_run_date(history.withColumn("o_totalprice", F.col("o_totalprice") + 10), zone, "2024-01-01")
    first, second = (m.read_run_date(spark, zone, d) for d in ("2024-01-01", "2024-01-02"))
    return _with_days(first.unionByName(second)).withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd"))


def _rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.col("o_orderdate") >= F.lit(HISTORY_END).cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").where(later).select(*COLUMNS.split(", "))


def _table_name() -> str:
    return f"orders_{uuid.uuid4().hex}"


@query(f"{HISTORY_SQL} UNION ALL {HISTORY_SQL.replace('<', '>=')}")
def load_append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load does not name the partition column; the path has it."""
    target = scratch_path(spark, "orders_append_partitioned")
    m.write_table(_history(spark, sf_dir), target, "append", partition_by=["o_orderstatus"])
    m.write_table(_rest(spark, sf_dir), target, "append")
    return _with_days(m.read_target(spark, target))


@query(MERGED_SQL)
def load_merge_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of two columns; the batch brings one of them, and a match keeps the other."""
    target = scratch_path(spark, "orders_merge_two_level")
    m.write_table(_history(spark, sf_dir), target, "overwrite", partition_by=["o_orderpriority", "o_orderstatus"])
    m.write_table(_batch(spark, sf_dir), target, "merge", keys=["o_orderkey"])
    return _with_days(m.read_target(spark, target))


ZERO_SQL = "lpad(CAST(o_orderkey % 12 AS VARCHAR), 3, '0')"


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE o_totalprice END AS o_totalprice, {ZERO_SQL} AS bucket
FROM orders""")
def load_text_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition text with leading zeros, merged and read back as the text it is."""
    target = scratch_path(spark, "orders_text")
    bucket = F.lpad((F.col("o_orderkey") % 12).cast("string"), 3, "0").alias("bucket")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", bucket)
    m.write_table(orders, target, "overwrite", partition_by=["bucket"])
    changed = orders.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit(-1.0).alias("o_totalprice"))
    m.write_table(changed, target, "merge", keys=["o_orderkey"])
    return m.read_target(spark, target)


@query(f"{HISTORY_SQL} UNION ALL {HISTORY_SQL.replace('<', '>=')}")
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ORC table; the second load names no format."""
    name = _table_name()
    m.write_table(_history(spark, sf_dir), name, "append", format="orc")
    m.write_table(_rest(spark, sf_dir), name, "append")
    return _with_days(m.read_target(spark, name))


@query(f"SELECT {DAY_SQL} FROM orders")
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged into, then overwritten."""
    name = _table_name()
    m.write_table(_history(spark, sf_dir), name, "overwrite")
    m.write_table(_batch(spark, sf_dir), name, "merge", keys=["o_orderkey"])
    m.write_table(table(spark, sf_dir, "orders").select(*COLUMNS.split(", ")), name, "overwrite")
    return _with_days(m.read_target(spark, name))


@query(MERGED_SQL)
def table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name()
    m.write_table(_history(spark, sf_dir), name, "overwrite")
    m.write_table(_batch(spark, sf_dir), name, "merge", keys=["o_orderkey"])
    return _with_days(m.read_target(spark, name))


@query(MERGED_SQL)
def table_merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged rows that change their status move; the merge does not repeat the partition column."""
    name = _table_name()
    m.write_table(_history(spark, sf_dir), name, "overwrite", partition_by=["o_orderstatus"])
    m.write_table(_batch(spark, sf_dir), name, "merge", keys=["o_orderkey"])
    return _with_days(m.read_target(spark, name))

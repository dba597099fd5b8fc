"""Deduplication over lineitem, where a quarter of the rows repeats a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from registry import query
from registry.inputs import table

# lineitem columns beyond the key, in the order that decides the survivor
REST = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


KEY = ("l_orderkey", "l_linenumber")
DAY = "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate"


@query(f"SELECT DISTINCT {', '.join(KEY)}, {DAY}, {', '.join(REST[1:])} FROM lineitem")
def dedup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row delivered twice, compared over all its columns."""
    rows = table(spark, sf_dir, "lineitem")
    distinct = m.drop_duplicates(rows.unionByName(rows)).select(*KEY, *REST)
    return distinct.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("""
SELECT DISTINCT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS line_no,
       concat('order ', l_orderkey) AS order_name, l_orderkey / 8.0 AS weight FROM lineitem""")
def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any survivor per key, with other columns that both engines can know: they follow from the key."""
    lines = table(spark, sf_dir, "lineitem").select(
        *KEY,
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("order_name"),
        (F.col("l_orderkey") / 8.0).alias("weight"),
    )
    return m.drop_duplicates(lines, list(KEY))


@query(f"""
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, {', '.join(REST[1:])}
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {', '.join(REST[1:])}) = 1""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    survivors = m.drop_duplicates(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc(REST[0]), *REST[1:]]
    )
    return survivors.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))

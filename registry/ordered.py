"""Joins by time and interval, and order-dependent columns over whole tables.

``HOT`` gives one key a third of all rows, so that what is dealt by key alone would show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from registry import query
from registry.inputs import table

HOT = "CASE WHEN {0} % 3 = 0 THEN 0 ELSE {0} END"
#: Order dates of 1997 and 1998, moved by 27 years of 365.25 days, fall among the events.
SHIFT = "INTERVAL '9862' DAY"


@query(f"""
WITH placed AS (
    SELECT {HOT.format("o_custkey")} AS k, o_orderdate + {SHIFT} AS at, max(o_orderkey) AS orderkey FROM orders GROUP BY 1, 2
), numbered AS (SELECT event_id, {HOT.format("user_id")} AS k, ts FROM events)
SELECT e.event_id, e.k, p.orderkey FROM numbered e ASOF LEFT JOIN placed p ON e.k = p.k AND e.ts >= p.at""")
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last order of its customer before it, the largest number of a day's orders."""
    events = table(spark, sf_dir, "events").select("event_id", F.expr(HOT.format("user_id")).alias("k"), "ts")
    orders = table(spark, sf_dir, "orders").select(
        F.expr(HOT.format("o_custkey")).alias("k"), F.expr(f"o_orderdate + {SHIFT}").alias("at"), F.col("o_orderkey").alias("orderkey")
    )
    return m.join_asof(events, orders, ("ts", "at"), ["k"], take=["orderkey"], tie=["orderkey"]).drop("ts")


@query(f"""
WITH numbered AS (SELECT event_id, {HOT.format("user_id")} AS k, ts FROM events),
placed AS (SELECT {HOT.format("o_custkey")} AS k, o_orderdate + {SHIFT} AS at, min(o_orderkey) AS orderkey FROM orders GROUP BY 1, 2)
SELECT e.event_id, e.k, CASE WHEN p.at <= e.ts + INTERVAL '7' DAY THEN p.orderkey END AS orderkey
FROM numbered e ASOF LEFT JOIN placed p ON e.k = p.k AND e.ts < p.at""")
def join_asof_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its customer's next order, if that comes within seven days."""
    events = table(spark, sf_dir, "events").select("event_id", F.expr(HOT.format("user_id")).alias("k"), "ts")
    orders = table(spark, sf_dir, "orders").select(
        F.expr(HOT.format("o_custkey")).alias("k"), F.expr(f"o_orderdate + {SHIFT}").alias("at"), F.col("o_orderkey").alias("orderkey")
    )
    found = m.join_asof(
        events, orders, ("ts", "at"), ["k"], ["orderkey"], direction="forward", exact=False, tolerance="INTERVAL '7' DAY", tie=["orderkey"]
    )
    return found.drop("ts")


@query("""
WITH spans AS (
    SELECT o_orderkey, o_orderdate AS a, o_orderdate + CASE o_orderpriority WHEN '1-URGENT' THEN INTERVAL '1' DAY WHEN '2-HIGH' THEN INTERVAL '12' HOUR
           WHEN '3-MEDIUM' THEN INTERVAL '2' DAY WHEN '5-LOW' THEN INTERVAL '40' DAY ELSE INTERVAL '0' DAY END AS b
    FROM orders
)
SELECT s.o_orderkey, count(*) AS n, sum(l.l_linenumber)::BIGINT AS line_numbers
FROM spans s JOIN lineitem l ON l.l_orderkey = s.o_orderkey AND l.l_shipdate BETWEEN s.a AND s.b GROUP BY s.o_orderkey""")
def join_points_in_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped within their order's term, which is 0 hours to 40 days."""
    term = F.expr(
        "o_orderdate + CASE o_orderpriority WHEN '1-URGENT' THEN INTERVAL '24' HOUR WHEN '2-HIGH' THEN INTERVAL '12' HOUR "
        "WHEN '3-MEDIUM' THEN INTERVAL '48' HOUR WHEN '5-LOW' THEN INTERVAL '960' HOUR ELSE INTERVAL '0' HOUR END"
    )
    spans = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("a"), term.alias("b"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate")
    found = m.join_overlapping(spans, lines, ("a", "b"), "l_shipdate", ["o_orderkey"])
    return found.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("line_numbers"))


#: A band of prices around each part's, wider for large ones; suppliers' balances are the points.
BANDS = "SELECT p_partkey, p_retailprice - p_size AS a, p_retailprice + p_size * p_size AS b FROM {part}"


@query(f"""
SELECT b.p_partkey, count(*) AS n, min(s.s_suppkey) AS first_supplier, max(s.s_suppkey) AS last_supplier
FROM ({BANDS.format(part="part")}) b JOIN supplier s ON s.s_acctbal BETWEEN b.a AND b.b GROUP BY b.p_partkey""")
def join_price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers whose balance lies in a part's price band: an interval join without any key."""
    bands = m.run_sql(table(spark, sf_dir, "part"), BANDS.format(part="src"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    measures = {"n": ("count", "*"), "first_supplier": ("min", "s_suppkey"), "last_supplier": ("max", "s_suppkey")}
    found = m.join_overlapping(bands, suppliers, ("a", "b"), "s_acctbal", measures=measures)
    return found.groupBy("p_partkey").agg(
        F.sum("n").alias("n"), F.min("first_supplier").alias("first_supplier"), F.max("last_supplier").alias("last_supplier")
    )


CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


@query(f"""
SELECT o_orderkey, row_number() OVER w - 1 AS position, count(*) OVER () AS n_orders,
       CAST(sum({CENTS}) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cents_so_far
FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""")
def global_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's place and the amount so far over all orders, by date and number."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.expr(CENTS).alias("cents"))
    by = ["o_orderdate", "o_orderkey"]
    summed = m.running_totals(orders, by, {"cents_so_far": "cents"})
    return m.number_rows(summed, by, total="n_orders").drop("o_orderdate", "cents")


@query(f"""
SELECT event_id, k, row_number() OVER w - 1 AS position,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cents_so_far
FROM (SELECT event_id, {HOT.format("user_id")} AS k, ts, value FROM events) WINDOW w AS (PARTITION BY k ORDER BY ts, event_id)""")
def running_sum_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same within keys, of which one holds a third of the rows and lies in many partitions."""
    cents = F.expr("CAST(round(value * 100) AS BIGINT)").alias("cents")
    events = table(spark, sf_dir, "events").select("event_id", F.expr(HOT.format("user_id")).alias("k"), "ts", cents)
    summed = m.running_totals(events, ["ts", "event_id"], {"cents_so_far": "cents"}, ["k"])
    return m.number_rows(summed, ["ts", "event_id"], ["k"]).drop("ts", "cents")


@query("""
SELECT l_orderkey, l_partkey, l_quantity,
       ntile(100) OVER (ORDER BY l_extendedprice, l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity) AS tile
FROM lineitem""")
def global_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hundredths of all lines by price."""
    by = ["l_extendedprice", "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity"]
    lines = table(spark, sf_dir, "lineitem").select(*by)
    return m.tiles(lines, by, 100).select("l_orderkey", "l_partkey", "l_quantity", "tile")

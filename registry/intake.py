"""Rejected rows and profiles of raw orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from millrace.storage import scratch_path
from registry import query
from registry.inputs import RAW_ORDERS_SQL, raw_orders, table

#: What a careless source delivers: some amounts are words, some dates are no dates, some numbers are missing.
DIRTY = {
    "order_id": "CASE WHEN order_id % 101 = 3 THEN NULL ELSE CAST(order_id AS {text}) END",
    "order_date": "CASE WHEN order_id % 89 = 5 THEN concat(order_date, 'x') ELSE order_date END",
    "amount": "CASE WHEN order_id % 97 = 4 THEN 'n/a' ELSE CAST(amount AS {text}) END",
    "qty": "CAST(qty AS {text})",
    "status": "status",
}


def _dirty_sql(source: str, text: str) -> str:
    return f"SELECT {', '.join(f'{v.format(text=text)} AS {k}' for k, v in DIRTY.items())} FROM {source}"


DIRTY_SQL = _dirty_sql(f"({RAW_ORDERS_SQL})", "VARCHAR")
CASTS = {"order_id": "bigint", "order_date": "date", "amount": "double", "qty": "int"}
BAD = {
    "not a date": "try_cast(order_date AS DATE) IS NULL AND order_date IS NOT NULL",
    "not a double": "try_cast(amount AS DOUBLE) IS NULL AND amount IS NOT NULL",
    "missing": "order_id IS NULL",
    "breaks ordered": "CAST(qty AS INTEGER) <= 0",
}


def _split(spark: SparkSession, sf_dir: str) -> str:
    dirty = m.run_sql(raw_orders(spark, sf_dir), _dirty_sql("src", "STRING"))
    place = scratch_path(spark, "split")
    m.write_split(m.find_problems(dirty, CASTS, required=["order_id"], rules={"ordered": "qty > 0"}), place)
    return place


@query(f"""
SELECT CAST(order_id AS BIGINT) AS order_id, order_date, CAST(amount AS DOUBLE) AS amount, CAST(qty AS INTEGER) AS qty, status
FROM ({DIRTY_SQL}) WHERE NOT ({" OR ".join(f"({b})" for b in BAD.values())})""")
def split_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a problem, typed; the same pass wrote the rejects."""
    return m.read_good(spark, _split(spark, sf_dir)).withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@query(f"""
SELECT 'order_date' AS "column", order_date AS value, 'not a date' AS reason FROM ({DIRTY_SQL}) WHERE {BAD["not a date"]}
UNION ALL SELECT 'amount', amount, 'not a double' FROM ({DIRTY_SQL}) WHERE {BAD["not a double"]}
UNION ALL SELECT 'order_id', NULL, 'missing' FROM ({DIRTY_SQL}) WHERE {BAD["missing"]}
UNION ALL SELECT NULL, NULL, 'breaks ordered' FROM ({DIRTY_SQL}) WHERE {BAD["breaks ordered"]}""")
def split_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every problem of every rejected row."""
    return m.read_rejects(spark, _split(spark, sf_dir)).drop("original")


PROFILED = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query(" UNION ALL ".join(
    f"""SELECT year(o_orderdate)::INTEGER AS year, '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
    min({c})::VARCHAR AS low, max({c})::VARCHAR AS high, true AS distinct_near, true AS median_near FROM orders GROUP BY 1""" if c == "o_orderpriority" else
    f"""SELECT year(o_orderdate)::INTEGER, '{c}', count(*), count(*) - count({c}), round(min({c}) * 100)::BIGINT::VARCHAR, round(max({c}) * 100)::BIGINT::VARCHAR,
    true, true FROM orders GROUP BY 1""" for c in reversed(PROFILED)))
def profile_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of days united to years; estimates are held against exact counts and ranks of all rows."""
    orders = table(spark, sf_dir, "orders").select(*PROFILED, "o_orderdate")
    days = m.profile(orders, PROFILED, by=["o_orderdate"])
    years = m.read_profiles(m.merge_profiles(days.withColumn("year", F.year("o_orderdate")), by=["year"]), [0.5])
    numbers = [c for c in PROFILED if c != "o_orderpriority"]
    exact = orders.groupBy(F.year("o_orderdate").alias("y")).agg(*(F.count_distinct(c).alias(f"d_{c}") for c in PROFILED))
    named = F.create_map(*(x for c in PROFILED for x in (F.lit(c), F.col(f"d_{c}"))))
    near = years.join(exact, years["year"] == exact["y"]).withColumn("exact", named[F.col("column")])
    middle = years.groupBy(F.col("year").alias("y")).agg(*(F.max(F.when(F.col("column") == c, F.col("q50"))).alias(f"q_{c}") for c in numbers))
    ranked = orders.join(middle, F.year("o_orderdate") == middle["y"]).groupBy("y")
    ranks = ranked.agg(*(F.avg((F.col(c) <= F.col(f"q_{c}")).cast("int")).alias(f"r_{c}") for c in numbers)).withColumnRenamed("y", "ry")
    rank = F.create_map(*(x for c in numbers for x in (F.lit(c), F.col(f"r_{c}"))))[F.col("column")]
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").cast("string")
    return near.join(ranks, near["year"] == ranks["ry"]).select(
        "year", "column", "n_rows", "n_nulls",
        F.coalesce("text_low", cents("low")).alias("low"), F.coalesce("text_high", cents("high")).alias("high"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact") + 1).alias("distinct_near"),
        F.coalesce(F.abs(rank - 0.5) <= 0.03, F.lit(True)).alias("median_near"),
    )

"""Merged profiles are those of all rows; estimates lie within the stated errors."""

import random

import pytest
from pyspark.sql import functions as F

import millrace as m


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    number = lambda: rng.choice([None, rng.gauss(0, 100), float("nan")])
    text = lambda i: rng.choice([None, "", "é", f"t{i % 900}"])
    rows = [(f"d{i % 7}", number(), rng.randrange(4000), text(i), i % 2 == 0) for i in range(20_000)]
    df = spark.createDataFrame(rows, "day string, v double, n int, t string, b boolean").repartition(4)
    return df.withColumn("at", F.timestamp_seconds("n")).withColumn("many", F.array("n")).cache()


def rows_of(profiles):
    return {r["column"]: r for r in m.read_profiles(profiles, (0.1, 0.5)).collect()}


def test_a_week_is_the_union_of_its_days(frame):
    days = m.profile(frame, by=["day"])
    assert days.count() == 7 * 6
    whole, merged = rows_of(m.profile(frame.drop("day"))), rows_of(m.merge_profiles(days))
    for column, row in whole.items():
        for name in ("n_rows", "n_nulls", "low", "high", "text_low", "text_high"):
            assert str(merged[column][name]) == str(row[name])
        exact = frame.select(column).distinct().dropna().count() if column != "many" else 0
        assert abs(merged[column].n_distinct - exact) <= 0.05 * exact
    numbers = frame.where("v IS NOT NULL AND NOT isnan(v)")
    ranks = frame.where(F.col("n") <= merged["n"].q50).count() / 20_000, numbers.where(F.col("v") < merged["v"].q10).count() / numbers.count()
    assert abs(ranks[0] - 0.5) < 0.03 and abs(ranks[1] - 0.1) < 0.03
    assert whole["many"].n_distinct == 0 and whole["t"].q50 is None and whole["t"].text_high == "é"
    assert whole["at"].high == frame.agg(F.max("n")).first()[0]


def test_some_days_and_groups(frame):
    days = m.profile(frame, ["n"], by=["day", "b"])
    found = m.merge_profiles(days.where("day < 'd3'"), by=["day"]).collect()
    assert sorted(r.day for r in found) == ["d0", "d1", "d2"]
    assert sum(r.n_rows for r in found) == frame.where("day < 'd3'").count()


def test_nulls_and_empty_tables(spark):
    empty = m.profile(spark.createDataFrame([], "v double, t string"))
    assert [(r.n_rows, r.n_nulls, r.n_distinct, r.q50) for r in m.read_profiles(empty).collect()] == [(0, 0, 0, None)] * 2
    nulls = m.profile(spark.createDataFrame([(None, None)], "v double, t string"))
    both = rows_of(m.merge_profiles(nulls.union(empty)))
    assert (both["v"].n_rows, both["v"].n_nulls, both["v"].n_distinct, both["v"].q50) == (1, 1, 0, None)
    with pytest.raises(ValueError, match="at least one"):
        m.profile(spark.createDataFrame([(1,)], "a int"), by=["a"])

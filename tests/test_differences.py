"""Rows that differ, against a comparison of all rows; and how little is read to find them."""

import random

import pytest
from pyspark.sql import functions as F

import millrace as m
from millrace.plans import differences as D

SCHEMA = "k int, g string, v double, tags map<string, int>"


def by_comparison(one, two):
    bags = [{}, {}]
    for bag, rows in zip(bags, (one, two)):
        for r in rows:
            bag.setdefault(r[:2], []).append(str((r[2], sorted((r[3] or {}).items()), r[3] is None)))
    out = []
    for k in bags[0].keys() | bags[1].keys():
        a, b = sorted(bags[0].get(k, [])), sorted(bags[1].get(k, []))
        if a != b:
            out.append(("missing" if not b else "extra" if not a else "changed", *k, len(a), len(b)))
    return sorted(out, key=str)


def differences(spark, tmp_path, one, two, bits=4):
    for name, rows in (("one", one), ("two", two)):
        D.write_digests(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / name), ["k", "g"], bits=bits)
    return D.find_differences(spark, str(tmp_path / "one"), str(tmp_path / "two"), str(tmp_path / "scratch"))


def test_against_comparison(spark, tmp_path):
    rng = random.Random(4)
    base = [(rng.choice([None, *range(80)]), rng.choice(["a", None]), float(i), {"x": i, "y": 1} if i % 3 else None) for i in range(300)]
    other = [r for r in base if rng.random() > 0.03]
    other = [(r[0], r[1], None, r[3]) if rng.random() < 0.03 else r for r in other] + [(1000, "a", 1.0, None), base[0]]
    rng.shuffle(other)
    found = differences(spark, tmp_path, base, other)
    assert found.columns == ["difference", "k", "g", "source_rows", "target_rows"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_comparison(base, other)


def test_a_null_moved_between_columns_is_a_change(spark, tmp_path):
    one = spark.createDataFrame([(1, None, 5)], "k int, a int, b int")
    two = spark.createDataFrame([(1, 5, None)], "k int, a int, b int")
    for name, df in (("one", one), ("two", two)):
        m.write_digests(df, str(tmp_path / name), ["k"])
    (row,) = m.find_differences(spark, str(tmp_path / "one"), str(tmp_path / "two"), str(tmp_path / "s")).collect()
    assert row.difference == "changed"


def test_only_unequal_buckets_are_read(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("CAST(id AS INT) AS k", "id * 2 AS v")
    changed = rows.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v")))
    for name, df in (("one", rows), ("two", changed)):
        D.write_digests(df, str(tmp_path / name), ["k"], bits=6)
    assert D.unequal_buckets(spark, str(tmp_path / "one"), str(tmp_path / "two")).count() == 1
    found = D.find_differences(spark, str(tmp_path / "one"), str(tmp_path / "two"), str(tmp_path / "scratch"))
    assert [tuple(r) for r in found.collect()] == [("changed", 77, 1, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 2 and "NestedLoop" not in plan


def test_equal_and_empty_tables(spark, tmp_path):
    rows = [(1, "a", 1.0, None)]
    assert differences(spark, tmp_path / "x", rows, rows).collect() == []
    found = differences(spark, tmp_path / "y", rows, []).collect()
    assert [tuple(r) for r in found] == [("missing", 1, "a", 1, 0)]
    with pytest.raises(ValueError, match="different keys"):
        D.write_digests(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "z"), ["k"])
        D.find_differences(spark, str(tmp_path / "x" / "one"), str(tmp_path / "z"), str(tmp_path / "zz"))

import math
import random
from decimal import Decimal

import pytest

import millrace as m


def only(source, target, *measures):
    rows = m.reconciliation_report(source, target, list(measures)).collect()
    assert len(rows) == 1
    return rows[0]


def amounts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_row_count(spark):
    row = only(spark.range(1000), spark.range(999), m.row_count())
    assert row.passed and (row.source_value, row.target_value) == (1000.0, 999.0)
    assert row.variance_pct == 0.001 and row.tolerance == 0.001
    assert not only(spark.range(1000), spark.range(998), m.row_count()).passed
    assert only(spark.range(1000), spark.range(900), m.row_count(0.1)).passed


@pytest.mark.parametrize(
    "source, target, variance",
    [
        ([0.0], [0.0], 0.0), ([0.0], [5.0], math.inf), ([], [], 0.0), ([], [5.0], math.inf),
        ([-100.0], [-100.0], 0.0), ([-100.0], [-50.0], 0.5), ([-100.0], [100.0], 2.0), ([100.0], [None], 1.0),
    ],
)
def test_sum_from_zero_and_negative_sources(spark, source, target, variance):
    row = only(amounts(spark, *source), amounts(spark, *target), m.aggregate("v"))
    assert row.variance_pct == variance
    assert row.passed is (variance == 0.0)


def test_nan_never_passes(spark):
    row = only(amounts(spark, 1.0), amounts(spark, float("nan")), m.aggregate("v"))
    assert not row.passed


def test_count_ignores_null_and_avg(spark):
    df = amounts(spark, 1.0, None, 3.0)
    assert only(df, df, m.aggregate("v", "count")).source_value == 2.0
    assert only(df, df, m.aggregate("v", "avg")).source_value == 2.0


def test_decimal_sums_stay_exact(spark):
    big = spark.createDataFrame([(Decimal("90071992547409.93"),), (Decimal("0.07"),)], "v decimal(18, 2)")
    assert only(big, big, m.aggregate("v")).source_value == 90071992547410.0


def test_unknown_function_and_column(spark):
    with pytest.raises(ValueError):
        m.aggregate("v", "median")
    with pytest.raises(ValueError):
        m.reconciliation_report(spark.range(1), spark.range(1), [m.aggregate("v")])


def test_hash_is_order_free_and_sees_copies(spark):
    rows = [(i % 7, f"n{i % 5}", None if i % 11 == 0 else i / 3) for i in range(500)]
    schema = "a int, b string, c double"
    df = spark.createDataFrame(rows, schema)
    random.Random(3).shuffle(rows)
    hashes = m.column_hash(["a", "b", "c"])
    same = m.reconciliation_report(df, spark.createDataFrame(rows, schema).repartition(5), [hashes]).collect()
    assert all(r.passed and r.variance_pct == 0.0 and r.source_value == r.target_value for r in same)

    # one value in place of another, and a pair of copies whose hashes cancel under XOR
    changed = rows[:-1] + [(rows[-1][0], "other", rows[-1][2])]
    verdicts = [r.passed for r in m.reconciliation_report(df, spark.createDataFrame(changed, schema), [hashes]).collect()]
    assert verdicts == [True, False, True]
    pairs, other = amounts(spark, 1.0, 1.0, 5.0), amounts(spark, 2.0, 2.0, 5.0)
    assert not only(pairs, other, m.column_hash(["v"])).passed


def test_hash_of_empty_sides(spark):
    empty = amounts(spark)
    assert only(empty, empty, m.column_hash(["v"])).passed
    assert not only(empty, amounts(spark, None), m.column_hash(["v"])).passed


def test_hash_needs_equal_types(spark):
    with pytest.raises(ValueError, match="cast"):
        m.reconciliation_report(amounts(spark, 1.0), spark.range(1).toDF("v"), [m.column_hash(["v"])])


def test_each_side_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "v")
    amounts(spark, 1.0, 2.0).write.parquet(path)
    df = spark.read.parquet(path)
    measures = [m.row_count(), m.aggregate("v"), m.aggregate("v", "avg"), m.column_hash(["v"])]
    plan = m.reconciliation_report(df, df, measures)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_gate(spark):
    df = amounts(spark, 1.0, 2.0)
    rows = m.enforce_reconciliation(m.reconciliation_report(df, df, [m.row_count(), m.aggregate("v")]), "t")
    assert [r.check_name for r in rows] == ["row_count", "sum:v"]
    bad = m.reconciliation_report(df, amounts(spark, 1.0), [m.row_count(), m.aggregate("v", "count")])
    with pytest.raises(m.ReconciliationError, match="2 reconciliation") as raised:
        m.enforce_reconciliation(bad, "t")
    assert isinstance(raised.value, RuntimeError)
    assert len(m.enforce_reconciliation(bad, "t", fail_on_error=False)) == 2


def test_several_pairs_are_numbered_through(spark):
    a, b = spark.createDataFrame([(1.0,), (2.0,)], "v double"), spark.createDataFrame([(1.0,)], "v double")
    rows = m.reconciliation_reports([(a, a, [m.row_count(), m.aggregate("v")]), (a, b, [m.row_count()])]).collect()
    assert sorted((r.check_no, r.passed) for r in rows) == [(1, True), (2, True), (3, False)]
    with pytest.raises(ValueError):
        m.reconciliation_reports([])

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import millrace as m
from millrace.plans import orders as plan

RAW = "order_id string, cust_id string, order_date string, amount string, qty string, status string"


def deliver(spark, path, *rows):
    spark.createDataFrame(list(rows), RAW).coalesce(1).write.mode("append").csv(path, header=True, nullValue="NULL")


def run(spark, root, run_date, target=None, **settings):
    return plan.run_orders(
        spark, run_date, f"{root}/raw/{run_date}/*.csv", f"{root}/zones", target or f"{root}/target",
        raw_schema=RAW, loaded_at=datetime(2024, 1, 1), **settings,
    )


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_two_days(spark, root, kind):
    target = f"{root}/target" if kind == "path" else f"t_{uuid.uuid4().hex}"
    deliver(
        spark, f"{root}/raw/2024-01-01",
        ("1", "c1", "2024-01-01", "1000", "3", "active"), ("1", "c1", "2024-01-01", "1000", "3", "active"),
        ("2", "c2", "2024-01-01", None, "0", None), ("3", "c3", "2023-12-31", "100", "2.0", "active"),
    )
    first = run(spark, root, "2024-01-01", target)
    assert (first.raw_rows, first.curated_rows, first.load.inserted) == (4, 3, 3)
    assert all(r.passed for r in (*first.quality, *first.reconciliation))

    deliver(
        spark, f"{root}/raw/2024-01-02",
        ("2", "c2", "2024-01-02", "50", "1", "shipped"), ("4", "c1", "2024-01-02", "99.5", "x", "active"),
    )
    second = run(spark, root, "2024-01-02", target)
    assert (second.load.inserted, second.load.updated) == (1, 1)
    assert [r.source_value for r in second.reconciliation] == [2.0, 149.5]

    found = m.read_target(spark, target).selectExpr(
        "id", "string(order_date) AS d", "amount", "qty", "unit_price", "status", "amount_tier", "_batch_id",
        "_source_system",
    )
    assert sorted(tuple(r) for r in found.collect()) == [
        ("1", "2024-01-01", 1000.0, 3, 333.33, "active", "HIGH", "2024-01-01", "orders_csv"),
        ("2", "2024-01-02", 50.0, 1, 50.0, "shipped", "LOW", "2024-01-02", "orders_csv"),
        ("3", "2023-12-31", 100.0, 2, 50.0, "active", "MEDIUM", "2024-01-01", "orders_csv"),
        ("4", "2024-01-02", 99.5, None, None, "active", "LOW", "2024-01-02", "orders_csv"),
    ]


def test_a_run_can_be_repeated(spark, root):
    deliver(spark, f"{root}/raw/2024-01-01", ("1", "c1", "2024-01-01", "10", "1", "a"))
    run(spark, root, "2024-01-01", grain="month")
    again = run(spark, root, "2024-01-01", grain="month")
    assert (again.curated_rows, again.load.inserted, again.load.updated) == (1, 0, 1)
    assert m.read_target(spark, f"{root}/target").count() == 1


def test_a_failed_check_stops_the_load(spark, root):
    deliver(spark, f"{root}/raw/2024-01-01", ("1", "c1", "2024-01-01", "-5", "1", "a"))
    with pytest.raises(m.QualityGateError, match="value_range:amount"):
        run(spark, root, "2024-01-01")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        m.read_target(spark, f"{root}/target")
    report = run(spark, root, "2024-01-01", fail_on_error=False)
    assert [r.check_name for r in report.quality if not r.passed] == ["value_range:amount"]


def test_an_empty_day_stops_the_load(spark, root):
    deliver(spark, f"{root}/raw/2024-01-01", ("1", "c1", "someday", "5", "1", "a"))
    with pytest.raises(m.QualityGateError, match="not_empty"):
        run(spark, root, "2024-01-01")


def test_reconciliation_looks_at_the_ids_of_the_batch(spark):
    batch = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, amount double")
    target = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 999.0)], "id int, amount double")
    assert all(r.passed for r in plan.reconcile_orders(batch, target).collect())
    lost = target.where("id <> 2")
    assert not any(r.passed for r in plan.reconcile_orders(batch, lost).collect())


def test_reconciliation_reads_only_the_partitions_of_the_batch(spark, root):
    rows = spark.range(40).selectExpr("id", "double(id) AS amount", "date_add(DATE '2024-01-01', int(id % 4)) AS order_date")
    m.write_table(rows, f"{root}/t", "overwrite", partition_by=["order_date"])
    report = plan.reconcile_orders(rows.where("order_date = DATE '2024-01-02'"), m.read_target(spark, f"{root}/t"))
    assert all(r.passed for r in report.collect())
    text = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in text and "(order_date" in text.split("PartitionFilters: ")[1]


def test_survivor_can_be_chosen(spark):
    raw = spark.createDataFrame(
        [("1", "c", "2024-01-01", "5", "1", "old"), ("1", "c", "2024-01-02", "6", "1", "new")], RAW
    )
    kept = plan.clean_orders("2024-01-02", order_by=[F.desc("order_date")]).apply(raw)
    assert [r.status for r in kept.collect()] == ["new"]


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        plan.with_grain(spark.range(1), "week")

import pytest

import millrace as m


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [(4, "hinge", 7.25, "sold"), (5, "bolt", 120.0, "open"), (6, "screw", 61.5, "open")],
        "id int, name string, amount double, status string",
    )


def only(df, *checks):
    rows = m.quality_report(df, list(checks)).collect()
    assert len(rows) == 1
    return rows[0]


def test_not_empty(spark, sample):
    row = only(sample, m.not_empty("t"))
    assert row.passed and row.observed == 3.0 and row.details == {"row_count": "3", "table": "t"}
    assert not only(spark.createDataFrame([], "id int"), m.not_empty()).passed


@pytest.mark.parametrize("threshold, passed", [(0.0, False), (0.49, False), (0.5, True), (1.0, True)])
def test_null_rate(spark, threshold, passed):
    df = spark.createDataFrame([(i, None if i % 2 else f"part {i}") for i in range(8)], "id int, name string")
    row = only(df, m.no_nulls(["name"], threshold))
    assert row.passed is passed
    assert row.details["null_count"] == "4" and float(row.details["null_rate"]) == 0.5


def test_null_rate_default_rounding_and_empty(spark):
    df = spark.range(21).selectExpr("nullif(id, 0) AS v")
    row = only(df, m.no_nulls(["v"]))
    assert row.passed and row.threshold == 0.05 and row.observed == 1 / 21
    assert float(row.details["null_rate"]) == 0.0476
    empty = spark.createDataFrame([], "v int")
    assert only(empty, m.no_nulls(["v"], 0.0)).passed


def test_unique(spark, sample):
    assert only(sample, m.unique(["id"])).passed
    df = spark.createDataFrame([(8, "p"), (3, "q"), (8, "r"), (8, "s")], "id int, val string")
    row = only(df, m.unique(["id"]))
    assert not row.passed
    assert row.details == {"total_rows": "4", "distinct_rows": "2", "duplicates": "2"}
    assert only(df, m.unique(["id", "val"])).passed


def test_unique_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    assert only(df, m.unique(["id"])).observed == 1.0
    assert only(spark.createDataFrame([], "id int"), m.unique(["id"])).passed


def test_value_range_nulls_nans_and_bounds(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-3.0,), (1.5,)], "v double")
    assert only(df, m.value_range("v", min_value=-3)).passed
    assert only(df, m.value_range("v", min_value=0)).observed == 1.0
    assert only(df, m.value_range("v", max_value=1.5)).observed == 1.0
    assert only(df, m.value_range("v", min_value=-5, max_value=0)).observed == 2.0
    assert only(df, m.value_range("v")).passed
    details = only(df, m.value_range("v", min_value=0)).details
    assert details == {"out_of_range_count": "1", "min": "0", "max": None}


def test_value_range_of_dates_and_text(spark):
    from datetime import date

    df = spark.createDataFrame([(date(2024, 1, 1), "b'c")], "d date, s string")
    assert only(df, m.value_range("d", date(2024, 1, 1), date(2024, 1, 31))).passed
    assert not only(df, m.value_range("d", date(2024, 1, 2))).passed
    assert only(df, m.value_range("s", "b'c", "b'c")).passed


def test_allowed_values(spark, sample):
    assert only(sample, m.allowed_values("status", ["open", "sold"])).passed
    df = spark.createDataFrame([(9, "open"), (9, "lost"), (7, "gone")], "id int, status string")
    row = only(df, m.allowed_values("status", ["open", "sold"]))
    assert not row.passed and row.details["violation_count"] == "2"


def test_allowed_values_none_in_list_empty_list_and_null_rows(spark):
    df = spark.createDataFrame([("a",), ("x",), (None,)], "v string")
    assert only(df, m.allowed_values("v", ["a", None])).observed == 1.0
    assert only(df, m.allowed_values("v", [])).observed == 2.0
    assert only(df, m.allowed_values("v", [None])).observed == 2.0


def test_allowed_values_from_a_table(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 333 THEN 'hot' WHEN id < 990 THEN string(id) END AS v")
    listed = spark.range(400, 5000).selectExpr("string(id) AS anything").unionAll(
        spark.createDataFrame([("hot",), (None,)], "anything string")
    )
    row = only(df, m.allowed_values("v", listed))
    assert row.observed == float(400 - 333) and not row.passed
    assert only(df, m.allowed_values("v", listed.limit(0))).observed == 990.0


def test_schema(sample):
    assert only(sample, m.has_columns(["ID", "name"])).passed
    row = only(sample, m.has_columns(["id", "nonexistent"]))
    assert not row.passed and row.observed == 1.0
    assert row.details == {"missing_columns": "nonexistent", "actual_columns": "id,name,amount,status"}


def test_checks_on_missing_columns_fail_instead_of_raising(sample):
    checks = [
        m.no_nulls(["gone"]), m.unique(["id", "gone"]), m.value_range("gone", 0), m.allowed_values("gone", ["a"])
    ]
    rows = m.quality_report(sample, checks).collect()
    assert [r.passed for r in rows] == [False] * 4
    assert all("gone" in r.details["error"] for r in rows)


def test_row_local_checks_share_one_scan(spark, sample, tmp_path):
    path = str(tmp_path / "sample")
    sample.write.parquet(path)
    df = spark.read.parquet(path)
    local = [
        m.not_empty(), m.has_columns(["id"]), m.no_nulls(["id", "name"]), m.value_range("amount", 0),
        m.allowed_values("status", ["open"]),
    ]
    plan = m.quality_report(df, local)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    plan = m.quality_report(df, [*local, m.unique(["id"])])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert "ReadSchema: struct<id:int>" in plan


def test_gate(sample):
    good = m.quality_report(sample, [m.unique(["id"]), m.not_empty("t"), m.no_nulls(["id", "name"])])
    rows = m.enforce_quality(good, "t")
    assert [r.check_name for r in rows] == ["unique:id", "not_empty", "no_nulls:id", "no_nulls:name"]

    bad = m.quality_report(sample, [m.value_range("amount", 60), m.not_empty(), m.has_columns(["gone"])])
    with pytest.raises(m.QualityGateError, match="2 quality check") as raised:
        m.enforce_quality(bad, "t")
    assert isinstance(raised.value, RuntimeError)
    assert "value_range:amount" in str(raised.value) and "schema_check" in str(raised.value)
    assert [r.passed for r in m.enforce_quality(bad, "t", fail_on_error=False)] == [False, True, False]


def test_a_report_needs_a_check(sample):
    with pytest.raises(ValueError):
        m.quality_report(sample, [])


def test_several_frames_are_numbered_through(spark, sample):
    other = spark.createDataFrame([(1,), (1,)], "k int")
    suites = [(sample, [m.not_empty(), m.no_nulls(["id", "name"])]), (other, [m.unique(["k"]), m.has_columns(["k"])])]
    rows = m.enforce_quality(m.quality_reports(suites), "both", fail_on_error=False)
    assert [(r.check_no, r.passed) for r in rows] == [(1, True), (2, True), (3, True), (4, False), (5, True)]
    with pytest.raises(ValueError):
        m.quality_reports([])

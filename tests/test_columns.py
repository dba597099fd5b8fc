import math
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

import millrace as m


def values(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def orders(spark):
    rows = [
        (11, "n-4", "2023-06-30", 740.25, 3, "open"),
        (12, "n-9", "2023-07-01", None, 8, "open"),
        (11, "n-4", "2023-06-30", 740.25, 3, "open"),
        (15, "n-4", "2023-07-02", 18.0, 6, None),
        (16, "n-7", "2023-07-02", 99.5, 4, "shut"),
    ]
    return spark.createDataFrame(
        rows, "order_id int, cust_id string, order_date string, amount double, qty int, status string"
    )


def test_rename_swaps_and_skips_absent(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    renamed = m.rename_columns(df, {"a": "b", "b": "a", "absent": "c"})
    assert renamed.columns == ["b", "a"]
    assert values(renamed) == [(1, "x")]


def test_rename_resolves_names_like_the_session(spark):
    df = spark.createDataFrame([(1,)], "Order_Id int")
    assert m.rename_columns(df, {"order_id": "id"}).columns == ["id"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert m.rename_columns(df, {"order_id": "id"}).columns == ["Order_Id"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_rename_onto_an_existing_name_is_refused(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        m.rename_columns(df, {"a": "b"})


INTEGERS = [
    ("7", 7), (" 7 ", 7), ("\t+7\n", 7), ("-7", -7), ("2.5", 2), ("2.", 2), ("-0.9", 0), ("", None),
    ("abc", None), ("1e3", None), ("12x", None), ("2147483647", 2147483647), ("2147483648", None),
    ("1.5.2", None), (None, None),
]


def test_text_to_integer(spark):
    df = spark.createDataFrame([(text,) for text, _ in INTEGERS], "v string")
    cast = m.cast_columns(df, {"v": "integer"})
    assert [r.v for r in cast.collect()] == [expected for _, expected in INTEGERS]
    assert dict(cast.dtypes) == {"v": "int"}


DOUBLES = [
    ("1.5", 1.5), (" -1.5e2 ", -150.0), (".5", 0.5), ("5.", 5.0), ("n/a", None), ("", None),
    ("Infinity", math.inf), ("-inf", -math.inf), ("1.5d", 1.5), ("nanny", None), (None, None),
]


def test_text_to_double_agrees_with_try_cast(spark):
    df = spark.createDataFrame([(text,) for text, _ in DOUBLES], "v string")
    cast = m.cast_columns(df, {"v": "double"})
    assert [r.v for r in cast.collect()] == [expected for _, expected in DOUBLES]
    assert cast.collect() == df.select(F.col("v").try_cast("double").alias("v")).collect()


DATES = [
    ("2024-01-10", date(2024, 1, 10)), ("2024-1-1", date(2024, 1, 1)), ("2024", date(2024, 1, 1)),
    ("2024-02", date(2024, 2, 1)), ("2024-01-10 05:00:00", date(2024, 1, 10)),
    ("2024-01-10T05:00", date(2024, 1, 10)), ("01/02/2024", None), ("2024-13-01", None), ("soon", None),
]


def test_text_to_date_agrees_with_try_cast(spark):
    df = spark.createDataFrame([(text,) for text, _ in DATES], "v string")
    cast = m.cast_columns(df, {"v": "date"})
    assert [r.v for r in cast.collect()] == [expected for _, expected in DATES]
    assert cast.collect() == df.select(F.col("v").try_cast("date").alias("v")).collect()


@pytest.mark.parametrize("target", ["double", "float", "decimal(12,3)", "date"])
def test_pattern_lets_every_castable_text_through(spark, target):
    rng = random.Random(5)
    parts = ["1", "20", "2024", "007", ".", "-", "+", "e", "E5", "d", "F", "inf", "Infinity", "NaN", " ", "\t", "T", ":",
             "/", "-01", "-3", "0x1p3", "x", "12:30", "\u00a0", "\x01"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    both = m.cast_columns(df.withColumn("w", F.col("v")), {"w": target}).withColumn("plain", F.col("v").try_cast(target))
    differ = both.where("NOT (w <=> plain)").selectExpr("v", "string(w)", "string(plain)").collect()
    assert not differ
    assert both.where("plain IS NOT NULL").count() > 20


def test_number_to_integer(spark):
    df = spark.createDataFrame([(2.9, 3e10, float("nan"))], "a double, b double, c double")
    assert values(m.cast_columns(df, dict.fromkeys("abc", "int"))) == [(2, None, None)]


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        m.cast_columns(df, {"v": "int"}, strict=True).collect()


def test_cast_skips_absent_columns_and_types_the_rest(orders):
    cast = m.cast_columns(orders, {"amount": "integer", "order_date": "date", "absent": "int"})
    types = dict(cast.dtypes)
    assert (types["amount"], types["order_date"]) == ("int", "date")
    assert cast.columns == orders.columns


def test_fill_replaces_null_and_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-3.0,), (1.5,)], "v double")
    assert values(m.fill_nulls(df, {"v": 0.0})) == [(0.0,), (0.0,), (-3.0,), (1.5,)]


def test_fill_of_an_unknown_column_raises(orders):
    with pytest.raises(Exception, match="absent"):
        m.fill_nulls(orders, {"absent": 0}).collect()


def test_drop_skips_absent(orders):
    assert m.drop_columns(orders, ["qty", "absent"]).columns == [c for c in orders.columns if c != "qty"]


def test_filter_drops_null_predicates(orders):
    assert [r.order_id for r in m.filter_rows(orders, "amount > 100").collect()] == [11, 11]


def test_audit_columns(orders):
    at = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    audited = m.add_audit_columns(orders, "2024-01-01", "test", at)
    assert audited.columns[-3:] == ["_etl_loaded_at", "_batch_id", "_source_system"]
    row = audited.selectExpr("unix_seconds(_etl_loaded_at)", "_batch_id", "_source_system").first()
    assert tuple(row) == (int(at.timestamp()), "2024-01-01", "test")


def test_audit_time_without_zone_is_in_the_zone_of_the_session(spark, orders):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        audited = m.add_audit_columns(orders, "b", loaded_at=datetime(2024, 1, 2, 3, 4, 5))
        row = audited.selectExpr("string(_etl_loaded_at) AS shown", "unix_seconds(_etl_loaded_at) AS at").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.shown == "2024-01-02 03:04:05"
    assert row.at == int(datetime(2024, 1, 1, 18, 4, 5, tzinfo=timezone.utc).timestamp())


def test_audit_defaults(orders):
    audited = m.add_audit_columns(orders, batch_id="", source="")
    assert "_source_system" not in audited.columns
    batch_ids = {r._batch_id for r in audited.collect()}
    assert len(batch_ids) == 1 and len(batch_ids.pop()) == 14
    first, second = audited.first()._etl_loaded_at, audited.first()._etl_loaded_at
    assert first == second


def test_flatten_part_wins_over_column_and_over_its_own_struct(spark):
    df = spark.createDataFrame([((1, "in", 3), 9)], "s struct<a: int, s: string, b: int>, a int")
    flat = m.flatten_column(df, "s")
    assert flat.columns == ["a", "s", "b"]
    assert values(flat) == [(1, "in", 3)]


def test_flatten_with_prefix_and_null_struct(spark):
    df = spark.createDataFrame([(1, (2, 3)), (2, None)], "id int, s struct<a: int, b: int>")
    flat = m.flatten_column(df, "s", prefix="s")
    assert flat.columns == ["id", "s_a", "s_b"]
    assert values(flat) == [(1, 2, 3), (2, None, None)]


def test_flatten_map_takes_keys(spark):
    df = spark.createDataFrame([({"x": 1, "o'k": 2},), (None,)], "m map<string, int>")
    assert m.flatten_column(df, "m").columns == ["m"]
    flat = m.flatten_column(df, "m", prefix="m", keys=["x", "o'k", "z"])
    assert flat.columns == ["m_x", "m_o'k", "m_z"]
    assert values(flat) == [(1, 2, None), (None, None, None)]


@pytest.mark.parametrize("column", ["absent", "id", "list"])
def test_flatten_leaves_other_columns_alone(spark, column):
    df = spark.createDataFrame([(1, [1, 2])], "id int, list array<int>")
    assert values(m.flatten_column(df, column)) == [(1, [1, 2])]


def test_names_with_dots(spark):
    df = spark.createDataFrame([("7", (1,))], "`a.b` string, `s.t` struct<`x.y`: int>")
    cast = m.flatten_column(m.cast_columns(df, {"a.b": "int"}), "s.t")
    assert cast.columns == ["a.b", "x.y"]
    assert values(cast) == [(7, 1)]


def test_recipe_runs_in_order_and_is_reusable(orders):
    base = m.Recipe("r").rename({"cust_id": "customer_id"}).fill({"amount": 0.0, "status": "UNKNOWN"})
    full = base.dedup(["order_id"]).audit(batch_id="20240101")
    assert len(base.steps) == 2
    first, second = full.apply(orders), full.apply(orders.limit(1))
    assert "customer_id" in first.columns and "_etl_loaded_at" in first.columns
    assert sorted(r.amount for r in first.collect()) == [0.0, 18.0, 99.5, 740.25]
    assert second.count() == 1


def test_recipe_takes_any_function(orders):
    recipe = m.Recipe("r").then(lambda df, n: df.limit(n), 1).drop(["qty"])
    assert recipe.apply(orders).count() == 1

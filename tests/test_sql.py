import pytest

import millrace as m


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(1, "c1", 250.0, "active"), (2, "c2", None, "active"), (3, "c1", 50.0, None)],
        "order_id int, cust_id string, amount double, status string",
    )


def test_one_statement(orders):
    assert [r.order_id for r in m.run_sql(orders, "SELECT * FROM src WHERE order_id = 1").collect()] == [1]


def test_view_name_can_be_set(orders):
    assert m.run_sql(orders, "SELECT count(*) AS n FROM orders_in", view="orders_in").first().n == 3


def test_params_are_bound_as_values(orders):
    text = "SELECT * FROM src WHERE status = :p"
    assert m.run_sql(orders, text, params={"p": "active"}).count() == 2
    assert m.run_sql(orders, text, params={"p": "x' OR '1' = '1"}).count() == 0


def test_identifier_params(orders):
    text = "SELECT IDENTIFIER(:c) AS v FROM IDENTIFIER(:t) ORDER BY v"
    assert [r.v for r in m.run_sql(orders, text, params={"c": "order_id", "t": "src"}).collect()] == [1, 2, 3]


def test_braces_in_text_are_left_alone(orders):
    row = m.run_sql(orders, """SELECT from_json('{"k": 1}', 'k int').k AS k FROM src""").first()
    assert row.k == 1


def test_file(orders, tmp_path):
    file = tmp_path / "q.sql"
    file.write_text("SELECT cust_id, sum(amount) AS total FROM src GROUP BY cust_id")
    assert dict(m.run_sql_file(orders, file).collect()) == {"c1": 300.0, "c2": None}
    with pytest.raises(FileNotFoundError):
        m.run_sql_file(orders, tmp_path / "absent.sql")


def test_steps_see_input_and_every_earlier_step(orders):
    steps = [
        ("big", "SELECT * FROM src WHERE amount > 100"),
        ("small", "SELECT * FROM src WHERE amount <= 100"),
        ("both", "SELECT 'big' AS kind, order_id FROM big UNION ALL SELECT 'small', order_id FROM small"),
    ]
    assert sorted(tuple(r) for r in m.run_sql_steps(orders, steps).collect()) == [("big", 1), ("small", 3)]


def test_views_do_not_outlive_the_call(spark, orders):
    m.run_sql_steps(orders, [("step_one", "SELECT * FROM src")]).collect()
    assert not {t.name for t in spark.catalog.listTables()} & {"src", "step_one"}
    with pytest.raises(Exception, match="absent_table"):
        m.run_sql(orders, "SELECT * FROM absent_table")
    assert "src" not in {t.name for t in spark.catalog.listTables()}


def test_a_view_of_the_same_name_comes_back(spark, orders):
    spark.range(5).createOrReplaceTempView("src")
    try:
        assert m.run_sql(orders, "SELECT * FROM src").count() == 3
        assert spark.table("src").count() == 5
        assert m.run_sql(spark.table("src"), "SELECT * FROM src").count() == 5
    finally:
        spark.catalog.dropTempView("src")


def test_step_counts_fill_on_one_action(orders):
    counts = {}
    result = m.run_sql_steps(
        orders,
        [("known", "SELECT * FROM src WHERE amount IS NOT NULL"), ("big", "SELECT * FROM known WHERE amount > 100")],
        counts=counts,
    )
    result.collect()
    assert {name: seen.get["rows"] for name, seen in counts.items()} == {"known": 2, "big": 1}


def test_exact_step_counts(orders):
    steps = [("known", "SELECT * FROM src WHERE amount IS NOT NULL"), ("none", "SELECT * FROM known WHERE false")]
    assert dict(m.count_sql_steps(orders, steps).collect()) == {"known": 2, "none": 0}


def test_step_counts_scan_the_source_once(spark, tmp_path):
    spark.range(50).write.csv(str(tmp_path / "source"))
    seen = spark.sparkContext.accumulator(0)
    source = spark.read.schema("id bigint").csv(str(tmp_path / "source"))

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    steps = [("even", "SELECT * FROM src WHERE id % 2 = 0"), ("few", "SELECT * FROM even WHERE id < 10")]
    counted = m.count_sql_steps(source.mapInPandas(count, "id bigint"), steps)
    assert dict(counted.collect()) == {"even": 25, "few": 5} and seen.value == 50


def test_forms_and_precedence(orders, tmp_path):
    file = tmp_path / "q.sql"
    file.write_text("SELECT 'file' AS via FROM src")
    steps = [("s", "SELECT 'steps' AS via FROM src")]
    text = "SELECT 'text' AS via FROM src"
    assert m.transform_sql(orders, text, file, steps).first().via == "steps"
    assert m.transform_sql(orders, text, file).first().via == "file"
    assert m.transform_sql(orders, text).first().via == "text"
    with pytest.raises(ValueError):
        m.transform_sql(orders)
    with pytest.raises(ValueError):
        m.run_sql_steps(orders, [])


def test_filters_reach_the_scan(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    orders.write.parquet(path)
    steps = [("a", "SELECT order_id, amount FROM src"), ("b", "SELECT order_id FROM a WHERE order_id > 1")]
    plan = m.run_sql_steps(spark.read.parquet(path), steps)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(order_id,1)" in plan
    assert "ReadSchema: struct<order_id:int>" in plan

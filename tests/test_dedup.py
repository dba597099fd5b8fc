import random

from pyspark.sql import functions as F

import millrace as m


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_row(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "id int, v string")
    assert m.drop_duplicates(df).count() == 2
    assert m.drop_duplicates(df, []).count() == 2


def test_key_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id int, v string")
    kept = m.drop_duplicates(df, ["ID"]).collect()
    assert sorted(str(r.id) for r in kept) == ["1", "None"]
    assert {tuple(r) for r in kept} <= {tuple(r) for r in df.collect()}


def test_order_decides_against_brute_force(spark):
    rng = random.Random(7)
    # key 0 holds about a third of the rows
    rows = [(0 if rng.random() < 0.33 else rng.randrange(50), rng.randrange(1000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int, i int").repartition(6)
    best = {}
    for k, v, i in rows:
        if k not in best or (-v, i) < (-best[k][1], best[k][2]):
            best[k] = (k, v, i)
    found = m.drop_duplicates(df, ["k"], [F.desc("v"), "i"])
    assert sorted(tuple(r) for r in found.collect()) == sorted(best.values())


def test_hot_keys_shrink_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    ordered = plan(m.drop_duplicates(df, ["k"], ["v"]))
    before_shuffle = ordered[ordered.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    arbitrary = plan(m.drop_duplicates(df, ["k"]))
    assert "partial_first" in arbitrary[arbitrary.index("Exchange"):]

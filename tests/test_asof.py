"""As-of joins against a search per row, with hot keys over many partitions, equal times, nulls and both directions."""

import random

import pytest

import millrace as m
from millrace.operators import ordered


def by_search(left, right, keyed, direction, exact, reach):
    out = []
    for i, k, t in left:
        near = []
        for j, rk, rt in right:
            if t is None or rt is None or (keyed and (k is None or rk != k)):
                continue
            far = t - rt if direction == "backward" else rt - t
            if far >= 0 and (exact or far > 0) and (reach is None or far <= reach):
                near.append((far, -j if direction == "backward" else j, j))
        out.append((i, min(near)[2] if near else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(11)
    keys = ["hot"] * 4 + ["a", "b", None]
    make = lambda n, s: [(i, rng.choice(keys), rng.choice([None, *range(s)])) for i in range(n)]
    return make(500, 60), make(120, 60)


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize(("direction", "exact", "reach"), [("backward", True, None), ("backward", False, 3), ("forward", True, 2), ("forward", False, None)])
def test_against_search(spark, sides, keyed, direction, exact, reach):
    left, right = sides
    one = spark.createDataFrame(left, "id int, k string, t int").repartition(4)
    two = spark.createDataFrame(right, "id int, k string, u int").repartition(4)
    found = m.join_asof(
        one, two, ("t", "u"), ["k"] if keyed else [], direction=direction, exact=exact, tie=["id"],
        tolerance=None if reach is None else str(reach), partitions=9,
    )
    assert found.columns == ["id", "k", "t", "id_right", *([] if keyed else ["k_right"]), "u"]
    assert sorted(((r.id, r.id_right) for r in found.collect()), key=str) == by_search(left, right, keyed, direction, exact, reach)


def test_repeated_left_rows_stay(spark):
    one = spark.createDataFrame([(1, 5)] * 40, "k int, t int").repartition(3)
    two = spark.createDataFrame([(1, 4, "x"), (1, 6, "y")], "k int, u int, v string")
    found = m.join_asof(one, two, ("t", "u"), ["k"], take=["v"], partitions=8)
    assert found.columns == ["k", "t", "v"] and [r.v for r in found.collect()] == ["x"] * 40


def test_times_and_intervals(spark):
    one = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-02 00:00:00' AS t UNION ALL SELECT 1, timestamp_ntz'2024-01-09 00:00:00'")
    two = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-01 00:00:00' AS u, 7 AS v")
    found = m.join_asof(one, two, ("t", "u"), ["k"], take=["v"], tolerance="INTERVAL 2 DAYS").orderBy("t").collect()
    assert [r.v for r in found] == [7, None]


def test_a_hot_key_is_dealt_to_many_tasks(spark, monkeypatch):
    seen = []
    deal = ordered.deal_by_range

    def watch(df, keys, part, row, partitions=None):
        dealt = deal(df, keys, part, row, partitions)
        seen.append(dealt.groupBy(part).count().count())
        return dealt

    monkeypatch.setattr("millrace.operators.asof.deal_by_range", watch)
    one = spark.range(3000).selectExpr("1 AS k", "id AS t")
    found = m.join_asof(one, one.selectExpr("k", "t * 5 AS u"), ("t", "u"), ["k"], partitions=16)
    assert found.where("u = t - t % 5").count() == 3000 and seen[0] >= 14
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_empty_sides_and_wrong_arguments(spark, sides):
    one = spark.createDataFrame(sides[0], "id int, k string, t int")
    two = spark.createDataFrame(sides[1], "id int, k string, u int")
    assert m.join_asof(one.limit(0), two, ("t", "u"), ["k"]).collect() == []
    assert all(r.u is None for r in m.join_asof(one, two.limit(0), ("t", "u"), ["k"]).collect())
    with pytest.raises(ValueError, match="direction"):
        m.join_asof(one, two, ("t", "u"), direction="nearest")
    with pytest.raises(ValueError, match="type"):
        m.join_asof(one, two, ("k", "u"))
    with pytest.raises(ValueError, match="twice"):
        m.join_asof(one.withColumnRenamed("k", "id_right"), two, ("t", "u"))

"""Overlap joins against all pairs, for lengths of every level, points, open ends, hot keys and unusable bounds."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import millrace as m
from millrace.operators import intervals

INF, NAN = float("inf"), float("nan")


def frames(spark, left, right, kind="double", key="string"):
    one = spark.createDataFrame(left, f"id int, k {key}, a {kind}, b {kind}").repartition(3)
    two = spark.createDataFrame(right, f"id int, k {key}, c {kind}, d {kind}").repartition(3)
    return one, two


def usable(row):
    return all(v is not None and v == v for v in row[2:]) and row[2] <= row[3]


def by_pairs(left, right, keyed, outer=False):
    out = []
    for x in left:
        found = [y for y in right if usable(x) and usable(y) and (not keyed or (x[1] is not None and x[1] == y[1])) and x[2] <= y[3] and y[2] <= x[3]]
        out += [(x[0], y[0]) for y in found] or ([(x[0], None)] if outer else [])
    return sorted(out, key=str)


def rows(rng, n, ends):
    return [(i, rng.choice(["hot", "hot", "a", None]), *ends(rng)) for i in range(n)]


def any_length(rng):
    a = rng.uniform(-1000, 1000)
    lengths = [(a, a), (a, a + 2.0 ** rng.randrange(-20, 11)), (a, a + rng.random()), (a, a - 1)]
    ends = [(None, a), (a, None), (NAN, a), (a, INF), (-INF, a), (-INF, INF), (INF, INF)]
    return rng.choice(lengths + ends)


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_against_all_pairs(spark, keyed, how):
    rng = random.Random(8)
    left, right = rows(rng, 160, any_length), rows(rng, 160, any_length)
    one, two = frames(spark, left, right)
    by = ["k"] if keyed else []
    found = m.join_overlapping(one, two, ("a", "b"), ("c", "d"), by, how)
    assert found.columns == ["id", "k", "a", "b", "id_right", *([] if keyed else ["k_right"]), "c", "d"]
    assert sorted(((r.id, r.id_right) for r in found.collect()), key=str) == by_pairs(left, right, keyed, how == "left")


@pytest.mark.parametrize(("kind", "make"), [
    ("long", lambda v: v), ("long", lambda v: v + 2**60), ("date", lambda v: date(2024, 1, 1) + timedelta(days=v)),
    ("timestamp", lambda v: datetime(2024, 1, 1) + timedelta(seconds=v, microseconds=v % 7)),
    ("timestamp_ntz", lambda v: datetime(2024, 1, 1) + timedelta(hours=v))])
def test_kinds_of_bounds(spark, kind, make):
    rng = random.Random(9)

    def ends(rng):
        a = rng.randrange(300)
        return make(a), make(a + rng.choice([0, 0, 1, 5, 64, 200]))

    left, right = rows(rng, 80, ends), rows(rng, 80, ends)
    one, two = frames(spark, left, right, kind)
    found = m.join_overlapping(one, two, ("a", "b"), ("c", "d"), ["k"])
    assert sorted(((r.id, r.id_right) for r in found.collect()), key=str) == by_pairs(left, right, True)


def test_points_and_repeated_rows(spark):
    left = [(1, "a", 0.0, 10.0), (1, "a", 0.0, 10.0), (2, "a", 10.0, 10.0)]
    points = [(i, "a", float(i), float(i)) for i in range(9, 12)] * 2
    one, two = frames(spark, left, points)
    found = m.join_overlapping(one, two.drop("d"), ("a", "b"), "c")
    assert sorted((r.id, r.id_right) for r in found.collect()) == sorted((x[0], p[0]) for x in left for p in points if x[2] <= p[2] <= x[3])


def test_two_short_intervals_never_meet_in_a_long_cell(spark):
    """4,000 points a side at places of their own beside one interval over all: candidates stay in proportion."""
    left = spark.range(4000).selectExpr("id", "CAST(id AS DOUBLE) AS a", "CAST(id AS DOUBLE) AS b").union(spark.sql("SELECT 9999L, -1D, 5000D"))
    right = spark.range(4000).selectExpr("id AS other", "id + 0.5D AS c").union(spark.sql("SELECT 9999L, 2D"))
    found = m.join_overlapping(left, right, ("a", "b"), "c")
    assert found.count() == 4002
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_empty_sides_and_wrong_arguments(spark):
    one, two = frames(spark, [(1, "a", 1.0, 2.0)], [(1, "a", 1.0, 2.0)])
    assert m.join_overlapping(one.limit(0), two, ("a", "b"), ("c", "d")).collect() == []
    assert m.join_overlapping(one, two.limit(0), ("a", "b"), ("c", "d")).collect() == []
    (kept,) = m.join_overlapping(one, two.limit(0), ("a", "b"), ("c", "d"), how="left").collect()
    assert kept.id == 1 and kept.c is None
    with pytest.raises(ValueError, match="how"):
        m.join_overlapping(one, two, ("a", "b"), ("c", "d"), how="outer")
    with pytest.raises(ValueError, match="differ"):
        m.join_overlapping(one, two, ("a", "b"), ("id", "id"))
    with pytest.raises(ValueError, match="twice"):
        m.join_overlapping(one.withColumnRenamed("k", "id_right"), two, ("a", "b"), ("c", "d"))


@pytest.mark.parametrize(("few", "many"), [(0, 100), (2, 100), (100, 30), (100, 100)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_and_other_keys(spark, monkeypatch, how, few, many):
    """Keys of the grid and keys of their own, each pair made once, wherever the line between them lies."""
    monkeypatch.setattr(intervals, "FEW", few)
    monkeypatch.setattr(intervals, "MANY", many)
    rng = random.Random(10)
    keys = ["hot"] * 40 + [f"k{i % 25}" for i in range(60)] + [None]
    left, right = ([(i, rng.choice(keys), *any_length(rng)) for i in range(120)] for _ in range(2))
    one, two = frames(spark, left, right)
    found = m.join_overlapping(one, two, ("a", "b"), ("c", "d"), ["k"], how)
    assert sorted(((r.id, r.id_right) for r in found.collect()), key=str) == by_pairs(left, right, True, how == "left")


def test_rows_of_other_keys_are_sent_once(spark):
    """No copies for cells and no packed rows where every key has few rows on one side."""
    left = spark.range(500).selectExpr("id AS k", "CAST(id AS DOUBLE) AS a", "id + pow(2D, id % 9) AS b")
    right = spark.range(3000).selectExpr("id % 500 AS k", "CAST(id % 700 AS DOUBLE) AS c", "id AS n", "'unused' AS more")
    found = m.join_overlapping(left, right, ("a", "b"), "c", ["k"]).groupBy("k").agg(F.sum("n").alias("n"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "unused" not in plan and "struct" not in plan
    want = {}
    for i in range(3000):
        if i % 500 <= i % 700 <= i % 500 + 2 ** (i % 500 % 9):
            want[i % 500] = want.get(i % 500, 0) + i
    assert {r.k: r.n for r in found.collect()} == want


@pytest.mark.parametrize(("keyed", "how"), [(False, "inner"), (True, "left")])
def test_measures_against_all_pairs(spark, keyed, how):
    rng = random.Random(11)
    left, right = rows(rng, 150, any_length), [(*r[:3], r[2]) for r in rows(rng, 150, any_length)]
    left += left[:9] + [(900 + i, r[1], r[2], r[2]) for i, r in enumerate(right[:20])]
    right += right[:9] + [(None, *r[1:]) for r in right[:9]]
    one, two = frames(spark, left, right)
    made = {"n": ("count", "*"), "least": ("min", "id"), "most": ("max", "id"), "ids": ("sum", "id"), "known": ("count", "id")}
    found = m.join_overlapping(one, two, ("a", "b"), "c", ["k"] if keyed else [], how, measures=made)
    assert found.columns == [*one.columns, *made]
    want = []
    for x in left:
        ids = [y for _, y in by_pairs([x], right, keyed)]
        known = [y for y in ids if y is not None]
        if ids:
            want.append((x[0], len(ids), min(known, default=None), max(known, default=None), sum(known) if known else None, len(known)))
        elif how == "left":
            want.append((x[0], *[None] * 5))
    assert sorted(((r.id, r.n, r.least, r.most, r.ids, r.known) for r in found.collect()), key=str) == sorted(want, key=str)


def test_measures_make_no_pairs(spark):
    """50,000 intervals that all hold 50,000 points: 2.5 billion pairs."""
    left = spark.range(50_000).selectExpr("id", "-1D - id AS a", "50000D + id AS b")
    right = spark.range(50_000).selectExpr("id AS point", "CAST(id AS DOUBLE) AS c")
    found = m.join_overlapping(left, right, ("a", "b"), "c", measures={"n": ("count", "*"), "last": ("max", "point")})
    assert found.groupBy("n", "last").count().collect() == [(50_000, 49_999, 50_000)]
    with pytest.raises(ValueError, match="measures"):
        m.join_overlapping(left, right, ("a", "b"), ("c", "c"), measures={"n": ("count", "*")})
    with pytest.raises(ValueError, match="twice"):
        m.join_overlapping(left, right, ("a", "b"), "c", measures={"a": ("count", "*")})

import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import millrace as m
from millrace import storage
from millrace.functions.names import qualified_name
from millrace.operators import sinks
from millrace.operators.merge import ACTION, repeated_key
from millrace.operators.sinks import lay_out, publish_stage

SCHEMA = "k int, v string, w int, p string"


@pytest.fixture(params=["path", "table"])
def target(request, tmp_path):
    return str(tmp_path / "target") if request.param == "path" else f"t_{uuid.uuid4().hex}"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def content(spark, target, *columns):
    return sorted(
        (tuple(r) for r in m.read_target(spark, target).select(*columns or ["k", "v", "w", "p"]).collect()),
        key=repr,
    )


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


# ---- append and overwrite -------------------------------------------------------------------


@pytest.mark.parametrize(
    "wrong",
    [
        "k int, v int, w int, p string",
        "k int, v string, w int, p string, extra int",
        "k int, v string, w int",
        "k string, v string, w int, p string",
    ],
)
def test_append_refuses_other_columns_and_types(spark, tmp_path, wrong):
    target = str(tmp_path / "target")
    m.write_table(frame(spark, (1, "a", 1, "x")), target)
    kinds = {"int": 5, "string": "s"}
    row = tuple(kinds[c.split()[1]] for c in wrong.split(", "))
    other = frame(spark, row, schema=wrong)
    if wrong.startswith("k int, v int"):
        m.write_table(other, target)  # a number is safely widened to text
        assert content(spark, target) == [(1, "a", 1, "x"), (5, "5", 5, "s")]
        return
    with pytest.raises(ValueError, match="not appended"):
        m.write_table(other, target)
    assert content(spark, target) == [(1, "a", 1, "x")]


def test_append_widens_and_reorders(spark, tmp_path):
    target = str(tmp_path / "target")
    m.write_table(frame(spark, (1, 1.0), schema="k long, v double"), target)
    m.write_table(frame(spark, (2.5, 2), schema="V float, K int"), target)
    assert content(spark, target, "k", "v") == [(1, 1.0), (2, 2.5)]


def test_an_empty_overwrite_keeps_layout_and_schema(spark, tmp_path):
    target = str(tmp_path / "target")
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite", partition_by=["p", "w"])
    m.write_table(frame(spark, (1, "a", 1, "x")).limit(0), target, "overwrite", partition_by=["p", "w"])
    assert content(spark, target) == []
    assert m.read_target(spark, target).schema["k"].dataType.simpleString() == "int"
    m.write_table(frame(spark, (2, "b", 2, "y")), target, "append")
    assert (Path(target) / "p=y" / "w=2").is_dir() and content(spark, target, "k", "v") == [(2, "b")]
    with pytest.raises(ValueError, match="not appended"):
        m.write_table(frame(spark, ("z", "b", 2, "y"), schema="k string, v string, w int, p string"), target)


def test_a_key_that_is_a_partition_column_prunes_the_key_pass(spark, tmp_path, monkeypatch):
    target, seen = str(tmp_path / "target"), []
    rows = [(i, "a", i, f"p{i % 5}") for i in range(50)]
    m.write_table(frame(spark, *rows), target, "overwrite", partition_by=["p"])
    found = sinks.matched_keys

    def watch(current, df, keys, partitions):
        seen.append(current._jdf.queryExecution().executedPlan().toString())
        return found(current, df, keys, partitions)

    monkeypatch.setattr(sinks, "matched_keys", watch)
    done = m.write_table(frame(spark, (1, "b", 1, "p1"), (60, "c", 60, "p2"), (7, "n", 7, None)), target, "merge", keys=["p", "k"])
    assert "dynamicpruning" in seen[0] and (done.updated, done.inserted) == (1, 2)
    want = sorted([(i, "b" if i == 1 else "a", i, p) for i, _, _, p in rows] + [(60, "c", 60, "p2"), (7, "n", 7, None)], key=repr)
    assert content(spark, target) == want


def test_a_narrow_batch_reads_few_of_the_keys(spark, target, monkeypatch):
    seen, found = [], sinks.matched_keys

    def watch(current, df, keys, partitions):
        hits = found(current, df, keys, partitions)
        seen.append((hits._jdf.queryExecution().executedPlan().toString(), current.count()))
        return hits

    monkeypatch.setattr(sinks, "matched_keys", watch)
    rows = [(i, "a", i, f"p{i % 3}") for i in range(300)]
    m.write_table(frame(spark, *rows), target, "overwrite", cluster_by=["k"])
    done = m.write_table(frame(spark, (40, "b", 1, "p1"), (45, "c", 2, "p0"), (None, "n", 3, "p0")), target, "merge", keys=["k", "p"])
    plan, read = seen[0]
    assert "GreaterThanOrEqual(k,40)" in plan and "LessThanOrEqual(k,45)" in plan and read == 4
    assert (done.updated, done.inserted, done.kept) == (2, 1, 298)
    empty = m.write_table(frame(spark, (1, "a", 1, "x")).limit(0), target, "merge", keys=["k"])
    assert (empty.updated, empty.inserted, empty.kept) == (0, 0, 301)


def test_run_dates_without_a_rename(spark, tmp_path, monkeypatch):
    """A store that copies on rename, as which the local one is passed off here."""
    monkeypatch.setattr(storage, "COPYING_SCHEMES", ("file",))
    zone = str(tmp_path / "zone")
    assert m.write_run_date(frame(spark, (1, "a", 1, "x")), zone, "2024-01-01") == 1
    assert m.write_run_date(frame(spark, (2, "b", 1, "x"), (3, "c", 1, "x")), zone, "2024-01-02") == 2
    assert m.write_run_date(frame(spark, (4, "d", 1, "x")), zone, "2024-01-02") == 1
    assert [r.k for r in m.read_run_date(spark, zone, "2024-01-02").collect()] == [4]
    assert m.write_run_date(frame(spark, (4, "d", 1, "x")).limit(0), zone, "2024-01-02") == 0
    assert m.read_run_date(spark, zone, "2024-01-02").collect() == []
    assert [r.k for r in m.read_run_date(spark, zone, "2024-01-01").collect()] == [1]


def test_append_and_overwrite(spark, target):
    a, b = frame(spark, (1, "a", 1, "x")), frame(spark, (2, "b", 2, "y"))
    assert m.write_table(a, target, "overwrite").rows == 1
    assert m.write_table(b, target).rows == 1
    assert content(spark, target) == [(1, "a", 1, "x"), (2, "b", 2, "y")]
    m.write_table(b, target, "overwrite")
    assert content(spark, target) == [(2, "b", 2, "y")]


def test_partitioned_append_and_overwrite(spark, target):
    layout = {"partition_by": ["p"], "cluster_by": ["k"]}
    m.write_table(frame(spark, (1, "a", 1, "x"), (2, "b", 2, "y")), target, "overwrite", **layout)
    m.write_table(frame(spark, (3, "c", 3, "x")), target, "append", **layout)
    assert content(spark, target) == [(1, "a", 1, "x"), (2, "b", 2, "y"), (3, "c", 3, "x")]
    m.write_table(frame(spark, (4, "d", 4, "z")), target, "overwrite", **layout)
    assert content(spark, target) == [(4, "d", 4, "z")]


def test_an_empty_frame_is_written(spark, target):
    empty = frame(spark, (1, "a", 1, "x")).limit(0)
    assert m.write_table(empty, target, "overwrite").rows == 0
    assert content(spark, target) == []


def test_bad_arguments_are_refused_before_any_write(spark, target):
    df = frame(spark, (1, "a", 1, "x"))
    with pytest.raises(ValueError, match="mode"):
        m.write_table(df, target, "upsert")
    with pytest.raises(ValueError, match="keys"):
        m.write_table(df, target, "merge")
    with pytest.raises(ValueError):
        m.write_table(df, target, "overwrite", partition_by=["absent"])
    with pytest.raises(Exception, match="NOT_FOUND"):
        m.read_target(spark, target)


def test_table_names_are_qualified(spark):
    assert qualified_name(spark, "orders") == "spark_catalog.default.orders"
    assert qualified_name(spark, "other.orders") == "other.orders"
    name = f"t_{uuid.uuid4().hex}"
    assert m.write_table(frame(spark, (1, "a", 1, "x")), name).target == f"spark_catalog.default.{name}"


def test_a_hot_partition_is_split_and_small_ones_are_not(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1500k")
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr(
            "id AS k", "uuid() AS v", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 20) END AS p"
        )
        m.write_table(df, path, "overwrite", partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(f"{path}/p=hot")) > 1
    # a value that shares the hot one's hash bucket is spread with it; the others are not
    rare = sorted(len(files(d)) for d in Path(path).glob("p=c*"))
    assert rare[len(rare) // 2] <= 2
    assert m.read_target(spark, path).count() == 200_000


def test_clustering_sorts_inside_files(spark, tmp_path):
    path = str(tmp_path / "clustered")
    df = spark.range(0, 5000, 1, 8).selectExpr("id % 97 AS c", "id AS k")
    m.write_table(df, path, "overwrite", cluster_by=["c"])
    for file in files(path):
        values = [r.c for r in spark.read.parquet(file).collect()]
        assert values == sorted(values)


def test_layout_without_columns_does_not_shuffle(spark):
    df = spark.range(10)
    assert lay_out(df, [], []) is df


# ---- one logical date -----------------------------------------------------------------------


def test_run_date_replaces_only_its_own_date(spark, tmp_path):
    zone = str(tmp_path / "zone")
    assert m.write_run_date(frame(spark, (1, "a", 1, "x")), zone, "2024-01-01") == 1
    m.write_run_date(frame(spark, (2, "b", 2, "y")), zone, "2024-01-02")
    m.write_run_date(frame(spark, (3, "c", 3, "z"), (4, "d", 4, "z")), zone, "2024-01-01")
    assert sorted(r.k for r in m.read_run_date(spark, zone, "2024-01-01").collect()) == [3, 4]
    assert [r.k for r in m.read_run_date(spark, zone, "2024-01-02").collect()] == [2]
    assert str(m.read_run_date(spark, zone, "2024-01-02").first().run_date) == "2024-01-02"


def test_run_date_replaced_by_nothing(spark, tmp_path):
    zone = str(tmp_path / "zone")
    df = frame(spark, (1, "a", 1, "x"))
    m.write_run_date(df, zone, "2024-01-01")
    assert m.write_run_date(df.where("k > 5"), zone, "2024-01-01") == 0
    assert m.read_run_date(spark, zone, "2024-01-01").count() == 0


def test_run_date_must_be_a_date(spark, tmp_path):
    with pytest.raises(ValueError):
        m.write_run_date(frame(spark, (1, "a", 1, "x")), str(tmp_path / "zone"), "../elsewhere")


def test_reading_a_date_lists_only_its_directory(spark, tmp_path):
    zone = str(tmp_path / "zone")
    for day in ("2024-01-01", "2024-01-02"):
        m.write_run_date(frame(spark, (1, "a", 1, "x")), zone, day)
    found = m.read_run_date(spark, zone, "2024-01-02")
    assert all("run_date=2024-01-02" in f for f in found.inputFiles())
    with_schema = m.read_run_date(spark, zone, "2024-01-02", schema=frame(spark, (1, "a", 1, "x")).schema)
    assert with_schema.collect() == found.collect()


# ---- merge ----------------------------------------------------------------------------------


def test_merge_updates_inserts_and_keeps(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x"), (2, "b", 2, "y")), target, "overwrite")
    done = m.write_table(frame(spark, (2, "B", 20, "y"), (3, "C", 30, "z")), target, "merge", keys=["k"])
    assert (done.inserted, done.updated, done.kept, done.rows) == (1, 1, 1, 2)
    assert content(spark, target) == [(1, "a", 1, "x"), (2, "B", 20, "y"), (3, "C", 30, "z")]


def test_merge_is_repeatable(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite", partition_by=["p"])
    batch = frame(spark, (1, "A", 10, "y"), (2, "B", 20, "x"))
    m.write_table(batch, target, "merge", keys=["k"], partition_by=["p"])
    once = content(spark, target)
    done = m.write_table(batch, target, "merge", keys=["k"], partition_by=["p"])
    assert content(spark, target) == once == [(1, "A", 10, "y"), (2, "B", 20, "x")]
    assert (done.inserted, done.updated, done.kept) == (0, 2, 0)


def test_merge_into_nothing_creates_the_target(spark, target):
    done = m.write_table(frame(spark, (1, "a", 1, "x")), target, "merge", keys=["k"], partition_by=["p"])
    assert (done.inserted, done.updated, done.kept) == (1, 0, 0)
    assert content(spark, target) == [(1, "a", 1, "x")]


def test_null_keys_never_match(spark, target):
    m.write_table(frame(spark, (None, "a", 1, "x"), (1, "b", 1, "x")), target, "overwrite")
    batch = frame(spark, (None, "n", 2, "x"), (None, "m", 3, "x"), (1, "B", 2, "x"))
    m.write_table(batch, target, "merge", keys=["k"])
    assert content(spark, target) == sorted(
        [(None, "a", 1, "x"), (None, "n", 2, "x"), (None, "m", 3, "x"), (1, "B", 2, "x")], key=repr
    )


def test_null_values_overwrite(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    m.write_table(frame(spark, (1, None, None, "x")), target, "merge", keys=["k"])
    assert content(spark, target) == [(1, None, None, "x")]


def test_columns_the_source_lacks_keep_their_value(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    batch = frame(spark, (2, 20), (1, 10), schema="K int, W int")
    m.write_table(batch, target, "merge", keys=["k"])
    assert content(spark, target) == [(1, "a", 10, "x"), (2, None, 20, None)]


def test_keys_only_source_just_inserts(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    done = m.write_table(frame(spark, (1,), (2,), schema="k int"), target, "merge", keys=["k"])
    assert content(spark, target) == [(1, "a", 1, "x"), (2, None, None, None)]
    assert (done.inserted, done.updated, done.kept) == (1, 0, 1)


def test_repeated_source_keys_are_refused(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    batch = frame(spark, (2, "b", 1, "x"), (2, "c", 1, "x"))
    with pytest.raises(ValueError, match="repeats the key"):
        m.write_table(batch, target, "merge", keys=["k"])
    assert content(spark, target) == [(1, "a", 1, "x")]
    assert repeated_key(batch, ["k", "v"]) is None


def test_keys_that_only_repeat_in_the_type_of_the_target_are_refused(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    batch = frame(spark, ("5", "b", 1, "x"), ("05", "c", 1, "x"), schema="k string, v string, w int, p string")
    with pytest.raises(ValueError, match="repeats the key"):
        m.write_table(batch, target, "merge", keys=["k"])


def test_a_source_that_changes_between_evaluations_is_pinned(spark, target):
    m.write_table(frame(spark, *[(i, "a", i, str(i % 4)) for i in range(40)]), target, "overwrite", partition_by=["p"])
    drawn = spark.range(20, 60).selectExpr("int(id) AS k", "'b' AS v", "0 AS w", "string(int(rand() * 4)) AS p")
    m.write_table(drawn, target, "merge", keys=["k"], partition_by=["p"])
    rows = content(spark, target)
    assert sorted(r[0] for r in rows) == list(range(60))
    assert all(r[1] == ("a" if r[0] < 20 else "b") for r in rows)


def test_unknown_source_columns_are_refused(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    with pytest.raises(ValueError, match="lacks"):
        m.write_table(frame(spark, (1, 2), schema="k int, other int"), target, "merge", keys=["k"])


def test_target_types_are_kept(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    m.write_table(frame(spark, (1, "A", 10, "x")).withColumn("w", F.col("w").cast("bigint")), target, "merge", keys=["k"])
    assert dict(m.read_target(spark, target).dtypes)["w"] == "int"
    assert content(spark, target) == [(1, "A", 10, "x")]


def test_rows_move_between_partitions_and_empty_ones_vanish(spark, target):
    rows = [(1, "a", 1, "x"), (2, "b", 2, "y"), (3, "c", 3, "y"), (4, "d", 4, "o'z"), (5, "e", 5, None)]
    m.write_table(frame(spark, *rows), target, "overwrite", partition_by=["p"])
    batch = frame(spark, (1, "A", 10, "y"), (4, "D", 40, "x"), (5, "E", 50, "y"), (6, "F", 60, None))
    done = m.write_table(batch, target, "merge", keys=["k"], partition_by=["p"])
    assert content(spark, target) == sorted(
        [(1, "A", 10, "y"), (2, "b", 2, "y"), (3, "c", 3, "y"), (4, "D", 40, "x"), (5, "E", 50, "y"),
         (6, "F", 60, None)], key=repr,
    )
    assert (done.inserted, done.updated) == (1, 3)


def test_only_the_emptied_directory_is_removed(spark, tmp_path):
    path = str(tmp_path / "target")
    m.write_table(frame(spark, (1, "a", 1, "x y"), (2, "b", 2, "y"), (3, "c", 3, "z")), path, "overwrite", partition_by=["p"])
    before = files(path)
    m.write_table(frame(spark, (1, "A", 10, "y")), path, "merge", keys=["k"])
    after = files(path)
    assert {f for f in before if "/p=z/" in f} == {f for f in before if after.get(f) == before[f]}
    assert sorted(d.name for d in Path(path).glob("p=*")) == ["p=y", "p=z"]
    assert content(spark, path) == [(1, "A", 10, "y"), (2, "b", 2, "y"), (3, "c", 3, "z")]


def test_many_emptied_partitions_of_a_table(spark, monkeypatch):
    from millrace.operators import sinks

    monkeypatch.setattr(sinks, "_AT_ONCE", 3)
    name = f"t_{uuid.uuid4().hex}"
    m.write_table(frame(spark, *[(i, "a", i, f"p'{i}") for i in range(8)]), name, "overwrite", partition_by=["p"])
    m.write_table(frame(spark, *[(i, "b", i, None) for i in range(7)]), name, "merge", keys=["k"])
    assert content(spark, name) == [(i, "b", i, None) for i in range(7)] + [(7, "a", 7, "p'7")]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2


def test_a_partition_whose_rows_all_leave(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x"), (2, "b", 2, "y"), (3, "c", 3, "z")), target, "overwrite", partition_by=["p"])
    m.write_table(frame(spark, (1, "A", 10, "y")), target, "merge", keys=["k"], partition_by=["p"])
    assert content(spark, target) == [(1, "A", 10, "y"), (2, "b", 2, "y"), (3, "c", 3, "z")]


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "target")
    rows = [(i, "v", i, p) for i, p in enumerate("xxyyzz")]
    m.write_table(frame(spark, *rows), path, "overwrite", partition_by=["p"])
    before = files(path)
    m.write_table(frame(spark, (0, "V", 0, "x"), (2, "V", 2, "x")), path, "merge", keys=["k"], partition_by=["p"])
    after = files(path)
    unchanged = {f for f in before if after.get(f) == before[f]}
    assert unchanged == {f for f in before if "/p=z/" in f}
    assert content(spark, path, "k", "p")[2] == (2, "x")


def test_one_tuple_of_two_levels_rewrites_one_directory(spark, tmp_path):
    path = str(tmp_path / "target")
    rows = [(y * 100 + m, y, m, "old") for y in (2024, 2025) for m in (1, 2, 3)]
    schema = "k int, y int, m int, v string"
    m.write_table(frame(spark, *rows, schema=schema), path, "overwrite", partition_by=["y", "m"])
    before = files(path)
    m.write_table(frame(spark, (202402, 2024, 2, "new"), schema=schema), path, "merge", keys=["k"])
    after = files(path)
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "/y=2024/m=2/" in f}
    assert ("202402", "new") in {(str(k), v) for k, v in content(spark, path, "k", "v")}


def test_partitions_of_timestamps_are_left_alone(spark, target):
    rows = spark.sql("SELECT int(id) AS k, 'a' AS v, timestamp '2024-01-01 10:00:00' + make_interval(0, 0, 0, id) AS t FROM range(3)")
    m.write_table(rows, target, "overwrite", partition_by=["t"])
    before = set(spark.read.parquet(target).inputFiles() if "/" in target else spark.table(target).inputFiles())
    m.write_table(rows.where("k = 1").withColumn("v", F.lit("b")), target, "merge", keys=["k"])
    found = m.read_target(spark, target)
    assert len(before & set(found.inputFiles())) == 2
    assert sorted(tuple(r) for r in found.select("k", "v").collect()) == [(0, "a"), (1, "b"), (2, "a")]


def test_a_source_without_the_partition_column(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x"), (2, "b", 2, "y")), target, "overwrite", partition_by=["p"])
    batch = frame(spark, (1, "A"), (3, "C"), schema="k int, v string")
    m.write_table(batch, target, "merge", keys=["k"], partition_by=["p"])
    assert content(spark, target) == [(1, "A", 1, "x"), (2, "b", 2, "y"), (3, "C", None, None)]


def test_empty_partition_text_joins_the_null_partition(spark, target):
    m.write_table(frame(spark, (1, "a", 1, None), (2, "b", 2, "x")), target, "overwrite", partition_by=["p"])
    m.write_table(frame(spark, (3, "c", 3, "")), target, "merge", keys=["k"], partition_by=["p"])
    assert content(spark, target) == [(1, "a", 1, None), (2, "b", 2, "x"), (3, "c", 3, None)]


@pytest.mark.parametrize("with_partition", [True, False])
def test_partition_text_that_looks_like_a_number(spark, tmp_path, with_partition):
    path = str(tmp_path / "target")
    m.write_table(frame(spark, (1, "a", 1, "007"), (2, "b", 2, "01"), (3, "c", 3, "7")), path, "overwrite", partition_by=["p"])
    batch = frame(spark, (1, "A", 10, "007"), (3, "C", 30, "7"))
    m.write_table(batch if with_partition else batch.drop("p"), path, "merge", keys=["k"], partition_by=["p"])
    found = spark.read.schema(SCHEMA).parquet(path).select("k", "v", "w", "p").collect()
    assert sorted(tuple(r) for r in found) == [(1, "A", 10, "007"), (2, "b", 2, "01"), (3, "C", 30, "7")]


def test_merge_on_nested_partitions_and_partition_in_key(spark, target):
    schema = "k int, y int, p string, v string"
    start = frame(spark, (1, 2024, "a", "old"), (1, 2025, "a", "old"), (2, 2025, "b", "old"), schema=schema)
    layout = {"partition_by": ["y", "p"]}
    m.write_table(start, target, "overwrite", **layout)
    batch = frame(spark, (1, 2025, "a", "new"), (3, 2026, "c", "new"), schema=schema)
    m.write_table(batch, target, "merge", keys=["k", "y", "p"], **layout)
    years = lambda: sorted((r.k, int(r.y), r.p, r.v) for r in m.read_target(spark, target).collect())
    assert years() == [
        (1, 2024, "a", "old"), (1, 2025, "a", "new"), (2, 2025, "b", "old"), (3, 2026, "c", "new")
    ]
    move = frame(spark, (2, 2025, "c", "moved"), schema=schema)
    m.write_table(move, target, "merge", keys=["k"], **layout)
    assert years()[2] == (2, 2025, "c", "moved")


def test_a_target_key_may_repeat(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x"), (1, "b", 2, "y")), target, "overwrite")
    done = m.write_table(frame(spark, (1, "N", 9, "z")), target, "merge", keys=["k"])
    assert content(spark, target) == [(1, "N", 9, "z")] * 2
    assert done.updated == 2


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_merges_against_brute_force(spark, target, partition_by):
    rng = random.Random(11)
    expected = {}
    for round_no in range(3):
        batch = {
            k: (k, f"v{round_no}", rng.randrange(100), rng.choice("abcd"))
            for k in rng.sample(range(120), 50)
        }
        expected |= batch
        df = frame(spark, *batch.values()).repartition(4)
        m.write_table(df, target, "merge", keys=["k"], partition_by=partition_by, cluster_by=["w"])
        assert content(spark, target) == sorted(expected.values(), key=repr)


def test_a_target_table_is_repointed_in_one_step(spark):
    name = f"t_{uuid.uuid4().hex}"
    m.write_table(frame(spark, (1, "a", 1, "x")), name, "overwrite")
    held = spark.table(name)
    old = set(held.inputFiles())
    for v in ("b", "c"):
        done = m.write_table(frame(spark, (1, v, 1, "x")), name, "merge", keys=["k"], keep_versions=2)
    assert content(spark, name) == [(1, "c", 1, "x")]
    assert held.collect()[0].v == "a"
    assert old.isdisjoint(spark.table(name).inputFiles())
    assert done.stage.count("__version_") == 1


def test_an_interrupted_publication_is_repeated_from_its_stage(spark, tmp_path):
    path = str(tmp_path / "target")
    m.write_table(frame(spark, (1, "a", 1, "x"), (2, "b", 2, "y")), path, "overwrite", partition_by=["p"])
    done = m.write_table(frame(spark, (1, "A", 1, "x")), path, "merge", keys=["k"], partition_by=["p"])
    want = content(spark, path)
    # partition x lost, as after a crash between removing the old files and moving the new ones in
    frame(spark, (1, "a", 1, "x")).drop("p").limit(0).write.mode("overwrite").parquet(f"{path}/p=x")
    assert content(spark, path) != want
    publish_stage(spark, done.stage, path, ["p"])
    assert content(spark, path) == want


def test_overwriting_a_merged_table_keeps_it(spark):
    name = f"t_{uuid.uuid4().hex}"
    m.write_table(frame(spark, (1, "a", 1, "x")), name, "overwrite")
    m.write_table(frame(spark, (2, "b", 2, "y")), name, "merge", keys=["k"])
    m.write_table(frame(spark, (3, "c", 3, "z")), name, "overwrite")
    assert content(spark, name) == [(3, "c", 3, "z")]
    m.write_table(frame(spark, (4, "d"), schema="k int, other string"), name, "overwrite")
    assert content(spark, name, "k", "other") == [(4, "d")]
    m.write_table(frame(spark, (5, "e"), schema="k int, other string"), name, "append")
    spark.sql(f"DROP TABLE {name}")
    m.write_table(frame(spark, (6, "f", 6, "w")), name, "overwrite")
    assert content(spark, name) == [(6, "f", 6, "w")]


def test_a_failed_overwrite_leaves_the_target(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "x")), target, "overwrite")
    bad = frame(spark, (2, "b", 2, "y")).withColumn("w", F.expr("int(raise_error('no'))"))
    with pytest.raises(Exception, match="no"):
        m.write_table(bad, target, "overwrite")
    assert content(spark, target) == [(1, "a", 1, "x")]


def test_partition_columns_of_a_target_are_looked_up(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "007"), (2, "b", 2, "008")), target, "overwrite", partition_by=["p"])
    m.write_table(frame(spark, (3, "c", 3, "009")), target, "append")
    m.write_table(frame(spark, (1, "A", 10, "007")), target, "merge", keys=["k"])
    assert content(spark, target) == [(1, "A", 10, "007"), (2, "b", 2, "008"), (3, "c", 3, "009")]
    for mode in ("append", "merge"):
        with pytest.raises(ValueError, match="partitioned by"):
            m.write_table(frame(spark, (4, "d", 4, "x")), target, mode, keys=["k"], partition_by=["w"])
    m.write_table(frame(spark, (4, "d", 4, "001")), target, "overwrite")
    assert content(spark, target) == [(4, "d", 4, "001")]
    m.write_table(frame(spark, (5, "e", 5, "002")), target, "append", partition_by=["P"])
    assert content(spark, target)[1] == (5, "e", 5, "002")


@pytest.mark.parametrize("partition", ["", "PARTITIONED BY (p)"])
def test_what_a_table_is_survives_loads(spark, partition):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} (k int, v string, w int, p string) USING orc OPTIONS ('compression' = 'zlib') {partition} "
        "COMMENT 'it''s mine' TBLPROPERTIES ('team' = 'me')"
    )
    m.write_table(frame(spark, (1, "a", 1, "x")), name)
    m.write_table(frame(spark, (2, "b", 2, "x")), name, "merge", keys=["k"])
    m.write_table(frame(spark, (3, "c", 3, "z")), name, "overwrite")
    assert content(spark, name) == [(3, "c", 3, "z")]
    m.write_table(frame(spark, (4, "d", "q"), schema="k int, other string, p string"), name, "overwrite")
    assert content(spark, name, "k", "other", "p") == [(4, "d", "q")]
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert about["Provider"].lower() == "orc" and about["Comment"] == "it's mine" and "team=me" in about["Table Properties"]
    assert "compression=zlib" in about["Storage Properties"]
    with pytest.raises(ValueError, match="format orc"):
        m.write_table(frame(spark, (4, "d", "q"), schema="k int, other string, p string"), name, format="parquet")


def test_a_stated_number_of_versions_stays(spark):
    name = f"t_{uuid.uuid4().hex}"
    m.write_table(frame(spark, (0, "a", 0, "x")), name, "overwrite")
    warehouse = Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"))
    for i in range(1, 4):
        m.write_table(frame(spark, (i, "a", i, "x")), name, "merge", keys=["k"])
        assert len(list(warehouse.glob(f"{name}*"))) == 2
    assert len(m.remove_old_versions(spark, name, keep=0)) == 1
    assert len(content(spark, name)) == 4


def test_old_scratch_is_cleared(spark, monkeypatch):
    from millrace import storage
    from millrace.storage import path_exists, scratch_path

    place = scratch_path(spark, "leftover")
    frame(spark, (1, "a", 1, "x")).write.parquet(place)
    m.clear_scratch(spark, older_than_hours=24)
    assert path_exists(spark, place)
    monkeypatch.setattr(storage, "scratch_root", lambda _: place)
    assert m.clear_scratch(spark, older_than_hours=-1) >= 1  # changed up to an hour from now
    assert not list(Path(place).glob("*.parquet"))


def test_a_failed_date_stays_and_dates_are_normalised(spark, tmp_path):
    zone = str(tmp_path / "zone")
    m.write_run_date(frame(spark, (1, "a", 1, "x")), zone, "20240101")
    assert [r.k for r in m.read_run_date(spark, zone, "20240101").collect()] == [1]
    bad = frame(spark, (2, "b", 2, "y")).withColumn("w", F.expr("int(raise_error('no'))"))
    with pytest.raises(Exception, match="no"):
        m.write_run_date(bad, zone, "2024-01-01")
    assert [r.k for r in m.read_run_date(spark, zone, "2024-01-01").collect()] == [1]
    assert "run_date" in spark.read.parquet(zone).columns


def test_a_target_is_read_with_a_schema(spark, target):
    m.write_table(frame(spark, (1, "a", 1, "007")), target, "overwrite", partition_by=["p"])
    assert m.read_target(spark, target).first().p == "007"
    typed = m.read_target(spark, target, schema="k bigint, p string")
    assert typed.dtypes == [("k", "bigint"), ("p", "string")] and typed.first().p == "007"


def test_small_source_is_broadcast_and_target_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.range(100_000).selectExpr("id AS k", "string(id) AS v").write.parquet(path)
    spark.range(10).selectExpr("id AS k", "'n' AS v").write.parquet(str(tmp_path / "small"))
    target, source = spark.read.parquet(path), spark.read.parquet(str(tmp_path / "small"))
    plan = m.merge_frames(target, source, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the distinct keys found, at most the source's
    assert {r[0]: r[1] for r in m.merge_frames(target, source, ["k"]).groupBy(ACTION).count().collect()} == {
        "keep": 99_990, "update": 10
    }


def test_table_formats_with_their_own_merge_get_it(spark, monkeypatch):
    from millrace.operators import sinks

    calls = []

    class Writer:
        def __getattr__(self, name):
            return lambda *args: (calls.append((name, *args)), self)[1]

    name = f"t_{uuid.uuid4().hex}"
    m.write_table(frame(spark, (1, "a", 1, "x")), name, "overwrite")
    monkeypatch.setattr(sinks, "_provider", lambda *_: "some_lake_format")
    df = frame(spark, (1, "b", 1, "x"))
    monkeypatch.setattr(type(df), "mergeInto", lambda self, table, on: (calls.append(("into", table)), Writer())[1])
    m.write_table(df, name, "merge", keys=["k"])
    assert [c[0] for c in calls] == ["into", "whenMatched", "update", "whenNotMatched", "insert", "merge"]
    assert calls[0][1] == f"spark_catalog.default.{name}"
    assert set(calls[2][1]) == {"v", "w", "p"} and set(calls[4][1]) == {"k", "v", "w", "p"}

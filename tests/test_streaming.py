"""Intake and sessions: several deliveries, runs that stop between write and commit, late rows."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import millrace as m
from millrace.streaming import sessions, stages
from millrace.streaming.intake import read_new_files, take_in

SCHEMA = "id int, v string, at int"


@pytest.fixture
def places(spark, tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "target"), str(tmp_path / "checkpoint")


def deliver(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(folder)


def run(spark, places, **more):
    return take_in(read_new_files(spark, places[0], "jsonl", SCHEMA), places[1], places[2], **more)


def content(spark, path):
    return sorted(tuple(r) for r in m.read_target(spark, path).select("id", "v", "at").collect())


def test_two_deliveries_are_merged(spark, places):
    deliver(spark, places[0], [(1, "a", 1), (2, "b", 1)])
    (first,) = run(spark, places, keys=["id"])
    deliver(spark, places[0], [(2, "c", 2), (3, "d", 2)])
    (second,) = run(spark, places, keys=["id"])
    assert (first.inserted, second.inserted, second.updated) == (2, 1, 1)
    assert content(spark, places[1]) == [(1, "a", 1), (2, "c", 2), (3, "d", 2)]
    assert run(spark, places, keys=["id"]) == []


@pytest.mark.parametrize("keys", [["id"], []])
def test_a_run_stopped_between_write_and_commit(spark, places, keys):
    deliver(spark, places[0], [(1, "a", 1), (2, "b", 1)])
    run(spark, places, keys=keys)
    deliver(spark, places[0], [(2, "c", 2), (3, "d", 2)])
    seen = []

    def stop(number, result):
        seen.append((number, content(spark, places[1])))
        raise RuntimeError("stopped before the commit")

    with pytest.raises(Exception, match="stopped before the commit"):
        run(spark, places, keys=keys, on_batch=stop)
    written = content(spark, places[1])
    assert seen == [(1, written)]
    deliver(spark, places[0], [(9, "later", 3)])  # not part of the batch that is repeated
    again = []
    run(spark, places, keys=keys, on_batch=lambda number, result: again.append((number, content(spark, places[1]))))
    assert again[0] == (1, written)
    assert content(spark, places[1]) == sorted([*written, (9, "later", 3)])


def test_latest_row_of_a_key_and_transform(spark, places):
    deliver(spark, places[0], [(1, "old", 1), (1, "new", 5), (2, "x", 1), (2, None, 0)])
    run(spark, places, keys=["id"], latest_by=["at"], transform=lambda df: df.where("v <> 'x'"))
    assert content(spark, places[1]) == [(1, "new", 5)]


def test_repeated_keys_and_wrong_arguments_raise(spark, places):
    deliver(spark, places[0], [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(Exception, match="repeats the key"):
        run(spark, places, keys=["id"])
    new = read_new_files(spark, places[0], "jsonl", SCHEMA)
    for wrong in ({"latest_by": ["at"]}, {"partition_by": ["v"]}):
        with pytest.raises(ValueError):
            take_in(new, places[1], places[2], **wrong)
    with pytest.raises(ValueError, match="path"):
        take_in(new, "a_table", places[2])
    with pytest.raises(ValueError, match="formats"):
        read_new_files(spark, places[0], "xml", SCHEMA)


def test_files_per_batch(spark, places):
    for i in range(3):
        deliver(spark, places[0], [(i, "a", i)])
    new = read_new_files(spark, places[0], "jsonl", SCHEMA, files_per_batch=1)
    assert len(take_in(new, places[1], places[2], keys=["id"])) == 3


EVENT = T.StructType().add("k", "string").add("at", "timestamp_ntz").add("v", "integer")
NOON = datetime(2024, 1, 1, 12)


def at(minutes):
    return NOON + timedelta(minutes=minutes)


def events(spark, root, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(f"{root}/in")


def sessions_of(spark, folders):
    found = m.read_target(spark, folders.sessions).orderBy("k", "session_start").collect()
    return [(r.k, r.n, (r.session_end - r.session_start).total_seconds() / 60) for r in found]


def step(spark, root, folders):
    new = spark.readStream.schema(EVENT).parquet(f"{root}/in")
    sessions.accept_in_time(new, folders, "at", "10 minutes")
    sessions.build_sessions(spark, folders, EVENT, "at", "10 minutes", "5 minutes", ["k"], [F.count("*").alias("n")])


def test_sessions_across_deliveries_and_late_rows(spark, tmp_path):
    root = str(tmp_path)
    folders = sessions.SessionFolders(f"{root}/job")
    events(spark, root, [("a", at(0), 1), ("a", at(4), 1), ("b", at(1), 1), (None, at(2), 1)])
    step(spark, root, folders)
    events(spark, root, [("a", at(8), 1), ("a", at(30), 1), ("b", at(3), 1), ("b", None, 1)])  # in time, as 8 - 10 < 0
    step(spark, root, folders)
    events(spark, root, [("a", at(12), 1), ("b", at(19), 2), ("a", at(20), 1)])  # before 30 - 10: late, but for the last
    step(spark, root, folders)
    sessions.end_of_input(spark, folders, EVENT, "at", "20 minutes")
    step(spark, root, folders)
    assert sessions_of(spark, folders) == [(None, 1, 5), ("a", 3, 13), ("a", 1, 5), ("a", 1, 5), ("b", 2, 7)]
    late = m.read_target(spark, folders.late).collect()
    assert sorted((r.k, r.v) for r in late) == [("a", 1), ("b", 1), ("b", 2)]
    accepted = m.read_target(spark, folders.accepted).where("NOT _ended").count()
    assert accepted + len(late) == 11


def test_a_repeated_batch_is_split_as_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    folders = sessions.SessionFolders(f"{root}/job")
    events(spark, root, [("a", at(0), 1), ("a", at(60), 1)])
    new = lambda: spark.readStream.schema(EVENT).parquet(f"{root}/in")
    sessions.accept_in_time(new(), folders, "at", "10 minutes")
    events(spark, root, [("a", at(55), 2), ("a", at(300), 2), ("a", at(49), 2)])
    write, seen = sessions.replace_batch, []

    def stop(rows, target, number):
        seen.append(target)
        if target == folders.accepted and len(seen) < 4:
            raise RuntimeError("stopped")
        return write(rows, target, number)

    monkeypatch.setattr(sessions, "replace_batch", stop)
    with pytest.raises(Exception, match="stopped"):
        sessions.accept_in_time(new(), folders, "at", "10 minutes")
    sessions.accept_in_time(new(), folders, "at", "10 minutes")
    assert [r["at"] for r in m.read_target(spark, folders.late).collect()] == [at(49)]
    assert m.read_target(spark, folders.accepted).count() == 4



def test_stages_as_in_batch(spark, tmp_path):
    """Events in any order within the delay; the last ones are over once a marker has passed."""
    root = str(tmp_path)
    folders = sessions.SessionFolders(f"{root}/job")
    first = [("a", at(0), 1), ("a", at(9), 3), ("a", at(3), 2), ("b", at(1), 1), (None, at(2), 1)]
    then = [("a", at(8), 9), ("b", at(20), 2), ("c", at(25), 1), ("a", at(8), 4)]
    for rows in (first, then):
        events(spark, root, rows)
        new = spark.readStream.schema(EVENT).parquet(f"{root}/in")
        sessions.accept_in_time(new, folders, "at", "10 minutes")
    sessions.end_of_input(spark, folders, EVENT, "at", "1 hour")
    stages.follow_stages(spark, folders.accepted, EVENT, f"{root}/stages", f"{root}/checkpoint", "k", "v", "at", "10 minutes", 300)
    found = m.read_target(spark, f"{root}/stages").drop("_intake_batch")
    want = stages.stages_in_batch(spark.createDataFrame(first + then, EVENT), "k", "v", "at", 300)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, found.select(*want.columns).collect())) == sorted(map(key, want.collect()))


class _State:
    """A list or value state, and the calls made to it."""

    def __init__(self):
        self.held, self.calls = None, 0

    def __getattr__(self, name):
        def call(*values):
            self.calls += 1
            if name == "get":
                return iter(self.held or []) if isinstance(self.held, list) or self.held is None else self.held
            if name == "exists":
                return self.held is not None
            self.held = {"clear": lambda: None, "update": lambda v: v, "put": list, "appendList": lambda v: [*(self.held or []), *v]}.get(
                name, lambda v: [*(self.held or []), v]
            )(*values)

        return call


class _Handle:
    def __init__(self):
        self.waiting, self.current, self.timers = _State(), _State(), []

    def getListState(self, name, schema):  # noqa: N802
        return self.waiting

    def getValueState(self, name, schema):  # noqa: N802
        return self.current

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


class _Mark:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.at


def test_calls_to_the_state_do_not_grow_with_the_events_of_a_key():
    """3,000 events a second apart in three parts, taken at two watermarks: a timer for the first one waiting, not for each."""
    handle, processor = _Handle(), stages.StageProcessor(500_000)
    processor.init(handle)
    order = [*range(2000, 3000), *range(1000), *range(1000, 2000)]
    parts = [pd.DataFrame({"at": [i * 1_000_000 for i in order[k : k + 1000]], "stage": [str(i) for i in order[k : k + 1000]]}) for k in (0, 1000, 2000)]
    assert list(processor.handleInputRows(("a",), iter(parts), _Mark(0))) == []
    assert handle.timers == [0] and handle.waiting.calls <= 3
    made = []
    for mark in (1_499_000, 10_000_000):
        made += [r for rows in processor.handleExpiredTimer(("a",), _Mark(mark), None) for r in rows.itertuples(index=False)]
        if mark < 2_999_000:
            assert set(handle.timers) == {0, 1_500_000, 1_499_500}
    assert [(r.stage, r.entered, r.left) for r in made] == [(str(i), i * 1_000_000, i * 1_000_000 + 500_000) for i in range(3000)]
    assert len(handle.timers) <= 4 and handle.waiting.calls + handle.current.calls <= 16
    assert handle.waiting.held is None and handle.current.held is None

"""Streams that run until nothing new is there, over tables delivered in several parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace as m
from millrace.storage import scratch_path
from millrace.streaming.intake import read_new_files, take_in
from millrace.streaming.sessions import SessionFolders, accept_in_time, build_sessions, end_of_input
from millrace.streaming.stages import follow_stages, stages_in_batch
from registry import query
from registry.inputs import second, table
from registry.sinks import COLUMNS, DAY_SQL

#: Orders are delivered twice: those before 1999, then those from 1998 on with another price and status.
HISTORY, BATCH = "o_orderdate < TIMESTAMP_NTZ '1999-01-01'", "o_orderdate >= TIMESTAMP_NTZ '1998-01-01'"


class _Stopped(Exception):
    pass


@query(f"""
SELECT {DAY_SQL.replace("o_orderstatus", "CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus")
        .replace("o_totalprice", "CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice")}
FROM orders""")
def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of files; the second run stops between write and commit, and is repeated."""
    place = scratch_path(spark, "intake")
    delivered, target, checkpoint = f"{place}/delivered", f"{place}/target", f"{place}/checkpoint"
    orders = table(spark, sf_dir, "orders").select(*COLUMNS.split(", "))
    later = orders.where(BATCH).withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 10})

    def run(on_batch=None) -> None:
        take_in(read_new_files(spark, delivered, "parquet", orders.schema), target, checkpoint, ["o_orderkey"], on_batch=on_batch)

    def stop(number: int, result: m.LoadResult) -> None:
        raise _Stopped("between write and commit")

    orders.where(HISTORY).write.parquet(delivered)
    run()
    later.write.mode("append").parquet(delivered)
    try:
        run(stop)
    except Exception as error:
        if "between write and commit" not in str(error):
            raise
    run()
    return m.read_target(spark, target).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


#: The first delivery has no event after this; of the later ones each seventh came with the second, some of them late.
CUT, DELAY, GAP = "2024-01-20 00:00:00", "2 days", "8 hours"
FIRST = f"(ts < TIMESTAMP '{CUT}' AND event_id % 7 <> 0)"
LATE_SQL = f"NOT {FIRST} AND ts < (SELECT max(ts) FROM events WHERE {FIRST}) - INTERVAL '{DELAY}'"
ACCEPTED_SQL = f"SELECT * FROM events WHERE NOT ({LATE_SQL})"


def _delivered(spark: SparkSession, sf_dir: str, sessions: bool) -> tuple[SessionFolders, DataFrame]:
    """Both deliveries taken in, and the sessions known to be over after each."""
    cents = F.expr("CAST(round(value * 100) AS BIGINT)").alias("cents")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", cents)
    place = scratch_path(spark, "sessions")
    folders = SessionFolders(f"{place}/job")
    first = F.expr(FIRST.replace("TIMESTAMP", "TIMESTAMP_NTZ"))
    for part in (events.where(first), events.where(~first)):
        part.write.mode("append").parquet(f"{place}/in")
        new = spark.readStream.schema(events.schema).parquet(f"{place}/in")
        accept_in_time(new, folders, "ts", DELAY)
        if sessions:
            _build(spark, folders, events)
    return folders, events


def _build(spark: SparkSession, folders: SessionFolders, events: DataFrame) -> None:
    build_sessions(spark, folders, events.schema, "ts", DELAY, GAP, ["user_id"], _measures())


def _measures() -> list:
    return [F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"), F.min("event_id").alias("first_event")]


@query(f"""
WITH marked AS (
    SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '{GAP}' THEN 0 ELSE 1 END AS begins FROM ({ACCEPTED_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(ts) + INTERVAL '{GAP}', '%Y-%m-%d %H:%M:%S') AS session_end,
       count(*) AS n, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents, min(event_id) AS first_event
FROM numbered GROUP BY user_id, session""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of all events but those that came more than two days behind what had been seen before."""
    folders, events = _delivered(spark, sf_dir, True)
    end_of_input(spark, folders, events.schema, "ts", "9 days")
    _build(spark, folders, events)
    found = m.read_target(spark, folders.sessions).drop("_intake_batch")
    return found.withColumns({c: second(c) for c in ("session_start", "session_end")})


@query(f"SELECT event_id, user_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE {LATE_SQL}")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late rows themselves, which no session counts."""
    folders, _ = _delivered(spark, sf_dir, False)
    return m.read_target(spark, folders.late).select("event_id", "user_id", "cents")


HOURS = 6
STAGES_SQL = f"""
WITH following AS (
    SELECT user_id AS key, event_type AS stage, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS next FROM ({{source}})
)
SELECT key, stage, strftime(ts, '%Y-%m-%d %H:%M:%S') AS entered,
       strftime(CASE WHEN next <= ts + INTERVAL '{HOURS}' HOUR THEN next ELSE ts + INTERVAL '{HOURS}' HOUR END, '%Y-%m-%d %H:%M:%S') AS "left",
       CASE WHEN next <= ts + INTERVAL '{HOURS}' HOUR THEN 'moved' ELSE 'timed out' END AS outcome
FROM following"""


@query(STAGES_SQL.format(source=ACCEPTED_SQL))
def stream_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every stage a user was in, from state with timers; it runs in Python workers."""
    folders, events = _delivered(spark, sf_dir, False)
    end_of_input(spark, folders, events.schema, "ts", "9 days")
    result = f"{folders.root}/stages"
    follow_stages(
        spark, folders.accepted, events.schema, result, f"{folders.root}/checkpoint-stages", "user_id", "event_type", "ts", DELAY, HOURS * 3600
    )
    found = m.read_target(spark, result).drop("_intake_batch")
    return found.withColumns({c: second(c) for c in ("entered", "left")})


@query(STAGES_SQL.format(source="events"))
def stages_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of all events in one batch, by a window."""
    found = stages_in_batch(table(spark, sf_dir, "events"), "user_id", "event_type", "ts", HOURS * 3600)
    return found.withColumns({c: second(c) for c in ("entered", "left")})

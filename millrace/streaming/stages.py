"""Stages that a key goes through, each left by the next one or by a time-out: keyed state with timers.

Events of a key wait in a list until the watermark has passed them, so that they are taken
in the order of their times however they arrive. A timer at the first waiting event's time
brings the key back then, for all that the watermark has passed, and the next timer is
for what is left; the stage the key is in is a value of the state, with a timer at its
time-out. The list holds an array for each Arrow batch of a key's events. So the calls to
the state are a few for each batch that a key is in, however many events it has. A key
whose last stage has timed out has no state left.

The processor runs in Python workers (``transformWithStateInPandas``), which Spark needs
for state of one's own; :func:`stages_in_batch` gives the same rows of a finished input with
a window alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from millrace.streaming.intake import BATCH, replace_batch

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What becomes of a stage. Times are microseconds inside the processor.
MOVED, TIMED_OUT = "moved", "timed out"
#: Waiting events put back in one array at most.
PACK = 10_000
_RESULT = "key string, stage string, entered long, left long, outcome string"


class StageProcessor(StatefulProcessor):
    def __init__(self, timeout: int) -> None:
        self.timeout = timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at array<bigint>, stage array<string>")
        self.current = handle.getValueState("current", "stage string, entered bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        first = None
        for batch in rows if key[0] is not None else ():
            found = [(at, stage) for at, stage in zip(batch["at"].tolist(), batch["stage"].tolist(), strict=True) if stage is not None]
            if found:
                self.waiting.appendValue(_packed(found))
                first = min(found)[0] if first is None else min(first, min(found)[0])
        if first is not None:
            self.handle.registerTimer(_milliseconds(first))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        mark = timerValues.getCurrentWatermarkInMs()
        due, later = [], []
        for packed in self.waiting.get():
            for at, stage in zip(*packed, strict=True):
                (due if _milliseconds(at) <= mark else later).append((at, stage))
        if due:
            self.waiting.put([_packed(later[i : i + PACK]) for i in range(0, len(later), PACK)]) if later else self.waiting.clear()
        if later:
            self.handle.registerTimer(_milliseconds(min(later)[0]))
        rows = []
        current = self.current.get() if self.current.exists() else None
        for at, stage in sorted(due):
            if current:
                rows.append((key[0], *self._left(current, at)))
            current = (stage, at)
        if current and _milliseconds(current[1] + self.timeout) <= mark:
            rows.append((key[0], *self._left(current, None)))
            current = None
        if current:
            self.current.update(current)
            self.handle.registerTimer(_milliseconds(current[1] + self.timeout))
        elif self.current.exists():
            self.current.clear()
        if rows:
            yield pd.DataFrame(rows, columns=["key", "stage", "entered", "left", "outcome"])

    def close(self) -> None:
        pass

    def _left(self, current: tuple, at: int | None) -> tuple:
        stage, entered = current
        if at is not None and at <= entered + self.timeout:
            return stage, entered, at, MOVED
        return stage, entered, entered + self.timeout, TIMED_OUT


def _packed(events: list[tuple]) -> tuple[list, list]:
    return [at for at, _ in events], [stage for _, stage in events]


def _milliseconds(at: int) -> int:
    """The first millisecond not before a time, so that a timer never comes early."""
    return -(-at // 1000)


def follow_stages(
    spark: SparkSession,
    accepted: str,
    schema: T.StructType,
    result: str,
    checkpoint: str,
    key: str,
    stage: str,
    time: str,
    delay: str,
    timeout_seconds: int,
) -> None:
    """Write what became of every stage known to be over: key, stage, entered, left, outcome.

    ``accepted`` holds events in time (see ``sessions.accept_in_time``). An event without
    key or stage is nobody's.
    """
    rows = spark.readStream.schema(T.StructType([*schema, T.StructField("_ended", T.BooleanType())])).parquet(f"{accepted}/{BATCH}=*")
    when = F.col(time).cast("timestamp")
    events = rows.select(
        F.col(key).cast("string").alias("key"), F.col(stage).cast("string").alias("stage"), F.unix_micros(when).alias("at"), when.alias("time"), "_ended"
    )
    watched = events.withWatermark("time", delay)
    made = watched.groupBy("key").transformWithStateInPandas(
        statefulProcessor=StageProcessor(timeout_seconds * 1_000_000), outputStructType=_RESULT, outputMode="Append", timeMode="EventTime"
    )
    kind = schema[key].dataType

    def write(batch: DataFrame, number: int) -> None:
        times = {c: F.timestamp_micros(c) for c in ("entered", "left")}
        replace_batch(batch.withColumns({"key": F.col("key").cast(kind), **times}), result, number)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        made.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)


def stages_in_batch(events: DataFrame, key: str, stage: str, time: str, timeout_seconds: int) -> DataFrame:
    """The same rows of all events at once."""
    known = events.where(F.col(key).isNotNull() & F.col(stage).isNotNull() & F.col(time).isNotNull())
    at, limit = F.col(time).cast("timestamp"), F.expr(f"INTERVAL {timeout_seconds} SECONDS")
    following = F.lead(at).over(Window.partitionBy(key).orderBy(at, F.col(stage).cast("string")))
    rows = known.select(F.col(key).alias("key"), F.col(stage).cast("string").alias("stage"), at.alias("entered"), following.alias("next"))
    moved = F.col("next") <= F.col("entered") + limit
    left = F.when(moved, F.col("next")).otherwise(F.col("entered") + limit)
    return rows.select("key", "stage", "entered", left.alias("left"), F.when(moved, MOVED).otherwise(TIMED_OUT).alias("outcome"))



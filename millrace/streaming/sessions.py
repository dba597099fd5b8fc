"""Sessions of events that arrive late: late rows set aside, the others in Spark's session windows.

Two streams run one after the other, each until nothing new is left.

1. Every batch of the input is split at the watermark, the greatest event time of all
   batches before less the delay allowed. Rows before it are late and kept apart; the
   others are accepted. The watermark of each batch is written down first, so a batch
   that is repeated is split in the same way.
2. Accepted rows go through ``withWatermark`` and ``session_window``; state holds open
   sessions only, and a session is written once the watermark has passed its end. As an
   accepted row is never behind that watermark, Spark drops none silently.

A row without event time is late. Rows of a NULL key are a key of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.tables import read_target
from millrace.storage import path_exists
from millrace.streaming.intake import BATCH, replace_batch

_ENDED = "_ended"
#: Batch numbers of markers, which no batch of events has.
_AFTER_ALL = 1_000_000_000


class SessionFolders(NamedTuple):
    """Where a session job keeps its rows, all below one folder."""

    root: str

    @property
    def accepted(self) -> str:
        return f"{self.root}/accepted"

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    @property
    def sessions(self) -> str:
        return f"{self.root}/sessions"

    @property
    def marks(self) -> str:
        return f"{self.root}/watermarks"


def accept_in_time(new: DataFrame, folders: SessionFolders, time: str, delay: str) -> None:
    """Split what is new in a stream into accepted and late rows. ``delay`` is an interval such as ``10 minutes``."""

    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not _marked(spark, folders, number):
            seen = batch.agg(F.max(time).alias("seen")).withColumn("batch", F.lit(number))
            replace_batch(seen, folders.marks, number)
        marks = read_target(spark, folders.marks).where(F.col("batch") < number)
        mark = marks.agg((F.max("seen") - F.expr(f"INTERVAL {delay}")).cast("string")).first()[0]
        on_time = F.col(time).isNotNull()
        if mark is not None:
            on_time &= F.coalesce(F.col(time) >= F.lit(mark).cast(dict(batch.dtypes)[time]), F.lit(False))
        replace_batch(batch.where(~on_time), folders.late, number)
        replace_batch(batch.where(on_time).withColumn(_ENDED, F.lit(False)), folders.accepted, number)

    _run(new.writeStream.foreachBatch(split), f"{folders.root}/checkpoint-accept")


def build_sessions(
    spark: SparkSession,
    folders: SessionFolders,
    schema: T.StructType,
    time: str,
    delay: str,
    gap: str,
    by: Sequence[str],
    measures: Sequence[Column],
) -> None:
    """Write every session that has ended: ``by``, session_start, session_end and the measures."""
    accepted = T.StructType([*schema, T.StructField(_ENDED, T.BooleanType())])
    rows = spark.readStream.schema(accepted).parquet(f"{folders.accepted}/{BATCH}=*")
    watched = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    grouped = watched.groupBy(F.session_window(time, gap).alias("_session"), *by, _ENDED).agg(*measures)
    ends = F.col("_session.start").alias("session_start"), F.col("_session.end").alias("session_end")
    measured = [c for c in grouped.columns if c not in ("_session", *by, _ENDED)]

    def write(batch: DataFrame, number: int) -> None:
        # Here and not in the stream, where the filter would be pushed below the watermark.
        replace_batch(batch.where(~F.col(_ENDED)).select(*by, *ends, *measured), folders.sessions, number)

    _run(grouped.writeStream.foreachBatch(write), f"{folders.root}/checkpoint-sessions")


def end_of_input(spark: SparkSession, folders: SessionFolders, schema: T.StructType, time: str, reach: str) -> None:
    """State that no more events will come: a marker, a row with nothing but a time, carries the watermark ``reach`` beyond all.

    Events that come after this are late by any measure.
    """
    latest = read_target(spark, folders.marks).agg(F.max("seen").alias(time))
    beyond = F.col(time) + F.expr(f"INTERVAL {reach}")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name != time}
    marker = latest.withColumns({time: beyond.cast(schema[time].dataType), **nothing, _ENDED: F.lit(True)})
    last = read_target(spark, folders.accepted).agg(F.max(F.col(BATCH).cast("long"))).first()[0] or 0
    replace_batch(marker.select(*schema.names, _ENDED), folders.accepted, _AFTER_ALL + last + 1)


def _marked(spark: SparkSession, folders: SessionFolders, number: int) -> bool:
    return path_exists(spark, f"{folders.marks}/{BATCH}={number}")


def _run(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

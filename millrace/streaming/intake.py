"""Incremental intake: files that were not taken in before, into a target, exactly once in effect.

A stream over the folder runs until no new file is left. Its checkpoint remembers the
files of every batch before the batch is written and marks it done afterwards, so a run
that stops in between repeats that batch with the same files and number. Repeating
changes nothing: with keys a batch is merged, and merging it twice gives the same rows;
without, its rows are a directory of their own, named by the batch, which is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.names import is_path
from millrace.operators.dedup import drop_duplicates
from millrace.operators.sinks import LoadResult, write_table
from millrace.sources.files import CSV_DEFAULTS, FILE_FORMATS, JSONL_DEFAULTS
from millrace.storage import beside, replace_directory

#: The partition column of a target without keys.
BATCH = "_intake_batch"


def read_new_files(
    spark: SparkSession,
    path: str,
    format: str,
    schema: StructType | str,
    options: Mapping[str, str] | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the files of a folder or glob, oldest first; a schema must be given."""
    if format not in FILE_FORMATS:
        raise ValueError(f"cannot read {format!r} files; known formats: {', '.join(FILE_FORMATS)}")
    settings = {"csv": CSV_DEFAULTS, "jsonl": JSONL_DEFAULTS}.get(format, {}) | dict(options or {})
    settings.pop("inferSchema", None)
    if files_per_batch:
        settings["maxFilesPerTrigger"] = str(files_per_batch)
    return spark.readStream.format("json" if format == "jsonl" else format).schema(schema).options(**settings).load(path)


def take_in(
    new: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    latest_by: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    on_batch: Callable[[int, LoadResult], None] | None = None,
) -> list[LoadResult]:
    """Load everything that is new in a stream and return what each batch did.

    ``transform`` works on a batch as on any frame. With ``keys`` batches are merged; of
    rows of one key in a batch the last by ``latest_by`` counts, or, without it, a
    repeated key raises. Without keys ``target`` must be a path. A ``checkpoint`` belongs
    to one source and one target. ``on_batch`` is called after a batch was written and
    before it counts as done; what it raises ends the run.
    """
    if latest_by and not keys:
        raise ValueError("latest_by needs keys")
    if not keys and not is_path(target):
        raise ValueError("an intake without keys goes to a path, where each batch has its directory")
    if not keys and partition_by:
        raise ValueError("an intake without keys is partitioned by its batches")
    results: list[LoadResult] = []

    def load(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        if keys:
            if latest_by:
                rows = drop_duplicates(rows, keys, [F.desc(c) for c in latest_by])
            result = write_table(rows, target, "merge", keys=keys, partition_by=partition_by)
        else:
            result = replace_batch(rows, target, number)
        if on_batch:
            on_batch(number, result)
        results.append(result)

    new.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return results


def replace_batch(rows: DataFrame, target: str, number: int) -> LoadResult:
    """Write the rows as one batch of a path, in place of what an earlier try may have left."""
    place = f"{target.rstrip('/')}/{BATCH}={number}"
    made = beside(place, "new")
    rows.write.parquet(made)
    written = rows.sparkSession.read.schema(rows.schema).parquet(made).count()
    replace_directory(rows.sparkSession, made, place)
    return LoadResult(target, "append", written)

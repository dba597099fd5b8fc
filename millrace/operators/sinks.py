"""Writing frames: append, overwrite, keyed merge, and one logical date of a zone.

A target is a catalog table by name or a dataset directory by path (a string with
a slash in it). New data is complete before old data goes: directories are written
beside their place and moved there, tables are pointed at a new version, partitions
are replaced from a stage that stays.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.curves import curve_place
from millrace.functions.literals import sql_literal
from millrace.functions.names import Columns, is_path, name_key, qualified_name, quoted, quoted_table
from millrace.functions.partitions import in_partitions, partition_tuples
from millrace.operators.merge import ACTION, MERGE_ACTIONS, conform, matched_keys, merge_frames, repeated_key
from millrace.operators.observe import count_rows
from millrace.sources.tables import iso_day, read_target
from millrace.storage import (
    beside,
    child_directories,
    partition_columns,
    path_exists,
    remove_paths,
    rename_copies,
    replace_directory,
    scratch_path,
)

log = logging.getLogger(__name__)

# The write modes a load accepts.
WRITE_MODES = ("append", "overwrite", "merge")

_VERSION = "__version_"
_AT_ONCE = 500
#: Kinds of keys whose ranges text can carry exactly.
_RANGED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampNTZType)
#: Fixed value: the directory of rows without a value in a partition column.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class LoadResult:
    """What a load did. The last four are set by a merge only.

    ``stage`` is where a merge into partitions keeps the merged rows, from which
    :func:`publish_stage` can repeat an interrupted one until
    :func:`millrace.storage.clear_scratch` removes it; for an unpartitioned table
    it is the new version's directory.
    """

    target: str
    mode: str
    rows: int | None
    inserted: int | None = None
    updated: int | None = None
    kept: int | None = None
    stage: str | None = None


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "append",
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    format: str | None = None,
    at_rest: bool = False,
    keep_versions: int = 1,
) -> LoadResult:
    """Append to, replace or merge into a target; creates it when absent.

    ``partition_by`` and ``format`` (Parquet) shape a new target. An existing one
    keeps its own, which are looked up, and naming others raises; only a path that
    is overwritten takes new partition columns. The format of a path cannot be
    looked up and must be given when it is not Parquet. ``cluster_by`` puts rows
    of similar value together inside the files. A merge first writes ``df`` to
    scratch; ``at_rest`` saves that for a plain scan of files that stay as they
    are. ``keep_versions`` former versions of an unpartitioned table stay behind
    for readers that still hold them.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}; known modes: {', '.join(WRITE_MODES)}")
    if mode == "merge" and not keys:
        raise ValueError("a merge needs keys")

    spark = df.sparkSession
    target = target if is_path(target) else qualified_name(spark, target)
    exists = path_exists(spark, target) if is_path(target) else spark.catalog.tableExists(target)
    if exists:
        partition_by = _own_partitions(spark, target, partition_by, mode)
        format = _own_format(spark, target, format)
    format = format or "parquet"
    if mode == "merge" and exists:
        return _merge(df, target, keys, partition_by, cluster_by, format, at_rest, keep_versions)
    if mode == "merge":
        df = _pinned(df, target, at_rest)
        _refuse_repeated_keys(df, keys)

    laid_out, seen = count_rows(lay_out(df, partition_by, cluster_by), f"load {target}")
    if mode == "append" and exists:
        _append(laid_out, target, partition_by, format)
    elif is_path(target):
        _overwrite_path(laid_out, target, partition_by, format)
    elif not exists:
        _create_table(laid_out, target, partition_by, format)
    elif not _same_columns(df, spark.table(target)):
        _recreate_table(laid_out, target, partition_by, keep_versions)
    elif partition_by:
        stage = scratch_path(spark, f"{_label(target)}_etl_stage")
        laid_out.write.parquet(f"{stage}/rows")
        log.info("overwrite of %s staged at %s", target, stage)
        _insert(lay_out(spark.read.parquet(f"{stage}/rows"), partition_by, cluster_by), target, overwrite=True)
    else:
        _swap(laid_out, target, keep_versions)
    rows = seen.get.get("rows", 0)
    created = {"inserted": rows, "updated": 0, "kept": 0} if mode == "merge" else {}
    return LoadResult(target, mode, rows, **created)


def write_run_date(df: DataFrame, zone: str, run_date: str, format: str = "parquet") -> int:
    """Replace one ``run_date`` partition of a zone and return the rows written.

    Other dates stay as they are, so a run can be repeated, also with nothing to
    write; one that fails leaves the date as it was. The partition's directory is
    written directly: ``partitionBy`` would sort every task's rows by a constant
    first. Where moving a directory copies it, Spark's committer puts the files in
    place instead (dynamic partition overwrite).
    """
    spark, place = df.sparkSession, f"{zone.rstrip('/')}/run_date={iso_day(run_date)}"
    counted, seen = count_rows(df.drop("run_date"), f"zone {place}")
    if rename_copies(spark, zone):
        dated = counted.withColumn("run_date", F.lit(iso_day(run_date)))
        writer = dated.write.format(format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_date").save(zone)
        rows = seen.get.get("rows", 0)
        if not rows:  # nothing to commit replaces nothing
            df.drop("run_date").limit(0).write.format(format).mode("overwrite").save(place)
        return rows
    new = beside(place, "new")
    counted.write.format(format).save(new)
    replace_directory(df.sparkSession, new, place)
    return seen.get.get("rows", 0)


def lay_out_by_curve(df: DataFrame, cluster_by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Group rows by several columns at once, so that a filter on any of them skips files.

    Sorting by one column after the other narrows the ranges of the first only. Here rows
    are dealt by ranges of their place on a space-filling curve through quantile cells of
    the columns, which one job measures. Rows of one place may lie in several files, so
    none is too common. The result goes to ``write_table`` as it is.
    """
    own = Columns(df)
    cluster_by, partition_by = own.require(cluster_by), own.require(partition_by)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place, tie = (f"_{uuid.uuid4().hex[:12]}" for _ in range(2))
    placed = df.withColumns({place: curve_place(df, cluster_by), tie: F.monotonically_increasing_id()})
    keys = [*map(quoted, partition_by), place]
    return placed.repartitionByRange(n, *keys, tie).sortWithinPartitions(*keys).drop(place, tie)


def lay_out(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Group rows for the files they will end up in.

    The rebalance hint shuffles by the columns and lets AQE merge small and split
    large shuffle partitions, so a value holding a third of all rows is written by
    many tasks and a rare one does not get a file per task. Sorting inside each
    task keeps the row-group and page ranges of the clustering columns narrow.
    """
    if not partition_by and not cluster_by:
        return df
    own = Columns(df)
    partition_by, cluster_by = own.require(partition_by), own.require(cluster_by)
    spread = [F.col(quoted(c)) for c in partition_by or cluster_by]
    order = [*partition_by, *[c for c in cluster_by if c not in partition_by]]
    return df.hint("rebalance", *spread).sortWithinPartitions(*map(quoted, order))


def publish_stage(
    spark: SparkSession,
    stage: str,
    target: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    format: str = "parquet",
    schema: T.StructType | None = None,
) -> None:
    """Put staged rows in place of the target partitions they belong to; remove those that lost all rows.

    Safe to repeat with the same stage until the next load.
    """
    rows = spark.read.schema(schema) if schema else spark.read
    staged = lay_out(rows.parquet(f"{stage}/rows").drop(ACTION), partition_by, cluster_by)
    if is_path(target):
        writer = staged.write.format(format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by).save(target)
    else:
        with _dynamic_inserts(spark):
            _insert(staged, target, overwrite=True)
    if not path_exists(spark, f"{stage}/emptied"):
        return
    emptied = spark.read.parquet(f"{stage}/emptied")
    if emptied.isEmpty():
        return
    if is_path(target):
        files = _read_path(spark, target, format).selectExpr(*map(quoted, partition_by), "_metadata.file_path AS _file")
        lost = in_partitions(files, emptied).selectExpr("regexp_replace(_file, '/[^/]*$', '') AS _directory").distinct()
        directories = (_plain_path(spark, r[0]) for r in lost.toLocalIterator())
        remove_paths(spark, directories)
        return
    specs_of = emptied.select(*[F.col(quoted(c)).cast("string") for c in partition_by]).toLocalIterator()
    while some := list(islice(specs_of, _AT_ONCE)):
        specs = [", ".join(f"{quoted(c)} = {_partition_value(v)}" for c, v in zip(partition_by, r)) for r in some]
        parts = ", ".join(f"PARTITION ({spec})" for spec in specs)
        spark.sql(f"ALTER TABLE {quoted_table(target)} DROP IF EXISTS {parts}")


def remove_old_versions(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Remove former versions of a table's files but the ``keep`` newest; returns their directories."""
    table = qualified_name(spark, table)
    current = _location(spark, table)
    base = current.split(_VERSION)[0]
    parent, _, name = base.rpartition("/")
    mine = [
        (changed, path)
        for path, changed in child_directories(spark, parent)
        if (own := path.rpartition("/")[2]) == name or own.startswith(f"{name}{_VERSION}")
    ]
    former = [p for _, p in sorted(mine, reverse=True) if p.rpartition("/")[2] != current.rpartition("/")[2]]
    remove_paths(spark, former[keep:])
    return former[keep:]


# ---- append and overwrite -------------------------------------------------------------------


def _append(df: DataFrame, target: str, partition_by: Sequence[str], format: str) -> None:
    if not is_path(target):
        _insert(df, target)
        return
    writer = _fitting(df, target, format).write.format(format).mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(target)


def _fitting(df: DataFrame, path: str, format: str) -> DataFrame:
    """The frame in the columns and types of a dataset: the same names, safely widened types, or an error.

    What does not fit is not written, since files that disagree make the whole dataset unreadable.
    """
    current = _read_path(df.sparkSession, path, format)
    own, given = Columns(current), Columns(df)
    unknown, lacking = [c for c in given.names if own.find(c) is None], [c for c in own.names if given.find(c) is None]
    if unknown or lacking:
        raise ValueError(f"{path} was not appended to: it lacks the columns {unknown}, and the frame lacks {lacking}")
    try:
        return df.to(current.schema)
    except AnalysisException as error:
        raise ValueError(f"{path} was not appended to: {error}") from error


def _overwrite_path(df: DataFrame, path: str, partition_by: Sequence[str], format: str) -> None:
    spark, new = df.sparkSession, beside(path, "new")
    writer = df.write.format(format)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(new)
    if partition_by and not partition_columns(spark, new):  # no rows: an empty file keeps layout and schema
        place = "/".join(f"{c}={_NO_VALUE}" for c in partition_by)
        df.drop(*partition_by).limit(0).write.format(format).save(f"{new}/{place}")
    replace_directory(spark, new, path)


def _insert(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """``insertInto`` by name: the table's columns, all of them and no others."""
    columns, own = df.sparkSession.table(table).columns, Columns(df)
    chosen = own.require(columns)
    if len(chosen) < len(own.names):
        raise ValueError(f"the frame has columns that {table} lacks: {set(own.names) - set(chosen)}")
    df.select(*map(quoted, chosen)).write.insertInto(table, overwrite=overwrite)


def _create_table(df: DataFrame, table: str, partition_by: Sequence[str], format: str) -> None:
    """A managed table, or one at a versioned directory when a dropped table has left files in its place."""
    spark = df.sparkSession
    writer = df.write.format(format)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    database, _, name = table.rpartition(".")
    described = spark.sql(f"DESCRIBE DATABASE {quoted_table(database)}").where("info_name = 'Location'")
    place = f"{described.first()[1].rstrip('/')}/{name.strip('`').lower()}"
    if path_exists(spark, place):
        writer = writer.option("path", f"{place}{_VERSION}{uuid.uuid4().hex}")
    writer.saveAsTable(table)


def _swap(df: DataFrame, table: str, keep_versions: int) -> str:
    """Write a new version of an unpartitioned table and point the table at it.

    Readers see the old or the new table, never a mix.
    """
    spark = df.sparkSession
    location = _write_version(df, table, ())
    _point(spark, table, location, keep_versions)
    return location


def _point(spark: SparkSession, table: str, location: str, keep_versions: int) -> None:
    spark.sql(f"ALTER TABLE {quoted_table(table)} SET LOCATION {sql_literal(location)}")
    spark.catalog.refreshTable(table)
    remove_old_versions(spark, table, keep_versions)


def _write_version(df: DataFrame, table: str, partition_by: Sequence[str]) -> str:
    spark = df.sparkSession
    base = _location(spark, table).split(_VERSION)[0].rstrip("/")
    location = f"{base}{_VERSION}{uuid.uuid4().hex}"
    writer = df.write.format(_provider(spark, table)).options(**_storage_options(spark, table))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(location)
    return location


def _recreate_table(df: DataFrame, table: str, partition_by: Sequence[str], keep_versions: int) -> None:
    """Overwrite with other columns: write the new version, then make the table anew over it.

    Format, options, properties and comment stay. Dropping the table may remove
    its old files, by then no longer needed.
    """
    spark = df.sparkSession
    location = _write_version(df, table, partition_by)
    about = _metadata(spark, table)
    written = [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    clauses = [
        f"CREATE TABLE {quoted_table(table)} ({', '.join(f'{quoted(f.name)} {f.dataType.simpleString()}' for f in written)})",
        f"USING {_provider(spark, table)}",
        _pairs("OPTIONS", _storage_options(spark, table)),
        f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else "",
        f"LOCATION {sql_literal(location)}",
        f"COMMENT {sql_literal(about.comment().get())}" if about.comment().isDefined() else "",
        _pairs("TBLPROPERTIES", _java_map(spark, about.properties())),
    ]
    spark.sql(f"DROP TABLE {quoted_table(table)}")
    spark.sql(" ".join(c for c in clauses if c))
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {quoted_table(table)}")
    remove_old_versions(spark, table, keep_versions)


# ---- merge ----------------------------------------------------------------------------------


def _merge(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    cluster_by: Sequence[str],
    format: str,
    at_rest: bool,
    keep_versions: int,
) -> LoadResult:
    spark = df.sparkSession
    current = _read_path(spark, target, format) if is_path(target) else spark.table(target)
    conformed = _directory_values(conform(df, current), partition_by)
    df = _pinned(conformed, target, at_rest)
    keys = Columns(current).require(keys)
    _refuse_repeated_keys(df, keys)
    if not is_path(target) and not _is_plain_files(spark, target):
        _native_merge(df, target, keys)
        return LoadResult(target, "merge", rows=None)

    # The only pass over all the target's keys; everything below knows from here what is hit.
    partition_by = Columns(current).require(partition_by)
    place = scratch_path(spark, f"{_label(target)}_etl_hits")
    hits = matched_keys(_within_reach(current, df, keys, partition_by, target), df, keys, partition_by)
    hits.write.parquet(place)
    hits = spark.read.schema(hits.schema).parquet(place)
    found = hits.select(*map(quoted, keys)).distinct()
    if partition_by:
        return _merge_partitions(df, current, target, keys, hits, found, partition_by, cluster_by, format)

    merged, seen = _count_actions(merge_frames(current, df, keys, found), f"merge {target}")
    merged = lay_out(merged.drop(ACTION), (), cluster_by)
    if is_path(target):
        stage, new = None, beside(target, "new")
        merged.write.format(format).save(new)
        written = spark.read.format(format)
    else:
        stage = new = _write_version(merged, target, ())
        written = spark.read.format(_provider(spark, target)).options(**_storage_options(spark, target))
    counts = _checked(target, current.count(), seen.get, written.schema(merged.schema).load(new).count(), hits, df, found)
    if is_path(target):
        replace_directory(spark, new, target)
    else:
        _point(spark, target, stage, keep_versions)
    return _merge_result(target, counts, stage)


def _within_reach(current: DataFrame, df: DataFrame, keys: Sequence[str], partition_by: Sequence[str], target: str) -> DataFrame:
    """The target's rows in which a key of the batch can be, read through what prunes: its partitions and its ranges of keys.

    Where partition columns are keys, only the batch's own partitions are read. Least and
    greatest key reach the scan as filters, so files and row groups whose footers tell
    that they lie outside are skipped: the narrower the batch and the better the target is clustered
    by its keys, the less is read.
    """
    shared = [c for c in partition_by if c in keys]
    if shared:
        tuples = partition_tuples(df.select(*map(quoted, shared)).dropna())
        current = in_partitions(current, _kept(tuples, f"{_label(target)}_etl_reach"))
    ranged = [c for c in keys if c not in shared and isinstance(current.schema[c].dataType, _RANGED)]
    if not ranged:
        return current
    ends = [F.expr(f"CAST({f}({quoted(c)}) AS STRING)") for c in ranged for f in ("min", "max")]
    found = df.agg(*ends).first()
    for i, c in enumerate(ranged):
        low, high = (F.lit(v).cast(current.schema[c].dataType) for v in found[2 * i : 2 * i + 2])
        current = current.where(F.col(quoted(c)).between(low, high))
    return current


def _count_actions(merged: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return merged.observe(seen, *[F.expr(f"count_if({ACTION} = '{a}') AS {a}") for a in MERGE_ACTIONS]), seen


def _checked(
    target: str, old: int, seen: dict, written: int, hits: DataFrame, df: DataFrame, found: DataFrame
) -> dict[str, int]:
    """What a merge did, as observed under its write; counted anew should a repeated task have been observed twice."""
    counts = {action: seen.get(action, 0) for action in MERGE_ACTIONS}
    if sum(counts.values()) != written:
        matched = hits.count()
        counts = {"update": matched, "keep": old - matched, "insert": df.count() - found.count()}
    if counts["keep"] + counts["update"] != old or sum(counts.values()) != written:
        raise RuntimeError(f"merge made {written} rows of {old} and {counts['insert']} new ones; {target} was not changed")
    return counts


def _merge_partitions(
    df: DataFrame,
    current: DataFrame,
    target: str,
    keys: Sequence[str],
    hits: DataFrame,
    found: DataFrame,
    partition_by: Sequence[str],
    cluster_by: Sequence[str],
    format: str,
) -> LoadResult:
    """Stage the merged rows of the partitions that rows arrive in or are hit in, then replace just those.

    Files cannot be overwritten while they are read, hence the staged copy. It is
    also what an interrupted publication is repeated from.
    """
    spark = df.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in current.schema}
    arriving = df.selectExpr(
        *[quoted(c) if c in df.columns else f"CAST(NULL AS {kinds[c]}) AS {quoted(c)}" for c in partition_by]
    )
    before = hits.select(*map(quoted, partition_by))
    touched = _kept(partition_tuples(before, arriving), f"{_label(target)}_etl_touched")
    old = in_partitions(current, touched)

    stage = scratch_path(spark, f"{_label(target)}_etl_stage")
    counted, seen = count_rows(old, f"merge {target}")
    merged = merge_frames(counted, df, keys, found)
    merged.write.parquet(f"{stage}/rows")
    staged = spark.read.schema(merged.schema).parquet(f"{stage}/rows")
    counts = dict.fromkeys(MERGE_ACTIONS, 0) | dict(staged.groupBy(ACTION).count().collect())
    # A repeated task is observed twice, so only a count of its own condemns a merge.
    remained = counts["keep"] + counts["update"]
    if remained != seen.get.get("rows", 0) and remained != (held := old.count()):
        raise RuntimeError(f"merge kept {remained} of {held} rows; {target} was not changed")
    if not set(partition_by) <= set(keys):
        # A partition all of whose rows moved elsewhere gets no row to be replaced with.
        emptied = before.distinct().subtract(staged.select(*map(quoted, partition_by)).distinct())
        partition_tuples(emptied).write.parquet(f"{stage}/emptied")
    log.info("merge into %s staged at %s", target, stage)
    publish_stage(spark, stage, target, partition_by, cluster_by, format, merged.schema)
    return _merge_result(target, counts, stage)


def _merge_result(target: str, counts: dict[str, int], stage: str | None) -> LoadResult:
    inserted, updated, kept = (counts[a] for a in ("insert", "update", "keep"))
    return LoadResult(target, "merge", inserted + updated, inserted, updated, kept, stage)


def _pinned(df: DataFrame, target: str, at_rest: bool) -> DataFrame:
    """The batch, which is read several times, as files: a frame that came out differently each
    time (an arbitrary survivor, a clock) would lose or repeat rows."""
    return df if at_rest else _kept(df, f"{_label(target)}_batch")


def _kept(df: DataFrame, label: str) -> DataFrame:
    place = scratch_path(df.sparkSession, label)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def _refuse_repeated_keys(df: DataFrame, keys: Sequence[str]) -> None:
    repeated = repeated_key(df, keys)
    if repeated is not None:
        raise ValueError(f"merge source repeats the key {repeated}")


def _native_merge(df: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Hand the merge to a table format with row-level operations of its own."""
    source = df.alias("source")
    match = F.expr(" AND ".join(f"{quoted_table(target)}.{quoted(k)} = source.{quoted(k)}" for k in keys))
    values = {c: F.col(f"source.{c}") for c in df.columns}
    changes = {c: v for c, v in values.items() if c not in keys}
    writer = source.mergeInto(target, match)
    if changes:
        writer = writer.whenMatched().update(changes)
    writer.whenNotMatched().insert(values).merge()


@contextmanager
def _dynamic_inserts(spark: SparkSession) -> Iterator[None]:
    """``insertInto`` takes the overwrite mode from the session, not from the writer."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


# ---- what a target is -----------------------------------------------------------------------


def _own_partitions(spark: SparkSession, target: str, given: Sequence[str], mode: str) -> list[str]:
    """The partition columns of an existing target; naming others raises."""
    own = partition_columns(spark, target) if is_path(target) else _table_partitions(spark, target)
    key = name_key(spark)
    if not given or [key(c) for c in given] == [key(c) for c in own]:
        return own
    if mode == "overwrite" and is_path(target):
        return list(given)
    raise ValueError(f"{target} is partitioned by {own or 'nothing'}, not by {list(given)}")


def _own_format(spark: SparkSession, target: str, given: str | None) -> str | None:
    if is_path(target):
        return given
    own = _provider(spark, target)
    if given and given.lower() != own:
        raise ValueError(f"{target} is a table of format {own}, not {given}")
    return own


def _read_path(spark: SparkSession, path: str, format: str) -> DataFrame:
    """A dataset directory with its partition columns as the text that names its directories."""
    return read_target(spark, path, format)


def _directory_values(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Empty text in a partition column as the NULL it becomes in a directory name."""
    partitions = [Columns(df).find(c) for c in partition_by]
    texts = [c for c in partitions if c and isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.expr(f"nullif({quoted(c)}, '')") for c in texts}) if texts else df


def _same_columns(df: DataFrame, table: DataFrame) -> bool:
    key = name_key(df.sparkSession)
    shape = lambda frame: sorted((key(f.name), f.dataType.simpleString()) for f in frame.schema)
    return shape(df) == shape(table)


def _table_partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _detail(spark: SparkSession, table: str, field: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)}")
    rows = described.where(F.col("col_name") == field).select("data_type").collect()
    return rows[-1][0] if rows else ""


def _provider(spark: SparkSession, table: str) -> str:
    if not _in_session_catalog(table):
        return _detail(spark, table, "Provider").lower()
    found = _metadata(spark, table).provider()
    return found.get().lower() if found.isDefined() else ""


def _location(spark: SparkSession, table: str) -> str:
    return _metadata(spark, table).location().toString().rstrip("/")


def _in_session_catalog(table: str) -> bool:
    """Whether the session's own catalog has the table, which then tells of it without a job."""
    return table.count(".") < 2 or table.split(".")[0].strip("`") == "spark_catalog"


def _is_plain_files(spark: SparkSession, table: str) -> bool:
    """Whether the table's format is only files, without row-level operations of its own."""
    provider = _provider(spark, table)
    if provider == "hive":
        return True
    source = spark._jvm.org.apache.spark.sql.execution.datasources
    try:
        found = source.DataSource.lookupDataSource(provider, spark._jsparkSession.sessionState().conf())
    except Exception:  # noqa: BLE001 - Spark knows no such source by that name: not its own files
        return False
    loader = spark._jvm.Thread.currentThread().getContextClassLoader()
    kinds = ("execution.datasources.FileFormat", "execution.datasources.v2.FileDataSourceV2")
    return any(loader.loadClass(f"org.apache.spark.sql.{k}").isAssignableFrom(found) for k in kinds)


def _metadata(spark: SparkSession, table: str):
    session = spark._jsparkSession.sessionState()
    name = quoted_table(".".join(table.split(".")[-2:]))
    return session.catalog().getTableMetadata(session.sqlParser().parseTableIdentifier(name))


def _storage_options(spark: SparkSession, table: str) -> dict[str, str]:
    """The options a table was made with, such as a header or a compression."""
    options = _java_map(spark, _metadata(spark, table).storage().properties())
    return {k: v for k, v in options.items() if k not in ("path", "serialization.format")}


def _java_map(spark: SparkSession, found) -> dict[str, str]:
    return dict(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(found))


def _pairs(clause: str, options: dict[str, str]) -> str:
    listed = ", ".join(f"{sql_literal(k)} = {sql_literal(v)}" for k, v in sorted(options.items()))
    return f"{clause} ({listed})" if listed else ""


def _plain_path(spark: SparkSession, uri: str) -> str:
    """A path out of the encoded form in which file metadata shows it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def _partition_value(value: str | None) -> str:
    return "NULL" if value is None else sql_literal(value)


def _label(target: str) -> str:
    return target.rstrip("/").replace("/", ".").rsplit(".", 1)[-1]

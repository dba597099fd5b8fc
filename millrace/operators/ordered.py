"""Order-dependent columns over a whole table: row numbers, running sums, tiles.

A window without a key, or with a key that holds much of a table, puts its rows into
one task. Here the rows are dealt by ranges of (``within``, ``order``), so that a large
group lies in many partitions; each partition's counts and sums of a group become
offsets of the partitions after it; and a local pass adds them up.

The dealt rows are staged before anything is counted: sampled range bounds may differ
when a lost partition is computed again. Rows equal in ``order`` are numbered in any
order of theirs, so give columns that decide where it matters. NULL sorts first, as
everywhere in Spark; a NULL in ``within`` is a group of its own; a NULL to be summed
counts as nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.storage import scratch_path

#: Partitions whose sums one task adds up; more of them are added up in a tree.
FAN = 512


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    within: Sequence[str] = (),
    position: str = "position",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The rows with their place from 0 in their group, and, if named, the rows of the group."""
    names = _names("part", "row", "before", "all", "n")
    dealt = deal_by_range(df, [*within, *order], names["part"], names["row"], partitions)
    counts = dealt.groupBy(names["part"], *within).agg(F.min(names["row"]).alias("first"), F.count(F.lit(1)).alias(names["n"]))
    offsets = _offsets(counts, names["part"], within, {names["n"]: names["before"]}, {names["n"]: names["all"]} if total else {})
    both = _join_groups(dealt, offsets, [names["part"], *within])
    place = F.col(names["row"]) - F.col("first") + F.col(names["before"])
    added = [place.alias(position), *([F.col(names["all"]).alias(total)] if total else [])]
    return both.select(*_columns(df, position, total), *added)


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Mapping[str, str | Column],
    within: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """The rows with, under each name, the sum of its column over the rows of the group up to this one.

    Sums of whole numbers and decimals are exact; those of floating point may differ
    in the last digits from a sum that is added up in one go.
    """
    names = _names("part", "row")
    values = {name: f"_{uuid.uuid4().hex[:12]}" for name in sums}
    before = {name: f"_{uuid.uuid4().hex[:12]}" for name in sums}
    frame = df.withColumns({values[name]: F.coalesce(_column(c), F.lit(0)) for name, c in sums.items()})
    dealt = deal_by_range(frame, [*within, *order], names["part"], names["row"], partitions)
    per_part = dealt.groupBy(names["part"], *within).agg(*(F.sum(v).alias(v) for v in values.values()))
    offsets = _offsets(per_part, names["part"], within, {values[n]: before[n] for n in sums}, {})
    rows = Window.partitionBy(names["part"], *within).orderBy(names["row"]).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({v: F.sum(v).over(rows) for v in values.values()})
    both = _join_groups(local, offsets.drop(*values.values()), [names["part"], *within])
    added = [(F.col(values[n]) + F.col(before[n])).alias(n) for n in sums]
    return both.select(*_columns(df, *sums), *added)


def tiles(
    df: DataFrame, order: Sequence[str | Column], n: int, within: Sequence[str] = (), tile: str = "tile", partitions: int | None = None
) -> DataFrame:
    """The rows with the number, from 1, of their tile: ``n`` tiles a group, the first ones a row longer if need be."""
    if n < 1:
        raise ValueError(f"tiles must be positive, not {n}")
    names = _names("position", "total")
    numbered = number_rows(df, order, within, names["position"], names["total"], partitions)
    at, small = F.col(names["position"]), F.floor(F.col(names["total"]) / n)
    longer = F.pmod(names["total"], F.lit(n))
    in_longer = F.floor(at / (small + 1))
    in_others = longer + F.floor((at - longer * (small + 1)) / F.greatest(small, F.lit(1)))
    return numbered.select(*_columns(df, tile), (F.when(at < longer * (small + 1), in_longer).otherwise(in_others) + 1).alias(tile))


def deal_by_range(df: DataFrame, keys: Sequence[str | Column], part: str, row: str, partitions: int | None = None) -> DataFrame:
    """The rows in partitions of consecutive ranges of the keys, staged with the partition's and the row's number.

    Rows that are equal in all keys may be dealt to several partitions, so no key is too common.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = f"_{uuid.uuid4().hex[:12]}"
    keyed = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(n, *keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
    number = F.monotonically_increasing_id()  # the partition in the upper bits, the row in the lower 33
    dealt = dealt.withColumns({part: F.shiftright(number, 33).cast("int"), row: number.bitwiseAND((1 << 33) - 1)})
    path = scratch_path(df.sparkSession, "ordered")
    dealt.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def _offsets(per_part: DataFrame, part: str, within: Sequence[str], before: Mapping[str, str], totals: Mapping[str, str]) -> DataFrame:
    """One row per partition and group, with the sums of the group's earlier partitions and of all.

    Partitions are added up ``FAN`` at a time, then their sums, until one run of them is left.
    """
    path = scratch_path(per_part.sparkSession, "ordered-sums")
    per_part.write.parquet(path)
    levels = [per_part.sparkSession.read.schema(per_part.schema).parquet(path)]
    count = int(levels[0].agg(F.coalesce(F.max(part), F.lit(0))).first()[0]) + 1
    while FAN ** len(levels) < count:
        block = F.floor(F.col(part) / FAN).cast("int").alias(part)
        levels.append(levels[-1].groupBy(block, *within).agg(*(F.sum(c).alias(c) for c in before)))
    done = None
    for level in reversed(levels):
        block = F.floor(F.col(part) / FAN).cast("int")
        run = Window.partitionBy(block, *within).orderBy(part)
        own = {b: F.coalesce(F.sum(c).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) for c, b in before.items()}
        whole = {t: F.sum(c).over(Window.partitionBy(block, *within)) for c, t in totals.items()}
        summed = level.withColumns({**own, **whole})
        if done is not None:
            up = _names("block", *before.values(), *totals.values())
            above = done.select(F.col(part).alias(up["block"]), *within, *(F.col(b).alias(up[b]) for b in up if b != "block"))
            joined = _join_groups(summed.withColumn(up["block"], block), above, [up["block"], *within])
            carried = {b: F.col(b) + F.col(up[b]) for b in before.values()} | {t: F.col(up[t]) for t in totals.values()}
            summed = joined.withColumns(carried).select(*summed.columns)
        done = summed
    return done


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The left rows with the right row of their keys, NULL being equal to NULL; key columns come from the left."""
    names = _names(*keys)
    renamed = right.select(*(F.col(k).alias(names[k]) for k in keys), *(c for c in right.columns if c not in keys))
    return left.join(renamed, [left[k].eqNullSafe(F.col(names[k])) for k in keys]).drop(*names.values())


def _names(*names: str) -> dict[str, str]:
    return {name: f"_{uuid.uuid4().hex[:12]}" for name in names}


def _columns(df: DataFrame, *replaced: str | None) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c not in replaced]


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c

"""Joins of intervals that overlap, and of points within intervals, through a grid of several levels.

An interval's level is the least power of two that is no shorter, so it touches at most
two cells of its level's grid. Two intervals that overlap share a cell of the longer
one's level: every interval goes into the cells of its own level, and into those of each
longer level that the other side has. The levels are those that occur, measured by one
aggregation a side; an interval is copied at most twice a level, however long it is, and
a short one never over the cells of a fine grid because a long one needs them.

A pair is made in one cell only, the one of the later of the two starts, and then
compared exactly. The join itself is an equi-join on (level, cell, keys), which Spark
broadcasts, sorts, and splits where a cell is too full; no nested loop or cartesian
product is planned.

With keys only the rows of the hot ones go through the grid: those with more than ``FEW``
rows on both sides, or more than ``MANY`` on one. Of any other key a row meets ``FEW``
rows at most on one side or the other, so these are joined by key, each row sent once.

Where only measures of the points met by each interval are asked for, no pairs are made,
whose number grows with the square of the input: the distinct points are numbered in their
order and summed up in runs of 1, 2, 4, 8 ... of them, and an interval, which holds a range
of numbers, is the sum of at most two runs of each length.

Bounds may be whole numbers, floating point, dates or timestamps; both ends are inclusive,
and infinite ones are open. The grid lies between the least and greatest finite bound.
An interval with a NULL or NaN bound, or that ends before it starts, overlaps nothing;
NULL keys match nothing.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import deal_by_range, running_totals
from millrace.storage import scratch_path

#: A key with no more rows than this on one side, and no more than ``MANY`` on the other, is joined as it is.
FEW, MANY = 64, 100_000
#: How parts of a measure are put together.
_MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


class _Grid(NamedTuple):
    """What was measured: the least and greatest finite bound, and the levels of either side."""

    low: float
    high: float
    least: int
    levels: tuple[list[int], list[int]]


def join_overlapping(
    left: DataFrame,
    right: DataFrame,
    left_on: tuple[str, str],
    right_on: tuple[str, str] | str,
    by: Sequence[str] = (),
    how: str = "inner",
    suffix: str = "_right",
    measures: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Each left row with each right row of the same ``by`` that overlaps it; with ``how="left"`` also the others, once.

    ``left_on`` names the columns of start and end; so does ``right_on``, or one column of
    points. The result has the left columns, then the right ones but ``by``; a name that
    both have gets the suffix on the right. Measuring jobs run first.

    With ``measures``, of points only, the result has each left row once with these of the
    right rows it overlaps: name -> (``count``, ``sum``, ``min`` or ``max``, a right column;
    ``*`` to count rows). ``how`` says whether left rows that overlap none are there, with NULLs.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if measures is not None and not (isinstance(right_on, str) and measures and {f for f, _ in measures.values()} <= {*_MERGED}):
        raise ValueError(f"measures must be of points, by {', '.join(_MERGED)}")
    if measures is not None and (twice := {*left.columns} & {*measures}):
        raise ValueError(f"overlap join would have a column twice: {sorted(twice)}")
    right_on = (right_on, right_on) if isinstance(right_on, str) else right_on
    kinds = {kind for df, on in ((left, left_on), (right, right_on)) for c, kind in df.dtypes if c in on}
    if len(kinds) != 1:
        raise ValueError(f"interval bounds differ in type: {sorted(kinds)}")
    if measures is not None:
        return _measured(left, right, left_on, right_on[0], by, how, measures)
    take = {c: c + suffix if c in left.columns else c for c in right.columns if c not in by}
    if len({*left.columns, *take.values()}) < len(left.columns) + len(take):
        raise ValueError(f"overlap join would have a column twice: {sorted(take.values())}")
    columns = ("id", "l", "r", "level", "cell", "kind", "a", "b", "x", "y", "a2", "b2", "x2")
    n = {x: f"_{uuid.uuid4().hex[:12]}" for x in columns} | {f"k{i}": f"_{uuid.uuid4().hex[:12]}" for i in range(len(by))}
    kept = _numbered(left, left_on, n["id"]) if how == "left" else left.withColumn(n["id"], F.lit(0))
    mine = _side(kept, left.columns, left_on, by, n, n["l"], [n["id"]])
    other = _side(right, list(take), right_on, by, n, n["r"], [])
    rights = [F.col(n["r"]).getField(f"c{i}").alias(name) for i, name in enumerate(take.values())]

    def finish(pairs: DataFrame) -> DataFrame:
        lefts = [F.col(n["l"]).getField(f"c{i}").alias(c) for i, c in enumerate(left.columns)]
        return pairs.select(*lefts, *rights) if how == "inner" else pairs.select(n["id"], n["r"])

    if by and all(dict(left.dtypes)[c] == dict(right.dtypes)[c] for c in by):
        keys = [n[f"k{i}"] for i in range(len(by))]
        found = finish(_join_by_key(kept, right, left.columns, take, left_on, right_on, by, n, hot := _hot_keys(mine, other, keys)))
        if hot is not None:
            found = found.unionByName(finish(_join_by_grid(mine.join(hot, keys, "left_semi"), other.join(hot, keys, "left_semi"), keys, n)))
    else:
        found = finish(_join_by_grid(mine, other, [n[f"k{i}"] for i in range(len(by))], n))
    if how == "inner":
        return found
    both = kept.join(found, n["id"], "left")
    return both.select(*(F.col(f"`{c}`") for c in left.columns), *rights)


def _measured(
    left: DataFrame, right: DataFrame, left_on: tuple[str, str], point: str, by: Sequence[str], how: str, measures: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """The left rows with the measures of the points they hold."""
    n = {x: f"_{uuid.uuid4().hex[:12]}" for x in ("a", "b", "at", "kind", "rank", "lo", "hi", "level", "run")}
    keys = {c: f"_{uuid.uuid4().hex[:12]}" for c in by}
    own = {name: f"_{uuid.uuid4().hex[:12]}" for name in measures}
    functions = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    first = [functions[f](F.lit(1) if c == "*" else F.col(f"`{c}`")).alias(own[name]) for name, (f, c) in measures.items()]
    merged = [_MERGED[f](own[name]).alias(own[name]) for name, (f, _) in measures.items()]
    k = list(keys.values())

    def keyed(df: DataFrame, on: tuple[str, str], names: tuple[str, str]) -> DataFrame:
        ends = dict(zip(names, on, strict=True))
        return df.where(_usable(df, on, by)).withColumns({name: F.col(f"`{c}`") for name, c in (*((v, c) for c, v in keys.items()), *ends.items())})

    spans = keyed(left, left_on, (n["a"], n["b"])).select(*k, n["a"], n["b"]).distinct()
    points = keyed(right, (point, point), (n["at"], n["at"])).groupBy(*k, n["at"]).agg(*first)
    # An interval's start comes before the points equal to it, its end after them.
    starts, ends = (spans.withColumns({n["at"]: F.col(n[c]), n["kind"]: F.lit(kind)}) for c, kind in (("a", 0), ("b", 2)))
    every = points.withColumn(n["kind"], F.lit(1)).unionByName(starts.unionByName(ends), allowMissingColumns=True)
    ranked = running_totals(every, [n["at"], n["kind"]], {n["rank"]: (F.col(n["kind"]) == 1).cast("long")}, k)
    end = lambda kind: F.max(F.when(F.col(n["kind"]) == kind, F.col(n["rank"])))
    ranges = ranked.where(F.col(n["kind"]) != 1).groupBy(*k, n["a"], n["b"]).agg(end(0).alias(n["lo"]), end(2).alias(n["hi"]))
    ranges = ranges.where(F.col(n["lo"]) < F.col(n["hi"]))
    longest = ranges.agg(F.max(F.col(n["hi"]) - F.col(n["lo"]))).first()[0] or 1
    levels = range(longest.bit_length())
    placed = ranked.where(F.col(n["kind"]) == 1).withColumn(n["level"], F.explode(F.array(*(F.lit(v) for v in levels))))
    run = F.expr(f"shiftright({n['rank']} - 1, {n['level']})").alias(n["run"])
    runs = placed.select(*k, n["level"], run, *own.values()).groupBy(*k, n["level"], n["run"]).agg(*merged)

    def used(level: int) -> Column:
        """The runs of a length that a range holds and no longer one of it does: one at either end at most."""
        low, high = F.shiftright(F.col(n["lo"]) + ((1 << level) - 1), level), F.shiftright(n["hi"], level)
        at = F.lit(level).alias("level")
        one = F.struct(at, low.alias("run"))
        two = F.struct(at, (high - 1).alias("run"))
        return F.array(F.when((low < high) & (low % 2 == 1), one), F.when((low < high) & (high % 2 == 1), two))

    parts = ranges.select(*k, n["a"], n["b"], F.explode(F.array_compact(F.concat(*(used(v) for v in levels)))).alias("part"))
    parts = parts.select(*k, n["a"], n["b"], F.col("part.level").alias(n["level"]), F.col("part.run").alias(n["run"]))
    found = parts.join(runs, [*k, n["level"], n["run"]]).groupBy(*k, n["a"], n["b"]).agg(*merged)
    same = (F.col(f"`{left_on[0]}`") == F.col(n["a"])) & (F.col(f"`{left_on[1]}`") == F.col(n["b"]))
    for c in by:
        same &= F.col(f"`{c}`") == F.col(keys[c])
    return left.join(found, same, how).select(*(F.col(f"`{c}`") for c in left.columns), *(F.col(own[name]).alias(name) for name in measures))


def _join_by_grid(mine: DataFrame, other: DataFrame, keys: Sequence[str], n: dict) -> DataFrame:
    """The pairs, met in the cells of the grid."""
    grid = _measure(mine, other, n)
    one = _copies(mine, grid, 0, n)
    two = _copies(other, grid, 1, n).withColumnsRenamed({n["a"]: n["a2"], n["b"]: n["b2"], n["x"]: n["x2"]}).drop(n["y"])
    met = one.join(two, [n["level"], n["kind"], n["cell"], *keys])
    own_cell = F.floor(F.greatest(n["x"], n["x2"]) / _size(F.col(n["level"]))) == F.col(n["cell"])
    return met.where(own_cell & (F.col(n["a"]) <= F.col(n["b2"])) & (F.col(n["a2"]) <= F.col(n["b"])))


def _join_by_key(
    kept: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    take: Mapping[str, str],
    left_on: tuple[str, str],
    right_on: tuple[str, str],
    by: Sequence[str],
    n: dict,
    hot: DataFrame | None,
) -> DataFrame:
    """The pairs of all keys but the hot ones. Columns go through the join one by one, so that unused ones are left out of it."""
    one = {c: f"{n['l']}_{i}" for i, c in enumerate(kept.columns)}
    two = {c: f"{n['r']}_{i}" for i, c in enumerate(right.columns)}
    sides = []
    for df, on, names in ((kept, left_on, one), (right, right_on, two)):
        side = df.where(_usable(df, on, by))
        if hot is not None:
            side = side.join(hot, [df[f"`{c}`"] == hot[n[f"k{i}"]] for i, c in enumerate(by)], "left_anti")
        sides.append(side.select(*(F.col(f"`{c}`").alias(name) for c, name in names.items())))
    overlap = (F.col(one[left_on[0]]) <= F.col(two[right_on[1]])) & (F.col(two[right_on[0]]) <= F.col(one[left_on[1]]))
    for c in by:
        overlap &= F.col(one[c]) == F.col(two[c])
    whole = F.struct(F.lit(0).alias("one"), *(F.col(one[c]).alias(f"c{i}") for i, c in enumerate(columns)))
    other = F.struct(F.lit(0).alias("one"), *(F.col(two[c]).alias(f"c{i}") for i, c in enumerate(take)))
    return sides[0].join(sides[1], overlap).select(F.col(one[n["id"]]).alias(n["id"]), whole.alias(n["l"]), other.alias(n["r"]))


def _hot_keys(mine: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys whose pairs, or whose rows, are too many for a join by key alone; staged. None if there is none."""
    n1, n2 = (f"_{uuid.uuid4().hex[:12]}" for _ in range(2))
    counts = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > FEW) for df, n in ((mine, n1), (other, n2))]
    hot = counts[0].join(counts[1], list(keys), "full").where((F.col(n1).isNotNull() & F.col(n2).isNotNull()) | (F.greatest(n1, n2) > MANY))
    path = scratch_path(mine.sparkSession, "hot-keys")
    hot.select(*keys).write.parquet(path)
    staged = mine.sparkSession.read.schema(hot.select(*keys).schema).parquet(path)
    return None if staged.isEmpty() else staged


def _number(c: str, kind: str) -> Column:
    """A bound as a double that keeps the order: days, microseconds, or the number itself."""
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def _size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _numbered(df: DataFrame, on: tuple[str, str], name: str) -> DataFrame:
    """The rows with numbers of their own; staged, for the numbers must not change."""
    low = f"_{uuid.uuid4().hex[:12]}"
    dealt = deal_by_range(df, [F.xxhash64(*(F.col(f"`{c}`").cast("string") for c in on))], name, low)
    return dealt.withColumn(name, F.col(name).cast("long") * (1 << 33) + F.col(low)).drop(low)


def _usable(df: DataFrame, on: tuple[str, str], by: Sequence[str]) -> Column:
    """Whether a row can overlap any."""
    kind = dict(df.dtypes)[on[0]]
    known = (F.col(on[0]) <= F.col(on[1])) & ~F.isnan(_number(on[0], kind)) & ~F.isnan(_number(on[1], kind))
    for c in by:
        known &= F.col(f"`{c}`").isNotNull()
    return known


def _side(df: DataFrame, columns: Sequence[str], on: tuple[str, str], by: Sequence[str], n: dict, packed: str, more: Sequence[str]) -> DataFrame:
    """The rows that can overlap any, as structs, with exact bounds a and b and the same as doubles x and y."""
    kind = dict(df.dtypes)[on[0]]
    x, y = _number(on[0], kind), _number(on[1], kind)
    whole = F.struct(F.lit(0).alias("one"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    keys = [F.col(f"`{c}`").alias(n[f"k{i}"]) for i, c in enumerate(by)]
    bounds = [F.col(on[0]).alias(n["a"]), F.col(on[1]).alias(n["b"]), x.alias(n["x"]), y.alias(n["y"])]
    return df.where(_usable(df, on, by)).select(whole.alias(packed), *more, *keys, *bounds)


def _measure(mine: DataFrame, other: DataFrame, n: dict) -> _Grid:
    """One aggregation a side; levels are some hundred at most, by the range of doubles."""
    x, y = F.col(n["x"]), F.col(n["y"])
    finite = (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))
    level = F.when(finite & (y > x), F.ceil(F.log2(y - x)).cast("int"))
    ends = [F.min(F.when(F.abs(c) < float("inf"), c)) for c in (x, y)] + [F.max(F.when(F.abs(c) < float("inf"), c)) for c in (x, y)]
    rows = [df.agg(*ends, F.collect_set(level), F.max(finite & (x == y)), F.max(~finite)).first() for df in (mine, other)]
    low = min((v for r in rows for v in r[:2] if v is not None), default=0.0)
    high = max((v for r in rows for v in r[2:4] if v is not None), default=0.0)
    least = math.ceil(math.log2(max(abs(low), abs(high), 1e-300))) - 52  # cells are told apart as far as doubles are
    top = max(math.ceil(math.log2(high - low)) if high > low else least, least)
    levels = [{max(v, least) for v in r[4]} | ({least} if r[5] else set()) | ({top} if r[6] else set()) for r in rows]
    return _Grid(low, high, least, (sorted(levels[0]), sorted(levels[1])))


def _copies(rows: DataFrame, grid: _Grid, side: int, n: dict) -> DataFrame:
    """A row for each cell that an interval touches: of its own level, and of the other side's longer levels.

    Kind 0 is for pairs whose left interval is of the cell's level, and kind 1 for those
    whose left one is shorter, so that two short intervals never meet in a long one's cell.
    """
    top = grid.levels[side][-1] if grid.levels[side] else grid.least
    x, y = (F.greatest(F.least(F.col(n[c]), F.lit(grid.high)), F.lit(grid.low)) for c in ("x", "y"))
    infinite = (F.abs(n["x"]) == float("inf")) | (F.abs(n["y"]) == float("inf"))
    length = F.when(y > x, F.greatest(F.ceil(F.log2(y - x)).cast("int"), F.lit(grid.least))).otherwise(F.lit(grid.least))
    own = F.when(infinite, F.lit(top)).otherwise(length).alias(n["level"])
    placed = rows.select(*(c for c in rows.columns if c not in (n["x"], n["y"])), x.alias(n["x"]), y.alias(n["y"]), own)
    longer = F.filter(F.array(*(F.lit(v) for v in grid.levels[1 - side])).cast("array<int>"), lambda v: v > F.col(n["level"]))

    def use(level: Column, kind: int) -> Column:
        return F.struct(level.alias("level"), F.lit(kind).alias("kind"))

    mine = [use(F.col(n["level"]), kind) for kind in ((0, 1) if side else (0,))]
    uses = F.concat(F.array(*mine), F.transform(longer, lambda v: use(v, 0 if side else 1)))
    used = placed.withColumn(n["kind"], F.explode(uses))
    used = used.withColumns({n["level"]: F.col(n["kind"])["level"], n["kind"]: F.col(n["kind"])["kind"]})
    size = _size(F.col(n["level"]))
    return used.withColumn(n["cell"], F.explode(F.sequence(F.floor(F.col(n["x"]) / size), F.floor(F.col(n["y"]) / size))))

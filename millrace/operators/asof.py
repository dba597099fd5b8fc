"""As-of join: for each left row the latest right row of its key at or before its time.

Both sides go into one frame dealt by ranges of (key, time), so that a key with much of
all rows lies in many partitions. Within a partition a window carries the last right row
on; what each partition hands to later ones, the last right row of each key in it, is a
small table, and a left row without a right row in its own partition takes what was
handed on. Every row is dealt by range once and by (partition, key) once; no key is
gathered in one task and no pair is made that is not returned.

A left row of a NULL key or time matches nothing, nor does such a right row. Of several
right rows at one time the greatest by ``tie`` counts, and among rows equal in that any.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.ordered import deal_by_range


def join_asof(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    by: Sequence[str] = (),
    take: Sequence[str] | None = None,
    direction: str = "backward",
    exact: bool = True,
    tolerance: Column | str | None = None,
    tie: Sequence[str] = (),
    suffix: str = "_right",
    partitions: int | None = None,
) -> DataFrame:
    """All left rows, once each, with the right columns ``take`` (all but ``by`` by default), NULL where none matches.

    ``on`` names the time column of either side, of one type. ``direction`` is ``backward``
    or ``forward`` (the next right row at or after the left time; of several the
    smallest by ``tie``). ``exact=False`` leaves equal times out. ``tolerance`` is an
    interval or number that the distance must not exceed, as a column or SQL text. A
    right column that the left side has gets the suffix.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction!r}")
    kinds = dict(left.dtypes)[on[0]], dict(right.dtypes)[on[1]]
    if kinds[0] != kinds[1]:
        raise ValueError(f"as-of columns differ in type: {on[0]} {kinds[0]}, {on[1]} {kinds[1]}")
    take = [c for c in right.columns if c not in by] if take is None else list(take)
    names = {c: c + suffix if c in left.columns else c for c in take}
    clash = sorted(n for n in names.values() if list(names.values()).count(n) > 1 or (n in left.columns))
    if clash:
        raise ValueError(f"as-of join would have the columns {clash} twice")
    n = {x: f"_{uuid.uuid4().hex[:12]}" for x in ("at", "side", "left", "right", "part", "row", "handed", "on")}
    n |= {f"k{i}": f"_{uuid.uuid4().hex[:12]}" for i in range(len(by))} | {f"t{i}": f"_{uuid.uuid4().hex[:12]}" for i in range(len(tie))}
    keys, ties = [n[f"k{i}"] for i in range(len(by))], [n[f"t{i}"] for i in range(len(tie))]
    backward = direction == "backward"
    both = _united(left, right, on, by, take, tie, n, exact == backward)
    order = F.asc if backward else F.desc
    sorted_by = [*keys, order(n["at"]), order(n["side"]), *(order(t) for t in ties)]
    dealt = deal_by_range(both, sorted_by, n["part"], n["row"], partitions)
    upto = Window.partitionBy(n["part"], *keys).orderBy(n["row"]).rowsBetween(Window.unboundedPreceding, 0)
    own = dealt.withColumn(n["right"], F.last(n["right"], ignorenulls=True).over(upto)).where(F.col(n["left"]).isNotNull())
    last = F.max_by(n["right"], F.when(F.col(n["right"]).isNotNull(), F.col(n["row"])))
    lasts = dealt.groupBy(n["part"], *keys).agg(last.alias(n["handed"]))
    earlier = Window.partitionBy(*keys).orderBy(n["part"]).rowsBetween(Window.unboundedPreceding, -1)
    if not keys:  # a row for each partition of the range
        lasts = lasts.withColumn(n["on"], F.lit(0))
        earlier = Window.partitionBy(n["on"]).orderBy(n["part"]).rowsBetween(Window.unboundedPreceding, -1)
    handed = lasts.withColumn(n["handed"], F.last(n["handed"], ignorenulls=True).over(earlier)).drop(n["on"])
    found = own.join(handed, [n["part"], *keys], "left").withColumn(n["right"], F.coalesce(n["right"], n["handed"]))
    found = found.select(n["left"], n["right"], n["at"])
    if tolerance is not None:
        reach = F.expr(tolerance) if isinstance(tolerance, str) else tolerance
        there = F.col(n["right"]).getField("at")
        near = F.col(n["at"]) <= there + reach if backward else there <= F.col(n["at"]) + reach
        found = found.withColumn(n["right"], F.when(near, F.col(n["right"])))
    rows = F.col(n["left"]), F.col(n["right"])
    columns = [rows[0].getField(c).alias(c) for c in left.columns]
    matched = found.select(*columns, *(rows[1].getField(f"c{i}").alias(names[c]) for i, c in enumerate(take)))
    void = F.lit(False)
    for c in [on[0], *by]:
        void |= F.col(c).isNull()
    kinds = dict(right.dtypes)
    lost = left.where(void).select("*", *(F.lit(None).cast(kinds[c]).alias(names[c]) for c in take))
    return matched.unionByName(lost)


def _united(
    left: DataFrame, right: DataFrame, on: tuple[str, str], by: Sequence[str], take: Sequence[str], tie: Sequence[str], n: dict, after: bool
) -> DataFrame:
    """Both sides' rows as structs, with key, time, ties and the place among rows of one time: right rows first if ``after``."""
    whole = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    held = F.struct(F.col(on[1]).alias("at"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(take)))
    sides = []
    kinds = dict(right.dtypes)
    for df, mine, at in ((left, n["left"], on[0]), (right, n["right"], on[1])):
        is_left = df is left and mine == n["left"]
        keys = [F.col(f"`{c}`").alias(n[f"k{i}"]) for i, c in enumerate(by)]
        ties = [(F.lit(None).cast(kinds[c]) if is_left else F.col(f"`{c}`")).alias(n[f"t{i}"]) for i, c in enumerate(tie)]
        place = F.lit(int(is_left) if after else int(not is_left))
        known = df.where(F.col(at).isNotNull())
        for c in by:
            known = known.where(F.col(c).isNotNull())
        sides.append(known.select(*keys, F.col(at).alias(n["at"]), place.alias(n["side"]), *ties, (whole if is_left else held).alias(mine)))
    return sides[0].unionByName(sides[1], allowMissingColumns=True)

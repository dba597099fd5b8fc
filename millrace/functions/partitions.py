"""Finding the partitions a batch touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import quoted

_HELD = "_held_"
ROWS = "_rows"


def partition_tuples(*frames: DataFrame) -> DataFrame:
    """The distinct rows of frames of partition columns, with how often each occurs."""
    names = frames[0].columns
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return rows.groupBy(*map(quoted, names)).agg(F.count(F.lit(1)).alias(ROWS))


def in_partitions(df: DataFrame, tuples: DataFrame) -> DataFrame:
    """The rows of ``df`` whose partition columns are among the tuples, NULL matching NULL.

    Any number of columns of any type. ``tuples`` comes from :func:`partition_tuples`;
    written to a file first, it is small, so Spark broadcasts it by its measured
    size and prunes the partitions of ``df`` before the scan (the filter on the
    counts is what makes it consider that worth while). Spark prunes by plain
    equality only, so partitions with a NULL, which a filter names, are a branch of
    their own.
    """
    names = [c for c in tuples.columns if c != ROWS]
    held = tuples.where(F.col(ROWS) > 0).selectExpr(*[f"{quoted(c)} AS {quoted(_HELD + c)}" for c in names])

    def matching(sign: str, condition: str) -> DataFrame:
        own, given = (condition.format(*[quoted(f"{p}{c}") for c in names]) for p in ("", _HELD))
        match = " AND ".join(f"{quoted(c)} {sign} {quoted(_HELD + c)}" for c in names)
        return df.where(own).join(held.where(given), F.expr(match), "left_semi")

    whole = matching("=", " AND ".join(["{} IS NOT NULL"] * len(names)))
    return whole.unionByName(matching("<=>", " OR ".join(["{} IS NULL"] * len(names))))

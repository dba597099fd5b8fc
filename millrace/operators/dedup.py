"""Deduplication."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.names import Columns, quoted


def drop_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per key, or per whole row without a key.

    With ``order_by`` the survivor is the first row in that order; without it any
    row of the group survives. Both forms reduce each map partition to one row per
    key before the shuffle (partial aggregation, or the partial window group limit
    Spark derives from ``rank = 1``), so a key that fills a third of the table
    sends one row per map task.
    """
    if not subset:
        return df.dropDuplicates()
    keys = Columns(df).require(subset)
    if not order_by:
        return df.dropDuplicates(keys)
    order = [quoted(o) if isinstance(o, str) else o for o in order_by]
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*order)
    rank = f"_{uuid.uuid4().hex[:12]}"  # a name that no column has
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)

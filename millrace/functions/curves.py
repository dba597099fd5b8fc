"""Places on a space-filling curve, so that rows close in several columns at once lie close together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import quoted

#: Quantile cells of a column are 2**BITS.
BITS = 6


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The Z-order place of a row: the bits of its cells in the columns, interleaved. Runs one job.

    Cells are quantiles, measured over all rows with partial aggregation, so a skewed
    column fills its cells evenly; NULL lies in the first one.
    """
    numbers = [_number(df, c) for c in columns]
    ranks = ", ".join(str(i / 2**bits) for i in range(1, 2**bits))
    quantiles = [F.expr(f"percentile_approx(v{i}, array({ranks}), 10000)").alias(f"q{i}") for i in range(len(columns))]
    bounds = df.select(*(n.alias(f"v{i}") for i, n in enumerate(numbers))).agg(*quantiles).first()
    place = F.lit(0).cast("long")
    for i, number in enumerate(numbers):
        cell = F.lit(0)
        for bound in sorted(set(bounds[i] or ())):
            cell += F.coalesce(number > bound, F.lit(False)).cast("int")
        cell = cell.cast("long")
        for b in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(cell, b).bitwiseAND(1), b * len(columns) + i))
    return place


def _number(df: DataFrame, column: str) -> Column:
    """A value as a number of the same order; text by its first six bytes."""
    kind, value = df.schema[column].dataType, F.col(quoted(column))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(value, "utf-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    raise ValueError(f"{column} is a {kind.simpleString()}, which has no place on a curve")

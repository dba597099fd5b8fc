"""Profiles of columns that add up: counts, bounds, and sketches of distinct values and quantiles.

A profile is made in one pass and has a row a column, so one for every run date costs
little to keep. Profiles of days are merged into that of a month without the days' rows:
counts are added, sketches united. Distinct counts come from HyperLogLog sketches
(relative error some 1.6 % at 2**12 registers) and quantiles from KLL sketches (rank error some 1.3 %).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.literals import sql_literal
from millrace.functions.names import Columns, quoted

_NUMBERS = (T.NumericType,)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def profile(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n_rows, n_nulls, low, high, text_low, text_high, distinct, quantiles) for every group and column.

    ``low`` and ``high`` are of numbers, and of dates and times in days or seconds; text
    has its own. NaN counts as a value but has no place among the quantiles. Other types
    have counts only.
    """
    own = Columns(df)
    by = own.require(by)
    columns = own.require(columns) if columns is not None else [c for c in own.names if c not in by]
    if not columns:
        raise ValueError("give at least one column to profile")
    measured = [_measures(df, c).alias(f"m{i}") for i, c in enumerate(columns)]
    groups = df.groupBy(*(F.col(quoted(c)).alias(f"g{i}") for i, c in enumerate(by))).agg(F.count(F.lit(1)).alias("n"), *measured)
    rows = [F.struct(F.expr(sql_literal(c)).alias("column"), F.col("n").alias("n_rows"), F.col(f"m{i}").alias("m")) for i, c in enumerate(columns)]
    named = groups.select(*(F.col(f"g{i}").alias(c) for i, c in enumerate(by)), F.explode(F.array(*rows)).alias("_p"))
    counts = F.col("_p.column").alias("column"), F.col("_p.n_rows").alias("n_rows")
    return named.select(*map(quoted, by), *counts, (F.col("_p.n_rows") - F.col("_p.m.n_values")).alias("n_nulls"), *(
        F.col(f"_p.m.{c}").alias(c) for c in ("low", "high", "text_low", "text_high", "distinct", "quantiles")))


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profiles of all rows that share ``by``, as if made of those rows at once."""
    merged = profiles.groupBy(*map(quoted, by), "column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("text_low").alias("text_low"),
        F.max("text_high").alias("text_high"),
        F.expr("hll_union_agg(`distinct`)").alias("distinct"),
        F.expr("kll_merge_agg_double(quantiles)").alias("quantiles"),
    )
    return merged


def read_profiles(profiles: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profiles with estimates in place of sketches: ``n_distinct``, and ``q<percent>`` for every rank."""
    values = [F.expr(f"kll_sketch_get_quantile_double(quantiles, {float(r)}D)").alias(f"q{round(r * 100)}") for r in ranks]
    has = F.col("quantiles").isNotNull() & (F.expr("kll_sketch_get_n_double(quantiles)") > 0)
    shown = [F.when(has, v).alias(f"q{round(r * 100)}") for v, r in zip(values, ranks, strict=True)]
    estimate = F.coalesce(F.expr("hll_sketch_estimate(`distinct`)"), F.lit(0)).alias("n_distinct")
    return profiles.select(*(F.col(quoted(c)) for c in profiles.columns if c not in ("distinct", "quantiles")), estimate, *shown)


def _measures(df: DataFrame, column: str) -> Column:
    kind, value = df.schema[column].dataType, F.col(quoted(column))
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, _NUMBERS):
        number = value.cast("double")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(value).cast("double")
    elif isinstance(kind, _TIMES):
        number = F.unix_micros(value.cast("timestamp")) / 1e6
    elif isinstance(kind, T.StringType):
        text = value
    number = F.when(~F.isnan(number), number)
    plain = isinstance(kind, (*_NUMBERS, *_TIMES, T.StringType, T.BooleanType))
    distinct = F.hll_sketch_agg(value.cast("string") if plain else F.lit(None).cast("string"), F.lit(12))
    return F.struct(
        F.count(value).alias("n_values"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.min(text).alias("text_low"),
        F.max(text).alias("text_high"),
        distinct.alias("distinct"),
        F.kll_sketch_agg_double(number).alias("quantiles"),
    )

"""Good rows and rejected ones, told apart in one pass and written by one job.

A row is rejected for every value that its column's type cannot take, every required
value that is missing, every rule it breaks, and for being unreadable at all, where the
reader kept such rows. Rejects keep their original values and say what is wrong with which.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import lenient_cast
from millrace.functions.literals import sql_literal
from millrace.functions.names import Columns, quoted

#: The columns that are added, and the directories of one written split.
PROBLEMS, GOOD = "_problems", "_good"
_PROBLEM = "struct<column: string, value: string, reason: string>"


def find_problems(
    df: DataFrame,
    casts: Mapping[str, str | T.DataType],
    required: Sequence[str] = (),
    rules: Mapping[str, str] | None = None,
    unreadable: str | None = None,
) -> DataFrame:
    """The frame with typed columns and ``_problems``, an array that is empty for a good row.

    ``rules`` are SQL conditions over the typed columns by name; one that is not TRUE, NULL
    aside, is broken. ``unreadable`` names the reader's column of corrupt records, which is
    dropped from the good. An absent column of ``casts`` is skipped, as in ``cast_columns``.
    """
    own = Columns(df)
    clash = [c for c in (PROBLEMS, GOOD) if own.find(c)]
    if clash:
        raise ValueError(f"the frame has columns of its own named {clash}")
    required = own.require(required)
    typed, problems = {}, []
    for name, target in casts.items():
        column = own.find(name)
        if column is None:
            continue
        value = F.col(quoted(column))
        cast = F.expr(lenient_cast(quoted(column), df.schema[column].dataType, target))
        wanted = target if isinstance(target, str) else target.simpleString()
        typed[column] = cast
        problems.append(_problem(value.isNotNull() & cast.isNull(), column, value, f"not a {wanted}"))
    for column in required:
        problems.append(_problem(F.col(quoted(column)).isNull(), column, F.lit(None), "missing"))
    if unreadable is not None:
        column = own.require([unreadable])[0]
        problems.append(_problem(F.col(quoted(column)).isNotNull(), column, F.col(quoted(column)), "unreadable"))
    original = [c for c in df.columns if c != unreadable]
    marked = df.withColumn(PROBLEMS, _array(problems))
    kept = F.struct(*(F.col(quoted(c)) for c in original)).alias("_original")
    after = marked.select(*(typed.get(c, F.col(quoted(c))).alias(c) for c in original), PROBLEMS, kept)
    broken = [_problem(~F.expr(rule), None, F.lit(None), f"breaks {name}") for name, rule in (rules or {}).items()]
    every = F.concat(F.col(PROBLEMS), _array(broken)) if broken else F.col(PROBLEMS)
    return after.withColumn(PROBLEMS, every).withColumn("_original", F.when(F.size(PROBLEMS) > 0, F.to_json("_original")))


def write_split(marked: DataFrame, path: str) -> tuple[int, int]:
    """Write what :func:`find_problems` gave, by one job, to a new path; returns the rows that are good and rejected."""
    split = marked.withColumn(GOOD, F.size(PROBLEMS) == 0)
    split.limit(0).write.parquet(f"{path}/schema")
    split.write.partitionBy(GOOD).parquet(f"{path}/rows")
    counts = {r[GOOD]: r["n"] for r in _read(marked.sparkSession, path).groupBy(GOOD).agg(F.count(F.lit(1)).alias("n")).collect()}
    return counts.get(True, 0), counts.get(False, 0)


def read_good(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of a written split, typed."""
    return _read(spark, path).where(F.col(GOOD)).drop(GOOD, PROBLEMS, "_original")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(column, value, reason, original): a row for every problem, with the whole row as it came, as JSON."""
    bad = _read(spark, path).where(~F.col(GOOD)).select(F.explode(PROBLEMS).alias("p"), F.col("_original").alias("original"))
    return bad.select("p.column", "p.value", "p.reason", "original")


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def _problem(condition: Column, column: str | None, value: Column, reason: str) -> Column:
    named = F.lit(None).cast("string") if column is None else F.expr(sql_literal(column))
    entry = F.struct(named.alias("column"), value.cast("string").alias("value"), F.expr(sql_literal(reason)).alias("reason"))
    return F.when(condition, entry)


def _array(problems: Sequence[Column]) -> Column:
    if not problems:
        return F.array().cast(f"array<{_PROBLEM}>")
    return F.filter(F.array(*problems), lambda p: p.isNotNull())

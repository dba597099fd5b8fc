"""Row counts that ride along with the job that reads or writes the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame and an observation whose ``get["rows"]`` fills on its next action.

    Meant for logs and statistics. Spark adds to an observation again when it has
    to re-run a finished shuffle stage, and a ``limit`` above it cuts it short, so
    place it directly under a write, and let gates use aggregates instead.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

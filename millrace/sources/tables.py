"""Reading back what the sinks wrote."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, NullType, StructField, StructType

from millrace.functions.names import is_path, qualified_name, quoted


def read_run_date(
    spark: SparkSession,
    zone: str,
    run_date: str,
    format: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """One logical date of a zone; the date may be written in any ISO form, as for the writer.

    Only that partition's directory is listed; ``basePath`` keeps ``run_date`` as
    a column. ``schema`` (without ``run_date``) saves the job that reads one from
    a file footer.
    """
    reader = spark.read.format(format).option("basePath", zone)
    if schema is not None:
        reader = reader.schema(StructType([*schema, StructField("run_date", DateType())]))
    return reader.load(f"{zone}/run_date={iso_day(run_date)}")


def read_target(
    spark: SparkSession, target: str, format: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """A target as it stands now: a catalog table by name, or a dataset by path.

    A path's partition values are directory names and come back as the text they
    are (``007`` is not 7) unless ``schema`` gives them a type. A schema for a
    table selects and casts its columns.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not is_path(target):
        found = spark.table(qualified_name(spark, target))
        return found if schema is None else found.to(schema)
    if schema is not None:
        return spark.read.format(format).schema(schema).load(target)
    with partition_values_as_text(spark):
        found = spark.read.format(format).load(target)
    untyped = [f.name for f in found.schema if isinstance(f.dataType, NullType)]  # no partition has a value
    return found.withColumns({c: found[quoted(c)].cast("string") for c in untyped}) if untyped else found


@contextmanager
def partition_values_as_text(spark: SparkSession) -> Iterator[None]:
    """Types of partition columns are settled while a frame is made, so the setting is needed only then."""
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def iso_day(run_date: str) -> str:
    """A date in any ISO form as the writer names its directory; anything else raises."""
    return date.fromisoformat(run_date).isoformat()

"""File scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The formats a scan accepts and the options each one starts from.
FILE_FORMATS = ("csv", "json", "jsonl", "parquet", "delta", "orc")
CSV_DEFAULTS = {"header": "true", "inferSchema": "true", "nullValue": "NULL"}
JSONL_DEFAULTS = {"multiLine": "false"}


def read_files(
    spark: SparkSession,
    path: str | Sequence[str],
    format: str,
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan files, directories or glob patterns.

    Without ``schema`` CSV and JSON are inferred, which reads the input once more;
    give a schema for anything large. ``options`` go to the reader unchanged and
    win over the defaults. Pass ``basePath`` to keep partition columns when a glob
    points below the partition directories.
    """
    if format not in FILE_FORMATS:
        raise ValueError(f"cannot read {format!r} files; known formats: {', '.join(FILE_FORMATS)}")

    settings = {"csv": CSV_DEFAULTS, "jsonl": JSONL_DEFAULTS}.get(format, {}) | dict(options or {})
    reader = spark.read.format("json" if format == "jsonl" else format)
    if schema is not None:
        settings.pop("inferSchema", None)
        reader = reader.schema(schema)
    try:
        return reader.options(**settings).load(path if isinstance(path, str) else list(path))
    except Exception as error:  # the JVM reports this one as a plain class-not-found
        if "[DATA_SOURCE_NOT_FOUND]" in str(error):
            raise RuntimeError(f"the {format!r} data source is not on this session's classpath") from error
        raise

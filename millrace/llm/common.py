"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.storage import scratch_path

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give every executor this library, once per Spark application.

    Whole documents are longer than the rows Spark's default batches are meant for, so
    batches for Python become smaller unless the session has a size of its own.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    context = spark.sparkContext
    if not hasattr(context, "_millrace_library"):
        root, folder = Path(__file__).resolve().parents[2], tempfile.TemporaryDirectory()
        target = Path(folder.name) / "millrace-library.zip"
        with zipfile.ZipFile(target, "w") as library:
            for source in sorted((root / "millrace").rglob("*.py")):
                library.write(source, source.relative_to(root))
        context.addPyFile(str(target))  # executors fetch it from the driver
        context._millrace_library = folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back, so that no later step computes it again."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(*taken: str) -> str:
    """A column name that none of the given ones has."""
    name = f"_{uuid.uuid4().hex[:12]}"
    return name if name not in taken else fresh(*taken)


def fold_is(column: str, folds: int, value: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == value, F.lit(False))


def text_udf(spark: SparkSession, make: Callable, model, returns: str) -> Callable[[str], Column]:
    """A column of ``make(model)(texts)``, a data frame or array per batch of texts; null texts come as ''.

    The model is broadcast; every caller bounds its size by its parameters.
    """
    held = spark.sparkContext.broadcast(model)

    if " " in returns:  # a struct, given as its fields

        @F.pandas_udf(returns)
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            score = make(held.value)
            for texts in batches:
                yield score([t or "" for t in texts])

    else:

        @F.pandas_udf(returns)
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            score = make(held.value)
            for texts in batches:
                yield score([t or "" for t in texts])

    return lambda column: apply(F.col(column))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, label) of at most ``most`` labelled documents, the ones of smallest hashed id.

    Each id counts once, with its largest label; the sample's ids are few enough to broadcast.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "y")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))

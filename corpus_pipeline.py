"""The corpus pipeline: five operators, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of
``documents``.

Defined results, which every stage keeps: a table without rows gives none. Null and empty texts
are scored like others by the first stage, are nobody's near copies, hold no leak and no
secret, and are packed as documents of one token. Rows without an id are scored, judged for leaks,
masked and packed; only as near copies they are not compared, so each stays. Of exact
copies one row stays; equal rows of one id are copies. Further columns pass through all
but the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import credentials, decontamination, neardup, packing, toxicity
from millrace.llm.common import fold_is, ship, table
from millrace.storage import scratch_path

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents scored below 0.5 by a machine learned from the labels outside the held-out fold."""
    ship(spark)
    labels = table(spark, sf_dir, "labels").where(~fold_is("doc_id", 5, 0))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of exact and near copies the document of smallest id."""
    ship(spark)
    return neardup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item was found."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts overwritten."""
    ship(spark)
    return credentials.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1,024 tokens."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Learned scores, signatures and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Which rows differ between two tables, found through trees of digests.

Every side keeps a digest table beside it: the hash of each row's key and of the whole row,
in directories by the first ``BITS`` bits of the key's hash and sorted by it, and the
node digests of those buckets, a few bytes each. Two tables are compared node by
node; only buckets whose nodes are unequal are read again and joined by key. What is read
is in proportion to the difference, however large the tables are.

Digest tables are made where the rows are, so two systems exchange digests, not rows.
A key may repeat and may be NULL: the rows of one key are compared as a bag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.digests import bag_digest
from millrace.functions.names import Columns, quoted
from millrace.functions.partitions import in_partitions, partition_tuples

BITS = 10
CHANGED, MISSING, EXTRA = "changed", "missing", "extra"


def write_digests(df: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str] | None = None, bits: int = BITS) -> None:
    """Write a frame's digest table: one shuffle of keys and two hashes a row.

    Both sides must name the same columns in the same order, with the same types; all but the keys by
    default. More ``bits`` make buckets smaller: some 100,000 rows each read well.
    """
    own = Columns(df)
    keys = own.require(keys)
    columns = own.require(columns) if columns is not None else [c for c in own.names if c not in keys]
    key, row = F.xxhash64(*map(F.col, map(quoted, keys))), F.xxhash64(*(_value(df, c) for c in columns), F.lit(0))
    bucket = F.shiftrightunsigned(key, 64 - bits).cast("int")
    rows = df.select(bucket.alias("bucket"), key.alias("key_hash"), row.alias("row_hash"), *(F.col(quoted(k)).alias(f"k_{k}") for k in keys))
    rows.limit(0).write.parquet(f"{path}/schema")  # of a table without rows there is no file to tell it
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "key_hash").write.partitionBy("bucket").parquet(f"{path}/rows")
    written = read_digests(df.sparkSession, path)
    whole = F.expr(bag_digest("key_hash, row_hash")).alias("node")
    nodes = written.groupBy("bucket").agg(whole).select("bucket", F.xxhash64("node").alias("node"), F.col("node.n_rows").alias("n_rows"))
    nodes.write.parquet(f"{path}/nodes")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def unequal_buckets(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(bucket) of the nodes that differ or that one side lacks: a join of two tables of at most 2**BITS rows."""
    one, two = (spark.read.parquet(f"{path}/nodes") for path in (source, target))
    both = one.withColumnRenamed("node", "s").join(two.withColumnRenamed("node", "t"), "bucket", "full")
    return both.where(~F.col("s").eqNullSafe(F.col("t"))).select("bucket")


def find_differences(spark: SparkSession, source: str, target: str, scratch: str) -> DataFrame:
    """(difference, keys, source_rows, target_rows): keys whose rows are changed, missing in the target, or extra there.

    ``source`` and ``target`` are digest tables; ``scratch`` is a new path for the list of
    unequal buckets, which prunes the directories of both before they are read.
    """
    partition_tuples(unequal_buckets(spark, source, target)).write.parquet(scratch)
    unequal = spark.read.parquet(scratch)
    sides = []
    for path, name in ((source, "s"), (target, "t")):
        rows = in_partitions(read_digests(spark, path), unequal)
        keys = [c for c in rows.columns if c.startswith("k_")]
        digest = F.expr(bag_digest("row_hash")).alias("digest")
        bags = rows.groupBy("key_hash", *map(quoted, keys)).agg(digest)
        sides.append(bags.select("key_hash", *map(quoted, keys), F.xxhash64("digest").alias(name), F.col("digest.n_rows").alias(f"{name}_rows")))
    one, two = sides
    keys = [c for c in one.columns if c.startswith("k_")]
    if sorted(keys) != sorted(c for c in two.columns if c.startswith("k_")):
        raise ValueError(f"the digests of {source} and {target} are of different keys")
    renamed = two.withColumnsRenamed({c: f"other_{c}" for c in [*keys, "key_hash"]})
    match = F.col("key_hash") == F.col("other_key_hash")
    for k in keys:
        match &= F.col(quoted(k)).eqNullSafe(F.col(quoted(f"other_{k}")))
    both = one.join(renamed, match, "full").where(~F.col("s").eqNullSafe(F.col("t")))
    what = F.when(F.col("t").isNull(), MISSING).when(F.col("s").isNull(), EXTRA).otherwise(CHANGED)
    named = [F.coalesce(F.col(quoted(k)), F.col(quoted(f"other_{k}"))).alias(k[2:]) for k in keys]
    rows = [F.coalesce(f"{x}_rows", F.lit(0)).alias(f"{n}_rows") for x, n in (("s", "source"), ("t", "target"))]
    return both.select(what.alias("difference"), *named, *rows)


def _value(df: DataFrame, column: str) -> Column:
    """A value for hashing in which a NULL is not nothing, and maps, which have no hash, are their sorted entries."""
    value = F.col(quoted(column))
    if dict(df.dtypes)[column].startswith("map<"):
        value = F.array_sort(F.map_entries(value))
    return F.struct(value.isNull(), value)

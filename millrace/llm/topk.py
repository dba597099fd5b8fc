"""Exact top-k by inner product: query tiles times shards, selection per tile, merging of top lists.

Queries are dealt into tiles of about ``TILE``, candidates into branches of about
``BRANCH`` rows, and every tile meets every branch in a group of its own. The group
multiplies the tile with ``SHARD`` candidates at a time, selects each query's best k
of the shard and merges them into the branch's lists; a window merges the branches'
lists. Products are exact: in doubles where all sums stay below 2**53, in int64 where
they stay below 2**63, and for the vectors beyond that in whole numbers of any size.

Edge cases: vectors that are null, empty or hold a null or non-finite component
take no part, nor does a null id; vectors meet only vectors of their own length; a query
id that repeats asks once, with its smallest vector; repeated candidate rows each
count. Equal scores: smaller id. A component that is no long once multiplied, or a score
that is none, raises.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import ship

TILE, SHARD, BRANCH = 1024, 2048, 16384
_FOUND = "query_id long, vec_id long, score long"


def quantised(df: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, without vectors that can't be used."""
    too_large = F.raise_error(F.lit(f"a component times {scale} is beyond 64 bits")).cast("long")
    v = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double") * scale) < 2.0**63, F.floor(x.cast("double") * scale)).otherwise(too_large))
    usable = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return df.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")
    )


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; raises if one is beyond 64 bits."""
    dim = queries.shape[1]
    q, v = (np.abs(x.astype(np.float64)).max(axis=1, initial=0) + 1 for x in (queries, vectors))
    if q.max(initial=1) * v.max(initial=1) * dim < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    found = queries @ vectors.T  # wraps where the sums below go beyond 64 bits
    doubtful = q[:, None] * v[None, :] * dim >= 2.0**63
    for row in np.flatnonzero(doubtful.any(axis=1)):
        col = np.flatnonzero(doubtful[row])
        exact = vectors[col].astype(object) @ queries[row].astype(object)
        if max(map(abs, exact)) >= 1 << 63:
            raise OverflowError("an inner product is beyond 64 bits")
        found[row, col] = exact.astype(np.int64)
    return found


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k largest scores, ties to the smaller id."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        row, col = np.nonzero(scores >= least[:, None])
    else:
        row, col = (a.ravel() for a in np.indices(scores.shape))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], col[rank < k]


def _search(k: int):
    def search(tile: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        best = tuple(np.zeros(0, np.int64) for _ in range(3))
        if len(tile) and len(shards):
            asked, queries = tile["vec_id"].to_numpy(np.int64), np.stack(tile["v"].to_list())
            for at in range(0, len(shards), SHARD):
                part = shards.iloc[at : at + SHARD]
                ids = part["vec_id"].to_numpy(np.int64)
                scores = products(queries, np.stack(part["v"].to_list()))
                row, col = _others(scores, asked, ids, k)
                best = _merge(best, (row, ids[col], scores[row, col]), k)
            best = (asked[best[0]], *best[1:])
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), best, strict=True)))

    return search


def _others(scores: np.ndarray, q_ids: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """best_of without the queries' own rows: as many more are taken as a query has own rows."""
    own = int(np.unique(ids[np.isin(ids, q_ids)], return_counts=True)[1].max(initial=0))
    row, col = best_of(scores, ids, k + own)
    keep = q_ids[row] != ids[col]
    return row[keep], col[keep]


def _merge(a: tuple, b: tuple, k: int) -> tuple:
    row, ids, score = (np.concatenate(x) for x in zip(a, b, strict=True))
    order = np.lexsort((ids, -score, row))
    row, ids, score = row[order], ids[order], score[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], ids[keep], score[keep]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id, v) frames; see the module's text for edge cases."""
    ship(queries.sparkSession)
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    tiles = max(1, math.ceil(asked.count() / TILE))
    branches = max(1, math.ceil(candidates.count() / BRANCH))
    left = asked.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).alias("tile"))
    left = left.withColumn("branch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(branches - 1))))
    right = candidates.select(
        "vec_id", "v", F.size("v").alias("dim"), (F.monotonically_increasing_id() % branches).alias("branch")
    ).withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1))))
    cell = ["tile", "branch", "dim"]
    found = left.groupBy(cell).cogroup(right.groupBy(cell)).applyInPandas(_search(k), _FOUND)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

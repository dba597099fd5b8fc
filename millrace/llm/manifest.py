"""A Merkle manifest of a dataset by time-forward processing.

Every row is a leaf, hashed inside the JVM. Leaves are numbered per source by a
distributed prefix scan. A tree then grows by time-forward processing: nodes are
labelled by the last leaf below them and their level, so a child's label comes before
its parent's; a node's digest is sent as a message to its parent, and waits in a priority
queue ordered by label until the sweep reaches it.

The queue is external: ``FANOUT**DEPTH`` neighbouring nodes are a block, which Spark's
sorted shuffle brings to a task in label order. Within a block at most ``FANOUT`` messages
a level wait in a heap; what a block sends beyond itself, the digest of its top, is the
input of the next round. Each round finishes DEPTH levels, so a source of 10**10 rows
takes three. Subroots are the leaves of one more tree.

The reversed sweep reads the same blocks from the last label to the first: a parent's
message, the digests beside it on its way to the root, waits for each of its children.
A leaf receives its whole proof and folds it.

Edge cases: a null field is hashed as ``-``; empty texts and texts of any length are
values like others. A null doc_id precedes all others, a null source all sources. Rows
of equal doc_id and source are ordered by their leaf; equal rows are leaves each. An empty
table has no rows and no root. Other columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fold_is, ship, staged
from millrace.operators.ordered import number_rows

FANOUT, DEPTH = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: Nodes: their tree and its number of leaves, their level and place in it.
_RUN = "tree string, leaves long, level int, place long, last long, digest string, run string"
_SUFFIX = "tree string, leaves long, level int, place long, subroot string, places array<int>, runs array<string>"
_PROOF = "row string, digest string, subroot string, proof_sha256 string, folded_root string"


def sha256(*parts: str) -> str:
    """Lowercase hex of the concatenation, in UTF-8."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(columns: dict[str, Column]) -> Column:
    """The digest of a row: each field `-` if null, else its UTF-8 length, a colon and its value."""
    texts = (c.cast("string") for c in columns.values())
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def lower_ascii(column: str) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col(column), upper, upper.lower())


class Shape(NamedTuple):
    """Children of a node, and the levels of a block."""

    fanout: int = FANOUT
    depth: int = DEPTH

    def height(self, leaves: int) -> int:
        """Levels above the leaves of a tree of so many."""
        levels = 0
        while leaves > 1:
            leaves, levels = -(-leaves // self.fanout), levels + 1
        return levels

    def block(self, level: Column, place: Column, base: int) -> Column:
        """The number of the block of a node; blocks of a round begin at the level ``base``."""
        nodes = F.pow(F.lit(float(self.fanout)), F.lit(base + self.depth) - level)
        return F.floor(place / nodes).cast("long")


class Link(NamedTuple):
    """A node's way to the root: its place in its run, the run's digests, and the parent's way."""

    at: int
    run: list[str]
    up: Link | None


def _digests(run: str) -> list[str]:
    return [run[i : i + 64] for i in range(0, len(run), 64)]


class _Block(NamedTuple):
    """The labels of a block of one tree, which goes from the level ``base`` to the level ``top``."""

    fanout: int
    base: int
    top: int
    end: int  # nodes of the level ``base`` in the tree

    @classmethod
    def of(cls, shape: Shape, leaves: int, base: int) -> _Block:
        top = min(base + shape.depth, max(shape.height(leaves), base))
        return cls(shape.fanout, base, top, -(-leaves // shape.fanout**base))

    def last(self, level: int, place: int) -> int:
        """The last node of the base level below a node."""
        return min((place + 1) * self.fanout ** (level - self.base), self.end) - 1


def _grow(shape: Shape, base: int):
    """Upward: nodes arrive by place; every node that their messages complete leaves, with its children's digests."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue: list[tuple[int, int, int, str]] = []  # (last, level, place of the sender, its digest)
        for batch in batches:
            out = []
            for tree, leaves, place, digest in zip(batch["tree"], batch["leaves"], batch["place"], batch["digest"], strict=True):
                block = _Block.of(shape, leaves, base)
                if block.top > base:
                    parent = place // shape.fanout
                    heapq.heappush(queue, (block.last(base + 1, parent), base + 1, place, digest))
                while queue and queue[0][0] <= place:
                    last, level = queue[0][:2]
                    children = []
                    while queue and queue[0][:2] == (last, level):
                        children.append(heapq.heappop(queue))
                    at, joined = children[0][2] // shape.fanout, "".join(c[3] for c in children)
                    up = sha256(joined)
                    out.append((tree, leaves, level, at, last, up, joined))
                    if level < block.top:
                        heapq.heappush(queue, (block.last(level + 1, at // shape.fanout), level + 1, at, up))
            yield pd.DataFrame(out, columns=["tree", "leaves", "level", "place", "last", "digest", "run"])

    return run


def _dealt(df: DataFrame, *order: Column | str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", *order)


def grow(leaves: DataFrame, shape: Shape) -> tuple[list[DataFrame], DataFrame]:
    """For each round its runs, (tree, leaves, level, place, last, digest, run); and (tree, root) of every tree.

    ``leaves`` are (tree, leaves, place, digest), staged.
    """
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    nodes, rounds, roots, base = leaves.select("tree", "leaves", "place", "digest"), [], [], 0
    roots.append(nodes.where("leaves = 1").select("tree", F.col("digest").alias("root")))
    while base < shape.height(most):
        blocks = _dealt(nodes.withColumn("block", shape.block(F.lit(base), F.col("place"), base)), "place")
        runs = staged(blocks.drop("block").mapInPandas(_grow(shape, base), _RUN), f"manifest-{base}")
        rounds.append(runs)
        is_root = (F.col("place") == 0) & (F.pow(F.lit(float(shape.fanout)), "level") >= F.col("leaves"))
        roots.append(runs.where(is_root).select("tree", F.col("digest").alias("root")))
        tops = runs.where((F.col("level") == base + shape.depth) & (F.col("leaves") > shape.fanout ** (base + shape.depth)))
        nodes = tops.select("tree", "leaves", "place", "digest")
        base += shape.depth
    found = roots[0]
    for more in roots[1:]:
        found = found.union(more)
    return rounds, found


def _deliver(shape: Shape, base: int, emit):
    """Downward: rows arrive from the last label to the first; each takes its message and sends one to each child."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue: list[tuple[int, int, Link | None]] = []
        subroot, block = "", None
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.places is not None:  # the message to the block's top, ahead of its rows
                    block, subroot, way = _Block.of(shape, r.leaves, base), r.subroot, None
                    for at, digests in zip(reversed(r.places), reversed(r.runs), strict=True):
                        way = Link(int(at), _digests(digests), way)
                    queue = [(-block.last(r.level, r.place), -r.level, way)]
                    continue
                last, level, way = heapq.heappop(queue)
                if (-last, -level) != (r.last, r.level):
                    raise AssertionError(f"the message for {(-last, -level)} met the node {(r.last, r.level)} of {r.tree}")
                if r.level == base:
                    out.append(emit(r, subroot, way))
                    continue
                digests = _digests(r.run)
                for at in range(len(digests)):
                    child = r.place * shape.fanout + at
                    heapq.heappush(queue, (-block.last(r.level - 1, child), 1 - r.level, Link(at, digests, way)))
            yield pd.DataFrame(out, columns=emit.columns)

    return run


def _pass_on(r, subroot: str, way: Link | None) -> tuple:
    places, runs = [], []
    while way:
        places.append(way.at)
        runs.append("".join(way.run))
        way = way.up
    return r.tree, r.leaves, r.level, r.place, subroot, places, runs


_pass_on.columns = ["tree", "leaves", "level", "place", "subroot", "places", "runs"]


def fold(leaf: str, way: Link | None) -> str:
    """The root that a leaf and the digests beside its way lead to."""
    while way:
        leaf = sha256(*way.run[: way.at], leaf, *way.run[way.at + 1 :])
        way = way.up
    return leaf


def proof(way: Link | None) -> Iterator[str]:
    while way:
        yield from way.run[: way.at]
        yield from way.run[way.at + 1 :]
        way = way.up


def _prove(r, subroot: str, way: Link | None) -> tuple:
    return r.row, r.digest, subroot, sha256(*proof(way)), fold(r.tampered or r.digest, way)


_prove.columns = ["row", "digest", "subroot", "proof_sha256", "folded_root"]


def deliver(leaves: DataFrame, rounds: list[DataFrame], suffixes: DataFrame, shape: Shape, emit, schema: str) -> DataFrame:
    """What ``emit`` makes of every leaf and the way from it through its tree's root to the end of that root's suffix.

    ``suffixes`` are (tree, leaves, subroot, places, runs), one for every tree.
    """
    found, waiting = None, suffixes
    for k in reversed(range(max(1, len(rounds)))):
        base = k * shape.depth
        own = F.col("leaves") <= shape.fanout ** (base + shape.depth)  # trees whose root is a top of this round
        if k:
            own &= F.col("leaves") > shape.fanout**base
        levels = F.lit(base)
        for level in range(base, base + shape.depth):
            levels = F.when(F.col("leaves") > shape.fanout**level, level + 1).otherwise(levels)
        tops = waiting.where(own).withColumns({"level": levels.cast("int"), "place": F.lit(0).cast("long")})
        waiting = waiting.where(~own) if k else waiting
        parts = [tops.select("tree", "leaves", "level", "place", "subroot", "places", "runs")]
        if found is not None:
            parts.append(found.where(F.col("level") == base + shape.depth))
        messages = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        messages = messages.withColumn("last", F.lit(1 << 62))
        here = leaves if not k else rounds[k - 1].where((F.col("level") == base) & (F.col("leaves") > shape.fanout**base))
        here = here.withColumns({"level": F.lit(base), "last": F.col("place")})
        rows = messages.unionByName(here, allowMissingColumns=True)
        if rounds:
            rows = rows.unionByName(rounds[k], allowMissingColumns=True)
        order = [F.desc("last"), F.desc("level")]
        swept = _dealt(rows.withColumn("block", shape.block(F.col("level"), F.col("place"), base)), *order)
        if k:
            found = staged(swept.mapInPandas(_deliver(shape, base, _pass_on), _SUFFIX), f"manifest-down-{base}")
    return swept.mapInPandas(_deliver(shape, 0, emit), schema)


def manifest(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row; see the module's text."""
    spark = docs.sparkSession
    ship(spark)
    raw = docs.select(*FIELDS)
    fields = {c: F.col(c) for c in FIELDS}
    leaf = leaf_hash(fields)
    changed = leaf_hash(fields | {"text": lower_ascii("text")})
    tampered = F.when(fold_is("doc_id", 5, 0) & (lower_ascii("text") != F.col("text")), changed)
    hashed = raw.select("doc_id", F.col("source").alias("tree"), leaf.alias("digest"), tampered.alias("tampered"))
    hashed = staged(hashed, "manifest-hashed")  # ranges are sampled and dealt without reading texts again
    placed = staged(number_rows(hashed, ["doc_id", "digest"], ["tree"], "place", "leaves"), "manifest-leaves")
    rounds, subroots = grow(placed, shape)
    named = staged(subroots.withColumnRenamed("tree", "source"), "manifest-subroots")
    numbered = number_rows(named, ["source"], (), "place", "leaves")
    sources = staged(numbered.select(F.lit("").alias("tree"), "leaves", "place", F.col("root").alias("digest"), "source"), "manifest-sources")
    above, top = grow(sources, shape)
    root = (top.first() or [None, ""])[1]
    whole = sources.where("place = 0").select("tree", "leaves", F.lit(root).alias("subroot"))
    empty = {"places": F.lit([]).cast("array<int>"), "runs": F.lit([]).cast("array<string>")}
    schema = "source string, subroot string, places array<int>, runs array<string>"
    suffixes = staged(deliver(sources, above, whole.withColumns(empty), shape, _of_source, schema), "manifest-suffixes")
    sizes = placed.groupBy("tree").agg(F.first("leaves").alias("leaves"))
    joined = sizes.join(suffixes, sizes["tree"].eqNullSafe(suffixes["source"]))
    ways = joined.select("tree", "leaves", "subroot", "places", "runs")
    kind = dict(docs.dtypes)["doc_id"]
    leaves = placed.withColumn("row", F.col("doc_id").cast("string")).drop("doc_id")
    proofs = deliver(leaves, rounds, ways, shape, _prove, _PROOF)
    return proofs.select(
        F.col("row").cast(kind).alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def _of_source(r, subroot: str, way: Link | None) -> tuple:
    _, _, _, _, _, places, runs = _pass_on(r, subroot, way)
    return r.source, r.digest, places, runs


_of_source.columns = ["source", "subroot", "places", "runs"]

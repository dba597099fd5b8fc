"""Near duplicates by weighted minimum hashes of darts.

A text is a set of five-word shingles weighted by how often each occurs: a shingle
seen c times owns c unit cells. Every cell throws darts by its own hash at
exponentially spaced ranks; each dart falls into one of ``bands * rows`` coordinates,
and of a coordinate the earliest dart is kept. Only darts up to a rank that should
fill all coordinates are thrown, and more for texts that still have an empty one, so
a signature costs about as much as the text has words. Two signatures agree in a
coordinate with the probability of the weighted Jaccard similarity.

Exact copies share their representative, the one of smallest id. Representatives with
equal bands fall into a bucket; each is compared with the bucket's first, exactly, by
its cells. Components of the pairs that pass are the classes. Where members of a bucket
are still in different classes, a small bucket gives all its pairs; the members of the
larger ones meet by their rarest cells (see ``_by_rare_cells``), which finds every pair
of them that is similar enough. Components of all that pass are the classes in the end.

Edge cases: a null text, a text without words or a null id is alone; a text of fewer
words than a shingle is one shingle; rows that share an id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, ship, staged
from millrace.llm.graph import components
from millrace.llm.text import blocks, hash_words, mix, shingles

SIZE, BANDS, ROWS, SIMILARITY, GROUP = 5, 20, 4, 0.8, 6
#: Counters of the sketch that orders cells by how many texts have them; texts of a cell that are one block.
_SLOTS, _BLOCK = 1 << 20, 1_024
_EPSILON = 1e-9
#: Links that a task reduces to a forest, about.
_EDGES = 1 << 16
_LOW48 = np.uint64((1 << 48) - 1)
_COPY, _DART = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC2B2AE3D27D4EB4F)


def cells_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the cells of all texts, grouped by text, and the text of each; at most 65,536 texts."""
    hashes, of = shingles(hash_words(texts), SIZE)
    keys = np.sort((of.astype(np.uint64) << np.uint64(48)) | (hashes & _LOW48))
    new = np.ones(len(keys), np.bool_)
    new[1:] = keys[1:] != keys[:-1]
    place = np.arange(len(keys))
    copy = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix((keys & _LOW48) + copy.astype(np.uint64) * _COPY), (keys >> np.uint64(48)).astype(np.int64)


def signatures(cells: np.ndarray, of: np.ndarray, n: int, k: int) -> np.ndarray:
    """The earliest dart in each of k coordinates for n texts, as (n, k); zeros for a text without cells."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    best = np.full(n * k, empty)
    weight = np.bincount(of, minlength=n)
    reach = k * (np.log(k) + 2) / np.maximum(weight, 1)
    rank = np.zeros(len(cells), np.float32)
    state, active, text = cells, np.arange(len(cells)), of
    reach_of = reach.astype(np.float32)
    pending_cells = [cells, of, rank]
    while len(active):
        # The next dart of every active cell: its rank grows by an exponential step.
        state = mix(state + _DART)
        step = -np.log(((state >> np.uint64(40)).astype(np.float32) + np.float32(1)) * np.float32(2.0**-24))
        rank = rank + step
        inside = rank < reach_of[text]
        hit = np.flatnonzero(inside)
        code = mix(state[hit])
        slot = text[hit] * k + (code >> np.uint64(32)).astype(np.int64) % k
        value = (rank[hit].view(np.uint32).astype(np.uint64) << np.uint64(32)) | (code & np.uint64(0xFFFFFFFF))
        np.minimum.at(best, slot, value)
        state, rank, text, active = state[hit], rank[hit], text[hit], active[hit]
        if not len(active):
            short = (best.reshape(n, k) == empty).any(axis=1) & (weight > 0)
            if short.any():  # throw again, twice as far, for texts with an empty coordinate
                again = np.flatnonzero(short[pending_cells[1]])
                pending_cells = [x[again] for x in pending_cells]
                state, text, rank = pending_cells
                active = again
                reach_of = reach_of * np.where(short, 2, 1).astype(np.float32)
    best[best == empty] = 0
    return best.reshape(n, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(-1, bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _COPY, parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * _DART + parts[:, :, r])
    return key.view(np.int64)


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            for part in blocks(texts):
                some = texts[part]
                cells, of = cells_of(some)
                keys = band_keys(signatures(cells, of, len(some), bands * rows), bands, rows)
                has = np.bincount(of, minlength=len(some)) > 0
                rest = batch.iloc[part]
                yield pd.DataFrame(
                    {
                        "doc_id": rest["doc_id"].array,
                        "digest": rest["digest"].array,
                        "bands": [keys[i] if h else None for i, h in enumerate(has)],
                    }
                )

    return run


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for part in blocks(texts):
            cells, of = cells_of(texts[part])
            low = (cells & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            cuts = np.searchsorted(of, np.arange(part.stop - part.start + 1))
            held = [np.unique(low[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pd.DataFrame({"node": batch["rep"].iloc[part].array, "cells": held})


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two sets of cells."""
    p, q = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = np.sort(np.concatenate([p, q]))
    shared = int((both[1:] == both[:-1]).sum())
    return shared / max(len(p) + len(q) - shared, 1)


def near_classes(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, n_copies): the smallest id of the class and the exact copies of the row's text;
    a row for each document."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    # Ids pass through pandas as text, since a null among integers would turn them into doubles there.
    keyed = docs.select(F.col("doc_id").cast("string"), "text", F.when(F.col("doc_id").isNotNull(), F.md5("text")).alias("digest"))
    signed = staged(keyed.mapInPandas(_sign(bands, rows), "doc_id string, digest string, bands array<long>"), "signatures")
    signed = signed.withColumn("doc_id", F.col("doc_id").cast(kind))
    reps = staged(
        signed.where("digest IS NOT NULL AND bands IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"), F.any_value("bands").alias("bands")),
        "representatives",
    )
    entries = reps.select(F.col("rep").alias("node"), F.explode("bands").alias("bucket"))
    full = entries.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = staged(entries.join(full.select("bucket"), "bucket").distinct(), "members")
    involved = members.select(F.col("node").alias("rep")).distinct()
    texts = docs.select(F.col("doc_id").alias("rep"), "text").where("text IS NOT NULL").join(involved, "rep", "left_semi")
    cells = staged(texts.mapInPandas(_cells, f"node {kind}, cells binary").dropDuplicates(["node"]), "cells")
    nodes = involved.withColumnRenamed("rep", "node")
    tried = verified(_with_first(members), cells, least)
    links = tried.where("passes").select("a", "b")
    labels = _labels(nodes, links)
    few, large = _mixed(members, labels)
    rare = _rarest_cells(cells.join(large, "node", "left_semi"), least)
    for step in (lambda: few.union(_with_hub(labels, rare, least)), lambda: _by_rare_cells(labels, rare, least)):
        found = verified(step().distinct().join(tried, ["a", "b"], "left_anti"), cells, least)
        tried, more = tried.union(found), found.where("passes").select("a", "b")
        if not more.isEmpty():
            links = links.union(more)
            labels = _labels(nodes, links)
    of_rep = reps.select("digest", F.col("rep").alias("node"), "n_copies").join(labels, "node", "left")
    of_text = of_rep.select("digest", F.coalesce("label", "node").alias("class_id"), "n_copies")
    return signed.select("doc_id", "digest").join(of_text, "digest", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
    )


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    forest = links.coalesce(links.count() // _EDGES + 1).mapInPandas(_forest, links.schema)
    alone = nodes.join(components(forest), "node", "left")
    return staged(alone.select("node", F.coalesce("label", "node").alias("label")), "classes")


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of a task without those whose ends earlier ones connect: the components stay the same."""
    above: dict = {}

    def root(x):
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for batch in batches:
        joins = []
        for a, b in zip(batch["a"], batch["b"], strict=True):
            a, b = root(a), root(b)
            above[a] = b
            joins.append(a != b)
        yield batch[joins]


def _with_first(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the smallest: as many pairs as members."""
    first = members.groupBy("bucket").agg(F.min("node").alias("a"))
    return members.join(first, "bucket").where(F.col("node") > F.col("a")).select("a", F.col("node").alias("b")).distinct()


def _mixed(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the buckets with members of different classes: the pairs (a, b) apart of those with at most GROUP members,
    and the members (node) of the others."""
    held = members.join(labels, "node")
    ends = (F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = held.groupBy("bucket").agg((F.count(F.lit(1)) > GROUP).alias("large"), *ends).where("low < high")
    inside = staged(held.join(mixed.select("bucket", "large"), "bucket"), "mixed")
    few = inside.where("NOT large")
    left = few.select("bucket", F.col("node").alias("a"), F.col("label").alias("one"))
    right = few.select("bucket", F.col("node").alias("b"), F.col("label").alias("other"))
    pairs = left.join(right, "bucket").where("a < b AND one <> other").select("a", "b")
    return pairs, inside.where("large").select("node").distinct()


def _rarest_cells(texts: DataFrame, least: float) -> DataFrame:
    """(node, cell, place, n, short): of each of the texts (node, cells) the rarest cells, in the order of all cells."""
    texts = staged(texts, "apart")
    counts = np.zeros(_SLOTS, np.int64)
    seen = texts.select("cells").mapInPandas(_count_cells, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts[seen["slot"].to_numpy()] = seen["n"].to_numpy()
    rare = _rarest(texts.sparkSession.sparkContext.broadcast(counts), least)
    kind = dict(texts.dtypes)["node"]
    return staged(texts.mapInPandas(rare, f"node {kind}, cell long, place int, n int, short boolean"), "rarest")


def _shared(labels: DataFrame, rare: DataFrame) -> DataFrame:
    """The rare cells that texts of different labels have, with the first text of each and its number of blocks."""
    rows = rare.join(labels, "node")
    parts = F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("parts")
    hub = F.min(F.struct("node", "label", "n")).alias("hub")
    mixed = rows.groupBy("cell").agg(parts, hub, F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return rows.join(mixed.select("cell", "parts", "hub"), "cell")


def _with_hub(labels: DataFrame, rare: DataFrame, least: float) -> DataFrame:
    """Each text of a rare cell with the cell's first, if lengths allow: what these join, later steps need not compare."""
    sizes = F.least("n", "hub.n") >= least * F.greatest("n", "hub.n") - _EPSILON
    apart = _shared(labels, rare).where((F.col("label") != F.col("hub.label")) & sizes)
    return apart.select(F.col("hub.node").alias("a"), F.col("node").alias("b"))


def _by_rare_cells(labels: DataFrame, rare: DataFrame, least: float) -> DataFrame:
    """Pairs of texts of different labels, among them all of similarity ``least`` or more.

    All cells are in one order, the rarest first. A pair that passes has ``least`` of the longer text's
    cells in common and 2 * least / (1 + least) of the shorter's, so its first common cell is among the first
    cells of both, but for as many as each can lack, and after it both still have enough. A cell of many texts
    is dealt by blocks of the longer ones.
    """
    inside = _shared(labels, rare)
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    long = inside.select("cell", part, *(F.col(c).alias(f"long_{c}") for c in ("node", "label", "place", "n")))
    short = inside.where("short").select("cell", each, "node", "label", "place", "n")
    ordered = F.struct("n", "node") < F.struct("long_n", "long_node")
    sizes = F.col("n") >= least * F.col("long_n") - _EPSILON
    rest = F.least(F.col("n") - F.col("place"), F.col("long_n") - F.col("long_place"))
    enough = rest >= least / (1 + least) * (F.col("n") + F.col("long_n")) - _EPSILON
    pairs = long.join(short, ["cell", "part"]).where((F.col("label") != F.col("long_label")) & ordered & sizes & enough)
    return pairs.select(F.least("node", "long_node").alias("a"), F.greatest("node", "long_node").alias("b")).distinct()


def _count_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many texts of the task a cell of each slot is."""
    counts = np.zeros(_SLOTS, np.int64)
    for batch in batches:
        for cells in batch["cells"]:
            np.add.at(counts, np.frombuffer(cells, np.uint32) % _SLOTS, 1)
    at = np.flatnonzero(counts)
    yield pd.DataFrame({"slot": at.astype(np.int32), "n": counts[at]})


def _rarest(counts, least: float):
    """A row for each of a text's first cells in the order of their counts, and whether it is one of the fewer
    that a text no longer than the other needs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.iloc[at : at + 256]
                held = [np.frombuffer(c, np.uint32) for c in some["cells"]]
                size = np.array([len(c) for c in held], np.int32)
                first, fewer = (size - np.ceil(x * size - _EPSILON).astype(np.int32) + 1 for x in (least, 2 * least / (1 + least)))
                ordered = [c[np.lexsort((c, counts.value[c % _SLOTS]))][:k] for c, k in zip(held, first, strict=True)]
                taken = np.array([len(c) for c in ordered])
                of = np.repeat(np.arange(len(some)), taken)
                place = (np.arange(len(of)) - np.repeat(np.cumsum(taken) - taken, taken)).astype(np.int32)
                cell = np.concatenate(ordered).astype(np.int64)
                node = some["node"].array.take(of)
                yield pd.DataFrame({"node": node, "cell": cell, "place": place, "n": size[of], "short": place < fewer[of]})

    return run


def verified(pairs: DataFrame, cells: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) and whether their similarity is ``least`` or more."""

    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y) >= least for x, y in zip(a, b, strict=True)], dtype=bool)

    left = cells.select(F.col("node").alias("a"), F.col("cells").alias("cells_a"))
    right = cells.select(F.col("node").alias("b"), F.col("cells").alias("cells_b"))
    both = pairs.join(left, "a").join(right, "b")
    return staged(both.select("a", "b", passes("cells_a", "cells_b").alias("passes")), "links")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The documents without all of a class but the one of smallest id; rows with a null id stay."""
    classes = near_classes(docs, **settings).where("doc_id IS NOT NULL")
    again, gone = fresh(*docs.columns), classes.where("class_id < doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    if classes.where("class_id = doc_id").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept.select(docs.columns)
    # Rows that share an id: one of them stays, and each row without an id.
    kept = kept.withColumn(again, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return kept.dropDuplicates(["doc_id", again]).select(docs.columns)

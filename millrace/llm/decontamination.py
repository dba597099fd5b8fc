"""Benchmark decontamination by latent semantic retrieval and subsequence checks.

The words of the benchmark items are numbered, each by itself; every document becomes the
sequence of these numbers, other words as gaps. Passages of ``WIDTH`` words are TF-IDF
vectors over ``SLOTS`` hashed terms. A randomised singular value decomposition finds their
main directions in one distributed pass: every task adds up A'(A R) for its passages A
and a fixed random R, sums meet in a tree, and the driver decomposes the result, whose
size depends on parameters only. In that space overlapping windows of every document
are compared with the items; a window and ``REACH`` times an item's length on both sides of
it are its surroundings, so that an item may stand stretched to six times its length. A
candidate is a window of sufficient cosine whose surroundings can pass the last test: of the
rarest half of the item's words no more are missing than may be missing of all words, or
the answer stands there word for word. That much is necessary, so no leak is lost by it. A
candidate is a leak if the longest common subsequence of item and surroundings covers
``least`` of the item's words, or ``weak`` of them along with the answer. The answer is the
column ``answer`` if there is one, else the item's last ``ANSWER`` words.

Items are taken ``CHUNK`` at a time, so what tasks hold is bounded however many
there are. Edge cases: null or empty texts and items without words match nothing;
rows that share an id are judged each on its own; an item id that repeats is one item
per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, ship, staged
from millrace.llm.text import blocks, hash_words

SLOTS, RANK, EXTRA, CHUNK, ANSWER = 8192, 48, 8, 4096, 5
WIDTH, REACH = 64, 3
_HITS = "item int, cosine double, lcs double, answer boolean, start int"


class Items:
    """A chunk of items as word numbers; ``other`` stands for every other word. Broadcast: at most CHUNK items."""

    def __init__(self, rows: list) -> None:
        words = hash_words([r["text"] for r in rows])
        answers = hash_words([r["answer"] for r in rows])
        self.vocabulary = np.unique(np.concatenate([words.hashes, answers.hashes]))
        self.other = len(self.vocabulary)
        self.ids = [r["item_id"] for r in rows]
        self.words = [self.numbers(words.hashes[a:b]) for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
        given = [self.numbers(answers.hashes[a:b]) for a, b in zip(answers.offsets[:-1], answers.offsets[1:], strict=True)]
        self.answers = [g if len(g) else w[-ANSWER:] for g, w in zip(given, self.words, strict=True)]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.vocabulary, hashes).astype(np.uint32)


def _sequences(vocabulary: np.ndarray):
    """Each text's words as numbers, the last one for words that no item has; texts without any are left out."""
    other = len(vocabulary)
    maybe = np.zeros(1 << 20, np.bool_)
    maybe[(vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            for part in blocks(texts):
                words = hash_words(texts[part])
                near = np.flatnonzero(maybe[(words.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
                at = np.searchsorted(vocabulary, words.hashes[near]).clip(max=other - 1)
                same = vocabulary[at] == words.hashes[near]
                coded = np.full(len(words.hashes), other, np.uint32)
                coded[near[same]] = at[same]
                cuts = zip(words.offsets[:-1], words.offsets[1:], strict=True)
                held = [coded[a:b].tobytes() if (coded[a:b] != other).any() else None for a, b in cuts]
                rows = batch.iloc[part].drop(columns="text").assign(words=held)
                yield rows[rows["words"].notna()]

    return run


def joined(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """All sequences end to end, and where each begins (with the end)."""
    parts = [np.frombuffer(w, np.uint32) for w in column]
    return np.concatenate([*parts, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def pieces(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of consecutive passages of ``width`` words within each text, and the text of each."""
    n = -(-np.diff(offsets) // width)
    of = np.repeat(np.arange(len(n)), n)
    return offsets[of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * width, of


def passage_terms(coded: np.ndarray, starts: np.ndarray, other: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, slot, times) of the items' words in the passages that begin at ``starts``."""
    known = np.flatnonzero(coded != other)
    passage = np.searchsorted(starts, known, side="right") - 1
    keys, times = np.unique(passage * SLOTS + (coded[known] % SLOTS).astype(np.int64), return_counts=True)
    return keys // SLOTS, keys % SLOTS, times


def _count(other: int):
    """In how many passages of the task's documents each slot is; slot -1: how many passages there are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for at in range(0, len(batch), 512):
                coded, offsets = joined(batch["words"].iloc[at : at + 512])
                starts, _ = pieces(offsets, WIDTH)
                seen += np.bincount(passage_terms(coded, starts, other)[1], minlength=SLOTS)
                total += len(starts)
        some = np.flatnonzero(seen)
        yield pd.DataFrame({"slot": np.append(some, -1), "n": np.append(seen[some], total)})

    return run


def weights_of(times: np.ndarray, slot: np.ndarray, passage: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """TF-IDF of each (passage, slot), of length 1 for each passage."""
    w = (1 + np.log(times)) * idf[slot]
    return (w / np.sqrt(np.maximum(np.bincount(passage, weights=w * w, minlength=n), 1e-12))[passage]).astype(np.float32)


def sketch(passage: np.ndarray, slot: np.ndarray, w: np.ndarray, n: int, random: np.ndarray) -> np.ndarray:
    """A'(A R) for the sparse matrix A of n passages."""
    total = np.zeros_like(random)
    if len(w):
        first = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
        image = np.zeros((n, random.shape[1]), np.float32)
        image[passage[first]] = np.add.reduceat(w[:, None] * random[slot], first, axis=0)
        order = np.argsort(slot, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(slot[order]) != 0))
        total[slot[order][begin]] = np.add.reduceat(w[order, None] * image[passage[order]], begin, axis=0)
    return total


def inverse_frequencies(seen: np.ndarray, passages: int) -> np.ndarray:
    """The squared logarithm of a slot's inverse share of passages."""
    return np.maximum(np.log((passages + 1) / (seen + 1)) ** 2, 1e-3)


def _sketch(idf: np.ndarray, other: int, random: np.ndarray, cells: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(random.shape, np.float64)
        for batch in batches:
            for at in range(0, len(batch), 128):
                coded, offsets = joined(batch["words"].iloc[at : at + 128])
                starts, _ = pieces(offsets, WIDTH)
                passage, slot, times = passage_terms(coded, starts, other)
                total += sketch(passage, slot, weights_of(times, slot, passage, idf, len(starts)), len(starts), random)
        yield pd.DataFrame({"cell": [TaskContext.get().partitionId() % cells], "sums": [total.astype(np.float32).tobytes()]})

    return run


def _add(shape: tuple[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, any_row = np.zeros(shape, np.float64), False
        for batch in batches:
            for held in batch["sums"]:
                total += np.frombuffer(held, np.float32).reshape(shape)
                any_row = True
        if any_row:
            yield pd.DataFrame({"cell": [0], "sums": [total.astype(np.float32).tobytes()]})

    return run


def directions(sums: np.ndarray, random: np.ndarray, rank: int) -> np.ndarray:
    """The main right singular vectors of A, from A'(A R) alone."""
    inner = random.T.astype(np.float64) @ sums
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    keep = values > 1e-6 * max(values.max(initial=0), 1e-12)
    root = sums @ (vectors[:, keep] / np.sqrt(values[keep]))
    return np.linalg.svd(root, full_matrices=False)[0][:, :rank].astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def common_length(item: np.ndarray, text: np.ndarray) -> int:
    """The length of the longest common subsequence, by bit rows of the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in text.tolist():
        if m := places.get(w):
            both = row & m
            row = ((row + both) | (row - both)) & full
    return len(item) - row.bit_count()


class Asked(NamedTuple):
    """An item to look for: of its ``rare`` words, surroundings hold ``need`` or more if they pass the last test."""

    words: np.ndarray
    known: np.ndarray
    rare: np.ndarray
    need: int
    answer: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, answer: np.ndarray, idf: np.ndarray, least: float) -> Asked:
        missing = len(words) - math.ceil(least * len(words))
        size = min(len(words), max((len(words) + 1) // 2, missing + 1))
        rare = words[np.argsort(-idf[words % SLOTS], kind="stable")][:size]
        return cls(words, np.unique(words), np.unique(rare), size - missing, answer)


class Places:
    """Where each word stands in a batch's documents, end to end."""

    def __init__(self, coded: np.ndarray, other: int) -> None:
        self.coded, self.order = coded, np.argsort(coded, kind="stable")
        self.begin = np.searchsorted(coded[self.order], np.arange(other + 1))

    def of(self, words: np.ndarray) -> np.ndarray:
        """Ascending places of any of the words."""
        found = [self.order[self.begin[w] : self.begin[w + 1]] for w in words.tolist()]
        return np.sort(np.concatenate([*found, np.zeros(0, np.int64)]))

    def of_sequence(self, words: np.ndarray) -> np.ndarray:
        """Where the words stand one after the other."""
        if not len(words):
            return np.zeros(0, np.int64)
        counts = self.begin[words + 1] - self.begin[words]
        rarest = int(counts.argmin())
        at = self.of(words[rarest : rarest + 1]) - rarest
        at = at[(at >= 0) & (at + len(words) <= len(self.coded))]
        return at[(self.coded[at[:, None] + np.arange(len(words))] == words).all(axis=1)]


def between(places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many of the places lie in each range."""
    return np.searchsorted(places, high) - np.searchsorted(places, low)


def _retrieve(items: Items, idf: np.ndarray, space: np.ndarray, cosine: float, least: float, weak: float):
    table, other = (space * idf[:, None]).astype(np.float32), items.other
    usable = [i for i, w in enumerate(items.words) if len(w)]
    asked = [Asked.of(items.words[i].astype(np.int64), items.answers[i].astype(np.int64), idf, least) for i in usable]
    query = unit(np.stack([table[a.words % SLOTS].sum(axis=0) for a in asked] or [np.zeros(space.shape[1])]))
    half = WIDTH // 2

    def windows_of(coded: np.ndarray, starts: np.ndarray, of: np.ndarray) -> np.ndarray:
        known = np.flatnonzero(coded != other)
        begin = np.searchsorted(known, starts)
        sums = np.zeros((len(starts) + 1, space.shape[1]), np.float32)
        full = np.flatnonzero(np.diff(np.append(begin, len(known))))
        if len(full):
            sums[full] = np.add.reduceat(table[coded[known] % SLOTS], begin[full], axis=0)
        same = np.append(of[1:] == of[:-1], False)
        return unit(sums[:-1] + sums[1:] * same[:, None])

    def hits(coded: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        """(text, item, lcs, cosine, answer, window) of the leaks, at their best windows."""
        starts, of = pieces(offsets, half)
        if not len(starts) or not usable:
            return
        windows, places = windows_of(coded, starts, of), Places(coded, other)
        begin, end = offsets[of], offsets[of + 1]
        for q, a in enumerate(asked):
            rare, said = places.of(a.rare), places.of_sequence(a.answer)
            if len(rare) < a.need and not len(said):
                continue
            reach = REACH * len(a.words)
            low, high = np.maximum(starts - reach, begin), np.minimum(starts + WIDTH + reach, end)
            last = np.maximum(high - len(a.answer) + 1, low)
            row = np.flatnonzero((between(rare, low, high) >= a.need) | (between(said, low, last) > 0))
            if not len(row):
                continue
            near = windows[row] @ query[q]
            row, near = row[near >= cosine], near[near >= cosine]
            every, best, done = places.of(a.known), {}, {}
            for r, c in zip(row.tolist(), near.tolist(), strict=True):
                one, two = np.searchsorted(every, (low[r], high[r])).tolist()
                if (one, two) not in done:
                    done[one, two] = common_length(a.words, coded[every[one:two]]) / len(a.words)
                found, here = done[one, two], bool(between(said, low[r], last[r]) > 0)
                if found >= least or (found >= weak and here):
                    hit = (found, c, found >= weak and here, int(starts[r] - begin[r]))
                    best[of[r]] = max(best.get(of[r], hit), hit)
            yield from ((int(text), q, *hit) for text, hit in best.items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.iloc[at : at + 128]
                found = sorted(hits(*joined(part["words"])))
                rows = part.iloc[[h[0] for h in found]].drop(columns="words").reset_index(drop=True)
                rows["item"] = [usable[h[1]] for h in found]
                for name, i in (("cosine", 3), ("lcs", 2), ("answer", 4), ("start", 5)):
                    rows[name] = [h[i] for h in found]
                yield rows

    return run


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, cosine: float = 0.2, least: float = 0.75, weak: float = 0.5
) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, start) for each item found in a document, at its best place (in words)."""
    spark = docs.sparkSession
    ship(spark)
    kind, id_kind = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = staged(benchmark.where("text IS NOT NULL").select("item_id", "text", answer.alias("answer")), "items")
    # Ids pass through pandas as text, since a null among integers would turn them into doubles there.
    texts = docs.select(F.col("doc_id").cast("string"), "text")
    found = None
    for rows in _chunks(items):
        chunk = Items(rows)
        if not len(chunk.vocabulary):
            continue
        sequences = staged(texts.mapInPandas(_sequences(chunk.vocabulary), "doc_id string, words binary"), "words")
        counted = sequences.mapInPandas(_count(chunk.other), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
        counts = {r["slot"]: r["n"] for r in counted.collect()}
        seen = np.array([counts.get(s, 0) for s in range(SLOTS)], np.float64)
        idf = inverse_frequencies(seen, counts.get(-1, 0))
        random = np.random.default_rng(17).normal(size=(SLOTS, RANK + EXTRA)).astype(np.float32)
        tasks = max(200, 3 * spark.sparkContext.defaultParallelism)  # each sends one matrix, however much it read
        cells = math.isqrt(tasks)
        parts = sequences.coalesce(tasks).mapInPandas(_sketch(idf, chunk.other, random, cells), "cell int, sums binary")
        halfway = parts.repartition(cells, "cell").mapInPandas(_add(random.shape), "cell int, sums binary")
        sums = np.zeros(random.shape)
        for r in halfway.coalesce(1).mapInPandas(_add(random.shape), "cell int, sums binary").collect():
            sums += np.frombuffer(r["sums"], np.float32).reshape(random.shape)
        own = [np.unique(w % SLOTS, return_counts=True) for w in chunk.words]
        slot = np.concatenate([s for s, _ in own]).astype(np.int64)
        passage = np.repeat(np.arange(len(own)), [len(s) for s, _ in own])
        times = np.concatenate([t for _, t in own])
        sums += sketch(passage, slot, weights_of(times, slot, passage, idf, len(own)), len(own), random)
        space = directions(sums, random, RANK)
        hits = sequences.mapInPandas(_retrieve(chunk, idf, space, cosine, least, weak), f"doc_id string, {_HITS}")
        names = spark.createDataFrame(list(enumerate(chunk.ids)), f"item int, item_id {id_kind}")
        hits = hits.join(F.broadcast(names), "item").select(F.col("doc_id").cast(kind), "item_id", "cosine", "lcs", "answer", "start")
        found = hits if found is None else found.union(hits)
    if found is None:
        return spark.createDataFrame([], f"doc_id {kind}, item_id {id_kind}, cosine double, lcs double, answer boolean, start int")
    return found


def _chunks(items: DataFrame) -> Iterator[list]:
    """The items, at most CHUNK at a time, by the remainder of a hash."""
    n = -(-items.count() // (CHUNK // 2)) or 1
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        rows.sort(key=lambda r: (str(r["item_id"]), r["text"]))
        yield from (rows[at : at + CHUNK] for at in range(0, len(rows), CHUNK))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents in which no item was found: rows are judged by their texts, whatever their ids."""
    key = fresh(*docs.columns)
    keyed = docs.withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    leaking = find_leaks(texts, benchmark, **settings).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(leaking, key, "left_anti").select(docs.columns)

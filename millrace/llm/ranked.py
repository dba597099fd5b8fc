"""Ranked lexical search by presence masks, exact.

The terms of the items are numbered, and one pass over the documents keeps, of each, its
length and the items' terms in it with their number. Document counts of terms, and so
their weights, come from all documents.

Every task then takes its documents in blocks, shorter ones first. In a block each term
has a bitmap of the documents that hold it, and its largest contribution there. For an
item:

1. terms so light that all of them together stay below the item's tenth score so far
   can't bring up a document alone; the bitmaps of the others, ORed, are the candidates;
2. the candidates are grouped by mask, the set of the item's terms that they hold, read
   from the bitmaps across; a mask's maximum is the sum of its terms' largest contributions;
3. masks are evaluated by descending maximum, until the next maximum is below the score
   of rank ``k``. Equal maxima are evaluated, since a smaller id may win the tie.

A task returns ``k`` documents an item; a window merges them. No task holds more than a
block, and items are taken about ``PAIRS`` (item, term) pairs at a time, so that what is
broadcast is bounded however many there are.

Edge cases: null and empty texts, and those without a term, are no documents and are
not counted; texts are taken whole; an item without a term, or whose terms no document
holds, has no rows; rows that share an item_id are one item with the terms of all; a null
item_id is an item; each document row counts for itself, also if ids repeat or are
null, and a null doc_id comes after others of its score. Ids of documents must be integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import ship, staged

#: What a term is, as a pattern and as bytes of UTF-8.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256)
)
#: (item, term) pairs broadcast at a time; documents and postings of a block.
PAIRS, BLOCK, POSTINGS = 1 << 18, 8192, 1 << 21
_LAST = (1 << 63) - 1
_POSTED = "key long, none boolean, n long, terms array<int>, times array<int>"


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """A chunk of items: the number of each term, and for each item its terms' numbers, ascending."""

    numbers: dict[bytes, int]
    terms: list[np.ndarray]


def _post(held):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = held.value.numbers.get
        for batch in batches:
            rows = []
            for key, none, text in zip(batch["key"], batch["none"], batch["text"], strict=True):
                words = terms_of(text)
                if words:
                    counts = Counter(map(number, words))
                    counts.pop(None, None)
                    terms = sorted(counts)
                    rows.append((key, none, len(words), terms, [counts[t] for t in terms]))
            yield pd.DataFrame(rows, columns=["key", "none", "n", "terms", "times"])

    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """The m of documents of ``n`` terms, among ``documents`` with ``words`` terms."""
    if int(n.max(initial=0)) * documents * 90 < 1 << 63:
        return 100 - 90 + (90 * n * documents) // words
    return np.array([100 - 90 + (90 * int(x) * documents) // words for x in n], np.int64)


class Block:
    """Documents of one block: what every posting contributes, and bitmaps of the terms as words of 64 bits."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, score: np.ndarray, size: int):
        order = np.lexsort((doc, term))
        term, doc, self.score = term[order], doc[order], score[order]
        self.size, self.words = size, -(-size // 64)
        self.keys = term * size + doc
        first = np.flatnonzero(np.append(True, np.diff(term) != 0)) if len(term) else np.zeros(0, np.int64)
        self.terms = term[first]
        self.most = np.maximum.reduceat(self.score, first) if len(first) else first
        cell = term * self.words + doc // 64
        at = np.flatnonzero(np.append(True, np.diff(cell) != 0)) if len(cell) else first
        bit = np.left_shift(np.uint64(1), (doc % 64).astype(np.uint64))
        self.bits = np.bitwise_or.reduceat(bit, at) if len(at) else bit
        self.word = doc[at] // 64
        self.begin = np.append(np.searchsorted(at, first), len(at))

    def bitmaps(self, places: np.ndarray) -> np.ndarray:
        """A row of bits a term, 64 documents a word."""
        maps = np.zeros((len(places), self.words), np.uint64)
        for row, p in enumerate(places):
            a, b = self.begin[p], self.begin[p + 1]
            maps[row, self.word[a:b]] = self.bits[a:b]
        return maps

    def scores(self, terms: np.ndarray, docs: np.ndarray, holds: np.ndarray) -> np.ndarray:
        """The documents' sums over the terms they hold; ``holds`` is documents times terms."""
        d, t = np.nonzero(holds)
        at = np.searchsorted(self.keys, terms[t] * self.size + docs[d])
        return np.bincount(d, weights=self.score[at], minlength=len(docs)).astype(np.int64)


def masks_of(maps: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks of the documents, as rows of booleans over the bitmaps' terms, and the mask of each document."""
    bits = np.unpackbits(maps.view(np.uint8), axis=1, bitorder="little")[:, docs]
    packed = np.packbits(bits, axis=0, bitorder="little")
    padded = np.zeros((len(docs), -(-len(packed) // 8) * 8), np.uint8)
    padded[:, : len(packed)] = packed.T
    codes = padded.view(np.uint64)
    if codes.shape[1] == 1:
        distinct, of = np.unique(codes[:, 0], return_inverse=True)
        distinct = distinct[:, None]
    else:
        distinct, of = np.unique(codes, axis=0, return_inverse=True)
    holds = np.unpackbits(np.ascontiguousarray(distinct).view(np.uint8), axis=1, bitorder="little")[:, : len(maps)]
    return holds.astype(np.bool_), of.ravel()


def search_block(block: Block, terms: np.ndarray, keys: np.ndarray, best: tuple, k: int) -> tuple:
    """The item's ``k`` best (score, key) after this block; ``keys`` orders documents of equal score."""
    places = np.searchsorted(block.terms, terms).clip(max=max(len(block.terms) - 1, 0))
    places = places[block.terms[places] == terms] if len(block.terms) else places[:0]
    places = places[np.argsort(block.most[places], kind="stable")]
    least = best[0][-1] if len(best[0]) == k else 1
    heavy = int(np.searchsorted(np.cumsum(block.most[places]), least))
    if heavy == len(places):
        return best
    maps = block.bitmaps(places)
    union = np.bitwise_or.reduce(maps[heavy:], axis=0)
    docs = np.flatnonzero(np.unpackbits(union.view(np.uint8), bitorder="little")[: block.size])
    holds, of = masks_of(maps, docs)
    most = holds @ block.most[places].astype(np.float64)
    by_most = np.argsort(-most, kind="stable")
    rank = np.empty(len(most), np.int64)
    rank[by_most] = np.arange(len(most))
    members = np.argsort(rank[of], kind="stable")  # documents, those of the highest mask first
    ends = np.cumsum(np.bincount(rank[of], minlength=len(most)))
    mask, step = 0, 4 * k
    while mask < len(most) and most[by_most[mask]] >= least:
        start = ends[mask - 1] if mask else 0
        stop = min(int(np.searchsorted(ends, start + step)), len(ends) - 1)
        while stop > mask and most[by_most[stop]] < least:
            stop -= 1
        chosen = members[start : ends[stop]]
        score = block.scores(block.terms[places], docs[chosen], holds[of[chosen]])
        best = keep_best((np.concatenate([best[0], score]), np.concatenate([best[1], keys[docs[chosen]]])), k)
        least = best[0][-1] if len(best[0]) == k else 1
        mask, step = stop + 1, 2 * step
    return best


def keep_best(found: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    score, key = found
    if len(score) > k:
        high = score >= -np.partition(-score, k - 1)[k - 1]
        score, key = score[high], key[high]
    order = np.lexsort((key["key"], key["none"], -score))[:k]
    return score[order], key[order]


_KEY = np.dtype([("none", "?"), ("key", "<i8")])


def _rank(held, weights: np.ndarray, documents: int, words: int, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = held.value.terms
        best = [(np.zeros(0, np.int64), np.zeros(0, _KEY)) for _ in items]
        for part in _parts(batches):
            counts = part["terms"].map(len).to_numpy(np.int64)
            term = np.concatenate([*part["terms"], np.zeros(0)]).astype(np.int64)
            times = np.concatenate([*part["times"], np.zeros(0)]).astype(np.int64)
            doc = np.repeat(np.arange(len(part)), counts)
            m = lengths(part["n"].to_numpy(np.int64), documents, words)[doc]
            score = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m))
            some = score > 0
            block = Block(term[some], doc[some], score[some], len(part))
            keys = np.empty(len(part), _KEY)
            keys["none"], keys["key"] = part["none"], part["key"]
            for i, terms in enumerate(items):
                best[i] = search_block(block, terms, keys, best[i], k)
        rows = {"item": np.repeat(np.arange(len(items)), [len(b[0]) for b in best]), "score": np.concatenate([b[0] for b in best])}
        keys = np.concatenate([b[1] for b in best])
        yield pd.DataFrame({"item": rows["item"], "key": keys["key"], "none": keys["none"], "score": rows["score"]})

    return run


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in blocks of at most BLOCK documents and about POSTINGS postings."""
    held, documents, postings = [], 0, 0
    for batch in batches:
        size = batch["terms"].map(len).to_numpy(np.int64)
        start = 0
        while start < len(batch):
            upto = np.searchsorted(np.cumsum(size[start:]), max(POSTINGS - postings, 1)) + 1
            stop = min(len(batch), start + int(upto), start + BLOCK - documents)
            held.append(batch.iloc[start:stop])
            documents, postings, start = documents + stop - start, postings + int(size[start:stop].sum()), stop
            if documents >= BLOCK or postings >= POSTINGS:
                yield pd.concat(held, ignore_index=True)
                held, documents, postings = [], 0, 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _chunks(pairs: DataFrame, most: int) -> Iterator[tuple[DataFrame, Items]]:
    """Numbered items, (item, item_id), and their terms, about ``most`` pairs at a time."""
    n = -(-pairs.count() // most)
    spark = pairs.sparkSession
    for c in range(n):
        rows = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == c).collect()
        numbers: dict[bytes, int] = {}
        terms: dict = {}
        for r in rows:
            terms.setdefault(r.item_id, []).append(numbers.setdefault(r.term.encode(), len(numbers)))
        if rows:
            ids = spark.createDataFrame([(i, item_id) for i, item_id in enumerate(terms)], f"item long, item_id {dict(pairs.dtypes)['item_id']}")
            yield ids, Items(numbers, [np.unique(t).astype(np.int64) for t in terms.values()])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, pairs: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 of each item."""
    spark = docs.sparkSession
    ship(spark)
    text = F.translate("text", _UPPER, _UPPER.lower())
    terms = items.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term"))
    asked = staged(terms.distinct(), "ranked-terms")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("key")
    texts = docs.where("text IS NOT NULL").select(key, F.col("doc_id").isNull().alias("none"), "text")
    kind, item_kind = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    found = spark.createDataFrame([], f"item_id {item_kind}, key long, none boolean, score long")
    for ids, chunk in _chunks(asked, pairs):
        held = spark.sparkContext.broadcast(chunk)
        posted = staged(texts.mapInPandas(_post(held), _POSTED), "ranked-postings")
        documents, words = posted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.full(len(chunk.numbers), weight(documents, 0), np.int64)
        for term, df in posted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[term] = weight(documents, df)
        ranked = posted.sortWithinPartitions("n").mapInPandas(
            _rank(held, weights, documents, words, k), "item long, key long, none boolean, score long"
        )
        found = found.union(staged(ranked.join(ids, "item").select("item_id", "key", "none", "score"), "ranked"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "none", "key")
    doc_id = F.when(~F.col("none"), F.col("key")).cast(kind).alias("doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", doc_id, "score")

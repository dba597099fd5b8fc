"""Removal of repeated byte strings by common-prefix interval trees over a sampled suffix array.

A string of ``LENGTH`` bytes that occurs twice lies in a maximal repeat, a string whose
occurrences cannot all be extended by one byte to the left or to the right; a byte goes
if a maximal repeat of LENGTH bytes or more covers it that starts earlier elsewhere.

Repeats are found where they share an anchor: of every window of LENGTH bytes the
gram of smallest hash, so equal windows have it at the same place. An anchor stands for
a run of windows, whose bytes are its span.

1. Every task combines its anchors and deals them by gram. Anchors of equal spans are
   one repeat with all its occurrences: all but the first are settled. A gram with one
   span needs no more; the first occurrence of each of several spans goes on.
2. Their bytes are fetched and grouped by gram: the suffixes that start at the anchor
   are sorted, their common prefixes scanned with a stack into intervals, and each
   interval's left sides in the same way; an interval whose left sides or right sides
   differ is a maximal repeat. (``repeat_groups`` follows repeats beyond the spans, and
   returns whole ones with all their occurrences.)
3. Grams with more than ``LIMIT`` spans would be too much for one group. Two spans that share
   a window agree in at least half of its bytes beside the gram on the left or on the right,
   so their spans are dealt by either half; groups that are still too large by half of
   the bytes left over, and so on. A step at most doubles the rows of groups that were too
   large, and each group ends in the interval tree, or holds copies of a single window.

Edge cases: a null text has no bytes; texts shorter than LENGTH lose none; rows of one
id and text are one document and get the same result each; texts that share an id are
ordered by hash; a null id comes before all others. Ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship, staged
from millrace.llm.text import mix, powers

LENGTH, GRAM = 100, 32
#: Spans of a gram that one group takes; that a task sends of a gram; and anchors held before they are combined.
LIMIT, SENT, HELD = 2_000, 64, 1 << 20
_FLUSH = 8 << 20
_PIECE, _BLOCK = 1 << 19, 1 << 18
_LOWEST = -(1 << 63)
_SETTLED, _TREE, _HOT = 0, 1, 2
_ENTRY = np.dtype(
    [("gram", "<u8"), ("span", "<u8"), ("doc_id", "<i8"), ("h", "<i8"), ("first", "<i4"), ("run", "u1"), ("lead", "u1"), ("many", "?")]
)
_FATE = "doc_id long, h long, gram long, first int, last int, place int, fate int"
_BASE = 0xA24BAED4963EE407
_SPAN = ("doc_id", "h", "start", "stop")
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Anchors:
    """Anchors of a block of pieces: piece number, place in it, first and last window they stand for, and two hashes."""

    piece: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray
    span: np.ndarray


def anchors(pieces: Sequence[bytes], length: int = LENGTH, gram: int = GRAM) -> Anchors:
    """For every window of ``length`` bytes within a piece, the leftmost of its grams of smallest hash.

    Equal windows have their anchor at the same place. All pieces together have at most 2**20 bytes.
    """
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(joined)
    size = np.array([len(p) for p in pieces], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=sums[1:])
    back = powers(_INVERSE, n + 1)
    if n < length:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, none.view(np.uint64), none.view(np.uint64))
    hashes = mix((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
    low = (hashes >> np.uint64(_PLACES) << np.uint64(_PLACES)) | np.arange(len(hashes), dtype=np.uint64)
    width, done = length - gram + 1, 1
    while 2 * done <= width:
        low = np.minimum(low[: len(low) - done], low[done:])
        done *= 2
    if done < width:
        low = np.minimum(low[: len(low) - (width - done)], low[width - done :])
    at = (low & np.uint64((1 << _PLACES) - 1)).astype(np.int64)
    windows = np.maximum(size - length + 1, 0)
    of = np.repeat(np.arange(len(size)), windows)
    start = begin[of] + np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = at[start]
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    end = np.append(new[1:], len(of)) - 1
    piece, place, first, last = of[new], place[new], start[new], start[end] if len(of) else new
    span = (sums[last + length] - sums[first]) * back[first]
    shape = ((place - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
    base = begin[piece]
    return Anchors(piece, place - base, first - base, last - base, hashes[place], mix(mix(span) + shape))


def pieces_of(texts: Sequence[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Blocks of (text number, offset, bytes) with less than 2**20 bytes; long texts are cut so that no window is lost."""
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, raw in enumerate(texts):
        for at in range(0, max(len(raw) - LENGTH + 1, 0), _PIECE):
            part = raw[at : at + _PIECE + LENGTH - 1]
            if size and size + len(part) > _BLOCK:
                yield held
                held, size = ([], [], []), 0
            for x, v in zip(held, (i, at, part), strict=True):
                x.append(v)
            size += len(part)
    if size:
        yield held


def _same_as_before(*columns: np.ndarray) -> np.ndarray:
    same = np.zeros(len(columns[0]), np.bool_)
    if len(same):
        same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return same


def _fates(entries: np.ndarray, fate) -> pd.DataFrame:
    first = entries["first"].astype(np.int32)
    return pd.DataFrame(
        {
            "doc_id": entries["doc_id"],
            "h": entries["h"],
            "gram": entries["gram"].view(np.int64),
            "first": first,
            "last": first + entries["run"],
            "place": first + entries["lead"],
            "fate": np.broadcast_to(np.int32(fate), len(entries)),
        }
    )


def _split(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first entry of each (gram, span), and the others: strictly later occurrences of the same bytes."""
    entries = entries[np.lexsort((entries["first"], entries["h"], entries["doc_id"], entries["span"], entries["gram"]))]
    later = _same_as_before(entries["gram"], entries["span"])
    again = later & _same_as_before(entries["doc_id"], entries["h"], entries["first"])
    return entries[~later], entries[later & ~again]


def _deal(buckets: int, most_sent: int):
    """Anchors of each task's texts, combined and dealt by gram; what is settled within the task goes along."""

    def send(entries: np.ndarray) -> Iterator[pd.DataFrame]:
        firsts, settled = _split(entries)
        _, at, n = np.unique(firsts["gram"], return_inverse=True, return_counts=True)
        hot = n[at] > most_sent
        firsts["many"] = hot
        kept = ~hot | ~_same_as_before(firsts["gram"])
        yield from blobs(firsts[kept], -1)
        yield from blobs(settled, _SETTLED)
        yield from blobs(firsts[hot], _HOT)

    def blobs(entries: np.ndarray, fate: int) -> Iterator[pd.DataFrame]:
        bucket = (mix(entries["gram"]) % np.uint64(buckets)).astype(np.int32)
        entries, bucket = entries[order := np.argsort(bucket, kind="stable")], bucket[order]
        cuts = np.flatnonzero(np.append(~_same_as_before(bucket), True))
        held = [entries[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pd.DataFrame({"bucket": bucket[cuts[:-1]], "fate": np.full(len(held), fate, np.int32), "entries": held})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            raw = [t.encode("utf-8", "replace") for t in batch["text"].fillna("")]
            ids, h = batch["doc_id"].to_numpy(np.int64), batch["h"].to_numpy(np.int64)
            for of, base, parts in pieces_of(raw):
                a = anchors(parts)
                text, base = np.array(of)[a.piece], np.array(base)[a.piece]
                entries = np.zeros(len(a.piece), _ENTRY)
                for name, value in (("gram", a.gram), ("span", a.span), ("doc_id", ids[text]), ("h", h[text]), ("first", a.first + base)):
                    entries[name] = value
                entries["run"], entries["lead"] = a.last - a.first, a.place - a.first
                held.append(entries)
                size += sum(map(len, parts))
                if size >= _FLUSH:
                    yield from send(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield from send(np.concatenate(held))

    return run


def _settle(limit: int, most_held: int):
    """The fate of the anchors of each bucket, rows of which come one after the other.

    What is held is combined as it grows: of a hot gram only a mark stays, the spans go on.
    """

    def settled(held: list[np.ndarray], ended: bool) -> Iterator[pd.DataFrame]:
        entries = np.concatenate(held) if held else np.zeros(0, _ENTRY)
        firsts, later = _split(entries)
        yield _fates(later[~later["many"]], _SETTLED)
        grams, of, n = np.unique(firsts["gram"], return_inverse=True, return_counts=True)
        hot = np.isin(grams, entries["gram"][entries["many"]]) | (n > limit)
        own = ~firsts["many"]  # the others were sent as they are
        yield _fates(firsts[own & hot[of]], _HOT)
        if ended:
            yield _fates(firsts[own & ~hot[of] & (n[of] > 1)], _TREE)
            return
        firsts["many"] |= hot[of]
        held[:] = [firsts[~hot[of] | ~_same_as_before(firsts["gram"])]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at, most = [], None, most_held
        for batch in batches:
            for bucket, fate, entries in zip(batch["bucket"], batch["fate"], batch["entries"], strict=True):
                if bucket != at:
                    yield from settled(held, True)
                    held, at, most = [], bucket, most_held
                entries = np.frombuffer(entries, _ENTRY)
                if fate < 0:
                    held.append(entries)
                else:
                    yield _fates(entries, fate)
                if sum(map(len, held)) > most:
                    yield from settled(held, False)
                    most = max(most_held, 2 * len(held[0]))
        yield from settled(held, True)

    return run


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a and b agree up to low, and not up to high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def intervals(suffixes: Sequence[bytes], least: int) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals (depth, from, to) of sorted strings with ``least`` bytes or more in common."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(suffixes) + 1):
        depth = common_prefix(suffixes[i - 1], suffixes[i]) if i < len(suffixes) else -1
        start = i - 1
        while stack and stack[-1][0] > depth:
            d, start = stack.pop()
            yield d, start, i
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, start))


def maximal_repeats(lefts: Sequence[bytes], rights: Sequence[bytes], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members): the repeats of ``length`` bytes or more around a common anchor, ``left`` bytes
    before it and ``right`` from it on. ``lefts`` are read backwards from the anchor.

    A right interval whose members all go on with the same left side is extended by it;
    where left sides differ, each part that still shares enough is a repeat of its own.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    for right, a, b in intervals([rights[i] for i in order], length - max(map(len, lefts), default=0)):
        members = sorted(order[a:b], key=lefts.__getitem__)
        for left, c, d in intervals([lefts[i] for i in members], max(length - right, 0)):
            yield left, right, members[c:d]


def _grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans to remove by the maximal repeats of each gram, rows of which come one after the other."""
    held, at, rows = [], None, []

    def found() -> None:
        widest: dict[int, tuple[int, int]] = {}
        held.sort(key=lambda r: (r.doc_id, r.h, r.first))
        lefts = [r.bytes[: r.place - r.first][::-1] for r in held]
        rights = [r.bytes[r.place - r.first :] for r in held]
        for left, right, members in maximal_repeats(lefts, rights):
            for i in sorted(members)[1:]:  # all spans of an anchor overlap in it, so the widest sides say all
                before, after = widest.get(i, (0, 0))
                widest[i] = max(before, left), max(after, right)
        rows.extend((held[i].doc_id, held[i].h, held[i].place - a, held[i].place + b) for i, (a, b) in widest.items())

    for batch in batches:
        for r in batch.itertuples(index=False):
            if r.gram != at:
                found()
                held, at = [], r.gram
            held.append(r)
        yield pd.DataFrame(rows, columns=_SPAN)
        rows.clear()
    found()
    yield pd.DataFrame(rows, columns=_SPAN)


def _fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the spans that go on."""
    for batch in batches:
        parts = []
        for r in batch.itertuples(index=False):
            raw = r.text.encode("utf-8", "replace")
            part = pd.DataFrame({"gram": r.gram, "doc_id": r.doc_id, "h": r.h, "first": r.first, "place": r.place, "fate": r.fate})
            part["bytes"] = [raw[a : b + LENGTH] for a, b in zip(r.first, r.last, strict=True)]
            parts.append(part)
            if len(parts) == 256:
                yield pd.concat(parts)
                parts = []
        if parts:
            yield pd.concat(parts)


def _spread(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _keyed(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST))
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _fate(keyed: DataFrame, limit: int, sent: int, held: int = HELD) -> DataFrame:
    n = _spread(keyed)
    dealt = keyed.mapInPandas(_deal(16 * n, sent), "bucket int, fate int, entries binary")
    return staged(dealt.repartition(n, "bucket").sortWithinPartitions("bucket").mapInPandas(_settle(limit, held), _FATE), "anchors")


def _spans_with_bytes(keyed: DataFrame, fates: DataFrame) -> DataFrame:
    lists = ("gram", "first", "last", "place", "fate")
    going = fates.where(F.col("fate") != _SETTLED).groupBy("doc_id", "h").agg(*(F.collect_list(c).alias(c) for c in lists))
    texts = keyed.join(going, ["doc_id", "h"])
    return staged(texts.mapInPandas(_fetch, "gram long, doc_id long, h long, first int, place int, fate int, bytes binary"), "spans")


def _trees(spans: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Groups for the interval tree, each named by ``gram`` and of bounded size, and spans to remove without it."""
    columns = ["gram", "doc_id", "h", "first", "place", "bytes"]
    trees = spans.where(F.col("fate") == _TREE).select(columns).distinct()
    hot = spans.where(F.col("fate") == _HOT).select(columns)
    none = hot.limit(0).select("doc_id", "h", F.col("first").alias("start"), F.col("place").alias("stop"))
    if hot.isEmpty():
        return trees, none
    lead, where = F.col("place") - F.col("first"), F.struct("doc_id", "h", "first")
    keyed = hot.withColumns({"span": F.xxhash64("bytes"), "lead": lead, "where": where})
    least = keyed.groupBy("gram", "span", "lead").agg(F.min("where").alias("least"))
    met = staged(keyed.join(least, ["gram", "span", "lead"]), "hot-spans").drop("span")
    settled = none.union(met.where("where > least").select("doc_id", "h", "first", F.col("first") + F.length("bytes")))
    rows = met.where("where = least").select(*columns, "lead").distinct()
    rows = rows.withColumns({"key": F.col("gram"), "left": F.lit(0), "right": F.lit(0)})
    while True:
        rows = staged(rows, "hot-halves")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = staged(rows.join(sizes, "key"), "hot-groups")
        trees = trees.union(rows.where(F.col("n") <= limit).withColumn("gram", F.col("key")).select(columns))
        large = rows.where(F.col("n") > limit)
        if large.isEmpty():
            return trees, settled
        whole = large.where(F.col("left") + F.col("right") == LENGTH - GRAM)
        settled = settled.union(_copies_of_a_window(whole))
        rows = _halves(large.where(F.col("left") + F.col("right") < LENGTH - GRAM))


def _copies_of_a_window(rows: DataFrame) -> DataFrame:
    """Spans to remove: in groups that agree in a whole window, that window, but for its first occurrence."""
    where = F.struct("doc_id", "h", (F.col("place") - F.col("left")).alias("start"))
    least = rows.groupBy("key").agg(F.min(where).alias("least"))
    later = rows.join(least, "key").where(where > F.col("least"))
    start = F.col("place") - F.col("left")
    return later.select("doc_id", "h", start.alias("start"), (start + LENGTH).alias("stop"))


def _halves(rows: DataFrame) -> DataFrame:
    """Each span by half of the bytes left over on the left, and by half of them on the right.

    Of two spans with ``left`` and ``right`` bytes beside the gram in common, any window in
    common takes ``half`` more on the left, or else at least the rest and one more on the right.
    """
    rest = F.lit(LENGTH - GRAM) - F.col("left") - F.col("right")
    half = F.ceil(rest / 2).cast("int")
    sides = F.array(
        F.struct((F.col("left") + half).alias("left"), F.col("right").alias("right")),
        F.struct(F.col("left").alias("left"), (F.col("right") + rest - half + 1).alias("right")),
    )
    split = rows.drop("key", "n").withColumn("side", F.explode(sides)).withColumns({c: F.col("side")[c] for c in ("left", "right")})
    tail = F.length("bytes") - F.col("lead") - GRAM  # bytes after the gram
    fits = split.where((F.col("left") <= F.col("lead")) & (F.col("right") <= tail)).drop("side")
    common = F.substring("bytes", F.col("lead") - F.col("left") + 1, F.col("left") + GRAM + F.col("right"))
    return fits.withColumn("key", F.xxhash64("gram", "left", "right", common))


def _by_gram(trees: DataFrame) -> DataFrame:
    return trees.repartition(_spread(trees), "gram").sortWithinPartitions("gram")


def removed_spans(keyed: DataFrame, limit: int, sent: int, held: int) -> DataFrame:
    """(doc_id, h, start, stop) of the bytes to remove; spans may overlap."""
    fates = _fate(keyed, limit, sent, held)
    span = (F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop"))
    settled = fates.where(F.col("fate") == _SETTLED).select("doc_id", "h", *span)
    trees, more = _trees(_spans_with_bytes(keyed, fates), limit)
    grown = _by_gram(trees).mapInPandas(_grow, "doc_id long, h long, start int, stop int")
    return settled.union(grown).union(more)


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            raw, runs, kept, at = r.text.encode("utf-8", "replace"), [], [], 0
            for a, b in sorted(zip(r.start, r.stop, strict=True)) if r.start is not None else ():
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            rows.append((r.doc_id, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, limit: int = LIMIT, sent: int = SENT, held: int = HELD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each document."""
    keyed = _keyed(docs)
    both = (F.collect_list(c).alias(c) for c in ("start", "stop"))
    lists = removed_spans(keyed, limit, sent, held).groupBy("doc_id", "h").agg(*both)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    result = keyed.join(lists, ["doc_id", "h"], "left").mapInPandas(_remove, schema)
    doc_id = F.when(F.col("doc_id") != _LOWEST, F.col("doc_id")).cast(dict(docs.dtypes)["doc_id"])
    return result.withColumn("doc_id", doc_id)

"""Whole maximal repeats with all their occurrences, from common-prefix interval trees.

A maximal repeat is a string of ``LENGTH`` bytes or more with two occurrences or more that
do not all go on with one byte to the left, nor all to the right; the edge of a text is
unlike everything, other edges too. A repeat belongs to the anchor of its first window
(see ``repeats``): at most ``LENGTH`` - ``GRAM`` bytes of it lie before the anchor, so only its
right side is without bound.

1. Anchors whose left sides are all equal begin no repeat. The others' bytes are fetched,
   some to the right, and equal surroundings become one entry with a number of occurrences.
2. The entries of an anchor are one group: their right sides are sorted, the common
   prefixes scanned with a stack into intervals, and each interval's left sides likewise.
   An interval with different left sides is a maximal repeat with all its occurrences.
3. Entries that agree in all fetched bytes, and not in their left sides, go on to the next
   round with ``GROWTH`` times as many bytes from there on.
4. A group of more entries than one task takes is dealt by halves of a window. What then
   agrees in a window and is still too large is one node of the tree: the least and
   greatest sides of it, an aggregate, give its common string; its entries go on by the next
   byte to the right and by the next to the left. No group is gathered beyond that bound.

A string with a period of ``PERIOD`` bytes or less repeats itself as often as it is long, with
occurrences that overlap; such strings are not listed as groups. ``periodic_runs`` has
their places. A repeat may begin in a run if it goes on beyond its end: then the bytes from
the anchor to that end are the same in all its occurrences, and are part of the group's key.

Edge cases: a null text has no bytes; rows of one id and text are one document; a null id
comes back as null; no documents give no groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.repeats import _BASE, _INVERSE, _LOWEST, GRAM, LENGTH, _halves, _keyed, _spread, anchors, common_prefix, intervals, pieces_of
from millrace.llm.text import mix, powers

#: Entries of a group that one task takes, bytes of them, bytes to the right at first, their growth, and occurrences of a row.
LIMIT, BYTES, REACH, GROWTH, CHUNK = 2_000, 64 << 20, 256, 4, 4_096
PERIOD = LENGTH // 2
_FLUSH = 8 << 20
_ANCHOR = "gram long, doc_id long, h long, first int, last int, place int, inside int, side long"
_OCCURRENCE = "gram string, doc_id long, h long, first int, last int, place int, inside int"
_FETCHED = f"{_OCCURRENCE}, lead int, run int, before binary, bytes binary"
_PLACE = ("doc_id", "h", "first", "last", "place", "inside")
_ENTRY = ("gram", "lead", "run", "inside", "before", "bytes")
_FOUND = "group string, length int, shift int, entry string, root string"
_NODE = "key long, l int, r int, group string, length int, root string"


def _digest(*parts: object) -> str:
    raw = [p if isinstance(p, bytes) else str(p).encode() for p in parts]
    return hashlib.md5(b"".join(len(r).to_bytes(4, "little") + r for r in raw), usedforsecurity=False).hexdigest()


def runs_of(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, stop, period) of the longest stretches of LENGTH bytes or more with a period of at most PERIOD, the least one."""
    data, found = np.frombuffer(raw, np.uint8), {}
    for period in range(1, min(PERIOD, len(data) - 1) + 1):
        breaks = np.flatnonzero(data[period:] != data[:-period])
        edges = np.concatenate([[-1], breaks, [len(data) - period]])
        for i in np.flatnonzero(np.diff(edges) - 1 >= LENGTH - period):
            found.setdefault((int(edges[i]) + 1, int(edges[i + 1]) + period), period)
    return [(start, stop, period) for (start, stop), period in found.items()]


def _cut_at_runs(entries: pd.DataFrame, runs: dict[int, list[tuple[int, int, int]]]) -> pd.DataFrame:
    """The anchors, those whose windows lie partly in a run cut where they enter or leave it; ``inside`` as in ``_ANCHOR``."""
    done = []
    for text, stretches in runs.items():
        own = entries["text"] == text
        here, entries = entries[own], entries[~own]
        for start, stop, _ in stretches:
            low, high = start, stop - LENGTH  # the windows of the run
            met = (here["first"] <= high) & (here["last"] >= low)
            hit, here = here[met], here[~met]
            done.append(hit.assign(first=hit["first"].clip(lower=low), last=hit["last"].clip(upper=high), inside=stop - hit["place"]))
            here = pd.concat([here, hit[hit["first"] < low].assign(last=low - 1), hit[hit["last"] > high].assign(first=high + 1)])
        done.append(here)
    return pd.concat([entries, *done])


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The anchors of all texts; ``side`` is equal where the bytes from before the first window to the anchor are,
    and ``inside`` the bytes from the anchor to the end of the run its windows lie in, or 0."""
    for batch in batches:
        raw = [t.encode("utf-8", "replace") for t in batch["text"].fillna("")]
        ids, h = batch["doc_id"].to_numpy(np.int64), batch["h"].to_numpy(np.int64)
        runs = {i: found for i, r in enumerate(raw) if len(r) >= LENGTH and (found := runs_of(r))}
        for of, base, parts in pieces_of(raw):
            a = anchors(parts)
            text, base = np.array(of)[a.piece], np.array(base)[a.piece]
            begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])])[:-1][a.piece]
            columns = {"text": text, "base": base, "begin": begin, "gram": a.gram, "first": a.first + base, "last": a.last + base}
            rows = pd.DataFrame({**columns, "place": a.place + base, "inside": 0})
            rows = _cut_at_runs(rows, {i: runs[i] for i in set(of) & runs.keys()})
            yield _with_sides(rows, b"".join(parts), ids, h)


def _with_sides(rows: pd.DataFrame, joined: bytes, ids: np.ndarray, h: np.ndarray) -> pd.DataFrame:
    c = {name: rows[name].to_numpy() for name in rows.columns}
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(joined)), out=sums[1:])
    shift = c["begin"] - c["base"]  # from places in the text to places in the joined bytes
    start = np.maximum(c["first"] - 1, c["base"]) + shift
    inner = mix((sums[c["place"] + shift] - sums[start]) * powers(_INVERSE, len(joined) + 1)[start])
    inner = mix(inner + (c["place"] - c["first"]).astype(np.uint64))
    doc_id, h = ids[c["text"]], h[c["text"]]
    own = mix(mix(mix(doc_id.view(np.uint64)) ^ h.view(np.uint64)) + c["place"].astype(np.uint64))
    side = np.where(c["first"] > c["base"], inner, own)  # an edge of a text, or of a piece, is unlike all others
    gram = mix(c["gram"] + mix(c["inside"].astype(np.uint64)))
    return pd.DataFrame(
        {
            "gram": gram.view(np.int64),
            "doc_id": doc_id,
            "h": h,
            **{name: c[name] for name in ("first", "last", "place", "inside")},
            "side": side.view(np.int64),
        }
    )


def _fetch(offset: int, reach: int):
    """The bytes before the first window, backwards from the anchor, and those of the left side and of the round."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for r in batch.itertuples(index=False):
                raw = r.text.encode("utf-8", "replace")
                for gram, first, last, place, inside in zip(r.gram, r.first, r.last, r.place, r.inside, strict=True):
                    before = raw[max(first - 1, 0) : place][::-1]
                    data = raw[first:place] + raw[place + offset : place + offset + reach]
                    rows.append((gram, r.doc_id, r.h, first, last, place, inside, place - first, last - first, before, data))
                    size += len(data)
                    if size > _FLUSH:
                        yield pd.DataFrame(rows, columns=_columns(_FETCHED))
                        rows, size = [], 0
            yield pd.DataFrame(rows, columns=_columns(_FETCHED))

    return run


def _columns(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def groups_of(entries: Sequence, least: tuple[int, int], offset: int, reach: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of the maximal repeats that begin in the entries' own windows.

    An entry with more than one occurrence counts as two. Right sides of ``reach`` bytes are cut.
    """
    twice = [i for i, e in enumerate(entries) for _ in range(min(e.n, 2))]
    rights = [e.bytes[e.lead :] for e in entries]
    order = sorted(twice, key=rights.__getitem__)
    for right, a, b in intervals([rights[i] for i in order], least[1]):
        members = sorted(order[a:b], key=lambda i: entries[i].before)
        for left, c, d in intervals([entries[i].before for i in members], max(least[0], LENGTH - offset - right, 0)):
            e, own = entries[members[c]], [rights[i] for i in members[c:d]]
            if e.lead - e.run <= left <= e.lead and offset + right > e.inside and common_prefix(min(own), max(own)) == right:
                yield left, right, sorted(set(members[c:d]))


def _grow(offset: int, reach: int):
    """The repeats of each group, rows of which come one after the other, and what goes on under which root."""
    base = 0 if offset else GRAM

    def found(held: list) -> Iterator[tuple]:
        if not held:
            return
        gram = held[0].gram
        for left, right, members in groups_of(held, (held[0].left, held[0].right + base), offset, reach):
            e = held[members[0]]
            after = e.bytes[e.lead : e.lead + right]
            if right == reach:
                name, root = None, _digest(gram, after)
            else:
                name, root = _digest(gram, offset, after, e.before[:left]), None
            for i in members:
                yield name, left + offset + right, left, held[i].entry, root

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = [], None
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if r.key != at:
                    rows.extend(found(held))
                    held, at = [], r.key
                held.append(r)
                if len(rows) > 1 << 16:
                    yield pd.DataFrame(rows, columns=_columns(_FOUND))
                    rows = []
            yield pd.DataFrame(rows, columns=_columns(_FOUND))
        yield pd.DataFrame(list(found(held)), columns=_columns(_FOUND))

    return run


def _nodes(offset: int, reach: int):
    """The common string of each large group, from its least and greatest sides."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for g in batch.itertuples(index=False):
                left, right = common_prefix(g.low_before, g.high_before), common_prefix(g.low_after, g.high_after)
                if left > g.lead:
                    continue  # one left side for all: no repeat begins here
                name = root = None
                if right == reach:
                    root = _digest(g.gram, g.low_after)
                elif left >= g.lead - g.run and offset + right > g.inside:
                    name = _digest(g.gram, offset, g.low_after[:right], g.low_before[:left])
                rows.append((g.key, left, right, name, left + offset + right, root))
            yield pd.DataFrame(rows, columns=_columns(_NODE))

    return run


def _by_nodes(large: DataFrame, offset: int, reach: int) -> tuple[DataFrame, DataFrame]:
    """What large groups have in common, and their entries dealt by the next byte to the right and to the left."""
    after = F.expr("substring(bytes, lead + 1)")
    sides = large.groupBy("key").agg(
        F.first("gram").alias("gram"),
        *(f(c).alias(f"{name}_{side}") for side, c in (("before", F.col("before")), ("after", after)) for name, f in (("low", F.min), ("high", F.max))),
        F.min("lead").alias("lead"),
        F.min("run").alias("run"),
        F.min("inside").alias("inside"),
    )
    met = staged(large.drop("left", "right").join(staged(sides.mapInPandas(_nodes(offset, reach), _NODE), "repeat-nodes"), "key"), "repeat-parts")
    found = met.where("group IS NOT NULL OR root IS NOT NULL").select("group", "length", F.col("l").alias("shift"), "entry", "root")
    base = 0 if offset else GRAM
    step = F.explode(F.array(F.struct(F.col("l").alias("a"), (F.col("r") + 1).alias("b")), F.struct((F.col("l") + 1).alias("a"), F.col("r").alias("b"))))
    parts = met.where("root IS NULL").withColumn("step", step).where("step.a <= lead AND step.b <= length(bytes) - lead")
    common = F.expr("substring(bytes, lead - step.a + 1, step.a + step.b)")
    key = F.xxhash64("gram", "step.a", "step.b", common)
    parts = parts.withColumns({"key": key, "left": F.col("step.a"), "right": F.col("step.b") - base})
    return found, parts.select("key", "left", "right", "entry", "n", *_ENTRY)


def _round(entries: DataFrame, offset: int, reach: int, limit: int) -> DataFrame:
    """(group, length, shift, entry, root): the entries of each repeat, or the root under which they go on."""
    rows = entries.withColumns({"key": F.xxhash64("gram"), "left": F.lit(0), "right": F.lit(0)})
    found = []
    while True:
        rows = staged(rows, "repeat-entries")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("all")).where("all > 1")
        rows = staged(rows.join(sizes.drop("all"), "key"), "repeat-sizes")
        small = rows.where(F.col("size") <= limit).repartition(_spread(rows), "key").sortWithinPartitions("key")
        found.append(staged(small.mapInPandas(_grow(offset, reach), _FOUND), "repeats-found"))
        large = rows.where(F.col("size") > limit).drop("size")
        if large.isEmpty():
            return reduce(DataFrame.union, found).distinct()
        whole = F.lit(offset > 0) | (F.col("left") + F.col("right") >= LENGTH - GRAM)
        nodes, parts = _by_nodes(large.where(whole), offset, reach)
        found.append(nodes)
        halves = _halves(large.where(~whole).withColumnRenamed("n", "many")).withColumnRenamed("many", "n")
        rows = parts.unionByName(halves.select(*parts.columns)).distinct()


def _beginnings(keyed: DataFrame) -> DataFrame:
    """Anchors with different left sides: (gram, doc_id, h, first, last, place), one row each."""
    found = staged(keyed.mapInPandas(_anchors, _ANCHOR), "repeat-anchors")
    grams = found.groupBy("gram").agg(F.min("side").alias("low"), F.max("side").alias("high")).where("low < high").select("gram")
    merged = found.join(grams, "gram", "left_semi").groupBy("gram", "doc_id", "h", "place", "inside")
    return merged.agg(F.min("first").alias("first"), F.max("last").alias("last")).select(F.col("gram").cast("string").alias("gram"), *_PLACE)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(r.doc_id, r.h, *run) for r in batch.itertuples(index=False) for run in runs_of(r.text.encode("utf-8", "replace"))]
        yield pd.DataFrame(rows, columns=["doc_id", "h", "start", "stop", "period"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, h, start, stop, period): the longest stretches of LENGTH bytes or more with a period of at most PERIOD."""
    found = _keyed(docs).mapInPandas(_runs, "doc_id long, h long, start int, stop int, period int").distinct()
    return found.withColumn("doc_id", _given_id(docs))


def _given_id(docs: DataFrame) -> Column:
    return F.when(F.col("doc_id") != _LOWEST, F.col("doc_id")).cast(dict(docs.dtypes)["doc_id"])


def repeat_occurrences(docs: DataFrame, limit: int = LIMIT, reach: int = REACH) -> DataFrame:
    """(group, length, doc_id, h, start): a row for each occurrence of each maximal repeat; ``h`` is its text's hash."""
    keyed, offset = _keyed(docs), 0
    going, results = staged(_beginnings(keyed), "repeats-going"), []
    texts = keyed.dropDuplicates(["doc_id", "h"])
    while True:
        lists = going.groupBy("doc_id", "h").agg(*(F.collect_list(c).alias(c) for c in ("gram", "first", "last", "place", "inside")))
        fetched = staged(texts.join(lists, ["doc_id", "h"]).mapInPandas(_fetch(offset, reach), _FETCHED), "repeat-bytes")
        entry = F.md5(F.concat(F.encode(F.concat_ws(" ", "gram", "lead", "run", F.length("before"), F.lit("")), "UTF-8"), "before", "bytes"))
        fetched = fetched.withColumn("entry", entry)
        entries = fetched.groupBy("entry", *_ENTRY).agg(F.count(F.lit(1)).alias("n"))
        most = max(2, min(limit, BYTES // reach)) if limit > 1 else limit
        found = staged(_round(entries, offset, reach, most), "repeat-members")
        places = fetched.select("entry", *_PLACE)
        start = F.col("place") - F.col("shift")
        results.append(found.where("group IS NOT NULL").join(places, "entry").select("group", "length", "doc_id", "h", start.alias("start")))
        more = found.where("root IS NOT NULL").select("entry", "root").distinct()
        going = staged(places.join(more, "entry").select(F.col("root").alias("gram"), *_PLACE), "repeats-going")
        if going.isEmpty():
            return reduce(DataFrame.union, results).withColumn("doc_id", _given_id(docs))
        offset, reach = offset + reach, reach * GROWTH


def repeat_groups(docs: DataFrame, limit: int = LIMIT, reach: int = REACH, chunk: int = CHUNK) -> DataFrame:
    """(group, length, n_occurrences, chunk, doc_ids, hs, starts): the maximal repeats, their occurrences in ascending order.

    Those of a repeat with more than ``chunk`` are dealt by hash over numbered rows of about that many.
    """
    found = staged(repeat_occurrences(docs, limit, reach), "repeat-occurrences")
    sizes = found.groupBy("group").agg(F.count(F.lit(1)).alias("n_occurrences"))
    number = F.pmod(F.xxhash64("doc_id", "h", "start"), F.ceil(F.col("n_occurrences") / chunk)).cast("int")
    places = F.sort_array(F.collect_list(F.struct("doc_id", "h", "start")))
    rows = found.join(sizes, "group").groupBy("group", "length", "n_occurrences", number.alias("chunk")).agg(places.alias("at"))
    lists = (F.col("at")[c].alias(name) for c, name in (("doc_id", "doc_ids"), ("h", "hs"), ("start", "starts")))
    return rows.select("group", "length", "n_occurrences", "chunk", *lists)

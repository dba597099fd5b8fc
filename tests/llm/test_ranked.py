"""Ranked search against scoring of every document by definition, over small blocks, ties, and awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import ranked as R

PATTERN = re.compile(R.TERM)
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_brute_force(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    found = []
    for item, own in asked.items():
        scores = []
        for i, c in counted:
            m = 100 - 90 + (90 * c.total() * n_docs) // words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(scores[:k], 1)]
    return sorted(found, key=str)


def ranked(spark, docs, items, k, **more):
    left, right = spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS).repartition(2)
    return sorted((tuple(r) for r in R.rank_documents(left, right, k, **more).collect()), key=str)


def corpus(n, seed, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Été", "日本", "x9"]
    heavy = [1 / (i + 1) for i in range(len(words))]
    text = lambda size: " ".join(rng.choices(words, heavy, k=size))
    docs = [(rng.randrange(10 * n), text(rng.choice([1, 3, 8, 30]))) for _ in range(n)]
    items = [(i, text(rng.choice([1, 4, 12]))) for i in range(25)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus(400, 1)
    docs += docs[:30] + [(i, docs[5][1]) for i in range(20)]
    assert ranked(spark, docs, items, 7) == by_brute_force(docs, items, 7)


def test_several_chunks_of_items(spark):
    docs, items = corpus(150, 2)
    assert ranked(spark, docs, items, 5, pairs=40) == by_brute_force(docs, items, 5)


def test_items_of_more_than_64_terms(spark):
    docs, items = corpus(200, 3, vocabulary=300)
    items += [(100, " ".join(f"w{i}" for i in range(200))), (101, " ".join(f"W{i},W{i}" for i in range(64)))]
    assert ranked(spark, docs, items, 10) == by_brute_force(docs, items, 10)


@pytest.mark.parametrize("size", [1, 63, 64, 200])
def test_blocks_in_turn_keep_the_best(size):
    rng = np.random.default_rng(size)
    n, k, terms_ = 900, 6, np.arange(0, 40, 3)
    postings = [(t, d) for d in range(n) for t in rng.choice(40, rng.integers(0, 9), replace=False)]
    score = {p: int(rng.integers(1, 9)) for p in postings}
    keys = np.empty(n, R._KEY)
    keys["none"], keys["key"] = rng.random(n) < 0.1, rng.permutation(n)
    best = (np.zeros(0, np.int64), np.zeros(0, R._KEY))
    for at in range(0, n, size):
        own = [(t, d - at) for t, d in postings if at <= d < at + size]
        t, d = (np.array(x, np.int64) for x in zip(*own)) if own else (np.zeros(0, np.int64),) * 2
        values = np.array([score[a, b + at] for a, b in own], np.int64)
        block = R.Block(t, d, values, min(size, n - at))
        best = R.search_block(block, terms_, keys[at : at + size], best, k)
    totals = Counter()
    for (t, d), s in score.items():
        if t in terms_:
            totals[d] += s
    want = sorted((-s, bool(keys["none"][d]), int(keys["key"][d])) for d, s in totals.items())[:k]
    assert [(-int(s), bool(x["none"]), int(x["key"])) for s, x in zip(*best)] == want


def test_few_masks_are_evaluated(monkeypatch):
    seen = []
    scores = R.Block.scores
    monkeypatch.setattr(R.Block, "scores", lambda self, t, d, h: (seen.append(len(d)), scores(self, t, d, h))[1])
    rng = np.random.default_rng(0)
    n = 8192
    held = [(t, d) for t, share in enumerate([0.9, 0.8, 0.5, 0.01, 0.003]) for d in np.flatnonzero(rng.random(n) < share)]
    t, d = (np.array(x, np.int64) for x in zip(*held))
    value = np.array([1, 2, 4, 200, 400])[t]
    keys = np.zeros(n, R._KEY)
    R.search_block(R.Block(t, d, value, n), np.arange(5), keys, (np.zeros(0, np.int64), np.zeros(0, R._KEY)), 10)
    assert sum(seen) < n / 20


def test_lengths_beyond_64_bits():
    n = np.array([10**9, 7])
    big, words = 10**12, 10**15
    assert R.lengths(n, big, words).tolist() == [10 + (90 * x * big) // words for x in n.tolist()]


def test_awkward_rows(spark, awkward, no_documents):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    items = [(1, "the LAZY dog"), (1, "idiot"), (2, None), (3, ""), (4, "!!!"), (None, "lorem 日本語 señor"), (5, "nowhere")]
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, score string, key int")
    found = R.rank_documents(awkward, asked, 4)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_brute_force(rows, items, 4)
    assert R.rank_documents(no_documents, asked).collect() == []
    assert R.rank_documents(awkward, asked.limit(0)).collect() == []


def test_terms_are_bytes_of_the_pattern():
    text = "".join(map(chr, range(1, 700))) + "ABC" + "\x7f\x80é日"
    assert [t.decode() for t in R.terms_of(text)] == terms(text)

import re
from collections import defaultdict

import numpy as np

from millrace.llm.text import blocks, hash_words, mix, shingles

TEXTS = ["The cat, the CAT.", "", "a-b c_d éÈ 日本", "x" * 5000 + " x", None, "  ", "one two three four five six one two three four five"]


def words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def test_words_are_those_of_a_pattern_and_equal_ones_hash_equal():
    found = hash_words(TEXTS, (2, 3))
    want = [w for t in TEXTS for w in words(t)]
    assert np.diff(found.offsets).tolist() == [len(words(t)) for t in TEXTS]
    by_word = defaultdict(set)
    for word, value in zip(want, found.hashes.tolist(), strict=True):
        by_word[word].add(value)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({v for s in by_word.values() for v in s}) == len(by_word)
    heads = found.prefixes[0]
    for i, a in enumerate(want):
        assert (heads[i] == 0) == (len(a.encode()) <= 2)
        for j, b in enumerate(want):
            if heads[i] and heads[j]:
                assert (heads[i] == heads[j]) == (a.encode()[:2] == b.encode()[:2])


def test_shingles_are_runs_of_words():
    hashes, of = shingles(hash_words(TEXTS), 5)
    lists = [words(t) for t in TEXTS]
    runs = [(i, tuple(w[k : k + 5])) for i, w in enumerate(lists) if w for k in range(max(1, len(w) - 4))]
    assert of.tolist() == [i for i, _ in runs]
    assert len(set(hashes.tolist())) == len({r for _, r in runs})
    same = {r: h for (_, r), h in zip(runs, hashes.tolist(), strict=True)}
    assert all(same[r] == h for (_, r), h in zip(runs, hashes.tolist(), strict=True))


def test_nothing_gives_nothing():
    assert len(hash_words([]).hashes) == len(hash_words([None, ""]).hashes) == len(shingles(hash_words([]))[0]) == 0
    assert list(blocks([])) == []


def test_blocks_cover_every_text_once():
    texts = ["a" * n for n in (3, 9, 1, 20, 0, 4)]
    parts = list(blocks(texts, 10))
    assert [i for p in parts for i in range(p.start, p.stop)] == list(range(6))
    assert all(p.stop - p.start == 1 or sum(map(len, texts[p])) <= 10 for p in parts)


def test_mixing_is_a_bijection_of_small_values():
    assert len(np.unique(mix(np.arange(100_000, dtype=np.uint64)))) == 100_000

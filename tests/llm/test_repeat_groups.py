import random
from collections import defaultdict

import pytest

from millrace.llm import repeat_groups as G

SCHEMA = "doc_id long, text string"


def by_brute_force(rows):
    """{(string, its occurrences)} of all maximal repeats of 100 bytes or more without a short period, from all strings of every length."""
    raws, found = [(i, (t or "").encode()) for i, t in rows], set()
    for n in range(100, max((len(r) for _, r in raws), default=0) + 1):
        places = defaultdict(list)
        for i, raw in raws:
            for at in range(len(raw) - n + 1):
                places[raw[at : at + n]].append((i, at, raw[at - 1] if at else (i, at), raw[at + n] if at + n < len(raw) else (i, at)))
        for w, at in places.items():
            if any(w[p:] == w[:-p] for p in range(1, 51)):
                continue
            if len({p[2] for p in at}) > 1 and len({p[3] for p in at}) > 1:
                found.add((w, tuple(sorted(p[:2] for p in at))))
    return found


def groups(spark, rows, parts=3, **settings):
    texts, found = dict(rows), set()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    held = defaultdict(list)
    for g in G.repeat_groups(docs, **settings).collect():
        held[g.group, g.length, g.n_occurrences].extend(zip(g.doc_ids, g.starts))
    for (_, length, n), places in held.items():
        strings = {texts[i].encode()[s : s + length] for i, s in places}
        assert len(strings) == 1 and len(places) == n == len(set(places))
        found.add((strings.pop(), tuple(sorted(places))))
    assert len(found) == len(held)
    return found


def word(rng, n, letters="abcdefgh"):
    return "".join(rng.choice(letters) for _ in range(n))


def made_up(seed, n):
    rng = random.Random(seed)
    parts = [word(rng, rng.choice((40, 90, 100, 101, 160)), "abé ") for _ in range(8)]
    texts = ["".join(rng.choice(parts) + rng.choice(("", "x", "yz")) for _ in range(rng.randrange(6))) for _ in range(n)]
    return list(enumerate([*texts, "a" * 130, "ab" * 70, texts[0], texts[1][1:]]))


def test_made_up_texts_against_brute_force(spark):
    rows = made_up(21, 25)
    want = by_brute_force(rows)
    assert len(want) > 20 and groups(spark, rows) == want


@pytest.mark.parametrize("settings", [{"reach": 170, "limit": 3}, {"reach": 120, "limit": 0, "chunk": 2}])
def test_small_bounds_give_the_same(spark, settings):
    rows = made_up(22, 8)
    assert groups(spark, rows, **settings) == by_brute_force(rows)


def test_exact_copies_are_one_group(spark):
    text = word(random.Random(23), 400)
    (w, places), = groups(spark, [(1, text), (2, text), (3, text)])
    assert w == text.encode() and places == ((1, 0), (2, 0), (3, 0))


def test_a_long_passage_in_many_texts_is_one_group(spark):
    rng = random.Random(24)
    passage = word(rng, 400)
    rows = [(i, word(rng, 60) + "ABCDE"[i] + passage + "VWXYZ"[i] + word(rng, 60)) for i in range(5)]
    (w, places), = groups(spark, rows)
    assert w == passage.encode() and places == tuple((i, 61) for i in range(5))


def test_hot_passages_against_brute_force(spark):
    """One passage in most texts, with surroundings that are shared in part, beyond the bound of a task."""
    rng = random.Random(25)
    ends, passage = [word(rng, 25) for _ in range(3)], word(rng, 130)
    rows = [(i, word(rng, 20) + rng.choice(ends) + passage + rng.choice(ends) + word(rng, 20)) for i in range(30)]
    want = by_brute_force(rows)
    assert groups(spark, rows) == groups(spark, rows, limit=4) == want


def test_very_long_copies(spark):
    rng = random.Random(26)
    text = word(rng, 700_000)
    rows = [(1, "x" + text), (2, "y" + text + "z"), (3, text[300_000:300_500])]
    found = {(len(w), places) for w, places in groups(spark, rows)}
    assert found == {(700_000, ((1, 1), (2, 1))), (500, ((1, 300_001), (2, 300_001), (3, 0)))}


def test_repeats_that_begin_in_runs(spark):
    rng = random.Random(28)
    end, unit = word(rng, 90), "abcabd"
    rows = [(i, "uvwxy"[i] + unit * (25 + 5 * i) + end + "UVWXY"[i]) for i in range(5)]
    rows += [(5, word(rng, 50) + "ab" * 80 + word(rng, 60)), (6, "q" * 300 + end), (7, "r" + "q" * 250 + end)]
    want = by_brute_force(rows)
    assert len(want) >= 5 and groups(spark, rows) == want


def test_periodic_runs(spark):
    texts = [(1, "x" * 30 + "ab" * 80 + "y"), (2, "a" * 120), (2, "a" * 120), (3, None), (4, word(random.Random(29), 300))]
    found = G.periodic_runs(spark.createDataFrame(texts, SCHEMA)).collect()
    assert sorted((r.doc_id, r.start, r.stop, r.period) for r in found) == [(1, 30, 190, 2), (2, 0, 120, 1)]


def test_awkward_documents(spark, awkward, no_documents):
    rows = G.repeat_groups(awkward)
    assert rows.columns == ["group", "length", "n_occurrences", "chunk", "doc_ids", "hs", "starts"]
    assert rows.count() == 0  # the long text is one run
    assert [(r.doc_id, r.start, r.period) for r in G.periodic_runs(awkward).collect()] == [(5, 0, 27)]
    assert G.repeat_groups(no_documents).count() == 0


def test_rows_of_one_document_are_no_copies_of_each_other(spark):
    text = word(random.Random(27), 300)
    assert G.repeat_groups(spark.createDataFrame([(1, text), (1, text)], SCHEMA)).count() == 0
    twice = G.repeat_groups(spark.createDataFrame([(1, text), (1, text), (None, text)], SCHEMA)).collect()
    assert [(g.length, g.doc_ids, g.starts) for g in twice] == [(300, [None, 1], [0, 0])]

import random

import numpy as np
import pytest

from millrace.llm import decontamination as D
from millrace.llm.common import table


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_length_against_a_table():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = (rng.integers(0, 6, rng.integers(0, 90)).astype(np.uint16) for _ in range(2))
        assert D.common_length(a, b) == lcs(a.tolist(), b.tolist())


def test_sketch_is_the_product():
    rng = np.random.default_rng(2)
    dense = (rng.random((7, D.SLOTS)) < 0.001) * rng.random((7, D.SLOTS))
    dense[3] = 0
    passage, slot = np.nonzero(dense)
    r = rng.normal(size=(D.SLOTS, 5)).astype(np.float32)
    got = D.sketch(passage, slot, dense[passage, slot].astype(np.float32), 7, r)
    assert np.allclose(got, dense.T @ (dense @ r), atol=1e-3)


def test_directions_span_a_low_rank():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(60, 4)) @ rng.normal(size=(4, 30))
    r = rng.normal(size=(30, 10))
    space = D.directions(a.T @ (a @ r), r, 4)
    assert np.allclose(space.T @ space, np.eye(4), atol=1e-4) and np.allclose(a @ space @ space.T, a, atol=1e-2)


def vocabulary(rng, n=600):
    return ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) for _ in range(n)]


def world(seed):
    rng = random.Random(seed)
    words = vocabulary(rng)
    say = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, say(rng.choice((12, 20, 35, 60, 150)))) for i in range(25)]
    docs = [(i, say(rng.choice((5, 80, 300)))) for i in range(150)]
    return rng, say, items, docs


def frames(spark, docs, items, schema="item_id long, text string"):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, schema)


def test_leaks_against_brute_force(spark):
    rng, say, items, docs = world(5)
    for i, (item, text) in enumerate(items):
        docs.append((1000 + i, f"{say(rng.randrange(90))} {text.upper()}! {say(rng.randrange(90))}"))
        kept = [w for w in text.split() if rng.random() > 0.1]  # a tenth of the words left out, others put between
        docs.append((2000 + i, f"{say(40)} {' '.join(w + (' so' if rng.random() < 0.1 else '') for w in kept)} {say(40)}"))
    found = {(r.doc_id, r.item_id) for r in D.find_leaks(*frames(spark, docs, items)).collect()}
    want = set()
    for i, text in docs:
        words = text.lower().replace("!", "").split()
        for item, asked in items:
            asked, best = asked.split(), 0
            for at in range(0, max(len(words) - len(asked), 0) + 1, 4):
                best = max(best, lcs(asked, words[at : at + len(asked) + 12]) / len(asked))
            if best >= 0.8:
                want.add((i, item))
    assert {(1000 + i, i) for i in range(25)} <= want <= found
    assert not [d for d, _ in found if d < 1000]


@pytest.mark.parametrize("foreign", [True, False])
def test_stretched_items_against_brute_force(spark, foreign):
    """0 to 5 other words after each word of an item, of its own vocabulary or of none, and a tenth of its words left out."""
    rng, say, _, docs = world(8)
    items = [(i, say(rng.choice((30, 60, 90)))) for i in range(20)]
    other = (lambda: "zz" + say(1)) if foreign else (lambda: say(1))
    for gaps in range(6):
        for i, text in items:
            stretched = " ".join(" ".join([w, *(other() for _ in range(gaps))]) for w in text.split() if rng.random() > 0.1)
            docs.append((1000 * (gaps + 1) + i, f"{say(rng.randrange(200))} {stretched} {say(rng.randrange(200))}"))
    found = {(r.doc_id, r.item_id) for r in D.find_leaks(*frames(spark, docs, items)).collect()}
    whole = {(d, i): lcs(asked.split(), text.split()) / len(asked.split()) for d, text in docs if d >= 1000 for i, asked in items if d % 1000 == i}
    want = {pair for pair, part in whole.items() if part >= 0.75}
    for gaps in range(6):
        mine = {p for p in want if p[0] // 1000 == gaps + 1}
        assert len(mine) >= 18 and len(mine & found) >= 0.9 * len(mine)
    assert not [p for p in found if p[0] < 1000]


def test_words_have_numbers_of_their_own():
    rows = [{"item_id": i, "text": " ".join(f"w{j}" for j in range(i * 50, i * 50 + 60)), "answer": None} for i in range(2000)]
    items = D.Items(rows)
    assert len(items.vocabulary) == 100_010 == items.other
    assert len(np.unique(np.concatenate(items.words))) == 100_010


def test_what_must_be_there(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(300):
        words, idf = rng.integers(0, 40, rng.integers(1, 30)), rng.random(D.SLOTS)
        asked = D.Asked.of(words, words[-2:], idf, 0.75)
        text = np.array([w for w in words if rng.random() < 0.85] + rng.integers(0, 60, 20).tolist())
        if D.common_length(words, text) >= 0.75 * len(words):
            assert np.isin(text, asked.rare).sum() >= asked.need
    places = D.Places(np.array([3, 1, 2, 1, 2, 9, 1, 2, 3]), 9)
    assert places.of(np.array([1, 3])).tolist() == [0, 1, 3, 6, 8] and places.of_sequence(np.array([1, 2])).tolist() == [1, 3, 6]
    assert places.of_sequence(np.array([2, 3, 3])).tolist() == []


def test_rows_without_id_are_judged(spark):
    rng, say, items, docs = world(9)
    text = f"{say(30)} {items[3][1]} {say(10)}"
    docs = [(None, text), (7, text), (7, say(50)), (None, say(40)), (None, None)]
    kept = D.drop_leaks(*frames(spark, docs, items)).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [docs[2]] and len(kept) == 3


def test_an_answer_word_for_word_counts_with_half_of_the_rest(spark):
    rng, say, items, docs = world(6)
    item = "which of the seven wide rivers floods the plain before the harvest moon"
    said = "seven wide rivers one may ask of them all which floods in spring the plain before all of the"
    asked = [(1, item, "blue water river"), *((i + 2, t, None) for i, (_, t) in enumerate(items))]
    docs += [(500, f"{say(30)} {said} blue water river {say(30)}"), (501, f"{say(30)} {said} {say(30)}")]
    found = D.find_leaks(*frames(spark, docs, asked, "item_id long, text string, answer string")).collect()
    assert {(r.doc_id, r.item_id, r.answer) for r in found} == {(500, 1, True)}
    assert 0.5 <= found[0].lcs < 0.75


def test_items_are_taken_in_chunks(spark, monkeypatch):
    rng, say, items, docs = world(7)
    docs += [(1000 + i, f"{say(30)} {text}") for i, (_, text) in enumerate(items)]
    monkeypatch.setattr(D, "CHUNK", 8)
    found = {(r.doc_id, r.item_id) for r in D.find_leaks(*frames(spark, docs, items)).collect()}
    assert found == {(1000 + i, i) for i in range(25)}


def test_recall_on_the_tables(spark):
    docs, items = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "benchmark"))
    texts = {r.item_id: r.text for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t in r.text}
    found = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()}
    assert len(want & found) >= 0.9 * len(want) and want and len(found) <= 1.2 * len(want)
    kept = D.drop_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({d for d, _ in found})


def test_awkward_documents(spark, awkward, no_documents):
    text = "the quick brown fox jumps over the lazy dog and runs far away"
    items = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (4, "..."), (None, text + " again and again and once more today")], "item_id long, text string")
    found = sorted((r.doc_id, r.item_id) for r in D.find_leaks(awkward, items).collect() if r.item_id)
    assert found == [(1, 1)] * 4 + [(2, 1)] * 2
    kept = D.drop_leaks(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == 8 and kept.where("doc_id IS NULL").count() == 2
    assert D.find_leaks(no_documents, items).count() == D.find_leaks(awkward, items.limit(0)).count() == 0
    assert D.drop_leaks(awkward, items.limit(0)).count() == 11

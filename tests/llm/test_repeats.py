import hashlib
import random

from millrace.llm import repeats as R
from millrace.llm.common import table


def by_brute_force(rows):
    """(doc_id, text) rows in order to what the operator returns for each, by a set of all strings of 100 bytes."""
    seen, found = set(), {}
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            part = raw[at : at + 100]
            if part in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (at and gone[at - 1]) for at, g in enumerate(gone))
        found[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def removed(docs, **settings):
    rows = R.remove_repeats(docs, **settings).drop("kept").collect()
    return {r.doc_id: tuple(r)[1:] for r in rows}


def made_up(rng, n):
    parts = ["".join(rng.choice("abé ") for _ in range(rng.choice((40, 90, 99, 100, 101, 160)))) for _ in range(12)]
    texts = ["".join(rng.choice(parts) + rng.choice(("", "x", "yz")) for _ in range(rng.randrange(6))) for _ in range(n)]
    return list(enumerate([*texts, "a" * 700, "ab" * 300, texts[0], texts[1][1:], "line of one kind " * 60]))


def test_made_up_texts_against_brute_force(spark):
    rng = random.Random(5)
    rows = made_up(rng, 60)
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    assert removed(docs) == by_brute_force(rows)


def test_hot_grams_by_halves_give_the_same(spark):
    rows = made_up(random.Random(6), 60)
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    want = by_brute_force(rows)
    assert removed(docs, limit=2) == removed(docs, sent=1) == removed(docs, limit=0, sent=3) == removed(docs, limit=3, held=5) == want


def test_a_passage_in_many_surroundings(spark):
    """Its edges are hot grams; spans are halved until they tell the surroundings apart."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage, ends = word(130), [word(20) for _ in range(3)]
    rows = [(i, word(90) + rng.choice(ends) + passage + rng.choice(ends) + word(90)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    assert removed(docs, limit=5) == removed(docs) == by_brute_force(rows)


def test_halves_at_most_double(spark):
    rows = spark.range(40).selectExpr(
        "1L AS gram", "id AS doc_id", "0L AS h", "0 AS first", "68 AS place", "unhex(repeat('61', 168)) AS bytes", "68 AS lead",
        "1L AS key", "0 AS left", "0 AS right", "40L AS n")
    for step in range(8):
        before = rows.count()
        rows = R._halves(rows.where("left + right < 68")).selectExpr("*", "40L AS n").cache()
        assert rows.count() <= 2 * before
    assert rows.where("left + right < 68").isEmpty()


def test_documents_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert removed(docs) == by_brute_force(rows)


def test_long_texts_are_cut_without_losing_a_window(spark):
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefgh") for _ in range(1_200_000))
    at = (1 << 19) - 50
    rows = [(1, text), (2, "zz" + text[at : at + 130] + "zz"), (3, text[-99:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = removed(docs)
    assert found[1][1:3] == (0, 0) and found[2][:3] == (134, 130, 1) and found[3][1] == 0


def test_prefix_intervals():
    words = sorted([b"banana", b"band", b"bandana", b"can", b"cane", b"cane"])
    assert sorted(R.intervals(words, 1)) == [(3, 0, 3), (3, 3, 6), (4, 1, 3), (4, 4, 6)]


def test_maximal_repeats_have_all_occurrences():
    lefts = [b"xq", b"xq", b"yq", b"zz"]
    rights = [b"anchor-one", b"anchor-two", b"anchor-one", b"anchor-six"]
    found = {(left, right, tuple(sorted(m))) for left, right, m in R.maximal_repeats([x[::-1] for x in lefts], rights, 8)}
    assert (1, 7, (0, 1, 2)) in found and (1, 10, (0, 2)) in found and (2, 7, (0, 1)) in found
    assert all(left + right >= 8 for left, right, _ in found)


def test_awkward_documents(awkward, no_documents):
    rows = R.remove_repeats(awkward)
    assert rows.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    found = rows.collect()
    assert len(found) == 11 and sum(r.doc_id is None for r in found) == 2
    assert {r.n_removed for r in found if r.doc_id != 5} == {0}
    long = next(r for r in found if r.doc_id == 5)
    assert long.n_removed == long.n_bytes - 27 and long.n_spans == 1
    assert next(r for r in found if r.doc_id == 3).kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert R.remove_repeats(no_documents).count() == 0


def test_rows_of_one_document_are_no_copies_of_each_other(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(300))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string").repartition(3)
    assert sorted((r.doc_id, r.n_removed) for r in R.remove_repeats(docs).collect()) == [(1, 0), (1, 0), (2, 300)]

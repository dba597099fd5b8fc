import numpy as np

from millrace.llm import quality as Q
from millrace.llm.common import fold_is, ship, sigmoid, table

SF = "/root/testdata/sf0.1"


def test_features_by_hand():
    text = "Ab, cd. CD! 12\n#|x é\nAb, cd. CD! 12"
    row = dict(zip(Q.FEATURES, Q.features_of([text])[0], strict=True))
    n, words = len(text.encode()), 10
    assert np.isclose(row["log_bytes"], np.log1p(n)) and np.isclose(row["log_words"], np.log1p(words))
    assert np.isclose(row["digits"], 4 / n) and np.isclose(row["symbols"], 4 / n) and np.isclose(row["wide"], 2 / n)
    assert np.isclose(row["distinct_words"], 5 / words) and np.isclose(row["top_word"], 4 / words)
    assert np.isclose(row["repeated_lines"], 1 / 3) and np.isclose(row["commas"], 2 / words)


def test_features_do_not_depend_on_the_batch():
    texts = ["one two", "", "THREE!!! " * 50, "é\n\né"]
    assert np.allclose(Q.features_of(texts), np.concatenate([Q.features_of([t]) for t in texts]))


def test_best_split_is_the_best():
    rng = np.random.default_rng(3)
    for _ in range(20):
        g, h = rng.normal(size=9), rng.random(9)
        gain = lambda i: Q._gain(g[:i].sum(), h[:i].sum()) + Q._gain(g[i:].sum(), h[i:].sum()) - Q._gain(g.sum(), h.sum())
        at, value = Q.best_split(g, h)
        best = max(range(1, 9), key=gain)
        assert (at == best and np.isclose(value, gain(best))) or (at == 0 and gain(best) <= 1e-6)


def test_pairs_catch_what_sums_cannot():
    rng = np.random.default_rng(4)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    with_pairs, without = Q.fit(x, y, rounds=40), Q.fit(x, y, rounds=40, pairs=0)
    right = lambda m: ((sigmoid(m.raw(m.binned(x))) >= 0.5) == y).mean()
    assert set(with_pairs.pairs[0]) == {0, 1} and right(with_pairs) > 0.9 > right(without) + 0.2


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = Q.train(docs, labels.where(~fold_is("doc_id", 5, 0)))
    held = Q.score_quality(docs.join(labels, "doc_id").where(fold_is("doc_id", 5, 0)), model).select("score", "quality").collect()
    assert sum((r.score >= 0.3) == r.quality for r in held) > 0.98 * len(held)


def test_awkward_documents(spark, awkward, no_documents):
    ship(spark)
    docs = spark.createDataFrame([(i, "junk ### " * 9 if i % 2 else f"A fine text, number {i}.") for i in range(80)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int((doc_id + 1) % 2) AS quality").unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int"))
    model = Q.train(docs, labels)
    found = Q.score_quality(awkward, model).collect()
    assert len(found) == 11 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not r.text}) == 1
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in Q.score_quality(docs, model).collect())
    assert Q.score_quality(no_documents, model).count() == 0
    assert all(r.score < 1e-6 for r in Q.score_quality(awkward, Q.train(docs, labels.limit(0))).collect())

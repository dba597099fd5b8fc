import numpy as np
import pytest

from millrace.llm import toxicity as T
from millrace.llm.common import fold_is, ship, sigmoid, table

SF = "/root/testdata/sf0.1"


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = T.Machine(np.arange(5, dtype=np.uint64), 0.3, rng.normal(size=5), rng.normal(size=(5, 3)))
    index, of = np.array([0, 2, 4, 1]), np.array([0, 0, 0, 2])
    want = [0.3 + m.weights[[0, 2, 4]].sum() + sum(m.factors[i] @ m.factors[j] for i, j in ((0, 2), (0, 4), (2, 4))), 0.3, 0.3 + m.weights[1]]
    assert T.raw_score(m, index, of, 3)[0] == pytest.approx(want)


def test_pairs_of_terms_are_learned():
    """Neither of two terms alone is toxic, both together are: no sum of weights can tell."""
    rng = np.random.default_rng(2)
    has = rng.random((2000, 4)) < 0.5
    y = (has[:, 0] == has[:, 1]).astype(float)
    of, index = np.nonzero(has)
    m = T.fit(np.arange(4, dtype=np.uint64), index, of, y, epochs=150)
    p = sigmoid(T.raw_score(m, index, of, len(y))[0])
    assert ((p >= 0.5) == y).mean() > 0.95


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = T.train(docs, labels.where(~fold_is("doc_id", 5, 0)))
    held = T.score_toxicity(docs.join(labels, "doc_id").where(fold_is("doc_id", 5, 0)), model).select("score", "toxic").collect()
    hits = [r.score >= 0.5 for r in held if r.toxic]
    assert sum((r.score >= 0.5) == r.toxic for r in held) > 0.97 * len(held) and sum(hits) > 0.8 * len(hits)
    assert not any(r.score >= 0.5 for r in held if not r.toxic)


def test_awkward_documents(spark, awkward, no_documents):
    ship(spark)
    rows = [(i, f"{'you vile worm' if i % 2 else 'a kind word'} number {i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic").unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    model = T.train(docs, labels)
    found = T.score_toxicity(awkward, model)
    assert found.columns.count("score") == 1 and sorted(found.columns) == sorted(awkward.columns)
    scores = {r.doc_id: r.score for r in found.collect()}
    assert found.count() == 11 and all(0 <= s <= 1 for s in scores.values()) and scores[3] == scores[4]
    assert T.drop_toxic(awkward, model).columns == awkward.columns
    vile = T.drop_toxic(docs, model)
    assert {r.doc_id % 2 for r in vile.collect()} == {0} and vile.count() == 30
    assert T.score_toxicity(no_documents, model).count() == 0
    for some, score in ((labels.limit(0), 0), (labels.where("toxic = 0"), 0), (labels.where("toxic = 1"), 1)):
        nothing = T.train(docs, some)
        assert [r.score for r in T.score_toxicity(awkward, nothing).collect()] == pytest.approx([score] * 11)

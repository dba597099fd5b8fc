import numpy as np
import pytest

from millrace.llm import language as L
from millrace.llm.common import fold_is, ship, table

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = L.new_network(["a", "b", "c"], 4)
    for p in net.parameters():
        p += rng.normal(0, 0.2, p.shape).astype(np.float32)
    for name in ("gate", "candidate", "gate_state", "candidate_state"):
        setattr(net, name, [x.astype(np.float64) for x in getattr(net, name)])
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    data, labels = rng.integers(0, 5, (6, 3)).astype(np.uint8), np.array([0, 2, 1])
    mask = np.ones((6, 3), np.float32)
    mask[4:, 1] = 0
    _, grads = L.gradients(net, data, labels, mask)
    for p, g in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before, step = p[at], 1e-2
        p[at] = before + step
        up = L.gradients(net, data, labels, mask)[0]
        p[at] = before - step
        down = L.gradients(net, data, labels, mask)[0]
        p[at] = before
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=2e-2, abs=1e-4)


def test_windows_hold_every_byte():
    texts = ["", "a" * 300, "é" * 64, "xyz"]
    data, of, used = L.windows_of(texts, 128)
    back = {i: b"".join(data[j, : used[j]].tobytes() for j in np.flatnonzero(of == i)) for i in range(4)}
    assert [back[i].decode() for i in range(4)] == texts


def test_the_whole_text_counts():
    net = L.fit([b"aaaa" * 16, b"bbbb" * 16] * 40, ["A", "B"] * 40, epochs=20)
    p = L.document_probabilities(net, ["a" * 1000 + "b" * 9000, "b" * 1000 + "a" * 9000, ""])
    assert p[0].argmax() == net.languages.index("B") and p[1].argmax() == net.languages.index("A")
    assert p[2].sum() == 0


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    net = L.train(docs.where(~fold_is("doc_id", 3, 1)))
    held = L.identify_language(docs.where(fold_is("doc_id", 3, 1)), net).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)


def test_awkward_documents(spark, awkward, no_documents):
    ship(spark)
    net = L.train(table(spark, SF, "documents"), sample=60)
    rows = L.identify_language(awkward, net)
    assert set(awkward.columns) - {"score"} <= set(rows.columns)
    found = rows.collect()
    assert len(found) == 11
    for r in found:
        unknown = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == unknown and (r.score == 0) == unknown and 0 <= r.score <= 1
    assert L.identify_language(no_documents, net).count() == 0
    nothing = L.train(no_documents)
    assert {r.lang_pred for r in L.identify_language(awkward, nothing).collect()} == {"und"}


def test_no_letters_no_language(spark):
    rows = [(1, "½ ²"), (2, "ⅷ"), (3, "12 #_ ٣"), (4, "é"), (5, "日"), (6, "²a")]
    assert [L.has_letter(t) for _, t in rows] == [False, False, False, True, True, True]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _predicted string")
    net = L.new_network(["de", "en"], 4)
    found = {r.doc_id: r for r in L.identify_language(docs, net).collect()}
    assert [found[i].lang_pred == "und" for i in range(1, 7)] == [True, True, True, False, False, False]
    assert found[1]["_predicted"] == "x" and found[1].score == 0


def test_a_repeated_id_is_learned_from_once(spark):
    rows = [(1, "ein Satz", "de")] * 50 + [(2, "a line", "en")]
    seen = []
    fit = L.fit
    try:
        L.fit = lambda windows, languages, *a, **b: seen.append(list(languages)) or fit(windows, languages, *a, **b)
        L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    finally:
        L.fit = fit
    assert sorted(seen[0]) == ["de", "en"]

"""Counts against their definition, estimates against the same steps in numpy, and what the rules reject."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import rules as R
from millrace.llm.common import table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_of(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), symbols, again, len(covered), failed)


def found_counts(docs):
    return sorted(((str(r.doc_id), *tuple(r)[3:]) for r in R.text_counts(docs).collect()), key=str)


def test_counts_by_definition(spark):
    rng = random.Random(3)
    alphabet = ["a", "b", "c", "é", "日本", "#", "x$", "<|>", " ", " ", " ", "\n", "\n", "\t", "\x0b", "\x0c\r", " ", " ", "\x1c", "\x85"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(220))) for _ in range(300)]
    texts += ["", None, "a a a", "a a a a", "a b c a b c", "x\n x\nx\n\n \n \nx", " lead", "a b c d a b c", "w " * 200]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert found_counts(docs) == sorted(((str(i), *counts_of(t)) for i, t in enumerate(texts)), key=str)


def test_awkward_rows(spark, awkward, no_documents):
    rows = awkward.collect()
    found = R.judge_texts(awkward).collect()
    assert len(found) == len(rows) and all(r.kept <= (not r.base_failed) for r in found)
    short = awkward.where("doc_id <> 5 OR doc_id IS NULL")
    assert found_counts(short) == sorted(((str(r.doc_id), *counts_of(r.text)) for r in short.collect()), key=str)
    long = next(r for r in found if r.doc_id == 5)
    assert (long.n_words, long.n_repeat_words, long.base_failed) == (200_000, 200_000, True)
    assert R.judge_texts(no_documents).collect() == []


def by_numpy(groups, steps):
    """The estimates of groups of whole-number vectors, by the module's text."""
    floors = np.diag(np.square(list(R.FLOORS.values())))
    estimates = {}
    for g, x in groups.items():
        ordered = np.sort(x, axis=0) / R.SCALE
        at = [ordered[-(-len(x) * q // 4) - 1] for q in (1, 2, 3)]
        estimates[g] = (at[1], np.diag(((at[2] - at[0]) / 1.349) ** 2) + floors)

    def distances(g):
        mean, cov = estimates[g]
        d = groups[g] / R.SCALE - mean
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)

    def estimate(chosen, factor):
        every = np.concatenate(list(chosen.values()))
        for g, x in chosen.items():
            n = len(x) + R.PRIOR
            mean = (x.sum(0) + R.PRIOR * every.mean(0)) / n
            second = (x.T @ x + R.PRIOR * (every.T @ every) / len(every)) / n
            estimates[g] = (mean / R.SCALE, factor * (second - np.outer(mean, mean)) / R.SCALE**2 + floors)

    for _ in range(steps):
        chosen = {}
        for g, x in groups.items():
            bins = np.minimum(np.floor(16 * np.log1p(distances(g))), 255)
            edges, counts = np.unique(bins, return_counts=True)
            before = np.cumsum(counts) - counts
            chosen[g] = x[np.isin(bins, edges[before < R.CLOSEST * len(x)])]
        estimate(chosen, R.consistency(R.CLOSEST))
    estimate({g: x[distances(g) <= R.chi_squared_quantile(R.REWEIGHT, 5)] for g, x in groups.items()}, R.consistency(R.REWEIGHT))
    return estimates


def test_estimates_as_in_numpy(spark):
    rng = np.random.default_rng(4)
    groups = {}
    for g, n in ((("en", "hot"), 900), (("en", None), 300), ((None, "b"), 60), (("de", "c"), 3)):
        x = rng.normal(size=(n, 5)) @ rng.normal(size=(5, 5)) * 100 + rng.normal(size=5) * 300
        x[: n // 6] += 4000
        x[:, 2] = 0
        groups[g] = np.round(x).astype(np.int64)
    rows = [(*g, *map(int, v)) for g, x in groups.items() for v in x]
    stats = spark.createDataFrame(rows, "lang string, source string, x0 long, x1 long, x2 long, x3 long, x4 long").repartition(4).cache()
    want = by_numpy(groups, 2)
    for r in R.estimates(stats, 2).collect():
        mean, cov = want[(r.lang, r.source)]
        np.testing.assert_allclose([r[f"m{i}"] for i in range(5)], mean, rtol=1e-6, atol=1e-6)
        w = np.array([[r[f"w{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
        np.testing.assert_allclose(w @ cov @ w.T, np.eye(5), atol=1e-6)


@pytest.mark.parametrize(("p", "k", "want"), [(0.975, 5, 12.8325), (0.75, 5, 6.6257), (0.95, 1, 3.8415), (0.99, 10, 23.2093)])
def test_quantiles(p, k, want):
    assert R.chi_squared_quantile(p, k) == pytest.approx(want, abs=1e-3)


def test_no_python_workers_and_no_clean_text_lost(spark):
    judged = R.judge_texts(table(spark, SF, "documents"))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
    labels = table(spark, SF, "labels")
    graded = {(r.quality, r.kept): r.n for r in judged.where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert graded.get((1, False), 0) <= 0.01 * graded[1, True]
    assert graded[0, False] >= 0.9 * graded.get((0, True), 0)

"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed words and of their beginnings of ``STEMS`` bytes, so
that an inflected form counts by its stem. Of these terms the ``features`` whose
presence tells most about the label stay; the machine has a weight and ``factors`` numbers for
each, so that pairs of terms count beyond their sum. It is trained in numpy by Adagrad
on a bounded sample of labelled texts and broadcast (features * (factors + 2) numbers); the sample's terms are counted in Spark.

Edge cases: a null or empty text, or one of unknown terms, gets the score of the bias
alone; without positive labels every score is 0, without negative ones 1.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, labelled_sample, sigmoid, staged, text_udf
from millrace.llm.text import blocks, hash_words

STEMS = (4, 5, 6)
_SLOTS = 1 << 20


@dataclass(frozen=True)
class Machine:
    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _terms(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    words = hash_words(texts, STEMS)
    hashes = np.concatenate([words.hashes, *words.prefixes])
    of = np.tile(words.text, 1 + len(STEMS))
    return hashes[hashes != 0], of[hashes != 0]


def distinct_terms(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of each text, as hashes and text numbers."""
    hashes, of = _terms(texts)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), np.bool_)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], of[new]


def telling_terms(rows: DataFrame, features: int, least: int = 3) -> np.ndarray:
    """Of the terms in ``least`` texts or more, the ``features`` with the largest z-score between the labels, sorted.

    ``rows`` has (y, terms), each term once a row; the counting is Spark's.
    """
    share = rows.agg(F.avg("y").alias("share")).first()["share"]
    if not share or share == 1:
        return np.zeros(0, np.uint64)
    counts = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    z = F.abs(F.col("hits") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    best = counts.where(F.col("n") >= least).orderBy(z.desc(), "term").limit(features).collect()
    return np.sort(np.array([r["term"] for r in best], np.int64).view(np.uint64))


def raw_score(model: Machine, index: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The machine's output for n texts with these (feature, text) pairs, and the sums of factors."""
    v = model.factors[index]
    sums = np.zeros((n, v.shape[1]))
    np.add.at(sums, of, v)
    squares = np.bincount(of, weights=(v * v).sum(axis=1), minlength=n)
    linear = np.bincount(of, weights=model.weights[index], minlength=n)
    return model.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fit(
    terms: np.ndarray, index: np.ndarray, of: np.ndarray, y: np.ndarray, factors: int = 6, epochs: int = 40, penalty: float = 2e-4
) -> Machine:
    """A machine for the texts 0 .. len(y) - 1, whose (feature, text) pairs are grouped by text."""
    rng = np.random.default_rng(7)
    if len(y) == 0 or y.min() == y.max():
        bias = -1000.0 if len(y) == 0 or y.max() == 0 else 1000.0
        return Machine(np.zeros(0, np.uint64), bias, np.zeros(0), np.zeros((0, factors)))
    share = y.mean()
    model = Machine(terms, float(np.log(share / (1 - share))), np.zeros(len(terms)), rng.normal(0, 0.05, (len(terms), factors)))
    bias, g_bias, g_w, g_v = model.bias, 1e-6, np.full(len(terms), 1e-6), np.full((len(terms), factors), 1e-6)
    starts = np.searchsorted(of, np.arange(len(y) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), 128):
            batch = order[begin : begin + 128]
            rows = np.concatenate([np.arange(starts[b], starts[b + 1]) for b in batch])
            i, t = index[rows], np.repeat(np.arange(len(batch)), starts[batch + 1] - starts[batch])
            out, sums = raw_score(Machine(terms, bias, model.weights, model.factors), i, t, len(batch))
            error = (sigmoid(out) - y[batch]) / len(batch)
            grad = error.sum()
            g_bias += grad**2
            bias -= 0.1 * grad / np.sqrt(g_bias)
            used, local = np.unique(i, return_inverse=True)
            gw = np.bincount(local, weights=error[t], minlength=len(used)) + penalty * model.weights[used] / 10
            gv = np.zeros((len(used), factors))
            np.add.at(gv, local, error[t][:, None] * (sums[t] - model.factors[i]))
            gv += penalty * model.factors[used]
            g_w[used] += gw**2
            g_v[used] += gv**2
            model.weights[used] -= 0.1 * gw / np.sqrt(g_w[used])
            model.factors[used] -= 0.02 * gv / np.sqrt(g_v[used])
    return Machine(terms, float(bias), model.weights, model.factors)


def scorer(model: Machine):
    """Scores of many texts; most words are dismissed by one lookup of their low bits."""
    maybe = np.zeros(_SLOTS, np.bool_)
    maybe[(model.terms & np.uint64(_SLOTS - 1)).astype(np.int64)] = True

    def score(texts: Sequence[str]) -> pd.Series:
        parts = []
        for part in blocks(texts):
            hashes, of = _terms(texts[part])
            n = part.stop - part.start
            near = np.flatnonzero(maybe[(hashes & np.uint64(_SLOTS - 1)).astype(np.int64)])
            hashes, of = hashes[near], of[near]
            at = np.searchsorted(model.terms, hashes).clip(max=max(len(model.terms) - 1, 0))
            known = model.terms[at] == hashes if len(model.terms) else np.zeros(0, np.bool_)
            pairs = np.unique(of[known] * max(len(model.terms), 1) + at[known])
            of, index = np.divmod(pairs, max(len(model.terms), 1))
            parts.append(sigmoid(raw_score(model, index, of, n)[0]))
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score


def train(docs: DataFrame, labels: DataFrame, sample: int = 8_000, features: int = 1024) -> Machine:
    """A machine fitted to at most ``sample`` documents with a label ``toxic``."""

    @F.pandas_udf("array<long>")
    def terms_of(texts: pd.Series) -> pd.Series:
        lists = []
        for part in blocks(given := [t or "" for t in texts]):
            hashes, of = distinct_terms(given[part])
            lists += np.split(hashes.view(np.int64), np.searchsorted(of, np.arange(1, part.stop - part.start)))
        return pd.Series(lists)

    rows = staged(labelled_sample(docs, labels, "toxic", sample).select("y", terms_of("text").alias("terms")), "terms")
    terms = telling_terms(rows, features)

    @F.pandas_udf("array<int>")
    def known(lists: pd.Series) -> pd.Series:
        def one(x: np.ndarray) -> np.ndarray:
            hashes = np.asarray(x, np.int64).view(np.uint64)
            at = np.searchsorted(terms, hashes).clip(max=max(len(terms) - 1, 0))
            return np.sort(at[terms[at] == hashes]) if len(terms) else at[:0]

        return lists.map(one)

    chosen = sorted((r["y"], r["index"]) for r in rows.select("y", known("terms").alias("index")).collect())
    index = np.array([i for _, x in chosen for i in x], np.int64)
    return fit(terms, index, np.repeat(np.arange(len(chosen)), [len(x) for _, x in chosen]), np.array([y for y, _ in chosen], float))


def score_toxicity(docs: DataFrame, model: Machine) -> DataFrame:
    """The documents with a column ``score``, which replaces one of that name."""
    return docs.withColumn("score", text_udf(docs.sparkSession, scorer, model, "double")("text"))


def drop_toxic(docs: DataFrame, model: Machine, threshold: float = 0.5) -> DataFrame:
    score = fresh(*docs.columns)
    scored = docs.withColumn(score, text_udf(docs.sparkSession, scorer, model, "double")("text"))
    return scored.where(F.col(score) < threshold).select(docs.columns)

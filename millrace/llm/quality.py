"""Quality by a generalised additive model with pairwise interactions.

Each text has a few surface features. Boosting goes round the features in turn; every
turn fits a shallow tree (two levels) on one feature's bins to the gradient and adds a
fraction of it to that feature's lookup table. Then the pairs of features that still
explain most get trees of one split each way, kept as two-way tables. A score is the
sum of the looked-up values. Trained in numpy on a bounded sample of labelled texts;
the broadcast tables hold (features * bins + pairs * bins**2) numbers.

Edge cases: a null or empty text has the features of no characters and is scored like
any other; without labelled texts every score is 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import labelled_sample, sigmoid, text_udf
from millrace.llm.text import blocks, hash_words

_SYMBOLS = b"#$%&*!|<>{}[]=_~^@\\/+"
FEATURES = (
    "log_bytes log_words word_length upper digits space newlines periods commas other_punctuation "
    "symbols top_symbol distinct_words top_word repeated_lines line_length wide"
).split()


def _classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for code, members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".", b",", b";:?'\"()-"), 1):
        table[list(members)] = code
    table[list(_SYMBOLS)] = np.arange(8, 8 + len(_SYMBOLS))
    table[128:] = 8 + len(_SYMBOLS)
    return table


_CLASS = _classes()
_N_CLASSES = int(_CLASS.max()) + 1


def features_of(texts: Sequence[str]) -> np.ndarray:
    """A row of FEATURES for each text."""
    return np.concatenate([_features(texts[part]) for part in blocks(texts)] or [np.zeros((0, len(FEATURES)))])


def _features(texts: Sequence[str]) -> np.ndarray:
    n = len(texts)
    raw = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    of = np.repeat(np.arange(n), size)
    kinds = np.bincount(of * _N_CLASSES + _CLASS[np.frombuffer(b"".join(raw), np.uint8)], minlength=n * _N_CLASSES)
    kinds = kinds.reshape(n, _N_CLASSES).astype(np.float64)
    words = hash_words(texts)
    n_words = np.diff(words.offsets)
    _, at, times = np.unique(words.hashes ^ (words.text.astype(np.uint64) << np.uint64(40)), return_index=True, return_counts=True)
    distinct = np.bincount(words.text[at], minlength=n)
    top_word = np.zeros(n)
    np.maximum.at(top_word, words.text[at], times)
    lines = [[line for line in t.split("\n") if line.strip()] for t in texts]
    n_lines = np.array([len(x) for x in lines])
    repeated = np.array([len(x) - len(set(x)) for x in lines])
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(n_words, 1)
    symbols = kinds[:, 8 : 8 + len(_SYMBOLS)]
    plain = kinds[:, 0] + kinds[:, 1] + kinds[:, -1]
    return np.column_stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            plain * per_word,
            kinds[:, 1] / np.maximum(plain, 1),
            kinds[:, 2] * per_byte,
            kinds[:, 3] * per_byte,
            kinds[:, 4] * per_word,
            kinds[:, 5] * per_word,
            kinds[:, 6] * per_word,
            kinds[:, 7] * per_word,
            symbols.sum(axis=1) * per_byte,
            symbols.max(axis=1) * per_byte,
            distinct * per_word,
            top_word * per_word,
            repeated / np.maximum(n_lines, 1),
            np.log1p(size / np.maximum(n_lines, 1)),
            kinds[:, -1] * per_byte,
        ]
    )


@dataclass
class Additive:
    bias: float
    edges: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def raw(self, bins: np.ndarray) -> np.ndarray:
        total = self.bias + sum(self.tables[j][bins[:, j]] for j in range(len(self.edges)))
        return total + sum(g[bins[:, a], bins[:, b]] for (a, b), g in zip(self.pairs, self.grids, strict=True))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def best_split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Where to cut bins with these gradient and curvature sums, and what that gains; 0 for nowhere."""
    if len(g) < 2:
        return 0, 0.0
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(cg, ch) + _gain(g.sum() - cg, h.sum() - ch) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return (at + 1, float(gains[at])) if gains[at] > 1e-6 else (0, 0.0)


def tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The step of a tree of ``depth`` levels over ordered bins, a value for each bin."""
    cut = best_split(g, h)[0] if depth else 0
    if not cut:
        return np.full(len(g), -g.sum() / (h.sum() + 1.0))
    return np.concatenate([tree(g[:cut], h[:cut], depth - 1), tree(g[cut:], h[cut:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The step of a tree that cuts a grid once along its rows and then each part along its columns, and its gain."""
    best, step = -1.0, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for cut in range(1, len(a), max(1, len(a) // 8)):
            parts = [best_split(x.sum(axis=0), y.sum(axis=0)) for x, y in ((a[:cut], b[:cut]), (a[cut:], b[cut:]))]
            gain = sum(p[1] for p in parts) + best_gain(a, b, cut)
            if gain > best:
                best, step = gain, np.zeros_like(a)
                for rows, (at, _) in zip((slice(0, cut), slice(cut, None)), parts, strict=True):
                    for cols in (slice(0, at), slice(at, None)):
                        x, y = a[rows, cols], b[rows, cols]
                        step[rows, cols] = -x.sum() / (y.sum() + 1.0) if x.size else 0
                step = step.T if flip else step
    return step, best


def best_gain(g: np.ndarray, h: np.ndarray, cut: int) -> float:
    top, rest, all_g, all_h = g[:cut].sum(), g[cut:].sum(), g.sum(), h.sum()
    return float(_gain(top, h[:cut].sum()) + _gain(rest, h[cut:].sum()) - _gain(all_g, all_h))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 60, pairs: int = 6, rate: float = 0.15) -> Additive:
    k = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(y) else np.zeros(0) for j in range(k)]
    share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 1e-12
    model = Additive(float(np.log(share / (1 - share))), edges, np.zeros((k, bins)))
    if len(y) == 0 or y.min() == y.max():
        return model
    b = model.binned(x)
    out = model.raw(b)
    for _ in range(rounds):
        for j in range(k):
            p = sigmoid(out)
            g = np.bincount(b[:, j], weights=p - y, minlength=bins)
            h = np.bincount(b[:, j], weights=p * (1 - p), minlength=bins)
            step = rate * tree(g, h)
            model.tables[j] += step
            out += step[b[:, j]]

    def grid_sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p, cell = sigmoid(out), b[:, i] * bins + b[:, j]
        sums = (np.bincount(cell, weights=w, minlength=bins * bins).reshape(bins, bins) for w in (p - y, p * (1 - p)))
        return tuple(sums)

    gains = [(pair_tree(*grid_sums(i, j))[1], i, j) for i in range(k) for j in range(i)]
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:pairs]]
    model.grids = [np.zeros((bins, bins)) for _ in model.pairs]
    for _ in range(rounds // 4):
        for grid, (i, j) in zip(model.grids, model.pairs, strict=True):
            step = rate * pair_tree(*grid_sums(i, j))[0]
            grid += step
            out += step[b[:, i], b[:, j]]
    return model


def scorer(model: Additive):
    return lambda texts: pd.Series(sigmoid(model.raw(model.binned(features_of(texts)))))


def train(docs: DataFrame, labels: DataFrame, sample: int = 8_000) -> Additive:
    """A model fitted to at most ``sample`` documents with a label ``quality``."""

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(features_of([t or "" for t in texts])))

    rows = labelled_sample(docs, labels, "quality", sample).select(features("text").alias("x"), "y").toPandas()
    x = np.stack([*rows["x"], np.zeros(len(FEATURES))])[:-1]
    return fit(x, rows["y"].to_numpy(np.float64))


def score_quality(docs: DataFrame, model: Additive) -> DataFrame:
    """The documents with a column ``score``, which replaces one of that name."""
    return docs.withColumn("score", text_udf(docs.sparkSession, scorer, model, "double")("text"))

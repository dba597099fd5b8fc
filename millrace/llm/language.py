"""Language of a text by a bidirectional gated recurrent network over its bytes.

Two minimal gated units (one gate, which both forgets and resets) read the UTF-8 bytes
forwards and backwards; at every position both states give a probability for each
language, and a text's probabilities are the mean over all its positions. Texts are
read in windows of ``WINDOW`` bytes that start from an empty state, many at once. The
network is trained in numpy by backpropagation through time with Adam, on windows of
a bounded sample of texts, and broadcast (its size depends on parameters only).

Edge cases: a null text or one without letters is ``und`` with score 0; so is every
text if there was nothing to learn from. Windows' unused ends do not count.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, ship, text_udf
from millrace.llm.text import blocks

UNKNOWN = "und"
WINDOW, LANES = 128, 4096
_PLAIN = re.compile("[A-Za-z]")


@dataclass
class Network:
    """For each direction: gate and candidate tables (256, h) for bytes, and matrices (h, h) for states; then the output."""

    languages: list[str]
    gate: list[np.ndarray]
    candidate: list[np.ndarray]
    gate_state: list[np.ndarray]
    candidate_state: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.gate, *self.candidate, *self.gate_state, *self.candidate_state, self.out, self.bias]


def new_network(languages: list[str], hidden: int, seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)
    two = lambda rows: [rng.normal(0, 1 / np.sqrt(hidden), (rows, hidden)).astype(np.float32) for _ in range(2)]
    out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
    return Network(languages, two(256), two(256), two(hidden), two(hidden), out, np.zeros(len(languages), np.float32))


def _sigmoid_(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def states(net: Network, data: np.ndarray, d: int, keep: list | None = None) -> np.ndarray:
    """The states after each byte of ``data`` (steps, lanes), as (steps, lanes, h); direction 1 reads from the end."""
    steps, lanes = data.shape
    hidden = net.gate[d].shape[1]
    result = np.empty((steps, lanes, hidden), np.float32)
    h = np.zeros((lanes, hidden), np.float32)
    f, c, r = (np.empty_like(h) for _ in range(3))
    for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
        np.matmul(h, net.gate_state[d], out=f)
        f += net.gate[d][data[t]]
        _sigmoid_(f)
        np.multiply(f, h, out=r)
        np.matmul(r, net.candidate_state[d], out=c)
        c += net.candidate[d][data[t]]
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((t, h.copy(), f.copy(), c.copy(), r.copy()))
        c -= h
        c *= f
        np.add(h, c, out=result[t])
        h = result[t]
    return result


def softmax_(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def position_probabilities(net: Network, data: np.ndarray) -> np.ndarray:
    hidden = net.gate[0].shape[1]
    logits = states(net, data, 0) @ net.out[:hidden]
    logits += states(net, data, 1) @ net.out[hidden:]
    logits += net.bias
    return softmax_(logits)


def gradients(net: Network, data: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the masked positions and its gradient for each of ``parameters()``."""
    hidden = net.gate[0].shape[1]
    kept: list[list] = [[], []]
    both = np.concatenate([states(net, data, d, kept[d]) for d in (0, 1)], axis=2)
    p = softmax_(both @ net.out + net.bias)
    n = max(mask.sum(), 1)
    lanes = np.arange(data.shape[1])
    loss = -(np.log(p[:, lanes, labels] + 1e-12) * mask).sum() / n
    error = p
    error[:, lanes, labels] -= 1
    error *= (mask / n)[:, :, None]
    flat = error.reshape(-1, error.shape[2])
    g_out, g_bias = both.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0)
    into = error @ net.out.T
    grads: dict[str, list] = {k: [] for k in ("gate", "candidate", "gate_state", "candidate_state")}
    for d in (0, 1):
        g = [np.zeros_like(x[d]) for x in (net.gate, net.candidate, net.gate_state, net.candidate_state)]
        carry = np.zeros_like(kept[d][0][1])
        for t, h, f, c, r in reversed(kept[d]):
            dh = carry + into[t, :, d * hidden : (d + 1) * hidden]
            dc = dh * f * (1 - c * c)
            dr = dc @ net.candidate_state[d].T
            df = (dh * (c - h) + dr * h) * f * (1 - f)
            np.add.at(g[0], data[t], df)
            np.add.at(g[1], data[t], dc)
            g[2] += h.T @ df
            g[3] += r.T @ dc
            carry = dh * (1 - f) + dr * f + df @ net.gate_state[d].T
        for k, x in zip(grads, g, strict=True):
            grads[k].append(x)
    return float(loss), [x for k in grads for x in grads[k]] + [g_out, g_bias]


def windows_of(texts: Sequence[str], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the texts as (windows, width), the text of each window, and how many bytes it really has."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    n = -(-size // width)
    of = np.repeat(np.arange(len(raw)), n)
    data = np.frombuffer(b"".join(r.ljust(k * width, b"\0") for r, k in zip(raw, n.tolist(), strict=True)), np.uint8)
    first = np.repeat(np.cumsum(n) - n, n)
    used = np.minimum(size[of] - (np.arange(len(of)) - first) * width, width)
    return data.reshape(-1, width), of, used


def document_probabilities(net: Network, texts: Sequence[str]) -> np.ndarray:
    """The mean over all positions of each text; zeros for an empty one."""
    total = np.zeros((len(texts), len(net.languages)))
    count = np.zeros(len(texts))
    for part in blocks(texts, WINDOW * LANES):
        data, of, used = windows_of(texts[part])
        for at in range(0, len(of), LANES):
            some = slice(at, at + LANES)
            p = position_probabilities(net, np.ascontiguousarray(data[some].T))
            p *= (np.arange(WINDOW)[:, None] < used[some][None, :])[:, :, None]
            np.add.at(total, of[some] + part.start, p.sum(axis=0))
            np.add.at(count, of[some] + part.start, used[some])
    return total / np.maximum(count, 1)[:, None]


def spread_windows(text: str, width: int, most: int) -> bytes:
    """At most ``most`` windows spread evenly over the text's bytes, padded to ``width``."""
    raw = text.encode("utf-8", "replace")
    n = -(-len(raw) // width)
    every = max(n // most, 1)
    return b"".join(raw[i * width : (i + 1) * width].ljust(width, b"\0") for i in range(0, n, every)[:most])


def fit(windows: Sequence[bytes], languages: Sequence[str], width: int = 64, hidden: int = 8, epochs: int = 12) -> Network:
    """Trained on windows of ``width`` bytes; each element of ``windows`` has those of one text."""
    known = sorted(set(languages))
    net = new_network(known, hidden)
    data = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, width)
    if not len(data):
        return replace(net, languages=[])
    labels = np.repeat([known.index(x) for x in languages], [len(w) // width for w in windows])
    used = np.where((data != 0).any(axis=1), width - (data[:, ::-1] != 0).argmax(axis=1), 0)
    rng = np.random.default_rng(5)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in net.parameters()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            mask = (np.arange(width)[:, None] < used[rows][None, :]).astype(np.float32)
            _, grads = gradients(net, np.ascontiguousarray(data[rows].T), labels[rows], mask)
            step += 1
            rate = 0.02 * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, (m, v) in zip(net.parameters(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * m / (np.sqrt(v) + 1e-8)
    return net


def train(docs: DataFrame, sample: int = 1_500, width: int = 64, per_text: int = 4) -> Network:
    """A network learned from ``per_text`` windows of each of at most ``sample`` documents with text, lang and id.

    They are those of the smallest hashed ids, which are few enough to broadcast; of an id that
    repeats one row counts.
    """
    known = docs.select("doc_id", "text", "lang").where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    ids = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    @F.pandas_udf("binary")
    def spread(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: spread_windows(t, width, per_text))

    chosen = known.join(F.broadcast(ids), "doc_id")
    one = F.min_by(F.struct("lang", "text"), F.struct(F.xxhash64("text"), "lang")).alias("one")
    rows = chosen.groupBy("doc_id").agg(one).select("one.lang", spread("one.text").alias("windows")).collect()
    rows.sort(key=lambda r: (r["windows"], r["lang"]))
    return fit([bytes(r["windows"]) for r in rows], [r["lang"] for r in rows], width)


def has_letter(text: str) -> bool:
    """Whether a character is a letter; digits, fractions, number forms and signs are none."""
    return bool(_PLAIN.search(text)) or any(map(str.isalpha, text))


def predictor(net: Network):
    def predict(texts: Sequence[str]) -> pd.DataFrame:
        lettered = np.array([has_letter(t) for t in texts], np.bool_) & bool(net.languages)
        language, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if lettered.any():
            chosen = np.flatnonzero(lettered)
            p = document_probabilities(net, [texts[i] for i in chosen])
            language[chosen] = np.array(net.languages, object)[p.argmax(axis=1)]
            score[chosen] = p.max(axis=1)
        return pd.DataFrame({"lang_pred": language, "score": score.clip(0, 1)})

    return predict


def identify_language(docs: DataFrame, net: Network) -> DataFrame:
    """The documents with columns ``lang_pred`` and ``score``, which replace those of that name."""
    ship(docs.sparkSession)
    both = text_udf(docs.sparkSession, predictor, net, "lang_pred string, score double")("text")
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = fresh(*kept)
    return docs.select(*kept, both.alias(found)).select(*kept, f"{found}.*")

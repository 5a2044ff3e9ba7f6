"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded; a gated attention layer weighs the
passages, and the document's score is a logistic function of their weighted sum. Only documents have
labels: which passages matter is learnt with the rest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import appended, small_batches, staged, text_of, with_arrays

WORDS = 64  # of a passage
BUCKETS = 4096
DENSE = 3
#: Bytes of text whose passages are encoded at a time.
STEP = 1 << 19


def _classes() -> np.ndarray:
    """Shape classes of bytes: 0 blank, 1 line end, 2 small, 3 capital, 4 digit, 5 beyond ASCII, 6 control, then punctuation."""
    out = np.full(256, 6, np.uint8)
    out[[32, 9]], out[[10, 11, 12, 13]] = 0, 1
    out[97:123], out[65:91], out[48:58], out[128:] = 2, 3, 4, 5
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    out[marks] = 7 + np.arange(len(marks)) % 25
    return out


CLASS = _classes()
#: Bucket of the shapes of three bytes (five bits each).
BUCKET_OF = ((np.arange(1 << 15, dtype=np.uint64) * np.uint64(0x9E3779B1) % np.uint64(1 << 32)) >> np.uint64(20)).astype(np.int64)


@dataclass
class Bags:
    """Passages of some texts: where each begins among all bytes, whose it is, and its dense features."""

    raw: np.ndarray
    ends: np.ndarray  # of the texts
    first: np.ndarray
    text: np.ndarray
    dense: np.ndarray

    def matrix(self, low: int, high: int) -> np.ndarray:
        """Square roots of the shares of the shape trigrams of passages ``low`` to ``high``. A trigram belongs to the passage in
        which it begins; none reaches into another text."""
        begin = int(self.first[low])
        end = int(self.first[high]) if high < len(self.first) else len(self.raw)
        owner = np.repeat(np.arange(high - low), np.diff(np.append(self.first[low:high], end)))
        cls = CLASS[self.raw[begin : end + 2]].astype(np.int64)
        n = min(len(owner), max(0, len(cls) - 2))
        bucket = BUCKET_OF[cls[:n] << 10 | cls[1 : n + 1] << 5 | cls[2 : n + 2]]
        inside = np.ones(n, bool)
        for back in (1, 2):
            at = self.ends - back - begin
            inside[at[(at >= 0) & (at < n)]] = False
        counts = np.bincount(owner[:n][inside] * BUCKETS + bucket[inside], minlength=(high - low) * BUCKETS).reshape(high - low, BUCKETS)
        return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1), dtype=np.float32)

    def steps(self) -> Iterator[tuple[int, int]]:
        """Ranges of passages of at most ``STEP`` bytes each, or one passage."""
        at, most = 0, max(1, STEP * 16 // BUCKETS)
        while at < len(self.first):
            to = int(np.searchsorted(self.first, self.first[at] + STEP, side="right"))
            to = min(max(to, at + 1), at + most, len(self.first))
            yield at, to
            at = to


def bags(texts: pa.Array) -> Bags:
    """Passages of whole texts; a text without words has one."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    ends -= ends[0]
    starts = ends[:-1]
    word = CLASS[raw] > 1
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    edge = starts[starts < len(raw)]
    before[edge] = False
    after[edge[edge > 0] - 1] = False
    at, stop = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    text = np.searchsorted(starts, at, side="right") - 1
    per_text = np.bincount(text, minlength=len(starts))
    number = np.arange(len(at)) - np.repeat(np.cumsum(per_text) - per_text, per_text)  # of the word in its text
    n_passages = np.maximum(1, -(-per_text // WORDS))
    base = np.cumsum(n_passages) - n_passages
    passage = base[text] + number // WORDS if len(at) else at
    total = int(n_passages.sum())
    first = np.repeat(starts, n_passages)
    inner = (number % WORDS == 0) & (number > 0)
    first[passage[inner]] = at[inner]

    offsets = np.zeros(len(at) + 1, np.int32)
    np.cumsum(stop - at, out=offsets[1:])
    ids = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(raw[word])]).dictionary_encode().indices.to_numpy().astype(np.int64)
    n = np.bincount(passage, minlength=total)
    again = (ids[1:] == ids[:-1]) & (passage[1:] == passage[:-1])
    repeats = np.bincount(passage[1:][again], minlength=total)
    distinct = np.bincount(pd.unique(passage * (ids.max() + 1) + ids) // (ids.max() + 1), minlength=total) if len(ids) else n
    of = np.maximum(n, 1)
    dense = np.stack([repeats / of, 1 - distinct / of, n / WORDS], axis=1).astype(np.float32)
    return Bags(raw, ends[1:], first, np.repeat(np.arange(len(starts)), n_passages), dense)


@dataclass
class Weights:
    """encoder (trigrams, dense features, bias), the attention's two gates and weight, and the classifier."""

    tri: np.ndarray
    dense: np.ndarray
    bias: np.ndarray
    gate_tanh: np.ndarray
    gate_sigm: np.ndarray
    attend: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def arrays(w: Weights) -> list[np.ndarray]:
    """The weights themselves, no copies."""
    return [getattr(w, f.name) for f in fields(w)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def start_weights(hidden: int, gates: int, seed: int) -> Weights:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
    return Weights(
        draw(BUCKETS, hidden) * np.sqrt(BUCKETS) * 0.3, draw(DENSE, hidden), np.zeros(hidden), draw(hidden, gates), draw(hidden, gates), draw(gates), draw(hidden), np.zeros(1),
    )


def softmax_by(g: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Softmax of ``g`` within each document."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, doc, g)
    e = np.exp(g - top[doc])
    return e / np.bincount(doc, e, minlength=n)[doc]


def sums_by(x: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, x.shape[1]))
    np.add.at(out, doc, x)
    return out


def encode(w: Weights, tri: np.ndarray, dense: np.ndarray) -> np.ndarray:
    return np.tanh(tri @ w.tri + dense @ w.dense + w.bias)


def attention(w: Weights, h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Attention of every passage and the documents' logits."""
    a = softmax_by((np.tanh(h @ w.gate_tanh) * sigmoid(h @ w.gate_sigm)) @ w.attend, doc, n)
    return a, sums_by(a[:, None] * h, doc, n) @ w.out + w.out_bias


def loss_and_gradients(w: Weights, tri: np.ndarray, dense: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, Weights]:
    """Weighted log loss over the documents ``y`` and its gradient."""
    n = len(y)
    h = encode(w, tri, dense)
    t, s = np.tanh(h @ w.gate_tanh), sigmoid(h @ w.gate_sigm)
    a = softmax_by((t * s) @ w.attend, doc, n)
    z = sums_by(a[:, None] * h, doc, n)
    logit = z @ w.out + w.out_bias
    loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum())
    d = weight * (sigmoid(logit) - y)
    dz = d[:, None] * w.out
    da = (h * dz[doc]).sum(axis=1)
    dg = a * (da - np.bincount(doc, a * da, minlength=n)[doc])
    dts = dg[:, None] * w.attend
    dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
    dh = a[:, None] * dz[doc] + dt @ w.gate_tanh.T + ds @ w.gate_sigm.T
    dpre = dh * (1 - h * h)
    return loss, Weights(tri.T @ dpre, dense.T @ dpre, dpre.sum(axis=0), h.T @ dt, h.T @ ds, (t * s).T @ dg, z.T @ d, np.array([d.sum()]))


def train(docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, hidden: int, gates: int, epochs: int, rate: float, decay: float, seed: int, batch: int = 32) -> Weights:
    """Adam over batches of documents in the form of ``sparse``; the two labels weigh the same in all."""
    w, rng = start_weights(hidden, gates, seed), np.random.default_rng(seed)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    m, v, step = [np.zeros_like(x) for x in arrays(w)], [np.zeros_like(x) for x in arrays(w)], 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            pick = order[k : k + batch]
            sizes = [len(docs[i][2]) for i in pick]
            base = np.cumsum(sizes) - sizes
            tri = np.zeros((sum(sizes), BUCKETS))
            for b, i in zip(base, pick, strict=True):
                cells, values, _ = docs[i]
                tri.reshape(-1)[cells + b * BUCKETS] = values
            dense = np.concatenate([docs[i][2] for i in pick])
            _, grad = loss_and_gradients(w, tri, dense, np.repeat(np.arange(len(pick)), sizes), y[pick].astype(float), share[pick] / len(pick))
            step += 1
            for x, g, mm, vv in zip(arrays(w), arrays(grad), m, v, strict=True):
                g += decay * x
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                x -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return w


def sparse(text: str, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-zero cells of a text's passages, their values, and the dense features; of more than ``most`` passages as many, evenly spaced."""
    b = bags(pa.array([text], pa.string()))
    pick = np.unique(np.linspace(0, len(b.first) - 1, min(most, len(b.first))).astype(int))
    cells, values = [], []
    for k, p in enumerate(pick):
        row = b.matrix(int(p), int(p) + 1)[0]
        at = np.flatnonzero(row)
        cells.append(at + k * BUCKETS)
        values.append(row[at])
    return np.concatenate(cells), np.concatenate(values), b.dense[pick]


@dataclass
class QualityModel:
    """``weights`` are None if there were no labels of both kinds; ``prior`` is the labels' log odds."""

    weights: Weights | None
    prior: float

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text; then the attention of all passages and whose they are."""
        b = bags(texts)
        if self.weights is None:
            return np.full(len(texts), sigmoid(np.array(self.prior))), np.ones(len(b.text)), b.text
        w = self.weights
        h = np.concatenate([encode(w, b.matrix(i, j), b.dense[i:j]) for i, j in b.steps()] or [np.zeros((0, len(w.out)))])
        a, logit = attention(w, h, b.text, len(texts))
        return sigmoid(logit + self.prior), a, b.text


def fit_quality(
    docs: DataFrame, labels: DataFrame, usable: Column, text: str = "text", key: str = "doc_id", label: str = "quality", per_class: int = 1000, passages: int = 32,
    hidden: int = 16, gates: int = 8, epochs: int = 12, rate: float = 0.01, decay: float = 1e-5, seed: int = 1,
) -> QualityModel:
    """Learn from the documents whose ``key`` is labelled 0 or 1 in ``labels``, where ``usable`` (over ``key``) holds.

    A key labelled both ways is left out; of several rows with one key the least text counts. Training sees at
    most ``per_class`` keys of each label, those of the smallest hashes, and at most ``passages`` passages of a
    document, evenly spaced; it runs in one task, whose input these numbers bound. The share of the labels
    among all labelled keys sets the prior. Two counts and the weights come to the driver.
    """
    known = labels.where(usable & F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("y"), F.max(label).alias("other"))
    known = staged(known.where(F.col("y") == F.col("other")).select(F.col(key).alias("k"), F.col("y").cast("int").alias("y")), "mil-labels")
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = float(np.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1)))
    if not n.get(0) or not n.get(1):
        return QualityModel(None, prior)
    picked = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    # the broadcast side has at most 2 * per_class rows
    rows = docs.select(F.col(key).alias("k"), text_of(text).alias("text")).join(F.broadcast(picked), "k")
    rows = rows.groupBy("k", "y").agg(F.min("text").alias("text"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = sorted((int(y), t) for part in batches for y, t in zip(part["y"], part["text"], strict=True))
        if len({y for y, _ in seen}) == 2:
            y = np.array([s[0] for s in seen])
            w = train([sparse(t, passages) for _, t in seen], y, hidden, gates, epochs, rate, decay, seed)
            yield pd.DataFrame({"name": [f.name for f in fields(w)], "shape": [list(x.shape) for x in arrays(w)], "cells": [x.astype(np.float32).tobytes() for x in arrays(w)]})

    got = {r["name"]: np.frombuffer(r["cells"], np.float32).reshape(r["shape"]) for r in rows.select("y", "text").repartition(1).mapInPandas(learn, "name string, shape array<int>, cells binary").collect()}
    return QualityModel(Weights(**got) if got else None, prior)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", keep: Sequence[str] = ("doc_id",), least: float = 0.3) -> DataFrame:
    """``keep`` columns, ``score`` (how likely the label is 1) and ``predicted`` (1 from ``least`` on) of every whole text.

    Every passage of a text is encoded, however long the text; a null text is empty, and an empty one has one empty passage.
    Repeated rows get equal results; a ``keep`` column named like a result gives way. Memory: one batch of texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = appended(docs.select(*keep), "score double, predicted int")
    kept = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, len(keep), 2 << 20):
            score, _, _ = shared.value.scores(batch.column(len(keep)))
            yield with_arrays(batch, kept, [pa.array(score, pa.float64()), pa.array((score >= least).astype(np.int32), pa.int32())], ["score", "predicted"])

    return docs.select(*keep, text_of(text).alias("_text")).mapInArrow(run, schema)

"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams,
trained with follow-the-regularised-leader (elastic net), calibrated by temperature."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import appended, small_batches, text_of, with_arrays

BITS = 17
BUCKETS = 1 << BITS
LETTER = re.compile(r"[^\W\d_]")
#: Characters of a text that are turned into n-grams at a time.
STEP = 1 << 20
#: Term frequencies are shares of a text's n-grams; this brings them near one.
SCALE = 32.0


def codepoints(text: str) -> np.ndarray:
    """Code points of the lower-case text between two spaces; what is no letter in ASCII is a space."""
    points = np.frombuffer(("  " + text.lower() + "  ").encode("utf-32-le"), np.uint32).copy()
    points[(points < 97) | ((points > 122) & (points < 128))] = 32
    return points


def gram_buckets(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams of 1, 2 and 3 characters that start at each but the last two places."""
    mix, shift = np.uint32(0x85EBCA6B), np.uint32(32 - BITS)
    h1 = points[:-2] * np.uint32(0x9E3779B1)
    h2 = (h1 ^ (points[1:-1] + np.uint32(0x7F4A7C15))) * mix
    h3 = (h2 ^ (points[2:] + np.uint32(0x2545F491))) * np.uint32(0xC2B2AE35)
    return (h1 * mix) >> shift, (h2 * np.uint32(0x27D4EB2F)) >> shift, (h3 * np.uint32(0x165667B1)) >> shift


def steps(text: str) -> Iterator[np.ndarray]:
    """Code points of a long text in parts that share no n-gram and leave out none."""
    for at in range(0, max(1, len(text)), STEP):
        part = text[at : at + STEP + 2]
        points = codepoints(part)
        left, right = (2 if at else 0), (2 if at + STEP < len(text) else 0)
        yield points[left : len(points) - right]


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text, ascending, and their counts."""
    total = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for points in steps(text):
        got = np.unique(np.concatenate(gram_buckets(points)), return_counts=True)
        if len(total[0]):
            keys, at = np.unique(np.concatenate([total[0], got[0]]), return_inverse=True)
            got = keys, np.bincount(at, np.concatenate([total[1], got[1]])).astype(np.int64)
        total = got
    return total


def has_letter(text: str | None) -> bool:
    return text is not None and LETTER.search(text) is not None


@dataclass
class LanguageModel:
    """``weights`` are those of the n-gram shares (idf and scale within), ``bias`` the classes'."""

    classes: list[str]
    weights: np.ndarray  # (BUCKETS, classes) float32
    bias: np.ndarray
    temperature: float

    def logits(self, texts: list[str]) -> np.ndarray:
        """Raw scores (texts, classes)."""
        out = np.zeros((len(texts), len(self.classes)))
        for first in range(0, len(texts), 64):
            group = texts[first : first + 64]
            if sum(map(len, group)) <= STEP:
                points = [codepoints(t) for t in group]
                lens = np.array([len(p) - 2 for p in points])
                self._add(out[first : first + len(group)], np.concatenate(points), lens)
            else:
                for k, text in enumerate(group):
                    n, total = 0, np.zeros(len(self.classes))
                    for part in steps(text):
                        total += self._sums(part)
                        n += len(part) - 2
                    out[first + k] = total / (3 * n)
        return (out + self.bias) / self.temperature

    def _sums(self, points: np.ndarray) -> np.ndarray:
        return sum(self.weights[h].sum(axis=0, dtype=np.float64) for h in gram_buckets(points))

    def _add(self, out: np.ndarray, points: np.ndarray, lens: np.ndarray) -> None:
        # each text has lens + 2 places; the n-grams of its last two places reach into the next text
        score = sum(self.weights[h] for h in gram_buckets(points))
        begin = np.cumsum(lens + 2) - (lens + 2)
        edges = np.empty(2 * len(lens), np.int64)
        edges[0::2], edges[1::2] = begin, begin + lens
        edges[-1] = min(edges[-1], len(score))
        whole = np.concatenate([score, np.zeros((1, score.shape[1]), score.dtype)])
        out[:] = np.add.reduceat(whole.astype(np.float64), edges, axis=0)[0::2] / (3 * lens[:, None])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and calibrated probabilities; ``und`` and 0 for a text that is null or has no letter."""
        sure = [has_letter(t) for t in texts]
        if not self.classes:
            return ["und"] * len(texts), np.zeros(len(texts))
        z = self.logits([t if ok else "" for t, ok in zip(texts, sure, strict=True)])
        p = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        p = p / p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1) if len(p) else []
        return (
            [self.classes[b] if ok else "und" for b, ok in zip(best, sure, strict=True)],
            np.array([p[i, b] if ok else 0.0 for i, (b, ok) in enumerate(zip(best, sure, strict=True))]),
        )


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for softmax regression with elastic net; the bias, in the last row, isn't penalised."""
    z, n = np.zeros((BUCKETS + 1, n_classes)), np.zeros((BUCKETS + 1, n_classes))

    def weights(at: np.ndarray) -> np.ndarray:
        bound = np.where(at == BUCKETS, 0.0, l1)[:, None]
        zz = z[at]
        return np.where(np.abs(zz) <= bound, 0.0, -(zz - np.sign(zz) * bound) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for (at, x), y in zip(rows, labels, strict=True):
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            n1 = n[at] + g * g
            z[at] += g - (np.sqrt(n1) - np.sqrt(n[at])) / alpha * w
            n[at] = n1
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def temperature_of(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood: golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]))

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all rows of the column ``text``, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen, mark = np.zeros(BUCKETS + 1, np.int64), 0, np.zeros(BUCKETS, np.uint8)
        for batch in small_batches(batches, 0):
            for text in batch.column(0).to_pylist():
                seen += 1
                if len(text) > 3000:
                    for points in steps(text):
                        for h in gram_buckets(points):
                            mark[h] = 1
                    df[:-1] += mark
                    mark[:] = 0
                else:
                    df[counts(text)[0]] += 1
        df[-1] = seen
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], names=["bucket", "df"])

    total = rows.mapInArrow(run, "bucket int, df bigint").groupBy("bucket").agg(F.sum("df").alias("df"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in total.toLocalIterator():  # at most BUCKETS + 1 rows, whatever the input
        out[r["bucket"]] = r["df"]
    return out[:-1], int(out[-1])


def fit_language(
    docs: DataFrame, usable: Column, text: str = "text", label: str = "lang", key: str = "doc_id", per_class: int = 400,
    epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1,
) -> LanguageModel:
    """Learn from the rows where ``usable`` holds and the label isn't null.

    Document frequencies cover all of them. FTRL and the calibration see a bounded sample: about
    ``per_class`` rows of each label (all, if it has fewer), chosen by a hash of key and text
    against the label's count of different rows (of repeated rows the sample holds one), a quarter of them for the calibration only. One task trains on
    the sample; what comes to the driver is the model and the frequencies, bounded by the
    number of buckets. Without any row the model has no classes and says ``und``.
    """
    rows = docs.where(usable & F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("label"), text_of(text).alias("text"), F.xxhash64(F.col(key)).alias("h")
    ).withColumn("draw", F.xxhash64("h", "text"))
    by_label = {r["label"]: r["n"] for r in rows.select("label", "draw").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(by_label)
    if not classes:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    df, n = document_frequencies(rows.select("text"))
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    limit = F.lit(None).cast("double")
    for c in classes:
        limit = F.when(F.col("label") == c, F.lit(min(1.0, per_class / by_label[c]))).otherwise(limit)
    share = F.pmod("draw", F.lit(1 << 30)) / F.lit(float(1 << 30))
    number = {c: k for k, c in enumerate(classes)}

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [(int(h), number[y], t) for part in batches for y, t, h in zip(part["label"], part["text"], part["h"], strict=True)]
        seen.sort(key=lambda r: (r[0], r[1], len(r[2]), r[2]))
        rows, labels = [], np.array([r[1] for r in seen], int)
        for _, _, body in seen:
            at, k = counts(body)
            rows.append((at.astype(np.int64), k / k.sum() * idf[at] * SCALE))
        aside = np.array([r[0] >> 8 & 3 == 0 for r in seen]) if len(seen) > 40 else np.zeros(len(seen), bool)
        w, b = ftrl([r for r, x in zip(rows, aside, strict=True) if not x], labels[~aside], len(classes), epochs, alpha, beta, l1, l2)
        held = np.array([x @ w[at] + b for (at, x), z in zip(rows, aside, strict=True) if z]).reshape(-1, len(classes))
        at, c = np.nonzero(w)
        yield pd.DataFrame({"bucket": at, "class": c, "weight": w[at, c]})
        yield pd.DataFrame({"bucket": -1, "class": np.arange(len(classes)), "weight": b})
        yield pd.DataFrame({"bucket": [-2], "class": [0], "weight": [temperature_of(held, labels[aside])]})

    sample = rows.where(share < limit).dropDuplicates(["label", "draw"]).select("label", "text", "h").repartition(1)
    weights, bias, temperature = np.zeros((BUCKETS, len(classes)), np.float64), np.zeros(len(classes)), 1.0
    got = sample.mapInPandas(train, "bucket int, class int, weight double").toPandas()
    at = got["bucket"] >= 0
    weights[got["bucket"][at], got["class"][at]] = got["weight"][at]
    bias[got["class"][got["bucket"] == -1]] = got["weight"][got["bucket"] == -1]
    temperature = float(got["weight"][got["bucket"] == -2].iloc[0])
    return LanguageModel(classes, (weights * (idf * SCALE)[:, None] * 3).astype(np.float32), bias, temperature)


def predict_language(docs: DataFrame, model: LanguageModel, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (the calibrated probability) of every whole text.

    A text that is null or has no letter gets ``und`` and 0; equal scores go to the first label
    in order; repeated rows get equal results. A ``keep`` column named like a result gives way.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = appended(docs.select(*keep), "lang_pred string, score double")
    kept = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, len(keep), 4 << 20):
            langs, scores = shared.value.predict(batch.column(len(keep)).to_pylist())
            yield with_arrays(batch, kept, [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return docs.select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def filter_language(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents with a language and a probability of at least ``least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, at, 4 << 20):
            langs, scores = shared.value.predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array([x != "und" and s >= least for x, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

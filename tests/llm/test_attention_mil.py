import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.llm import attention_mil as mil
from tandem.llm import queries
from tandem.llm.common import table

TEXTS = ["", " ", "one", "a b\nc\td", "É日本 x! " * 40, "word " * 64, "word " * 65, "x" * 300, "A1 b2, " * 200, "\x00 \x07z", "tail\n\n\n", "  lead and " * 30, "no space at the end of it"]


def plain_passages(text):
    """(bytes, trigram counter, dense) of each passage, step by step."""
    raw = text.encode()
    spans = [m.span() for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", raw)]
    cuts = [0] + [spans[k][0] for k in range(mil.WORDS, len(spans), mil.WORDS)]
    out = []
    for n, begin in enumerate(cuts):
        end = cuts[n + 1] if n + 1 < len(cuts) else len(raw)
        grams = Counter(int(mil.BUCKET_OF[int(mil.CLASS[raw[i]]) << 10 | int(mil.CLASS[raw[i + 1]]) << 5 | int(mil.CLASS[raw[i + 2]])]) for i in range(begin, min(end, len(raw) - 2)))
        words = [raw[a:b] for a, b in spans[n * mil.WORDS : (n + 1) * mil.WORDS]]
        again = sum(x == y for x, y in zip(words, words[1:], strict=False))
        k = max(1, len(words))
        out.append((grams, [again / k, 1 - len(set(words)) / k, len(words) / mil.WORDS]))
    return out


def test_passages_equal_plain_ones():
    b = mil.bags(pa.array(TEXTS))
    want = [(k, *p) for k, t in enumerate(TEXTS) for p in plain_passages(t)]
    assert b.text.tolist() == [w[0] for w in want]
    n_words = [len(re.findall(rb"[^ \t\n\x0b\x0c\r]+", t.encode())) for t in TEXTS]
    got = np.concatenate([b.matrix(i, j) for i, j in b.steps()])
    assert len(got) == len(want)
    for row, dense, (k, grams, expected) in zip(got, b.dense, want, strict=True):
        total = sum(grams.values())
        plain = np.zeros(mil.BUCKETS)
        for g, c in grams.items():
            plain[g] = (c / total) ** 0.5
        np.testing.assert_allclose(row, plain, atol=1e-6)
        # a text without words has distinct words of none
        np.testing.assert_allclose(dense, expected if n_words[k] else [0, 1, 0], atol=1e-6)
    np.testing.assert_array_equal(np.concatenate([b.matrix(i, i + 1) for i in range(len(b.first))]), got)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    w = mil.start_weights(4, 3, 5)
    tri, dense, doc = rng.random((9, mil.BUCKETS)) * (rng.random((9, mil.BUCKETS)) < 0.01), rng.random((9, mil.DENSE)), np.array([0, 0, 0, 1, 2, 2, 3, 3, 3])
    y, weight = np.array([1.0, 0, 1, 0]), np.array([0.1, 0.4, 0.2, 0.3])
    _, grad = mil.loss_and_gradients(w, tri, dense, doc, y, weight)
    for x, g in zip(mil.arrays(w), mil.arrays(grad), strict=True):
        assert x.shape == g.shape
        for at in {0, x.size - 1, int(np.abs(g).argmax()), *rng.integers(0, x.size, 4).tolist()}:
            cell, old = x.reshape(-1), x.reshape(-1)[at]
            cell[at] = old + 1e-5
            up, _ = mil.loss_and_gradients(w, tri, dense, doc, y, weight)
            cell[at] = old - 1e-5
            down, _ = mil.loss_and_gradients(w, tri, dense, doc, y, weight)
            cell[at] = old
            assert abs((up - down) / 2e-5 - g.reshape(-1)[at]) < 1e-6


def test_attention_is_a_softmax_per_document():
    w = mil.start_weights(4, 3, 5)
    model = mil.QualityModel(w, 0.3)
    scores, a, doc = model.scores(pa.array(TEXTS))
    np.testing.assert_allclose(np.bincount(doc, a), np.ones(len(TEXTS)))
    # neighbours don't matter
    alone = [model.scores(pa.array([t]))[0][0] for t in TEXTS]
    np.testing.assert_allclose(scores, alone, atol=1e-6)
    long = "Plain words of a text. " * 200_000
    assert abs(model.scores(pa.array([long]))[0][0] - model.scores(pa.array([long[: 23 * 64 * 100]]))[0][0]) < 1e-3


def test_held_out_accuracy_and_untouched_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op13_quality_classifier(spark, sf).toPandas()
    assert len(rows) == table(spark, sf, "documents").count() and rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.3)).all()
    both = rows.merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert len(held) > 500 and (held.predicted == held.quality).mean() > 0.98


def test_learning_leaves_out_held_rows(spark, odd, empty):
    docs = spark.createDataFrame([(k, ("plain text here. " if k % 2 else "### *** $$$ ") * (k % 7 + 1)) for k in range(120)], "doc_id bigint, text string")
    y = spark.range(120).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    usable = F.col("doc_id") % 5 != 0
    flipped = y.withColumn("quality", F.when(usable, F.col("quality")).otherwise(1 - F.col("quality")))
    one, two = (mil.fit_quality(docs, labels, usable, epochs=3) for labels in (y, flipped))
    assert all((a == b).all() for a, b in zip(mil.arrays(one.weights), mil.arrays(two.weights), strict=True)) and one.prior == two.prior
    got = mil.score_quality(docs, one).collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.95
    # contrary labels and repeated rows
    twice = y.unionByName(y).unionByName(spark.createDataFrame([(1, 0), (None, 1), (7, None)], "doc_id bigint, quality int"))
    assert mil.fit_quality(docs.unionByName(docs), twice, usable, epochs=1).weights is not None
    assert mil.score_quality(odd, one, keep=("doc_id", "ids")).columns == ["doc_id", "ids", "score", "predicted"]
    rows = mil.score_quality(odd, one).collect()
    assert len(rows) == 9 and len({r.score for r in rows if r.doc_id == 4}) == 1
    assert mil.score_quality(empty, one).count() == 0
    none = mil.fit_quality(docs, y.where("quality = 1"), usable)
    assert none.weights is None
    assert [r.score for r in mil.score_quality(odd, none).collect()] == pytest.approx([float(mil.sigmoid(np.array(none.prior)))] * 9)

import math
from collections import Counter

import pytest

from tandem.operators.bleu import corpus_bleu
from tandem.operators.vectors import explode_chunks, vector_mean


def plain_bleu(pairs, max_n=4):
    m = [0] * max_n
    t = [0] * max_n
    c = r = 0
    for h, ref in pairs:
        h, ref = h.split(), ref.split()
        c += len(h)
        r += len(ref)
        for n in range(1, max_n + 1):
            hg = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
            rg = Counter(tuple(ref[i:i + n]) for i in range(len(ref) - n + 1))
            m[n - 1] += sum(min(v, rg[g]) for g, v in hg.items())
            t[n - 1] += sum(hg.values())
    ps = [m[i] / t[i] if t[i] else 0.0 for i in range(max_n)]
    bp = 1.0 if c > r else math.exp(1 - r / c)
    return 0.0 if min(ps) <= 0 else bp * math.exp(sum(math.log(p) for p in ps) / max_n)


def test_bleu_matches_plain_python(spark):
    pairs = [
        ("the cat sat on the mat today", "the cat sat on a mat today"),
        ("a b c d e f", "a b c d e g h"),
        ("hello there general kenobi", "hello there general kenobi"),
    ]
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "id long, hyp string, ref string")
    got = corpus_bleu(df).first()
    assert got.bleu == pytest.approx(round(plain_bleu(pairs), 6), abs=1e-6)


def test_vector_mean_and_completeness(spark):
    rows = [("m", "p", 1, [1.0, 2.0]), ("m", "p", 2, [3.0, 6.0]), ("m", "q", 1, [1.0]), ("m", "q", 2, [5.0]), ("m", "z", 2, [9.0])]
    df = spark.createDataFrame(rows, "grp string, name string, step long, w array<double>")
    out = {(r.name, r.dim): r.value for r in explode_chunks(vector_mean(df, chunk=1), "grp", "name", chunk=1).collect()}
    assert out == {("p", 0): 2.0, ("p", 1): 4.0, ("q", 0): 3.0}  # "z" is not in the first step
    bad = spark.createDataFrame(rows[:3], "grp string, name string, step long, w array<double>")
    with pytest.raises(ValueError):
        vector_mean(bad)


def test_bleu_shuffles_no_ngram_and_takes_odd_rows(spark):
    rows = [(1, "a a a a b", "a a b b"), (2, None, "x"), (3, "", ""), (4, "one", None), (5, "w " * 3000, "w v " * 2000)]
    df = spark.createDataFrame(rows, "id long, hyp string, ref string")
    out = corpus_bleu(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan  # the sums of the batches
    got = out.first()
    pairs = [(h or "", r or "") for _, h, r in rows]
    assert got.bleu == pytest.approx(round(plain_bleu(pairs), 6), abs=1e-6)
    assert (got.hyp_len, got.ref_len) == (sum(len(h.split()) for h, _ in pairs), sum(len(r.split()) for _, r in pairs))
    assert corpus_bleu(df.limit(0)).first().bleu == 0.0


def test_range_report_has_clipped_and_empty_ranges(spark):
    from tandem.operators.checks import range_report

    def ranges(ids, kept, gap):
        frame, some = (spark.createDataFrame([(i,) for i in x], "id long") for x in (ids, kept))
        return sorted(tuple(r) for r in range_report(frame, some, gap).select("range_start", "range_end", "rows_read", "rows_kept").collect())

    assert ranges([5, 6, 250, 104], [6], 100) == [(5, 105, 3, 1), (105, 205, 0, 0), (205, 251, 1, 0)]
    assert ranges([0, 199], [199], 100) == [(0, 100, 1, 0), (100, 200, 1, 1)]
    assert ranges([7], [], 100) == [(7, 8, 1, 0)]
    assert ranges([], [], 100) == []

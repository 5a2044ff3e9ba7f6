import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from tandem.functions.text import WORD_START
from tandem.operators import unigram as U
from tandem.operators.vocab import RESERVED_PIECES


def all_segmentations(model, word):
    """Every segmentation with its score, by trying all cuts."""
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:], strict=False)]
        scores = [model.scores.get(p, model.unknown if len(p) == 1 else None) for p in parts]
        if None not in scores:
            yield parts, sum(scores)


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(2)
    pieces = {"".join(rnd.choices("abc", k=rnd.randint(1, 4))) for _ in range(25)} | {"a", "b", WORD_START, WORD_START + "a"}
    return U.UnigramModel({p: -rnd.uniform(0.5, 6) for p in sorted(pieces)})


def test_forward_backward_and_best_equal_all_segmentations(model):
    rnd = random.Random(3)
    for _ in range(60):
        word = WORD_START + "".join(rnd.choices("abcz", k=rnd.randint(1, 8)))
        ways = list(all_segmentations(model, word))
        total = sum(math.exp(s) for _, s in ways)
        want = Counter()
        for parts, s in ways:
            for p in parts:
                want[p] += math.exp(s) / total
        got = Counter()
        for p, x in model.expected(word):
            got[p] += x
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
        best = max(s for _, s in ways)
        score = sum(model.scores.get(p, model.unknown) for p in model.best(word))
        assert "".join(model.best(word)) == word and abs(score - best) < 1e-9
        avoid = model.best(word)[0]
        others = [s for parts, s in ways if avoid not in parts]
        found = model.best(word, without=avoid)
        assert bool(found) == bool(others) and (not others or abs(sum(model.scores.get(p, model.unknown) for p in found) - max(others)) < 1e-9)


def test_digamma():
    assert abs(U.digamma(1) + 0.5772156649015329) < 1e-6 and abs(U.digamma(10.5) - 2.303001034) < 1e-6


WORDS = ["lower", "lowest", "newer", "newest", "wide", "wider", "widest", "low", "new", "lo", "é日", "lowlowlow"]


def plain_learn(counts, vocab_size, seeds, shrink, steps):
    """The same rules in one process."""
    want = vocab_size - len(RESERVED_PIECES)
    model = U.maximized({p: n * U.UNIT for p, n in seeds.items()}, want)
    while True:
        for _ in range(steps):
            total = Counter()
            for w, f in counts.items():
                for p, x in model.expected(WORD_START + w):
                    total[p] += f * round(x * U.UNIT)
            model = U.maximized({p: total[p] for p in model.scores}, want)
        if len(model.scores) <= want:
            return model
        size = max(want, int(len(model.scores) * shrink))
        size = want if size <= 1.1 * want else size
        used = Counter()
        for w, f in counts.items():
            for p in model.best(WORD_START + w):
                used[p] += f
        model = U.pruned(model, {p: n for p, n in used.items() if p in model.scores}, size)
        if size == want:
            return model


def test_learning_equals_one_process_and_hits_the_size(spark):
    rnd = random.Random(5)
    counts = {w: rnd.randint(1, 40) for w in WORDS + ["".join(rnd.choices("lowernstid", k=rnd.randint(2, 9))) for _ in range(80)]}
    subs = Counter()
    for w, f in counts.items():
        m = WORD_START + w
        for i in range(len(m)):
            for j in range(i + 1, min(len(m), i + 16) + 1):
                subs[m[i:j]] += f
    top = sorted(subs, key=lambda p: (-subs[p], p))[:200]
    seeds = {p: subs[p] for p in {*top, *[p for p in subs if len(p) == 1]}}
    want = plain_learn(counts, 60, seeds, 0.75, 2)
    for parts in (1, 7):
        frame = spark.createDataFrame(sorted(counts.items()), "word string, freq bigint").repartition(parts)
        vocab, model = U.learn_unigram_em(frame, 60, seed_size=200)
        assert model.scores == want.scores
        rows = {r.piece: r.score for r in vocab.collect()}
        assert len(rows) == 60 == vocab.count() and all(rows[p] == 0 for p in RESERVED_PIECES)
        assert {c for w in counts for c in WORD_START + w} <= set(rows)


def test_encoding_takes_any_word(spark, model):
    texts = [(1, "ab abc"), (2, None), (3, " \n "), (4, "zzz unseen　ab"), (5, "ab " * 3000)]
    got = {r.sid: r for r in U.encode_unigram(spark.createDataFrame(texts, "sid int, text string"), model).collect()}
    for sid, text in texts:
        want = [p for w in (text or "").split() for p in model.best(WORD_START + w)]
        assert got[sid].pieces == want and got[sid].n_pieces == len(want)
    plan = U.encode_unigram(spark.range(3).selectExpr("id as sid", "'ab' as text"), model, with_pieces=False)
    assert plan.columns == ["sid", "n_pieces"] and "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_lattices_of_many_words_equal_one_word_at_a_time(model):
    rnd = random.Random(7)
    words = [WORD_START + "".join(rnd.choices("abcz日\U0001f600", k=rnd.randint(1, 12))) for _ in range(300)] + ["", "z", WORD_START + "ab" * 3000]
    freq = np.array([rnd.randint(1, 50) for _ in words], np.int64)
    pieces = sorted({*model.scores, "zz", "abz"})  # two pieces have left the model
    trie = U.PieceTrie(pieces)
    scores = np.array([model.scores.get(p, math.nan) for p in pieces] + [model.unknown])
    lattice = U.Words(freq, *trie.edges(words), scores)
    want, used = Counter(), Counter()
    for word, f in zip(words, freq.tolist(), strict=True):
        for p, x in model.expected(word) if word else []:
            want[p] += f * x
        for p in model.best(word):
            used[p] += f
    got, paths = Counter(), Counter()
    for p, w, x in zip(lattice.piece.tolist(), lattice.word.tolist(), lattice.expected().tolist(), strict=True):
        got[p] += int(freq[w]) * x
    for piece, word in lattice.used():
        for p, w in zip(piece.tolist(), word.tolist(), strict=True):
            paths[p] += int(freq[w])
    for k, p in enumerate(pieces):
        assert abs(got[k] - want[p]) < 1e-6 and paths[k] == used[p], p
    odd = [p for p in used if p not in model.scores]
    assert odd and paths[len(pieces)] == sum(used[p] for p in odd)


def test_counts_alone_equal_the_pieces(spark, model):
    texts = [(1, "ab abc"), (2, None), (3, " \n "), (4, "zzz unseen\u3000ab \U0001f600"), (5, "ab " * 3000), (6, "a\x00b\x1cc")]
    frame = spark.createDataFrame(texts, "sid int, text string")
    want = {r.sid: r.n_pieces for r in U.encode_unigram(frame, model).collect()}
    assert {r.sid: r.n_pieces for r in U.encode_unigram(frame, model, with_pieces=False).collect()} == want
    counter = U.PieceCounter(model, most=3)  # a full memory changes nothing
    assert counter.of([(t or "").replace("\x00", " ") for _, t in texts]) == [want[k] for k, _ in texts]


def test_passes_read_stored_lattices(spark, model):
    """A pass over the words builds no lattice anew: it reads piece numbers, not words."""
    counts = spark.createDataFrame([("abca", 3), ("z", 2)], "word string, freq bigint")
    pieces = sorted(model.scores)
    lattice = U.lattices(counts, U.PieceTrie(pieces))
    assert lattice.columns == ["freq", "edges"]
    got = U.expected_counts(lattice, pieces, model)
    want = Counter()
    for word, f in (("abca", 3), ("z", 2)):
        for p, x in model.expected(WORD_START + word):
            want[p] += f * round(x * U.UNIT)
    assert {p: n for p, n in got.items() if n} == {p: n for p, n in want.items() if n and p in model.scores}
    assert U.segment_counts(lattice, pieces, model) == {p: n for p, n in Counter(
        p for w, f in (("abca", 3), ("z", 2)) for p in model.best(WORD_START + w) * f).items() if p in model.scores}

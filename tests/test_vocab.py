from collections import Counter

from pyspark.sql import functions as F

from tandem.operators.vocab import (
    encode,
    learn_bpe,
    learn_unigram,
    pair_counts,
    initial_symbols,
    parse_vocab_lines,
    substrings,
    to_trainer_vocab,
    word_counts,
)


def test_vocab_conversion_fixture(spark):
    lines = spark.createDataFrame([("<unk> 0",), ("▁a -1.5",), ("b",), ("c x",), ("d -20",)], "value string")
    out = {r.piece: r.freq for r in to_trainer_vocab(parse_vocab_lines(lines)).collect()}
    assert out == {"▁a": 223131, "d": 1}


def plain_bpe(counts, rounds):
    words = {w: ["▁"] + list(w) for w in counts}
    merges = []
    for _ in range(rounds):
        pc = Counter()
        for w, syms in words.items():
            for a, b in zip(syms, syms[1:]):
                pc[(a, b)] += counts[w]
        if not pc:
            break
        (a, b), f = min(pc.items(), key=lambda kv: (-kv[1], kv[0]))
        merges.append((a, b, f))
        for w, syms in words.items():
            out = []
            for s in syms:
                if out and out[-1] == a and s == b:
                    out[-1] = a + b
                else:
                    out.append(s)
            words[w] = out
    return merges, words


def test_bpe_matches_plain_python(spark):
    text = ["low lower lowest newer wider new new low aaa aaaa", "the then there lower low"]
    df = spark.createDataFrame([(t,) for t in text], "text string")
    wc = word_counts(df)
    counts = {r.word: r.freq for r in wc.collect()}
    merges, words = learn_bpe(wc, 8, checkpoint_every=3)
    want_m, want_w = plain_bpe(counts, 8)
    assert [(r.left, r.right, r.freq) for r in merges.orderBy("rank").collect()] == want_m
    assert {r.word: list(r.syms) for r in words.collect()} == want_w


def test_pair_counts_and_substrings(spark):
    wc = spark.createDataFrame([("ab", 2), ("b", 5)], "word string, freq long")
    pc = {(r.left, r.right): r.freq for r in pair_counts(wc.select("freq", initial_symbols(F.col("word")).alias("syms"))).collect()}
    assert pc == {("▁", "a"): 2, ("a", "b"): 2, ("▁", "b"): 5}
    subs = wc.select(substrings(F.col("word"), 8).alias("s")).collect()
    assert sorted(subs[0].s) == sorted(["a", "ab", "b"])


def test_unigram_and_encode(spark):
    text = ["the cat sat on the mat", "the cat ate the rat", "a cat"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "sid long, text string")
    wc = word_counts(df)
    vocab = learn_unigram(wc, 20, rounds=2, seed_size=40)
    pieces = {r.piece for r in vocab.collect()}
    assert {c for t in text for c in t.replace(" ", "")} <= pieces  # every character is kept
    _, words = learn_bpe(wc, 5)
    enc = {r.sid: r.pieces for r in encode(df, words, pieces_col="syms").collect()}
    for sid, t in enumerate(text):
        assert "".join(enc[sid]).replace("▁", " ").strip() == t


def test_multi_merge_rounds_equal_sequential(spark):
    import os

    path = "/root/testdata/sf0.001/documents.parquet"
    if os.path.exists(path):
        df = spark.read.parquet(path).select("text")
    else:
        df = spark.createDataFrame([("low lower lowest newer wider new the then there " * 3,)], "text string")
    wc = word_counts(df).checkpoint(eager=True)
    one_m, one_w = learn_bpe(wc, 40, checkpoint_every=10, max_merges_per_round=1)
    many_m, many_w = learn_bpe(wc, 40, checkpoint_every=3, max_merges_per_round=16)
    assert [tuple(r) for r in one_m.orderBy("rank").collect()] == [tuple(r) for r in many_m.orderBy("rank").collect()]
    assert {r.word: list(r.syms) for r in one_w.collect()} == {r.word: list(r.syms) for r in many_w.collect()}


def test_top_k_distributed_path_equals_sort_limit(spark):
    import random

    from tandem.operators.vocab import top_k

    rnd = random.Random(5)
    rows = [(f"w{rnd.randint(0, 5000)}x{i}", rnd.choice([1, 1, 1, 2, 3, 7, 50])) for i in range(3000)]
    df = spark.createDataFrame(rows, "word string, freq long").repartition(6)
    want = [tuple(r) for r in df.orderBy(F.col("freq").desc(), "word").limit(700).collect()]
    got = sorted((tuple(r) for r in top_k(df, 700).collect()), key=lambda t: (-t[1], t[0]))
    assert got == want


def plain_unigram(counts, vocab_size, rounds, seed_size, max_len=8):
    """Hard-EM unigram vocabulary in plain Python (the rule the Spark job implements)."""
    import math

    marked = {"▁" + w: f for w, f in counts.items()}
    subs = Counter()
    chars = Counter()
    for m, f in marked.items():
        for i in range(len(m)):
            chars[m[i]] += f
            for n in range(1, max_len + 1):
                if i + n <= len(m):
                    subs[m[i:i + n]] += f
    top = sorted(subs.items(), key=lambda kv: (-kv[1], kv[0]))[:seed_size]
    seed = dict(top)
    seed.update(chars)
    total = sum(seed.values())
    scores = {p: math.log(f / total) for p, f in seed.items()}
    for _ in range(rounds):
        unk = min(scores.values()) - 10.0
        used = Counter()
        for m, f in marked.items():
            n = len(m)
            best, back = [float("-inf")] * (n + 1), [0] * (n + 1)
            best[0] = 0.0
            for end in range(1, n + 1):
                for start in range(max(0, end - max_len), end):
                    s = scores.get(m[start:end])
                    if s is None:
                        if end - start != 1:
                            continue
                        s = unk
                    if best[start] + s > best[end]:
                        best[end], back[end] = best[start] + s, start
            end = n
            while end > 0:
                used[m[back[end]:end]] += f
                end = back[end]
        total = sum(used.values())
        scored = {p: math.log(f / total) for p, f in used.items()}
        keep = dict(sorted(scored.items(), key=lambda kv: (-kv[1], kv[0]))[:vocab_size])
        for c in chars:
            keep.setdefault(c, scored.get(c, math.log(0.5 / total)))
        scores = keep
    return scores


def test_unigram_matches_plain_python(spark):
    text = ["the cat sat on the mat", "the cat ate the rat and the bat", "a cat and a hat", "that is the thing"]
    df = spark.createDataFrame([(t,) for t in text], "text string")
    wc = word_counts(df)
    counts = {r.word: r.freq for r in wc.collect()}
    got = {r.piece: r.score for r in learn_unigram(wc, 12, rounds=2, seed_size=30).collect()}
    want = plain_unigram(counts, 12, 2, 30)
    assert set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_encode_equals_plain_bpe(spark):
    text = ["low lower lowest newer wider new new low aaa aaaa", "the then there lower low"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "sid long, text string")
    wc = word_counts(df)
    counts = {r.word: r.freq for r in wc.collect()}
    _, words = learn_bpe(wc, 8, max_merges_per_round=1)
    _, want_words = plain_bpe(counts, 8)
    enc = {r.sid: list(r.pieces) for r in encode(df, words, pieces_col="syms").collect()}
    for sid, t in enumerate(text):
        assert enc[sid] == [p for w in t.split() for p in want_words[w]]


def test_char_mode_and_count_only_encode(spark):
    df = spark.createDataFrame([(0, "日本 語　日"), (1, "ab a")], "sid long, text string")
    got = {r.word: r.freq for r in word_counts(df, mode="chars").collect()}
    assert got == {"日": 2, "本": 1, "語": 1, "a": 2, "b": 1}
    _, words = learn_bpe(word_counts(df), 2, max_merges_per_round=1)
    full = {r.sid: r.n_pieces for r in encode(df, words, pieces_col="syms").collect()}
    only = {r.sid: r.n_pieces for r in encode(df, words, pieces_col="syms", with_pieces=False).collect()}
    assert full == only


def test_encode_keeps_sentences_without_words(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "  "), (3, None)], "sid long, text string")
    pieces = spark.createDataFrame([("a", ["a"])], "word string, pieces array<string>")
    for full in (True, False):
        assert {r.sid: r.n_pieces for r in encode(rows, pieces, with_pieces=full).collect()} == {1: 3, 2: 0, 3: 0}


def test_word_counts_and_substring_rows_equal_the_cleaned_words(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from tandem.functions.text import sanitize, words
    from tandem.operators.vocab import substring_rows, substrings, word_counts

    texts = ["a b  a\x00b", None, "", " \t ", "x\u3000y\x1cz\x85w", "日本 \U0001f600a", "\ufeffq\x0bq"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    want = Counter(w for r in frame.select(words(sanitize("text")).alias("w")).collect() for w in r.w or [])
    assert {r.word: r.freq for r in word_counts(frame).collect()} == want
    plan = word_counts(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 0 and plan.count("translate") == 0  # one pass over a text
    counts = word_counts(frame)
    rows = Counter(r.piece for r in substring_rows(counts, 3).collect())
    assert rows == Counter(s for r in counts.select(substrings(F.col("word"), 3).alias("s")).collect() for s in r.s)

"""Subword vocabulary work as Spark aggregations over distinct words.

The corpus-sized step is one aggregation (sentences -> distinct words with counts);
everything iterative then runs over the much smaller word table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.functions.text import WORD_START, WS_CLASS, chars, logprob_to_freq, sanitize, spaces_only, split_piece_score, words
from tandem.session import dealt

# The reserved pieces the trainer's vocabulary conversion omits.
RESERVED_PIECES = ("<unk>", "<s>", "</s>")


def word_counts(sentences: DataFrame, text_col: str = "text", mode: str = "whitespace", clean: bool = True) -> DataFrame:
    """``(word, freq)`` over all sentences.

    ``mode="whitespace"`` splits on Unicode whitespace; ``mode="chars"`` treats every
    character as a word (for scripts written without spaces). Partial aggregation
    collapses frequent words before the shuffle.
    """
    if mode not in ("whitespace", "chars"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "whitespace" and clean:
        # what cleaning changes is white space and NUL, so one split at runs of these gives the words of the clean text
        toks = F.split(F.col(text_col), "[\\x00" + WS_CLASS[1:] + "+", -1)
        return (
            sentences.select(F.explode(toks).alias("word"))
            .where(F.col("word") != "")
            .groupBy("word")
            .agg(F.count(F.lit(1)).cast("bigint").alias("freq"))
        )
    t = sanitize(text_col) if clean else F.col(text_col)
    if mode == "whitespace":
        toks = words(t)
    else:  # every non-whitespace character is a word
        toks = F.filter(chars(spaces_only(t)), lambda c: (c != F.lit("")) & (c != F.lit(" ")))
    return (
        sentences.select(F.explode(toks).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).cast("bigint").alias("freq"))
    )


def top_k(counts: DataFrame, k: int, item_col: str = "word", freq_col: str = "freq") -> DataFrame:
    """The ``k`` most frequent items (ties by item); ``k`` is the vocabulary size.

    A histogram of the frequencies (their number grows with the square root of the
    corpus) gives the k-th frequency. Items above it pass without a sort; only those that
    tie with it are ordered, and of these each task sends at most the rows still wanted.
    """
    histogram = counts.groupBy(F.col(freq_col).alias("_f")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.col("_f").desc()).rowsBetween(Window.unboundedPreceding, -1)
    histogram = histogram.withColumn("_above", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_above") < k)
    near = counts.join(histogram, counts[freq_col] == histogram["_f"])
    rank = F.row_number().over(Window.partitionBy("_f").orderBy(F.col(item_col).asc()))
    ties = near.where(F.col("_above") + F.col("_n") > k).withColumn("_rank", rank).where((F.col("_rank") <= k) & (F.col("_rank") <= k - F.col("_above")))
    return near.where(F.col("_above") + F.col("_n") <= k).select(*counts.columns).unionByName(ties.select(*counts.columns))


def char_coverage(counts: DataFrame, coverage: float = 1.0) -> DataFrame:
    """Characters by frequency with their cumulative share; keeps characters up to ``coverage``.

    The running share is a window over the character table, whose size is bounded by
    the number of Unicode code points, never by the corpus.
    """
    ch = (
        counts.select(F.explode(chars("word")).alias("ch"), "freq")
        .groupBy("ch")
        .agg(F.sum("freq").cast("bigint").alias("freq"))
    )
    order = Window.orderBy(F.col("freq").desc(), F.col("ch"))
    total = Window.partitionBy(F.lit(1))
    cum = F.sum("freq").over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = ch.select(
        "ch",
        "freq",
        F.row_number().over(order).cast("bigint").alias("rank"),
        (cum / F.sum("freq").over(total)).alias("coverage"),
    )
    if coverage >= 1.0:
        return out
    # keep a character while the share before it is still below the target
    total_freq = F.sum("freq").over(total)
    return out.where(F.col("coverage") - F.col("freq") / total_freq < F.lit(coverage))


def initial_symbols(word: Column) -> Column:
    """Start symbols of a word: its characters after the word-start marker."""
    return chars(F.concat(F.lit(WORD_START), word))


def pair_counts(symbol_words: DataFrame, syms_col: str = "syms", freq_col: str = "freq") -> DataFrame:
    """``(left, right, freq)``: adjacent symbol pairs weighted by word frequency.

    Pairs come from zipping the symbol array with itself shifted by one (no lambda).
    """
    s = F.col(syms_col)
    n = F.size(s) - 1
    shifted = symbol_words.where(F.size(s) >= 2).select(
        F.slice(s, 1, n).alias("left"), F.slice(s, 2, n).alias("right"), F.col(freq_col).alias("f")
    )
    return (
        shifted.select(F.explode(F.arrays_zip("left", "right")).alias("p"), "f")
        .groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right"))
        .agg(F.sum("f").cast("bigint").alias("freq"))
    )


def apply_merge(syms: Column, left: str, right: str) -> Column:
    """Merge every non-overlapping ``left right`` occurrence, left to right (built-in fold)."""
    lv, rv, mv = F.lit(left), F.lit(right), F.lit(left + right)

    def step(acc, x):
        hit = (F.size(acc) > 0) & (F.element_at(acc, -1) == lv) & (x == rv)
        return F.when(hit, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(mv))).otherwise(
            F.concat(acc, F.array(x))
        )

    return F.aggregate(syms, F.array().cast("array<string>"), step)


def _independent_prefix(top, bound_rows, limit: int) -> list:
    """The longest prefix of the ranked pairs that sequential BPE would also merge next.

    After merging ``(a, b)`` every new pair is ``(x, ab)`` or ``(ab, y)``, whose count
    is at most the old count of ``(x, a)`` or ``(b, y)``; pairs without ``a`` or ``b``
    keep their counts and the rest only lose. So the next ranked pair is merged next
    by the sequential algorithm too when it shares no symbol with the merges taken so
    far and its count is strictly above every such bound.
    """
    max_right = {r["sym"]: r["as_right"] for r in bound_rows}
    max_left = {r["sym"]: r["as_left"] for r in bound_rows}
    first = top[0]
    taken = [first]
    used = {first["left"], first["right"]}
    bound = max(max_right.get(first["left"]) or 0, max_left.get(first["right"]) or 0)
    for cand in top[1:]:
        if len(taken) >= limit:
            break
        left, right, freq = cand["left"], cand["right"], cand["freq"]
        if left in used or right in used or freq <= bound:
            break
        taken.append(cand)
        used |= {left, right}
        bound = max(bound, max_right.get(left) or 0, max_left.get(right) or 0)
    return taken


def learn_bpe(
    counts: DataFrame,
    rounds: int,
    checkpoint_every: int = 5,
    max_merges_per_round: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """Byte-pair merges over the distinct-word table (Sennrich et al., 2016).

    Each round counts pairs (one aggregation) and takes the most frequent pair (ties:
    left, then right, ascending). With ``max_merges_per_round > 1`` it also takes the
    following ranked pairs as long as they provably are the sequential algorithm's next
    merges (see ``_independent_prefix``), so a long run needs far fewer passes with the
    same result. The symbol arrays are rewritten with a built-in fold. ``rounds`` is the
    number of merges. Lineage is cut with a reliable checkpoint every
    ``checkpoint_every`` passes. Returns ``(merges, words)``: ranked merges and the final
    ``(word, freq, syms)`` table.
    """
    spark = counts.sparkSession
    from tandem.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    # the word table is read by every round: materialize it once in the shared folder
    w = dealt(counts.select("word", "freq", initial_symbols(F.col("word")).alias("syms"))).checkpoint(eager=True)
    merges: list = []
    prev = None
    passes = 0
    while len(merges) < rounds:
        want = min(max_merges_per_round, rounds - len(merges))
        # (not cached: a cached aggregate keeps every shuffle partition, while the
        # pair table is cheap to recount from the materialized word table)
        pc = pair_counts(w)
        top = pc.orderBy(F.col("freq").desc(), F.col("left"), F.col("right")).limit(want).collect()
        if prev is not None:  # the pass has materialized ``w``
            prev.unpersist()
        if not top:
            break
        if want > 1 and len(top) > 1:
            syms = sorted({r["left"] for r in top} | {r["right"] for r in top})  # at most 2 * want
            bound_rows = (
                pc.where(F.col("left").isin(syms) | F.col("right").isin(syms))
                .select(
                    F.explode(
                        F.array(
                            F.struct(F.col("right").alias("sym"), F.col("freq").alias("r"), F.lit(0).cast("bigint").alias("l")),
                            F.struct(F.col("left").alias("sym"), F.lit(0).cast("bigint").alias("r"), F.col("freq").alias("l")),
                        )
                    ).alias("x")
                )
                .groupBy(F.col("x.sym").alias("sym"))
                .agg(F.max("x.r").alias("as_right"), F.max("x.l").alias("as_left"))
                .where(F.col("sym").isin(syms))
                .collect()
            )
            top = _independent_prefix(top, bound_rows, want)
        nxt = w
        for r in top:
            left, right = r["left"], r["right"]
            merges.append((len(merges), left, right, left + right, int(r["freq"])))
            nxt = nxt.withColumn("syms", apply_merge(F.col("syms"), left, right))
        passes += 1
        if checkpoint_every and passes % checkpoint_every == 0:
            prev, w = w, nxt.checkpoint(eager=True)
        else:
            prev, w = w, nxt.persist()
    schema = "rank bigint, left string, right string, merged string, freq bigint"
    return spark.createDataFrame(merges, schema), w


def substrings(word: Column, max_len: int = 8) -> Column:
    """All substrings of up to ``max_len`` characters (code points) of a word.

    For each length a zero-width lookahead regex yields every overlapping substring in
    one native pass (no per-element lambda).
    """
    return F.concat(*[F.regexp_extract_all(word, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) for n in range(1, max_len + 1)])


def substring_rows(words: DataFrame, max_len: int = 8) -> DataFrame:
    """``(piece, freq)``: all substrings of up to ``max_len`` characters (code points) of ``(word, freq)``, a row each.

    A zero-width lookahead regex yields the window of ``max_len`` characters at each place; the
    substrings are the windows' beginnings, so the work grows with a word's length.
    """
    windows = F.regexp_extract_all("word", F.lit(f"(?s)(?=(.{{1,{max_len}}}))"), 1)
    at = words.select("freq", F.explode(windows).alias("window"))
    sizes = F.sequence(F.lit(1), F.char_length("window"))
    return at.select("freq", "window", F.explode(sizes).alias("n")).select(F.substring("window", F.lit(1), F.col("n")).alias("piece"), "freq")


def unigram_seed(counts: DataFrame, seed_size: int, max_piece_len: int = 8, materialize: bool = True) -> DataFrame:
    """Seed pieces for the unigram model (Kudo, 2018): the most frequent substrings of the
    marked words, weighted by word frequency, plus every single character.

    The word table feeds two branches (substrings for the top-k, characters); with
    ``materialize`` it is checkpointed once, so the corpus is not re-counted per branch.
    """
    if materialize:
        counts = dealt(counts).checkpoint(eager=True)
    marked = F.concat(F.lit(WORD_START), F.col("word"))
    subs = (
        substring_rows(counts.select(marked.alias("word"), "freq"), max_piece_len)
        .groupBy("piece")
        .agg(F.sum("freq").cast("bigint").alias("freq"))
    )
    top = top_k(subs, seed_size, "piece")
    # characters come from the (materialized) word table, so the large substring table
    # has a single consumer; a character's count is the same either way
    singles = (
        counts.select(F.explode(chars(marked)).alias("piece"), "freq")
        .groupBy("piece")
        .agg(F.sum("freq").cast("bigint").alias("freq"))
    )
    return top.unionByName(singles).dropDuplicates(["piece"])


def _viterbi_rows(it):
    """Best segmentation of each word from its own scored candidates (``mapInPandas``).

    A row holds the marked word, its candidate pieces ``(s, l, score)`` (``score`` NULL
    for a single character outside the vocabulary) and the unknown-piece score. Ties
    keep the earliest start, as the sequential rule does.
    """
    import pandas as pd

    def seg(m: str, cands, unk: float):
        n = len(m)
        by_end = [[] for _ in range(n + 1)]
        for c in cands:
            sc = c["score"]
            by_end[c["s"] + c["l"]].append((c["s"], unk if sc is None else sc))
        best = [float("-inf")] * (n + 1)
        back = [0] * (n + 1)
        best[0] = 0.0
        for end in range(1, n + 1):
            for start, sc in sorted(by_end[end]):
                v = best[start] + sc
                if v > best[end]:
                    best[end], back[end] = v, start
        out, end = [], n
        while end > 0:
            out.append(m[back[end]:end])
            end = back[end]
        return out[::-1]

    for pdf in it:
        pieces = [seg(m, c, u) for m, c, u in zip(pdf["mword"], pdf["cands"], pdf["unk"])]
        yield pd.DataFrame({"word": pdf["word"], "freq": pdf["freq"], "pieces": pieces})


def segment_words(counts: DataFrame, vocab: DataFrame, max_piece_len: int = 8) -> DataFrame:
    """``(word, freq, pieces)``: Viterbi segmentation of every distinct word.

    Each word's substrings (at most ``max_piece_len`` characters) are scored by a
    broadcast join with the piece table (bounded by the vocabulary size, never collected
    to the driver) and gathered per word (at most ``8 x length`` candidates); the
    dynamic programme then runs per word in Arrow batches.
    """
    m = F.concat(F.lit(WORD_START), F.col("word"))
    n = F.char_length(m)
    cands = F.flatten(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(max_piece_len), n - i + 1)),
                lambda ln: F.struct((i - 1).alias("s"), ln.alias("l"), F.substring(m, i, ln).alias("piece")),
            ),
        )
    )
    subs = counts.select("word", "freq", m.alias("mword"), F.explode(cands).alias("c")).select(
        "word", "freq", "mword", "c.s", "c.l", "c.piece"
    )
    scored = subs.join(F.broadcast(vocab.select("piece", "score")), on="piece", how="left").where(
        F.col("score").isNotNull() | (F.col("l") == 1)
    )
    unk = vocab.select(F.min("score") - F.lit(10.0)).scalar()
    per_word = scored.groupBy("word", "freq", "mword").agg(
        F.collect_list(F.struct("s", "l", "score")).alias("cands")
    )
    return per_word.withColumn("unk", unk).mapInPandas(_viterbi_rows, "word string, freq bigint, pieces array<string>")


def learn_unigram(
    counts: DataFrame, vocab_size: int, rounds: int = 2, seed_size: int | None = None, max_piece_len: int = 8
) -> DataFrame:
    """Hard-EM unigram vocabulary: seed, then ``rounds`` of (Viterbi E-step, counting
    M-step, prune to ``vocab_size`` keeping all characters). Returns ``(piece, score)``
    with ``score = ln(share)``."""
    counts = dealt(counts).checkpoint(eager=True)
    seed = unigram_seed(counts, seed_size or vocab_size * 4, max_piece_len, materialize=False)
    total = seed.select(F.sum("freq")).scalar()
    vocab = seed.select("piece", F.log(F.col("freq") / total).alias("score")).checkpoint(eager=True)
    characters = seed.where(F.char_length("piece") == 1).select("piece")  # always kept
    for _ in range(rounds):
        seg = segment_words(counts, vocab, max_piece_len)
        used = (
            seg.select(F.explode("pieces").alias("piece"), "freq")
            .groupBy("piece")
            .agg(F.sum("freq").alias("freq"))
        )
        total = used.select(F.sum("freq")).scalar()
        scored = used.select("piece", F.log(F.col("freq") / total).alias("score"))
        keep = top_k(scored.withColumnRenamed("score", "s"), vocab_size, "piece", "s").withColumnRenamed("s", "score")
        floor = F.log(F.lit(0.5) / total)  # total is a scalar subquery
        singles = characters.join(scored, on="piece", how="left").select(
            "piece", F.coalesce(F.col("score"), floor).alias("score")
        )
        vocab = keep.unionByName(singles).dropDuplicates(["piece"]).checkpoint(eager=True)
    return vocab


def encode(
    sentences: DataFrame,
    word_pieces: DataFrame,
    id_col: str = "sid",
    text_col: str = "text",
    pieces_col: str = "pieces",
    with_pieces: bool = True,
) -> DataFrame:
    """Subword-encode sentences by joining their words to the ``word -> pieces`` table.

    ``(sid, pieces, n_pieces)``; the join is relational (no UDF) and AQE splits a
    partition made hot by a very frequent word. A word missing from the table keeps
    its characters as pieces; a sentence without words (blank, NULL) has no pieces but
    keeps its row. With ``with_pieces=False`` only ``(sid, n_pieces)`` is
    computed, as a partial-aggregated sum (no per-sentence arrays are gathered).
    """
    toks = sentences.select(id_col, F.posexplode(words(sanitize(text_col))).alias("tpos", "word"))
    wp = word_pieces.select("word", F.col(pieces_col).alias("_p"))
    j = toks.join(wp, on="word", how="left").withColumn(
        "_p", F.coalesce(F.col("_p"), initial_symbols(F.col("word")))
    )
    if not with_pieces:
        g = j.groupBy(id_col).agg(F.sum(F.size("_p")).cast("bigint").alias("n_pieces"))
        return sentences.select(id_col).join(g, on=id_col, how="left").withColumn("n_pieces", F.coalesce("n_pieces", F.lit(0).cast("bigint")))
    g = j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("tpos", "_p"))).alias("_s"))
    pieces = F.flatten(F.transform("_s", lambda x: x["_p"]))
    g = g.select(id_col, pieces.alias("pieces"))
    pieces = F.coalesce("pieces", F.array().cast("array<string>"))
    return sentences.select(id_col).join(g, on=id_col, how="left").select(id_col, pieces.alias("pieces"), F.size(pieces).cast("bigint").alias("n_pieces"))


def parse_vocab_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``(piece, score)`` from ``piece <whitespace> log-prob`` lines; malformed lines
    (not two fields, or a score that is not a number) are dropped, not fatal."""
    parts = split_piece_score(F.col(line_col))
    return (
        lines.select(parts.alias("_p"))
        .where(F.size("_p") == 2)
        .select(F.col("_p")[0].alias("piece"), F.col("_p")[1].try_cast("double").alias("score"))
        .where(F.col("score").isNotNull())
    )


def vocab_line_report(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row of counts: all lines, those kept, and the rejects by reason (``fields``: not two of them, ``score``: no number)."""
    parts = split_piece_score(F.col(line_col))
    two = F.size(parts) == 2
    score = F.when(two, parts[1].try_cast("double"))
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"), n(two & score.isNotNull()).alias("n_kept"), n(~two | two.isNull()).alias("rejected_fields"), n(two & score.isNull()).alias("rejected_score")
    )


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return parse_vocab_lines(spark.read.option("lineSep", "\n").text(path))


def to_trainer_vocab(vocab: DataFrame) -> DataFrame:
    """Scores to frequencies for the trainer: drop reserved pieces, ``int(exp(s)*1e6)+1``."""
    return vocab.where(~F.col("piece").isin(*RESERVED_PIECES)).select(
        "piece", logprob_to_freq(F.col("score")).alias("freq")
    )

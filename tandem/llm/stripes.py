"""Phrase collocations by the stripes pattern.

A stripe is an associative counter: a prefix of words, and how often each word follows it. Tasks build stripes from
their texts; stripes of one prefix are merged element by element. A merged stripe gives the phrases that
extend its prefix, and the largest of them, which decides whether the prefix is subsumed. Level by level the
prefix grows by a word, and only over phrases that are frequent themselves; from three words on, only the runs of words
whose pairs are frequent are read again.

A stripe can be as large as the vocabulary, so it is cut into segments by a hash of the next word. A
table of one byte per hash slot, of fixed size, tells every task whether a phrase may be a frequent prefix and in how
many segments its stripe is cut. Two phrases in one slot cost some more counting or cutting, never a count.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import small_batches, staged, text_of
from tandem.operators.position import ranked

#: Classes of bytes: 0 of a word, 1 between words, 2 between pieces.
CLASS = np.zeros(256, np.uint8)
CLASS[list(b" \t")] = 1
CLASS[list(b".,;:!?\n\x0b\x0c\r")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: A phrase's hash: that of its prefix times STEP plus the last word's crc32, modulo PRIME; products fit in 63 bits.
STEP, PRIME = 1_000_003, (1 << 40) - 87
STRIPES = "lang string, prefix string, next array<string>, n array<bigint>, total bigint"


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of the lower-cased texts; then, per word, its number among them and its piece."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    buf = LOWER[np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]]] if raw is not None else np.zeros(0, np.uint8)
    ends -= ends[0]
    kind = CLASS[buf]
    word = kind == 0
    edge = ends[:-1][ends[:-1] < len(buf)]  # where a text begins
    before, after = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[edge] = False
    after[edge[edge > 0] - 1] = False
    starts, stops = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(stops - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[word])]).dictionary_encode()
    # a piece ends with its text, too
    broken = kind == 2
    piece = np.cumsum(broken, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    piece += np.searchsorted(ends[:-1], starts, side="right").astype(np.int32)
    return found.dictionary, found.indices.to_numpy(), piece


def crcs(words: pa.Array) -> np.ndarray:
    """crc32 of each word."""
    if not len(words):
        return np.zeros(0, np.int64)
    raw = words.buffers()[2].to_pybytes()
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    return np.array([crc32(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)], np.int64)


class Phrases:
    """The phrases of one language's texts, a word longer with each step, as far as the table lets them be frequent."""

    def __init__(self, lang: str, texts: pa.Array, table: np.ndarray):
        self.table = table
        self.words, self.ids, self.piece = tokens(texts)
        self.spelled = crcs(self.words)
        self.hashes = (crc32(lang.encode() + b"\0") * STEP + self.spelled) % PRIME
        self.here, self.at = self.ids, np.arange(len(self.ids))  # the phrases' numbers, and where they begin
        self.prefix, self.last = np.zeros(len(self.words), np.int64), np.arange(len(self.words))
        self.spelling = self.last[:, None]  # a row of words per phrase
        self.length = 1

    def power(self) -> np.ndarray:
        """The table's byte of every phrase."""
        return self.table[self.hashes % len(self.table)]

    def frequent(self) -> np.ndarray:
        """For each word of the texts the phrase that begins there, if it may be frequent, else -1; one place more."""
        full = np.full(len(self.ids) + 1, -1, np.int64)
        ok = self.power()[self.here] > 0
        full[self.at[ok]] = self.here[ok]
        return full

    def step(self) -> None:
        """On to the phrases of one word more, of which both parts without an end may be frequent."""
        full = self.frequent()
        at = np.flatnonzero((full[:-1] >= 0) & (full[1:] >= 0))
        if self.length == 1:
            at = at[self.piece[at] == self.piece[at + 1]]
        n = max(1, len(self.words))
        self.here, distinct = pd.factorize(full[at] * n + self.ids[at + self.length])
        self.at, self.before, self.hashed, self.prefix, self.last = at, self.power(), self.hashes, distinct // n, distinct % n
        self.hashes = (self.hashes[self.prefix] * STEP + self.spelled[self.last]) % PRIME
        self.prefixes, self.spelling = self.spelling, np.hstack([self.spelling[self.prefix], self.last[:, None]])
        self.length += 1


def lang_stripes(lang: str, texts: pa.Array, level: int, table: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Stripes of one language's phrases of ``level`` words: a row per prefix and bucket.

    The segments of a prefix go to different buckets, all of a segment's words to one.
    """
    p = Phrases(lang, texts, table)
    for _ in range(level - 1):
        p.step()
    segments = buckets if level == 1 else np.int64(1) << (p.before[p.prefix].astype(np.int64) - 1)
    whose = 0 if level == 1 else p.hashed[p.prefix]
    bucket = (whose + (p.spelled[p.last] >> 4) % segments * STEP) % PRIME % buckets
    order = np.lexsort((bucket, p.prefix))
    prefix, last, bucket, counts = p.prefix[order], p.last[order], bucket[order], np.bincount(p.here, minlength=len(p.last))[order]
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (bucket[1:] != bucket[:-1])
    rows = np.flatnonzero(new)
    if level == 1:
        names = pa.array([""] * len(rows), pa.string())
    else:
        names = pc.binary_join_element_wise(*[p.words.take(pa.array(c)) for c in p.prefixes[prefix[rows]].T], b" ").view(pa.string())
    nexts, n = as_lists(np.append(rows, len(prefix)), p.words.take(pa.array(last)).view(pa.string()), counts)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), names, pa.array(bucket[rows], pa.int32()), nexts, n], names=["lang", "prefix", "bucket", "next", "n"])


def lang_runs(lang: str, texts: pa.Array, table: np.ndarray) -> pa.RecordBatch:
    """The longest runs of words all of whose pairs may be frequent, if of three words or more: as lines of a few texts."""
    p = Phrases(lang, texts, table)
    p.step()
    pair = p.frequent()[:-1] >= 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], pair, [False]]).astype(np.int8)))
    first, stop = edges[0::2], edges[1::2] + 1  # a run of pairs has one word more
    first, stop = first[stop - first > 2], stop[stop - first > 2]
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(stop - first, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], stop - first)
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), p.words.take(pa.array(p.ids[at]))), b" ")
    parts = pa.array(np.append(np.arange(0, len(first), 512), len(first)), pa.int32())
    texts = pc.binary_join(pa.ListArray.from_arrays(parts, lines), b"\n").view(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(texts), pa.string()), texts], names=["lang", "text"])


def by_lang(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[tuple[str, pa.Array]]:
    """Batches of (lang, text), language by language."""
    for batch in small_batches(batches, 1, most):
        codes, names = pd.factorize(np.array(batch.column(0).to_pylist(), object))
        for g, name in enumerate(names):
            yield name, batch.column(1) if len(names) == 1 else batch.column(1).take(pa.array(np.flatnonzero(codes == g)))


def as_lists(starts: np.ndarray, words: pa.Array, n: np.ndarray) -> tuple[pa.Array, pa.Array]:
    offsets = pa.array(starts, pa.int32())
    return pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64()))


def merged(stripes: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Stripes of one language, prefix and bucket added up element by element, in the order of the buckets."""
    t = pa.Table.from_batches(stripes).combine_chunks()
    if not len(t):
        return stripes[0]
    lang, prefix = (t[c].combine_chunks().dictionary_encode() for c in ("lang", "prefix"))
    bucket = t["bucket"].to_numpy().astype(np.int64)
    key = (bucket * len(lang.dictionary) + lang.indices.to_numpy()) * len(prefix.dictionary) + prefix.indices.to_numpy()
    _, first, group = np.unique(key, return_index=True, return_inverse=True)
    cells = pa.table({"g": np.repeat(group, pc.list_value_length(t["next"]).to_numpy()), "w": pc.list_flatten(t["next"]), "n": pc.list_flatten(t["n"])})
    cells = cells.group_by(["g", "w"]).aggregate([("n", "sum")])
    cells = cells.take(pa.array(np.argsort(cells["g"].to_numpy(), kind="stable"))).combine_chunks()
    nexts, n = as_lists(np.searchsorted(cells["g"].to_numpy(), np.arange(len(first) + 1)), cells["w"].combine_chunks(), cells["n_sum"].to_numpy())
    keys = [t[c].take(pa.array(first)).combine_chunks() for c in ("lang", "prefix", "bucket")]
    return pa.RecordBatch.from_arrays([*keys, nexts, n], names=["lang", "prefix", "bucket", "next", "n"])


def packed(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, stripes): a task's stripes, merged as far as ``most`` cells reach, as one compressed block per bucket."""
    held: list[pa.RecordBatch] = []
    cells = 0

    def blocks() -> pa.RecordBatch:
        whole = merged(held)
        bucket = whole["bucket"].to_numpy()
        at = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        out = []
        for low, high in zip(at, at[1:], strict=False):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=options) as writer:
                writer.write_batch(whole.slice(low, high - low))
            out.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(bucket[at[:-1]], pa.int32()), pa.array(out, pa.binary())], names=["bucket", "stripes"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            cells += len(pc.list_flatten(batch["next"]))
            if cells >= most:
                yield blocks()
                held, cells = [], 0
    if held:
        yield blocks()


def frequent(batches: Iterator[pa.RecordBatch], least: int, totals: bool) -> Iterator[pa.RecordBatch]:
    """Blocks in the order of their buckets to the merged stripes' words counted ``least`` times or more.

    ``total`` sums all words of a stripe; a stripe without frequent words stays only if ``totals``. Memory: one bucket's stripes.
    """
    held: list[pa.RecordBatch] = []
    now = None

    def out() -> pa.RecordBatch:
        t = merged(held)
        n = pc.list_flatten(t["n"]).to_numpy()
        starts = t["n"].offsets.to_numpy() - t["n"].offsets[0].as_py()
        group = np.repeat(np.arange(len(t)), np.diff(starts))
        total = np.zeros(len(t), np.int64)
        np.add.at(total, group, n)
        often = n >= least
        stay = np.ones(len(t), bool) if totals else np.bincount(group[often], minlength=len(t)) > 0
        nexts, counts = as_lists(np.searchsorted(group[often], np.append(np.flatnonzero(stay), len(t))), pc.list_flatten(t["next"]).filter(pa.array(often)), n[often])
        keys = [t[c].filter(pa.array(stay)) for c in ("lang", "prefix")]
        return pa.RecordBatch.from_arrays([*keys, nexts, counts, pa.array(total[stay], pa.int64())], names=["lang", "prefix", "next", "n", "total"])

    for batch in batches:
        for bucket, block in zip(batch["bucket"].to_pylist(), batch["stripes"], strict=True):
            if held and bucket != now:
                yield out()
                held = []
            now = bucket
            held += pa.ipc.open_stream(block.as_buffer())
            if sum(map(len, held)) > 1 << 16:
                held = [merged(held)]
    if held:
        yield out()


def count_level(docs: DataFrame, level: int, table: np.ndarray, least: int, buckets: int) -> DataFrame:
    """Merged stripes (lang, prefix, next, n, total) of the phrases of ``level`` words over ``docs`` (lang, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(lang_stripes(lang, texts, level, shared.value, buckets) for lang, texts in by_lang(batches))

    blocks = docs.mapInArrow(count, "bucket int, stripes binary").repartition("bucket").sortWithinPartitions("bucket")
    out = staged(blocks.mapInArrow(lambda b: frequent(b, least, level == 1), STRIPES), f"stripes-{level}")
    shared.destroy()
    return out


def frequent_runs(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """What of ``docs`` (lang, text) can hold frequent phrases of three words or more, in the same form."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in by_lang(batches):
            yield lang_runs(lang, texts, shared.value)

    out = staged(docs.mapInArrow(run, "lang string, text string"), "stripes-runs")
    shared.destroy()
    return out


def mark(table: np.ndarray, phrases: DataFrame, limit: int) -> None:
    """Enter ``phrases`` (lang, phrase, a) in the table: 1 plus the power of two of segments that keeps a stripe below ``limit``.

    What comes to the driver is at most one number per slot, a block of slots a row.
    """
    hashed = F.aggregate(F.split("phrase", " "), F.crc32(F.concat("lang", F.lit("\0"))), lambda h, w: F.pmod(h * F.lit(STEP) + F.crc32(w), F.lit(PRIME)))
    slot = F.pmod(hashed, F.lit(len(table)))
    power = F.greatest(F.ceil(F.log2(F.col("a") / F.lit(limit))), F.lit(0)).cast("int") + 1
    slots = phrases.select(slot.alias("slot"), F.least(power, F.lit(31)).alias("v")).groupBy("slot").agg(F.max("v").alias("v"))
    blocks = slots.groupBy(F.floor(F.col("slot") / 4096)).agg(F.collect_list(F.col("slot") * 32 + F.col("v")).alias("cells"))
    for r in blocks.select("cells").toLocalIterator():
        cells = np.array(r["cells"], np.int64)
        at = cells >> 5
        table[at] = np.maximum(table[at], (cells & 31).astype(np.uint8))


def phrases_of(stripes: DataFrame) -> DataFrame:
    """Stripes as (lang, prefix, phrase, a)."""
    cell = F.explode(F.arrays_zip("next", "n")).alias("cell")
    phrase = F.when(F.col("prefix") == "", F.col("cell.next")).otherwise(F.concat("prefix", F.lit(" "), "cell.next"))
    return stripes.select("lang", "prefix", cell).select("lang", "prefix", phrase.alias("phrase"), F.col("cell.n").alias("a"))


def score_of(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact for counts of up to 17 digits."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    over, under = F.lit(1000).cast("decimal(4,0)") * wide(a, 17) * wide(n, 17), wide(left, 19) * wide(right, 19)
    return F.call_function("div", over, under)


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, lang: str = "lang", text: str = "text", slot_bits: int = 24,
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z only), cut into pieces at ``. , ; : ! ?`` and line ends, and into words at spaces
    and tabs. A phrase of 2 to ``longest`` words counted ``least`` times or more scores
    floor(1000 * a * n / (l * r)) by the cut that scores lowest (of equal ones the first). Phrases inside a longer one
    that is counted as often are dropped. A null text is empty, a null language is ``und``; repeated rows count
    each time; an empty table gives no rows; other columns don't matter.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = np.zeros(1 << slot_bits, np.uint8)
    longs = "array<bigint>"

    stripes = count_level(rows, 1, table, least, 4 * parts)  # the empty prefix is cut by the shuffle's size
    sizes = stripes.groupBy("lang").agg(F.sum("total").alias("n_all"))
    whole = sizes.agg(F.sum("n_all")).first()[0] or 0
    buckets = max(4 * parts, whole // 1_000_000)
    limit = max(least, min(1_000_000, whole // (4 * parts)))
    empty = F.array().cast(longs)
    known = [phrases_of(stripes).select("lang", "phrase", "a", empty.alias("pre"), empty.alias("suf"))]
    for level in range(2, longest + 1):
        mark(table, known[-1].select("lang", "phrase", "a"), limit)
        if level == 3:
            rows = frequent_runs(rows, table)
        stripes = count_level(rows, level, table, least, buckets)
        below = known[-1]
        # the counts of what stands before a cut come with the prefix, of what stands behind it with the rest
        before = below.select(F.col("lang").alias("g"), F.col("phrase").alias("p"), F.concat("pre", F.array("a")).alias("pre"))
        behind = below.select(F.col("lang").alias("g"), F.col("phrase").alias("s"), F.concat(F.array("a"), "suf").alias("suf"))
        cells = stripes.join(before, (F.col("lang") == F.col("g")) & (F.col("prefix") == F.col("p"))).drop("g", "p")
        cells = cells.select("lang", "prefix", "pre", F.explode(F.arrays_zip("next", "n")).alias("cell")).select(
            "lang", "prefix", "pre", F.concat("prefix", F.lit(" "), "cell.next").alias("phrase"), F.col("cell.n").alias("a")
        )
        cells = cells.withColumn("rest", F.split("phrase", " ", 2)[1])
        cells = cells.join(behind, (F.col("lang") == F.col("g")) & (F.col("rest") == F.col("s")))
        found = staged(cells.select("lang", "phrase", "prefix", "rest", "a", "pre", "suf"), f"phrases-{level}")
        known.append(found)
        if found.isEmpty():
            break

    longs_of = lambda f, c: f.groupBy("lang", F.col(c).alias("phrase")).agg(F.max("a").alias("most"))
    kept = None
    for level, found in enumerate(known[1:], start=2):
        if level < len(known):
            over = longs_of(known[level], "prefix").unionByName(longs_of(known[level], "rest")).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
            over = over.select(F.col("lang").alias("g"), F.col("phrase").alias("p"), "most")
            found = found.join(over, (F.col("lang") == F.col("g")) & (F.col("phrase") == F.col("p")), "left").where(F.col("most").isNull() | (F.col("most") < F.col("a")))
        found = found.select("lang", "phrase", "a", "pre", "suf")
        kept = found if kept is None else kept.unionByName(found)
    kept = kept.join(sizes, "lang")
    cuts = F.transform(
        F.arrays_zip("pre", "suf"), lambda x, k: F.struct(score_of(F.col("a"), F.col("n_all"), x["pre"], x["suf"]).alias("score"), k.alias("k"), x["pre"].alias("l"), x["suf"].alias("r"))
    )
    scored = kept.withColumn("cut", F.array_min(cuts)).select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("n_all").alias("n"), F.col("cut.score").alias("score"))
    placed = ranked(scored, [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], ["lang"])
    return placed.where(F.col("pos") < top).select("lang", (F.col("pos") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")

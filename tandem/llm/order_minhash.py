"""Near-duplicates by Order MinHash: sketches of minimum occurrence-labelled word k-mers in text
order, verified by a banded alignment of the whole texts."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import small_batches, staged, text_of

WORDS = 5
LEAST = 0.8
SKETCHES = 32
MINIMA = 5
#: Sketches that a pair must share to be compared. Texts of similarity 0.8 share 10 of 32 on average,
#: and fewer than 3 with a chance of 4 in 10,000 (of similarity 0.85: 1 in a million).
AGREE = 3
#: Nodes and bytes of text of a bucket's block at most (a longer text is a block of its own), and how many
#: pairs of two blocks have their signatures compared at a time.
BLOCK = 512
BLOCK_BYTES = 4 << 20
PAIRS = 1 << 15
#: Bytes of a text's set signature, and how many of them two texts share whose shingle sets have a Jaccard
#: similarity of 0.8 (102 on average; 85 or fewer with a chance of about 1 in 10,000).
SIGNED = 128
SIGNED_ALIKE = 85
#: Bits of the filter that keeps texts without a candidate out of the shuffle: 8 MB at any size of the corpus.
FILTER_BITS = 1 << 26
#: Rows of bucket members for each file of the small tables.
FILE_ROWS = 100_000
#: Shingles of a short text. Pairs with a short text are found exactly, by prefixes, not by sketches; its partners
#: have at most a quarter more.
SHORT = 60
PARTNER = 75
#: Slots of the table of shingle counts that orders the shingles of short texts: 2 MB at any size of the corpus.
SLOTS = 1 << 18
#: Values per sketch among which its smallest are looked for.
LIKELY = 20
NONE = np.zeros(0, np.int64)

_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64 | 1 for k in range(8)], np.uint64)
_SEEDS = np.array([xxhash.xxh64_intdigest(b"sketch", seed=k) for k in range(256)], np.uint64)
_TIMES = _SEEDS | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[1]
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words: lower case, separated by white space."""
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Hashes of the text's k-word shingles in text order, each labelled with its occurrence
    number, so none occurs twice. A shorter text is one shingle; one without words has none."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    k, n = min(k, len(words)), max(1, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out ^= words[j : j + n]
        out *= _ODD[2]
        out ^= out >> np.uint64(32)
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    if not fresh.all():
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        number = np.empty(n, np.uint64)
        number[order] = np.arange(n) - first
        out = np.where(number > 0, _mixed(out + number * _ODD[4]), out)
    return out


def _smallest(y: np.ndarray, take: int) -> np.ndarray | None:
    """Places of each row's smallest values, looked for among its about ``LIKELY`` values below a
    bound; None if a row has too few of them."""
    row, col = np.nonzero(y < np.uint64(2**64 / y.shape[1] * LIKELY))
    count = np.bincount(row, minlength=len(y))
    if count.min() < take:
        return None
    bits = np.uint64(max(1, (len(y) - 1).bit_length()))
    order = np.argsort(row.astype(np.uint64) << np.uint64(64 - int(bits)) | y[row, col] >> bits)
    return col[order][(np.cumsum(count) - count)[:, None] + np.arange(take)]


def sketch_keys(labelled: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA) -> np.ndarray:
    """One key per sketch, an even number: a hash of its smallest labelled shingles in text order."""
    if not len(labelled):
        return np.zeros(0, np.int64)
    n, take = len(labelled), min(minima, len(labelled))
    keys = np.empty((sketches, take), np.uint64)
    step = max(1, min(sketches, (1 << 20) // n))
    for a in range(0, sketches, step):
        y = labelled[None, :] * _TIMES[a : a + step, None]
        at = _smallest(y, take) if n > 4 * LIKELY else None
        if at is None:
            at = np.argpartition(y, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(y), 1))
        keys[a : a + step] = labelled[np.sort(at, axis=1)]
    out = _SEEDS[:sketches].copy()
    for j in range(take):
        out = _mixed((out ^ keys[:, j]) * _ODD[6] + _ODD[7])
    return (out & ~np.uint64(1)).view(np.int64)


def prefix_keys(labelled: np.ndarray, counts: np.ndarray, least: float = LEAST) -> np.ndarray:
    """One key, an odd number, for each of the text's rarest shingles, so many that two texts with a Jaccard
    similarity of ``least`` share one. ``counts`` has the shingles' counts by slot; any table gives whole results."""
    n = len(labelled)
    take = n - int(np.ceil(least * n - 1e-9)) + 1
    mixed = _mixed(labelled * _ODD[3])
    order = np.lexsort((mixed, counts[(labelled % np.uint64(SLOTS)).astype(np.int64)]))
    return (mixed[order[:take]] | np.uint64(1)).view(np.int64)


def signature(labelled: np.ndarray) -> bytes:
    """One byte for each of ``SIGNED`` minimum hashes of the labelled shingles."""
    out = np.empty(SIGNED, np.uint64)
    step = max(1, (1 << 20) // len(labelled))
    for a in range(0, SIGNED, step):
        out[a : a + step] = (labelled[None, :] * _TIMES[SIGNED + a : SIGNED + a + step, None][: SIGNED - a]).min(axis=1)
    return ((out * _ODD[5]) >> np.uint64(56)).astype(np.uint8).tobytes()


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """Matched shingles of the best order-keeping alignment over the shingles of both; 0 below ``least``.

    Labelled shingles occur once in a text, so the alignment is the longest ascending run of
    matching places. Only places within the band count: any alignment that reaches
    ``least`` leaves at most that many shingles unmatched.
    """
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    need = int(np.ceil(least * total / (1 + least) - 1e-9))
    if min(len(a), len(b)) < need:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = total - 2 * need
    near = np.abs(at_a - at_b) <= band
    at_a, at_b = at_a[near], at_b[near]
    if len(at_a) < need:
        return 0.0
    ends: list[int] = []
    for x in at_b[np.argsort(at_a)].tolist():
        if not ends or x > ends[-1]:
            ends.append(x)
        else:
            ends[bisect_left(ends, x)] = x
    share = len(ends) / (total - len(ends))
    return share if share >= least - 1e-12 else 0.0


def sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: ``rid``, key, text digest, sketch keys (none without words), number of shingles and, of texts that
    may be partners of short ones, the shingles; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 3):
            found = [shingles(t) for t in batch.column(3).to_pylist()]
            sizes = pa.array([len(x) for x in found], pa.int64())
            few = lists([x.view(np.int64) if len(x) <= PARTNER else NONE for x in found])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists([sketch_keys(x) for x in found]), sizes, few], names=["rid", "id", "digest", "keys", "n", "few"])

    def lists(keys: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))

    t = text_of(text)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).cast("bigint").alias("id"), F.md5(t).alias("digest"), t.alias("text"))
    return staged(rows.mapInArrow(run, "rid bigint, id bigint, digest string, keys array<bigint>, n bigint, few array<bigint>"), "near-rows")


def bucketed(rows: DataFrame) -> DataFrame:
    """``(node, key)``: the buckets of the nodes' rows. Short texts have prefix keys, their longer partners
    prefix and sketch keys, all others sketch keys."""
    few = rows.where(F.size("few") > 0)
    slot = F.pmod("x", F.lit(SLOTS)).cast("int")
    table = few.select(F.explode("few").alias("x")).groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).toPandas()  # at most SLOTS rows
    counts = np.zeros(SLOTS, np.int64)
    counts[table["slot"]] = table["n"]
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = [prefix_keys(np.array(x, np.int64).view(np.uint64), shared.value) for x in batch.column(1).to_pylist()]
                nodes = np.repeat(np.asarray(batch.column(0)), [len(x) for x in keys])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(keys))], names=["node", "key"])

    short = few.select(F.col("rid").alias("node"), "few").mapInArrow(run, "node bigint, key bigint")
    return short.unionByName(rows.where(F.col("n") > SHORT).select(F.col("rid").alias("node"), F.explode("keys").alias("key")))


def agreed() -> Column:
    """How much the shared buckets of an aggregate's rows tell: a prefix key is enough, sketch keys count one each."""
    return F.sum(F.when(F.col("key").bitwiseAND(F.lit(1)) == 1, AGREE).otherwise(1))


def signed(texts: DataFrame) -> DataFrame:
    """``node, text`` with the text's signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            marks = pa.array([signature(shingles(t)) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], names=["node", "text", "mark"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, text string, mark binary")


def within(rows: DataFrame, wanted: DataFrame, digest: str) -> DataFrame:
    """The rows whose digest may be among those of ``wanted``: a bitmap of ``FILTER_BITS`` bits, made by an
    aggregate, is broadcast. A bit that is set by chance lets a row pass; an exact join follows."""
    spot = F.pmod(F.xxhash64(digest), F.lit(FILTER_BITS))
    marks = wanted.select(spot.alias("x")).groupBy(F.bitmap_bucket_number("x").alias("_at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("_bits"))
    marked = rows.withColumn("_x", spot).join(F.broadcast(marks), F.bitmap_bucket_number("_x") == F.col("_at"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_x) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("pmod(bitmap_bit_position(_x), 8)").cast("int")
    return marked.where(F.floor(byte / F.pow(F.lit(2), hit)) % 2 == 1).select(*rows.columns)


def may_be_alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the signatures in the rows of ``a`` and ``b`` let the texts be similar."""
    return (a == b).sum(axis=1) > SIGNED_ALIKE


def alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose signatures let them be similar: an alignment is never above the Jaccard similarity
    of the shingle sets, so the whole texts of the others needn't be brought together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, SIGNED) for k in (4, 5))
                yield pa.RecordBatch.from_arrays(batch.columns[:4], names=["u", "v", "u_root", "v_root"]).filter(pa.array(may_be_alike(a, b)))

    mine = texts.select(F.col("node").alias("u"), F.col("mark").alias("mine"))
    other = texts.select(F.col("node").alias("v"), F.col("mark").alias("other"))
    both = pairs.join(mine, "u").join(other, "v").select("u", "v", "u_root", "v_root", "mine", "other")
    return staged(both.mapInArrow(run, "u bigint, v bigint, u_root bigint, v_root bigint"), "near-alike")


def verified(pairs: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """The pairs (u, v, and their roots) whose texts align to at least ``LEAST``, with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4):
            last, right = None, np.zeros(0, np.uint64)
            got = []
            for mine, other, v in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if v != last:
                    last, right = v, shingles(other)
                got.append(aligned_similarity(shingles(mine), right))
            out = pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(got, pa.float64())], names=["u", "v", "u_root", "v_root", "similarity"])
            yield out.filter(pa.array([s > 0 for s in got], pa.bool_()))

    mine = texts.select(F.col("node").alias("u"), F.col("text").alias("mine"))
    other = texts.select(F.col("node").alias("v"), F.col("text").alias("other"))
    both = alike(pairs, texts).join(mine, "u").join(other, "v").select("u", "v", "u_root", "v_root", "mine", "other")
    return staged(both.mapInArrow(run, "u bigint, v bigint, u_root bigint, v_root bigint, similarity double"), label)


def components(edges: DataFrame, parts: int) -> DataFrame:
    """``(u, v)``: every node of the edges that isn't the smallest of its component, and the smallest.

    Large and small stars take turns: minima by partial aggregation, each turn written
    to the shared folder, until every node hangs on one root that hangs on none.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = staged(edges.coalesce(parts), "near-edges")
    while True:
        once = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        if once and edges.join(edges.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty():
            return edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staged(both.where("v > u").join(staged(least.coalesce(parts), "near-least"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct().coalesce(parts), "near-large")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), "near-least")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(least.select("u", F.col("m").alias("v")))
        edges = staged(small.distinct().coalesce(parts), "near-small")


def blocks_of(placed: DataFrame, texts: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """The buckets of several components, cut into blocks: their nodes are dealt and sorted by range of key, root
    and node, so a large bucket spreads over tasks and most of its blocks are of one component."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in small_batches(batches, 5):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (row[0] != key or len(held) == BLOCK or size + len(row[5]) > BLOCK_BYTES):
                    yield block(key, held)
                    held, size = [], 0
                key, size = row[0], size + len(row[5])
                held.append(row[1:])
        if held:
            yield block(key, held)

    def block(key: int, held: list[tuple]) -> pa.RecordBatch:
        _, roots, marks, keys, bodies = zip(*held, strict=True)
        keys = np.array(keys, np.int64).tobytes()
        row = ((key, "int64"), (min(roots), "int64"), (max(roots), "int64"), (roots, LONGS), (b"".join(marks), "binary"), (keys, "binary"), (bodies, pa.list_(pa.string())))
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in row], names=["key", "low", "high", *BLOCKS])

    mixed = placed.groupBy("key").agg(F.min("u_root").alias("low"), F.max("u_root").alias("high")).where("low < high").select("key")
    mixed = staged(placed.join(mixed, "key").coalesce(parts), "near-mixed")
    often = mixed.groupBy("node").agg(agreed().alias("n")).where(F.col("n") >= AGREE).select("node")
    facts = texts.join(rows.select(F.col("rid").alias("node"), "keys"), "node")
    open_rows = staged(mixed.join(often, "node").coalesce(parts), "near-open").join(facts, "node")
    dealt = open_rows.repartitionByRange(parts, "key", "u_root", "node").sortWithinPartitions("key", "u_root", "node")
    dealt = dealt.select("key", "node", "u_root", "mark", "keys", "text")
    found = dealt.mapInArrow(cut, "key bigint, low bigint, high bigint, roots array<bigint>, marks binary, sketches binary, texts array<string>")
    return staged(found.withColumn("block", F.monotonically_increasing_id()), "near-blocks")


LONGS = pa.list_(pa.int64())
BLOCKS = ["roots", "marks", "sketches", "texts"]


def unmet(placed: DataFrame, texts: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """Links (u, v) between the roots of all components that are tied by a pair of similar texts with ``AGREE``
    shared sketches or a shared prefix.

    Each block of a bucket meets each other one, and itself, in a row of its own, unless both are of one and the
    same component. First signatures and sketches alone: a row stays if a pair of different components passes that
    shares a prefix, or the sketches in the first bucket of both. Only then do the two blocks' texts meet, and the pairs
    are aligned unless the row's links tie their components already. Only links become rows.
    """

    def some_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = [any(len(x) for x, _ in candidates(batch.slice(k, 1).to_pylist()[0])) for k in range(batch.num_rows)]
            yield batch.select(["key", "block", "other"]).filter(pa.array(fits, pa.bool_()))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                links = joined_in(batch.slice(k, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*links, strict=True) if links else ((), ()))], names=["u", "v"])

    def candidates(cell: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places, in the row's two blocks, of the pairs that have to be aligned."""
        (roots, marks, keys), (o_roots, o_marks, o_keys) = (
            (np.array(cell[s + "roots"], np.int64), *(np.frombuffer(cell[s + c], t).reshape(len(cell[s + "roots"]), -1) for c, t in (("marks", np.uint8), ("sketches", np.int64))))
            for s in ("", "other_")
        )
        differs = roots[:, None] != o_roots[None, :]
        if cell["block"] == cell["other"]:
            differs = np.triu(differs)
        all_x, all_y = np.nonzero(differs)
        for a in range(0, len(all_x), PAIRS):
            x, y = all_x[a : a + PAIRS], all_y[a : a + PAIRS]
            fits = may_be_alike(marks[x], o_marks[y])
            x, y = x[fits], y[fits]
            if not cell["key"] & 1:
                same = keys[x] == o_keys[y]
                here = (same.sum(axis=1) >= AGREE) & (keys[x, same.argmax(axis=1)] == cell["key"])
                x, y = x[here], y[here]
            yield x, y

    def joined_in(cell: dict) -> list[tuple[int, int]]:
        tied, links, known = {}, [], {}

        def top(root: int) -> int:
            while root in tied:
                root = tied[root]
            return root

        def of(side: str, at: int) -> np.ndarray:
            if (side, at) not in known:
                known[side, at] = shingles(cell[side + "texts"][at])
            return known[side, at]

        for x, y in candidates(cell):
            for p, q in zip(x.tolist(), y.tolist(), strict=True):
                mine, other = top(cell["roots"][p]), top(cell["other_roots"][q])
                if mine != other and aligned_similarity(of("", p), of("other_", q)):
                    tied[max(mine, other)] = min(mine, other)
                    links.append((max(mine, other), min(mine, other)))
        return links

    def with_blocks(cells: DataFrame, columns: list[str]) -> DataFrame:
        mine, other = blocks.select("block", *columns), blocks.select(F.col("block").alias("other"), *[F.col(c).alias("other_" + c) for c in columns])
        return cells.join(mine, "block").join(other, "other").select("key", "block", "other", *columns, *["other_" + c for c in columns])

    blocks = blocks_of(placed, texts, rows, parts)
    light = blocks.select("key", "block", "low", "high")
    other = light.select("key", F.col("block").alias("other"), F.col("low").alias("l"), F.col("high").alias("h"))
    cells = light.join(other, "key").where("block <= other and not (low = high and l = h and low = l)").select("key", "block", "other")
    cells = with_blocks(staged(cells, "near-cells"), BLOCKS[:-1]).mapInArrow(some_fit, "key bigint, block bigint, other bigint")
    met = with_blocks(staged(cells, "near-met"), BLOCKS).mapInArrow(meet, "u bigint, v bigint")
    return staged(met.distinct(), "near-unmet")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, digest, class_id (the smallest id of its class) and whether it is the
    smallest of equal texts.

    Equal texts are one node; nodes with an alignment of 5-word shingles of at least 0.8 are
    linked, and linked nodes are one class. A text that is null or without words is a class of its
    own, as is a row with a null key unless others share its class (null if none has an id).
    Repeated rows share a class. An empty table gives no rows.

    Candidates share three sketches; pairs with a text of at most ``SHORT`` shingles share a prefix of their
    rarest shingles, which no such pair escapes. Every bucket is first compared as a star: every node with
    the weightiest node of each of its buckets, that with the most company in all of its own (the text that the
    others were copied from, if it is there). What the stars leave apart is closed exactly, see ``unmet``: block of
    a bucket against block, so no bucket meets in one task, and no pairs within a bucket are listed.
    """
    rows = sketched(docs, key, text)
    nodes = staged(rows.where(F.size("keys") > 0).groupBy("digest").agg(F.min("rid").alias("node"), F.min("id").alias("id")), "near-nodes")
    keyed = staged(bucketed(rows.join(nodes.select(F.col("node").alias("rid")), "rid", "left_semi")), "near-keys")
    buckets = staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-buckets")
    members = staged(keyed.join(buckets, "key"), "near-members")
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-members.count() // FILE_ROWS))
    some = members.groupBy("node").agg(agreed().alias("shares"), F.sum("n").alias("weight")).where(F.col("shares") >= AGREE)
    some = staged(some.select("node", "weight").coalesce(parts), "near-some")
    members = staged(members.select("key", "node").join(some, "node").coalesce(parts), "near-members")
    heads = staged(members.groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("leader")).coalesce(parts), "near-heads")
    shared = members.join(heads, "key").where("leader != node").groupBy("node", "leader").agg(agreed().alias("n")).where(F.col("n") >= AGREE)
    shared = staged(shared.coalesce(parts), "near-shared")
    needed = staged(nodes.join(some, "node").select("node", F.col("id").alias("_id"), F.col("digest").alias("_digest")).coalesce(parts), "near-needed")
    whole = docs.select(F.col(key).cast("bigint").alias("id"), F.md5(text_of(text)).alias("digest"), text_of(text).alias("text"))
    texts = within(whole, needed.withColumnRenamed("_digest", "digest"), "digest").join(needed, (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_id"))).select("node", "text")
    texts = staged(signed(texts), "near-texts")
    first = shared.select(F.col("node").alias("u"), F.col("leader").alias("v"), F.col("node").alias("u_root"), F.col("leader").alias("v_root"))
    stars = components(verified(first, texts, "near-links").select("u", "v"), parts)
    placed = members.join(stars.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    placed = staged(placed.select("key", "node", F.coalesce("root", "node").alias("u_root")).coalesce(parts), "near-placed")
    more = unmet(placed, texts, rows, parts)
    if not more.isEmpty():
        joined = components(more, parts).select(F.col("u").alias("old"), F.col("v").alias("new"))
        moved = stars.join(joined, stars["v"] == joined["old"], "left").select("u", F.coalesce("new", "v").alias("v"))
        stars = staged(moved.unionByName(joined.select(F.col("old").alias("u"), F.col("new").alias("v"))).coalesce(parts), "near-stars")
    rooted = nodes.join(stars.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    rooted = staged(rooted.select("digest", F.col("id").alias("first_id"), F.coalesce("root", "node").alias("root")), "near-rooted")
    ids = staged(rooted.groupBy("root").agg(F.min("first_id").alias("class_id")), "near-ids")
    classes = staged(rooted.join(ids, "root").select(F.col("digest").alias("_digest"), "first_id", "class_id"), "near-classes")
    own = rows.select("id", "digest", (F.size("keys") > 0).alias("worded"))
    found = own.join(classes, own["digest"] == classes["_digest"], "left")
    return found.select(
        "id", "digest", F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("id")).alias("class_id"), "worded",
        (F.col("worded") & F.col("id").eqNullSafe(F.col("first_id")) & F.col("id").eqNullSafe(F.col("class_id"))).alias("kept"),
    )


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each class: that with the smallest id. Texts without words all stay.

    Of repeated rows (equal key and text) one stays, of those with null keys too.
    """
    found = near_classes(docs, key, text).where(F.col("worded"))
    keep = found.where("kept").groupBy("id", "digest").agg(F.count(F.lit(1)).alias("_n"))
    keep = staged(keep.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "_n"), "near-keep")
    marked = docs.withColumn("_md5", F.md5(text_of(text)))
    bare = F.length(F.trim(F.regexp_replace(text_of(text), r"[\p{Z}\s\x1c-\x1f\x85]+", ""))) == 0
    kept = marked.where(~bare).join(keep, marked[key].eqNullSafe(keep["_id"]) & (marked["_md5"] == keep["_digest"]))
    once = kept.where("_n = 1").select(*docs.columns)
    again = kept.where("_n > 1").dropDuplicates(["_id", "_digest"]).select(*docs.columns)
    return once.unionByName(again).unionByName(docs.where(bare))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, class_id)`` for every row, the class being named by its smallest id."""
    return near_classes(docs, key, text).select(F.col("id").alias("doc_id"), "class_id")

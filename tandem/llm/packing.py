"""Packing of token sequences: best-fit decreasing with a segment tree over free space."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tandem.llm.chunk_tokens import added_pattern
from tandem.llm.common import small_batches, text_of

#: Split pattern of the byte-level vocabulary (a fixed value of that public tokenizer).
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A run without white space that is left to the other library, whose merges stay near linear.
LONG_RUN = re.compile(r"\S{5000}|\s{5000}")


@lru_cache(maxsize=4)
def byte_encoder(json_path: str, ranks_path: str, added: bool = False):
    """Text to ids of the byte-level vocabulary; both files hold the same one.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``; the rank file serves a
    faster library. With ``added``, texts that hold an added token of the file go to the unchanged
    tokenizer; without, the strings of such tokens are ordinary text.
    """
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    sure = Tokenizer.from_file(json_path)
    pattern = added_pattern(sure) if added else None
    holds = re.compile(pattern).search if pattern is not None else lambda text: None
    sure.encode_special_tokens = not added

    def encode(text: str) -> np.ndarray:
        if holds(text) or LONG_RUN.search(text):
            return np.array(sure.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)

    return encode


class FreeSpaceTree:
    """Open windows by free space: a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, free: int, window: int) -> None:
        self.windows[free].append(window)
        at = free + self.width
        while at:
            self.count[at] += 1
            at >>= 1

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the window with the least free space of at least ``size``: (free, window)."""
        count, at = self.count, size + self.width
        if not count[at]:
            while at & 1 or not count[at + 1]:  # climb until a right sibling has a window
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.width:
                at = 2 * at if count[2 * at] else 2 * at + 1
        free = at - self.width
        while at:
            count[at] -= 1
            at >>= 1
        return free, self.windows[free].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows as lists of item numbers; items go in by descending size, ties by number."""
    tree, windows = FreeSpaceTree(capacity), []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        found = tree.tightest(size)
        if found is None:
            found = capacity, len(windows)
            windows.append([])
        windows[found[1]].append(item)
        tree.add(found[0] - size, found[1])
    return windows


def pack_pool(sizes: list[int], capacity: int, slack: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of one pool, each a list of pieces (item, start, length).

    Full windows are cut from overlong items first, the rests go to best-fit decreasing. What
    windows with more than ``slack`` free hold is cut again as one stream into full windows,
    and its end along its binary digits, so that no sequence of it needs padding.
    """
    sequences, rests = [], []
    for item, size in enumerate(sizes):
        full = size // capacity * capacity
        sequences += [[(item, at, capacity)] for at in range(0, full, capacity)]
        if size > full:
            rests.append((item, full, size - full))
    lengths = np.array([r[2] for r in rests], np.int64)
    stream = []
    for window in best_fit_decreasing(lengths, capacity):
        pieces = [rests[i] for i in window]
        if capacity - sum(p[2] for p in pieces) <= slack:
            sequences.append(pieces)
        else:
            stream += pieces
    total = sum(p[2] for p in stream)
    cuts = [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if total % capacity >> b & 1]
    stream.reverse()
    for room in cuts:
        pieces = []
        while room:
            item, at, n = stream.pop()
            take = min(n, room)
            pieces.append((item, at, take))
            room -= take
            if take < n:
                stream.append((item, at + take, n - take))
        sequences.append(pieces)
    return sequences


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame, json_path: str, ranks_path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1,
    pool_tokens: int = 4 << 20, slack: int = 16, with_ids: bool = False,
) -> DataFrame:
    """Pack all texts, each ended by ``end_id``, into sequences of at most ``capacity`` ids.

    One row per piece. Every partition packs its own rows in pools of about ``pool_tokens``
    ids, so nothing is shuffled and memory doesn't grow with the data; a pool always ends
    with a whole document. The sequence number is made of the partition's and a counter, the
    same in a second attempt. A null or empty text has ``end_id`` alone; a null key stays
    null; repeated rows are packed each; an empty table gives no rows. ``with_ids`` adds the
    ids of each piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(json_path, ranks_path, added=True)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 36
        pool: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            rows, ids_of = [], []
            for pieces in pack_pool([len(ids) for _, ids in pool], capacity, slack):
                offset = 0
                for item, at, n in pieces:
                    doc_id, ids = pool[item]
                    part = ids[at : at + n]
                    rows.append((doc_id, at, n, zlib.crc32(part), len(ids), sequence, offset))
                    if with_ids:
                        ids_of.append(part.astype(np.int32))
                    offset += n
                sequence += 1
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids_of)]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids_of))))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in small_batches(batches, 1):
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.ascontiguousarray(np.append(encode(body), np.uint32(end_id)), "<u4")
                pool.append((doc_id, ids))
                held += len(ids)
                if held >= pool_tokens:
                    yield flush()
                    pool, held = [], 0
        if pool:
            yield flush()

    names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, PIECES + ", ids array<int>" * with_ids)

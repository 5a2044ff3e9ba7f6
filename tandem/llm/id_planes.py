"""Token-id files: fixed-size id blocks, transposed into bit or byte planes, each plane
compressed with zstandard, with a chunk index at the end of the file.

File layout, all numbers little-endian:

* blocks one after another; a block has at most ``block`` ids. Its planes (32 bit planes or
  4 byte planes of the unsigned 32-bit ids, lowest first) are zstandard frames; a plane of
  zero bytes only takes no space;
* the index, a zstandard frame of: u32 plane width in bits (1 or 8), u32 block size,
  u64 number of blocks, per block u64 offset, u32 ids, planes x u32 compressed size;
  u64 number of documents, per document i64 key, u8 key is null, u64 number of ids;
* u64 size of the index, then the mark ``PLANES1`` and one line end.

Spark's text sink writes the files (its line end closes the mark), so they go to any file
system by Spark's commit protocol, and a lost executor leaves no half file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.chunk_tokens import chunk_encoder
from tandem.llm.common import small_batches, staged, text_of

MARK = b"PLANES1\n"


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of one block, lowest first. ``bits`` is the width of a plane: 1 or 8."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [raw[:, k].tobytes() for k in range(4)]
    return [np.packbits((raw[:, k // 8] >> (k % 8)) & 1, bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes | None], n: int, bits: int) -> np.ndarray:
    """The ids of one block; None stands for a plane of zeros."""
    raw = np.zeros((n, 4), np.uint8)
    for k, plane in enumerate(planes):
        if plane is None:
            continue
        got = np.frombuffer(plane, np.uint8)
        if bits == 8:
            raw[:, k] = got
        else:
            raw[:, k // 8] |= np.unpackbits(got, count=n, bitorder="little") << (k % 8)
    return raw.reshape(-1).view("<u4")


class PlaneWriter:
    """Pieces of one file: ``add`` gives the blocks that are full, ``close`` the rest."""

    def __init__(self, bits: int = 8, block: int = 1 << 16, level: int = 3):
        self.bits, self.block, self.codec = bits, block, zstandard.ZstdCompressor(level=level)
        self.rest = np.zeros(0, np.uint32)
        self.at, self.index, self.keys, self.nulls, self.counts = 0, [], [], [], []

    def _block(self, ids: np.ndarray) -> bytes:
        planes = [self.codec.compress(p) if p.count(0) < len(p) else b"" for p in to_planes(ids, self.bits)]
        self.index.append(struct.pack(f"<QI{len(planes)}I", self.at, len(ids), *map(len, planes)))
        out = b"".join(planes)
        self.at += len(out)
        return out

    def add(self, keys: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
        self.keys += [0 if k is None else k for k in keys]
        self.nulls += [k is None for k in keys]
        self.counts.append(np.asarray(counts, np.uint64))
        ids = np.concatenate([self.rest, ids])
        full = len(ids) // self.block * self.block
        out = b"".join(self._block(ids[a : a + self.block]) for a in range(0, full, self.block))
        self.rest = ids[full:]
        return out

    def close(self) -> bytes:
        """The last block, the index and the mark, without the mark's line end."""
        out = self._block(self.rest) if len(self.rest) else b""
        docs = np.zeros(len(self.keys), dtype=[("key", "<i8"), ("null", "u1"), ("n", "<u8")])
        docs["key"], docs["null"] = self.keys, self.nulls
        docs["n"] = np.concatenate(self.counts) if self.counts else []
        index = struct.pack("<IIQ", self.bits, self.block, len(self.index)) + b"".join(self.index)
        index = self.codec.compress(index + struct.pack("<Q", len(docs)) + docs.tobytes())
        return out + index + struct.pack("<Q", len(index)) + MARK[:-1]


def read_planes(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of a file: keys, null flags and id counts of the documents that end in it, and its ids.

    An error tells of a damaged file: the mark, an index or a plane that doesn't fit.
    """
    if content[-8:] != MARK:
        raise ValueError("not a plane file, or cut off")
    size = struct.unpack_from("<Q", content, len(content) - 16)[0]
    codec = zstandard.ZstdDecompressor()
    index = codec.decompress(content[len(content) - 16 - size : len(content) - 16])
    bits, _, n_blocks = struct.unpack_from("<IIQ", index)
    n_planes, at, blocks = 32 // bits, 16, []
    for _ in range(n_blocks):
        blocks.append(struct.unpack_from(f"<QI{n_planes}I", index, at))
        at += 12 + 4 * n_planes
    n_docs = struct.unpack_from("<Q", index, at)[0]
    docs = np.frombuffer(index, dtype=[("key", "<i8"), ("null", "u1"), ("n", "<u8")], count=n_docs, offset=at + 8)
    ends, seen, done = np.cumsum(docs["n"].astype(np.int64)), 0, 0
    for place, n, *sizes in [*blocks, (0, 0)]:
        planes = []
        for s in sizes:
            planes.append(codec.decompress(content[place : place + s]) if s else None)
            place += s
        seen += n
        to = int(np.searchsorted(ends, seen, side="right"))
        part = docs[done:to]
        done = to
        yield part["key"], part["null"], part["n"].astype(np.int64), from_planes(planes, n, bits) if n else np.zeros(0, np.uint32)


def write_id_files(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 1, bits: int = 8, block: int = 1 << 16
) -> None:
    """Encode whole texts, append ``end_id`` to each and write id files in ascending key order.

    Files in the order of their numbers hold the keys in order (null keys first, repeated keys
    in any fixed order). The sort is Spark's range partitioning by key and a row number, so a
    key with many rows spreads over files; a task holds one batch of texts and its file's bytes.
    A null text is empty: it has ``end_id`` alone. An empty table gives no or empty files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, rows = chunk_encoder(tokenizer), PlaneWriter(bits, block), 0
        pending = []
        for batch in small_batches(batches, 1, 4 << 20):
            ids, counts = encoder.encode(batch.column(1))
            at = np.cumsum(counts)
            ids = np.insert(ids, at, np.uint32(end_id))
            pending.append(out.add(batch.column(0).to_pylist(), counts + 1, ids))
            rows += batch.num_rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join([*pending, out.close()])], pa.binary())], names=["value"])

    rows = docs.select(F.col(key).cast("bigint").alias("k"), text_of(text).alias("t"), F.monotonically_increasing_id().alias("r"))
    rows = rows.repartitionByRange("k", "r").sortWithinPartitions("k", "r").select("k", "t")
    files = rows.mapInArrow(write, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("lineSep", "\n").text(path)


def read_id_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of id files: ``(file, doc_id, within, n_tokens, ids_crc32)``.

    ``within`` counts the ids before the document in its file. A task holds one file at a time.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["file"], frame["content"], strict=True):
                yield from rows_of(name, content)

    def rows_of(name: str, content: bytes) -> Iterator[pd.DataFrame]:
        start, had, crc = 0, 0, 0  # had, crc: ids of the open document in earlier blocks
        for keys, nulls, counts, ids in read_planes(content):
            ids, crcs, at = np.ascontiguousarray(ids, "<u4"), [], 0
            for count in counts.tolist():
                to = at + count - had
                crcs.append(zlib.crc32(ids[at:to], crc))
                at, had, crc = to, 0, 0
            had, crc = had + len(ids) - at, zlib.crc32(ids[at:], crc)
            if len(keys):
                ends = start + np.cumsum(counts)
                yield pd.DataFrame({
                    "file": name, "doc_id": pd.array([None if z else int(x) for x, z in zip(keys, nulls, strict=True)], dtype="Int64"),
                    "within": ends - counts, "n_tokens": counts, "ids_crc32": np.array(crcs, np.int64),
                })
                start = int(ends[-1])

    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.mapInPandas(read, "file string, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")


def id_offsets(read: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: start counts the ids of all documents before.

    Only the sums over files run in one task, over one row a file.
    """
    read = staged(read, "planes-read")
    files = read.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    number = F.regexp_extract("file", r"part-(\d+)", 1).try_cast("bigint")  # names alone sort part-100000 before part-99999
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    rows = read.join(files, "file")
    return rows.select("doc_id", (F.col("base") + F.col("within")).cast("bigint").alias("start"), "n_tokens", "ids_crc32")

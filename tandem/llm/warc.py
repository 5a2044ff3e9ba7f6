"""WARC archives: a writer with deduplicated payloads and a reader that salvages what it can."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import small_batches, staged, text_of

VERSION = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r\n")
MEMBER = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member ends with its size's highest byte, so it ends in a zero byte below this size.
MEMBER_MOST = (1 << 24) - 1


def record_bytes(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One record; a revisit has an empty block. ``digest`` is SHA-1 in lower-case hex."""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: text/html",
    ]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", uri))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT}"]
    block = b"" if refers_to is not None else payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(record: bytes, level: int = 6) -> bytes:
    """The record as gzip members, as a rule one; each ends with a zero byte."""
    parts = [record[a : a + MEMBER_MOST] for a in range(0, len(record), MEMBER_MOST)]
    return b"".join(gzip.compress(p, level, mtime=0) for p in parts)


@dataclass
class Salvage:
    """Records found in an archive and the byte gaps that held none."""

    records: list[tuple[int, dict[str, str], bytes]] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)

    def gap(self, start: int, end: int, why: str) -> None:
        if end > start:
            if self.gaps and self.gaps[-1][1] == start:
                start, _, why = self.gaps.pop()
            self.gaps.append((start, end, why))


class Incomplete(ValueError):
    """A record that may go on behind the data; ``need`` bytes are wanted at least."""

    def __init__(self, why: str, need: int):
        super().__init__(why)
        self.need = need


def hex_digest(value: str) -> str | None:
    """A SHA-1 as lower-case hex, from hex or base32; None if it is neither."""
    value = value[5:] if value.lower().startswith("sha1:") else ""
    if re.fullmatch(r"[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[2-7A-Za-z]{32}", value) else None


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """The block, of HTTP messages without their head."""
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return block
    return block.partition(b"\r\n\r\n")[2]


def vouched(fields: dict[str, str], block: bytes) -> bool | None:
    """Whether the record's digests fit; None if it has none that can be checked.

    A payload digest may be over the payload or, by some writers, the whole block. That of a chunked HTTP
    payload, which writers take before or after they join the chunks, isn't held against a record.
    """
    own, found = hex_digest(fields.get("warc-block-digest", "")), None
    if own is not None:
        if hashlib.sha1(block).hexdigest() != own:
            return False
        found = True
    own = hex_digest(fields.get("warc-payload-digest", ""))
    if own is None or fields.get("warc-type") == "revisit":
        return found
    payload = payload_of(fields, block)
    if own in (hashlib.sha1(payload).hexdigest(), hashlib.sha1(block).hexdigest()):
        return True
    head = block[: len(block) - len(payload)].lower()
    return found if re.search(rb"transfer-encoding:[^\r\n]*chunked", head) else False


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields (names in lower case), block and end of the record at ``at``; ValueError if it is damaged,
    ``Incomplete`` if by its Content-Length it goes on behind the data.

    The checks: version line, header lines, length, the two line ends behind the block, and
    the digests of block and payload where the record has them.
    """
    if not (version := VERSION.match(data, at)):
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", version.end())
    if end < 0:
        raise Incomplete("header without end", len(data) - at + 1)
    fields: dict[str, str] = {}
    for line in data[version.end() : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-9;-~]+", name):
            raise ValueError("bad header line")
        fields[name.decode().lower()] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        raise ValueError("no length")
    start = end + 4
    stop = start + int(fields["content-length"])
    if stop + 4 > len(data):
        raise Incomplete("record cut off", stop + 4 - at)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("no line ends behind the block")
    block = data[start:stop]
    if vouched(fields, block) is False:
        raise ValueError("a digest doesn't match")
    return fields, block, stop + 4


def starts_record(data: bytes) -> bool:
    """Whether a whole, valid record stands at the start."""
    try:
        return bool(parse_record(data, 0))
    except ValueError:
        return False


def records_in(data: bytes) -> tuple[list[tuple[dict[str, str], bytes, int]], str | None, int, int]:
    """Valid records of what gzip members hold with their ends, the first damage, and where an incomplete last record
    starts (the end if there is none) with the bytes that it needs."""
    found, damage, at, open_at, need = [], None, 0, None, 0
    while at < len(data):
        try:
            fields, block, at = parse_record(data, at)
        except ValueError as why:
            if isinstance(why, Incomplete) and open_at is None:
                open_at, need = at, why.need
            elif not isinstance(why, Incomplete):
                damage = damage or str(why)
            later = VERSION.search(data, at + 1)
            at = later.start() if later else len(data)
            continue
        if open_at is not None:  # a valid record behind it: the incomplete one was cut off
            damage, open_at = damage or "record cut off", None
        found.append((fields, block, at))
    return found, damage, len(data) if open_at is None else open_at, need


def next_member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` holds as far as it can be read, where reading ended, and how:
    ``whole``, ``cut`` (the file ends in it) or ``bad``."""
    view, most = memoryview(data), 1 << 16

    def read(start: int, engine, out: list[bytes], step: int) -> tuple[int, str]:
        to = start
        while not engine.eof and to < len(data):  # in small steps: what a member leaves over is copied
            try:
                out.append(engine.decompress(view[to : to + step]))
            except zlib.error:
                return to, "bad"
            to += step
        return min(to, len(data)) - len(engine.unused_data), "whole" if engine.eof else "cut"

    engine, out = zlib.decompressobj(31), []
    end, how = read(at, engine, out, most)
    if how == "bad":  # again, byte by byte where it broke: a failed step gives nothing
        engine, out, stop = zlib.decompressobj(31), [], end
        for to in range(at, stop, most):
            out.append(engine.decompress(view[to : to + most]))
        end, how = read(stop, engine, out, 1)
    return b"".join(out), end, how


def salvage_members(data: bytes, at: int, out: Salvage) -> tuple[int, int]:
    """Records of the row of gzip members at ``at``. Returns where the row ends, and from where on a
    version line may start a record (further on, if the last member is damaged: what it holds is not to be
    read again, but the next member may start within the bytes that the damage made it swallow)."""
    held, size, need, since = [], 0, 0, at  # members from ``since`` on that hold the start of a record
    while data.startswith(MEMBER, at):
        body, end, how = next_member(data, at)
        if held and VERSION.match(body) and starts_record(body):
            out.gap(since, at, "record cut off")
            held, size = [], 0
        if not held:
            since, need = at, 0
        held.append(body)
        size += len(body)
        if size < need and how == "whole":
            at = end
            continue
        whole = b"".join(held)
        found, damage, rest, need = records_in(whole)
        if how != "whole":  # the record at which reading stops isn't taken for whole
            found = [r for r in found if r[2] < len(whole)]
        kept = [r[:2] for r in found if how != "bad" or vouched(*r[:2]) and r[0].get("warc-type") != "revisit"]
        out.records += [(since, *r) for r in kept]
        if how != "whole":
            why = "member cut off" if how == "cut" else "damaged member"
            out.gap(since, at + 1, why + (f", {len(kept)} records kept" if kept else ""))
            return at + 1, end
        if damage:
            out.gap(since, end, damage)
        if rest == len(whole):
            held, size = [], 0
        else:
            held, size = [whole[rest:]], len(whole) - rest
            since = at if found else since
        at = end
    if held:
        out.gap(since, at, "record cut off")
    return at, at


def salvage(data: bytes) -> Salvage:
    """All records of an archive, plain, of gzip members, or both, and its gaps in bytes of the file.

    A record that fails a check is left out and its bytes are logged as a gap; the search goes on, through the
    whole file, at the next member or version line. A record may span members: its Content-Length tells.
    Of a member that the file's end cuts, the records are kept that something follows in it; of a damaged one
    those of them that a digest vouches for. Such a member's bytes are a gap all the same.
    """
    out, at, floor = Salvage(), 0, 0
    member, line = -1, -1  # the next ones found; searched again only when passed
    while at < len(data):
        if data.startswith(MEMBER, at):
            at, floor = salvage_members(data, at, out)
            if at >= len(data) or data.startswith(MEMBER, at):
                continue
        start, why = at, "neither member nor version line"
        if at >= floor and VERSION.match(data, at):
            try:
                fields, block, end = parse_record(data, at)
                out.records.append((at, fields, block))
                at = end
                continue
            except ValueError as error:
                why, start = str(error), at + 1
        if member < start:
            member = data.find(MEMBER, start)
            member = len(data) if member < 0 else member
        if line < max(start, floor):
            found = VERSION.search(data, max(start, floor))
            line = found.start() if found else len(data)
        out.gap(at, min(member, line), why)
        at = min(member, line)
    return out


def payloads(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    body = F.encode(text_of(html), "UTF-8")
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    return rows.withColumns({"size": F.octet_length("body").cast("bigint"), "digest": F.sha1("body")})


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 1000, per_file: int = 5000) -> None:
    """One record per page, its payload the html in UTF-8 (null: empty), into archives of gzip members.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest key is
    a response and the others revisit it; smaller payloads are all responses. A null key is
    written as none and never is the one revisited, unless all of a payload's are null: then all are
    responses. Rows that repeat the largest key are all responses. An empty table gives no archives.

    The payloads' largest keys are made with partial aggregation and joined back by digest;
    the join leaves it to adaptive execution to split a payload that many pages share. Spark's
    text sink writes the members, with the zero byte that ends each as line end, so the archives
    reach any file system by Spark's commit protocol.
    """
    rows = payloads(pages, key, url, html)
    largest = staged(rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "last"), "warc-last")
    rows = rows.join(largest, "digest", "left").select("page_id", "url", "body", "size", "digest", "last")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            out = []
            for row in batch.to_pylist():
                page, last = row["page_id"], row["last"]
                revisits = last is not None and page != last
                name = f"<urn:page:{'' if page is None else page}>"
                record = record_bytes(
                    "revisit" if revisits else "response", name, row["url"], row["body"], row["digest"], row["size"], f"<urn:page:{last}>" if revisits else None
                )
                out.append(members(record)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    lines = rows.mapInArrow(records, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", "\0").option("maxRecordsPerFile", per_file).text(path)


RECORDS = "file string, position bigint, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary, gap_end bigint, gap_reason string"


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives in a folder, and their quarantined gaps as rows with ``gap_end``.

    A task holds one archive at a time (2 GB at most, the limit of Spark's binary files).
    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for revisits as
    their records state it; of HTTP messages the payload is the block without its head. See ``salvage`` for damaged archives.
    """

    def number(field: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", field or "")
        return int(found[1]) if found else None

    def stated(f: dict[str, str], body: bytes) -> tuple[int, str]:
        size = f.get("x-payload-length", "")
        size = int(size) if size.isdigit() and f.get("warc-type") == "revisit" else len(body)
        return size, hex_digest(f.get("warc-payload-digest", "")) or hashlib.sha1(body).hexdigest()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["file"], frame["content"], strict=True):
                found = salvage(content)
                rows = [
                    (file, at, number(f.get("warc-record-id")), f.get("warc-target-uri"), *stated(f, payload_of(f, block)), f.get("warc-type"), number(f.get("warc-refers-to")), payload_of(f, block) if payload else None, None, None)
                    for at, f, block in found.records
                ]
                rows += [(file, a, None, None, None, None, None, None, None, b, why) for a, b, why in found.gaps]
                for k in range(0, len(rows), 2000):
                    part = pd.DataFrame(rows[k : k + 2000], columns=names, dtype=object)
                    yield part.astype({c: "Int64" for c in ("position", "page_id", "payload_bytes", "refers_to", "gap_end")})

    names = [x.split()[0] for x in RECORDS.split(", ")]
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInPandas(read, RECORDS)

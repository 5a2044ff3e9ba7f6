"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The pieces and the byte fallback are compiled into one transducer over characters. Only models with
an identity normaliser are taken: spaces become marks beforehand, other rules raise an error. Composed with an input it is a lattice of pieces, and the encoding is the lattice's
shortest path in the tropical semiring (weights add along a path, the least path wins).

In a unigram model a piece weighs its negative log-probability. In a BPE model the path is the one
whose neighbours could not have been merged otherwise: a pair of pieces weighs 0 if merging
its characters by rank gives that very pair, and infinity if not. Exactly one path through
the lattice is then finite, and it is the model's encoding.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tandem.llm.common import ragged, small_batches, text_of

MARK = "▁"
UNIGRAM, BPE = 1, 2


@dataclass
class State:
    """A state of the piece transducer: arcs by character, and the piece accepted here, if any."""

    arcs: dict[str, State]
    piece: int = -1


class PieceTransducer:
    """Encoder and decoder of one model. ``most`` bounds each of its memories (encodings of
    segments, weights of pairs); a full one starts afresh."""

    def __init__(self, path: str, most: int = 700_000):
        proto = sentencepiece_model_pb2.ModelProto()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto.ParseFromString(model.serialized_model_proto())
        spec, train = proto.normalizer_spec, proto.trainer_spec
        if spec.precompiled_charsmap or train.treat_whitespace_as_suffix or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise NotImplementedError("a normaliser that does more than mark spaces")
        if train.model_type not in (UNIGRAM, BPE):
            raise NotImplementedError("neither a unigram nor a BPE model")
        self.kind, self.prefix, self.most = train.model_type, spec.add_dummy_prefix, most
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.text = [p.piece for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        if any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise NotImplementedError("user-defined pieces")
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.start = State({})
        for piece, number in self.ids.items():
            at = self.start
            for c in piece:
                at = at.arcs.setdefault(c, State({}))
            at.piece = number
        # segments end before a mark if no piece has one behind another character
        self.apart = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.marks_only = not any(p.startswith(MARK * 2) and p.strip(MARK) for p in self.ids)
        # characters that are neighbours within some piece; between others a segment ends for sure
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.least = min((s for s in self.score), default=0.0)
        self.known: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        controls = {i for i, p in enumerate(proto.pieces) if p.type in (kinds.CONTROL, kinds.UNUSED)}
        byte_of = {i: b for b, i in self.byte.items()}
        self.surface = [
            bytes([byte_of[i]]) if i in byte_of else b"" if i in controls else " ⁇ ".encode() if i == self.unknown else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.text)
        ]

    def merged(self, symbols: list[str]) -> list[str]:
        """BPE by rank: the best-scored neighbours merge first, of equals the leftmost."""
        if len(symbols) > 64:
            return self.merged_by_heap(symbols)
        while len(symbols) > 1:
            best = max(((self.score[i], -k) for k in range(len(symbols) - 1) if (i := self.ids.get(symbols[k] + symbols[k + 1])) is not None), default=None)
            if best is None:
                break
            k = -best[1]
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def merged_by_heap(self, symbols: list[str]) -> list[str]:
        """``merged`` for long lists: pairs wait in a heap by score and place; outdated ones are passed over."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < len(symbols):
                a, b = symbols[k], symbols[after[k]]
                if (i := self.ids.get(a + b)) is not None:
                    heapq.heappush(heap, (-self.score[i], k, a, b))

        for k in range(len(symbols)):
            offer(k)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if symbols[k] != a or j == len(symbols) or symbols[j] != b:
                continue
            symbols[k], symbols[j], after[k] = a + b, "", after[j]
            if after[j] < len(symbols):
                before[after[j]] = k
            offer(before[k])
            offer(k)
        return [s for s in symbols if s]

    def fits(self, left: int, right: int) -> bool:
        """Whether the pair weighs 0: merging the characters of both gives them back."""
        got = self.pairs.get((left, right))
        if got is None:
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            a, b = self.text[left], self.text[right]
            got = self.pairs[left, right] = self.merged(list(a + b)) == [a, b]
        return got

    @lru_cache(maxsize=4096)  # noqa: B019
    def marks(self, n: int) -> tuple[int, ...]:
        """A run of marks; the pieces of marks all have one score, so their merges go by place."""
        return tuple(self.ids.get(s, self.unknown) for s in self.merged([MARK] * n))

    def shortest(self, text: str) -> list[int]:
        """Ids on the shortest path through the lattice of one normalised segment."""
        n, bpe, fits = len(text), self.kind == BPE, self.fits
        cost = [0.0] + [np.inf] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        reached = [True] + [False] * n
        for i in range(n):
            if not reached[i]:
                continue
            last, at, single = back[i][1], self.start, False
            for j in range(i, n):
                at = at.arcs.get(text[j])
                if at is None:
                    break
                p = at.piece
                if p < 0:
                    continue
                single = single or j == i
                if bpe:
                    # the prefix up to j + 1 has one valid path, so the first found is it
                    if not reached[j + 1] and (fits(last, p) if last >= 0 else i > 0 or j == i or self.whole(p)):
                        reached[j + 1], back[j + 1] = True, (i, p)
                elif cost[i] - self.score[p] < cost[j + 1]:
                    reached[j + 1], cost[j + 1], back[j + 1] = True, cost[i] - self.score[p], (i, p)
            if not single and not (bpe and reached[i + 1]):
                c = cost[i] - (self.least - 10.0)
                if bpe or c < cost[i + 1]:
                    reached[i + 1], cost[i + 1], back[i + 1] = True, c, (i, -2)
        path, at = [], n
        while at:
            i, p = back[at]
            path.append([p] if p >= 0 else self.fallback(text[i:at]))
            at = i
        return [p for part in reversed(path) for p in part]

    @lru_cache(maxsize=65536)  # noqa: B019
    def whole(self, piece: int) -> bool:
        """Whether merging the piece's own characters gives the piece."""
        return self.merged(list(self.text[piece])) == [self.text[piece]]

    def fallback(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode()] if len(self.byte) == 256 else [self.unknown]

    def segment(self, text: str) -> bytes:
        """Ids of a normalised segment as bytes: marks, if any, then characters that are none."""
        got = self.known.get(text)
        if got is None:
            joined = self.joined
            cuts = [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in joined]
            if cuts:
                return b"".join([self.segment(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)])
            ids = self._segment(text)
            got = np.array(ids, np.int32).tobytes()
            if len(text) <= 64:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[text] = got
        return got

    def _segment(self, text: str) -> list[int]:
        if self.kind == BPE and self.marks_only:
            rest = text.lstrip(MARK)
            n = len(text) - len(rest)
            if not rest:
                return list(self.marks(n))
            if n > 1:
                ids = self.shortest(MARK + rest)
                if ids[0] == self.ids.get(MARK):  # no letter took the last mark
                    return [*self.marks(n), *ids[1:]]
                return [*self.marks(n - 1), *ids]
        return self.shortest(text)

    def _encode_marked(self, text: str) -> bytes:
        if not self.apart:
            return self.segment(text)
        return b"".join(map(self.segment, re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", text)))

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the empty text has none."""
        if not text:
            return []
        marked = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return np.frombuffer(self._encode_marked(marked), np.int32).tolist()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts, one after another, and the number of ids of each.

        Texts whose words are parted by single spaces are looked up word by word, each
        distinct word of the batch once.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        lists = pc.split_pattern(texts, " ")
        ends = np.asarray(lists.offsets, np.int64)
        words = lists.values.slice(ends[0], ends[-1] - ends[0])
        ends = ends - ends[0]
        coded = words.dictionary_encode()
        codes, distinct = np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()
        odd = np.fromiter((not w or MARK in w for w in distinct), bool, len(distinct))
        plain = self.prefix and self.apart
        hard = np.add.reduceat(np.append(odd[codes], False), ends[:-1], dtype=np.int64) > 0 if len(texts) and plain else np.ones(len(texts), bool)
        got = [b"" if o else self.segment(MARK + w) if plain else b"" for w, o in zip(distinct, odd.tolist(), strict=True)]
        lens = np.fromiter(map(len, got), np.int64, len(got)) // 4
        flat = np.frombuffer(b"".join(got), np.int32)
        starts = np.cumsum(lens) - lens
        for k in np.flatnonzero(hard):  # their words count for nothing, the text for itself
            codes[ends[k] : ends[k + 1]] = -1
        extra = [np.array(self.encode(texts[int(k)].as_py()), np.int32) for k in np.flatnonzero(hard)]
        extra_lens = np.fromiter(map(len, extra), np.int64, len(extra))
        starts = np.concatenate([starts, len(flat) + np.cumsum(extra_lens) - extra_lens, [0]])
        lens = np.concatenate([lens, extra_lens, [0]])
        flat = np.concatenate([flat, *extra])
        codes[ends[:-1][hard]] = len(distinct) + np.arange(len(extra))
        total = np.concatenate([[0], np.cumsum(lens[codes])]).astype(np.int64)
        return ragged(codes, starts, lens, flat), total[ends[1:]] - total[ends[:-1]]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces' characters and bytes joined, marks as spaces, without the
        space that normalising put in front; bytes that are no UTF-8 become U+FFFD."""
        surface = self.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def transducer(path: str) -> PieceTransducer:
    """The worker's transducer of a model file."""
    return PieceTransducer(path)


def encode_pieces(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", round_trip: bool = True) -> DataFrame:
    """``(doc_id, n_ids, ids)`` of every whole text, and with ``round_trip`` whether decoding gives it back.

    A null or empty text has no ids. A mark in a text decodes as a space, so its round trip is
    false. Repeated rows are encoded each; an empty table gives no rows. Memory: one batch of
    texts, and the worker's bounded memories.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in small_batches(batches, 1, 8 << 20):
            ids, counts = machine.encode_all(batch.column(1))
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            out = [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))]
            if round_trip:
                numbers = ids.tolist()
                back = [machine.decode(numbers[a:b]) == t for a, b, t in zip(ends[:-1].tolist(), ends[1:].tolist(), batch.column(1).to_pylist(), strict=True)]
                out.append(pa.array(back, pa.bool_()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id bigint, n_ids bigint, ids array<int>" + ", round_trip boolean" * round_trip
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, schema)


def decode_pieces(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of rows of ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            texts = [None if x is None else machine.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col(key).cast("bigint").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id bigint, text string")

"""The unigram subword model (Kudo, 2018) over distinct words: expected counts by the forward-backward
algorithm, pruning by loss, an exact vocabulary size; and encoding of any text by the model.

What grows with the corpus is the word table, and it stays distributed. The model is small: it has at most
``seed_size`` pieces, so it is collected and broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.text import WORD_START, WS_CHARS, sanitize
from tandem.operators.vocab import RESERVED_PIECES, unigram_seed
from tandem.session import dealt

#: Expected counts are summed as whole numbers of this fraction, so that the sums don't hang on the order.
UNIT = 1 << 24
#: What a character costs that no piece holds, below the least score.
UNKNOWN = 10.0


def digamma(x: float) -> float:
    out = 0.0
    while x < 7:
        out -= 1 / x
        x += 1
    x -= 0.5
    y = 1 / (x * x)
    return out + math.log(x) + y / 24 - 7 * y * y / 960 + 31 * y**3 / 8064


@dataclass
class UnigramModel:
    """Pieces with their log probabilities; a character outside it is a piece of its own, at a fixed low score."""

    scores: dict[str, float]

    def __post_init__(self):
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN

    def lattice(self, word: str) -> list[list[tuple[int, float]]]:
        """For every end the pieces of ``word`` that end there: (start, score)."""
        get, n = self.scores.get, len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for start in range(n):
            for end in range(start + 1, min(n, start + self.longest) + 1):
                s = get(word[start:end])
                if s is not None:
                    ends[end].append((start, s))
                elif end == start + 1:
                    ends[end].append((start, self.unknown))
        return ends

    def best(self, word: str, without: str | None = None) -> list[str]:
        """The likeliest segmentation (of equal ones that with the earliest starts), which may have to do without one piece."""
        n = len(word)
        top, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for end, pieces in enumerate(self.lattice(word)):
            for start, s in pieces:
                if word[start:end] != without and top[start] + s > top[end]:
                    top[end], back[end] = top[start] + s, start
        if top[n] == -math.inf:
            return []
        out = []
        while n:
            out.append(word[back[n] : n])
            n = back[n]
        return out[::-1]

    def expected(self, word: str) -> Iterator[tuple[str, float]]:
        """How often each piece is expected in ``word`` over all its segmentations."""
        n, ends = len(word), self.lattice(word)
        forward = [0.0] + [-math.inf] * n
        for end in range(1, n + 1):
            forward[end] = _log_sum([forward[start] + s for start, s in ends[end]])
        backward = [-math.inf] * n + [0.0]
        ways: list[list[float]] = [[] for _ in range(n + 1)]
        for end in range(n, 0, -1):
            if end < n:
                backward[end] = _log_sum(ways[end])
            for start, s in ends[end]:
                ways[start].append(s + backward[end])
        for end in range(1, n + 1):
            for start, s in ends[end]:
                yield word[start:end], math.exp(forward[start] + s + backward[end] - forward[n])


def _log_sum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


class PieceTrie:
    """Pieces by number, as arrays: the sorted steps ``node << 21 | code point``, the nodes they lead to, the nodes' pieces."""

    def __init__(self, pieces: list[str]):
        self.size, self.longest = len(pieces), max(map(len, pieces), default=1)
        node = {"": 0}
        for piece in pieces:
            for k in range(1, len(piece) + 1):
                node.setdefault(piece[:k], len(node))
        steps = np.array([node[p[:-1]] << 21 | ord(p[-1]) for p in node if p], np.int64)
        order = np.argsort(steps)
        self.steps, self.to = np.append(steps[order], np.int64(1) << 62), np.append(order + 1, 0)
        self.number = np.full(len(node), -1, np.int32)
        self.number[[node[p] for p in pieces]] = np.arange(len(pieces))

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces and lengths of all edges in the words' lattices, by end, then by start, and the number of edges per word.

        Every end has an edge of one character, its last one; a character that is no piece has the number ``size``.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(points))  # characters up to the word's end
        found = np.full((len(points), self.longest), -1, np.int32)  # by end, the longest first
        start, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for length in range(1, self.longest + 1):
            step = node << 21 | points[start + length - 1]
            at = np.searchsorted(self.steps, step)
            hit = self.steps[at] == step
            if length == 1:
                found[~hit, -1] = self.size
            start, node = start[hit], self.to[at[hit]]
            number = self.number[node]
            if length == 1:
                number = np.where(number < 0, self.size, number)
            found[start + length - 1, -length] = number
            on = left[start] > length
            start, node = start[on], node[on]
        at = np.flatnonzero(found.reshape(-1) >= 0)
        counts = np.add.reduceat(np.append((found >= 0).sum(axis=1), 0), np.minimum(ends - sizes, len(points))) * (sizes > 0) if words else sizes
        return found.reshape(-1)[at], (self.longest - at % self.longest).astype(np.int32), counts


def lattices(counts: DataFrame, trie: PieceTrie) -> DataFrame:
    """``(freq, edges)``: per word its lattice of numbered pieces, looked up once for all passes.

    ``edges`` holds the edges as 64-bit whole numbers ``piece << 32 | length``.
    """
    shared = counts.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for freq, words in _parts(batch):
                piece, length, sizes = shared.value.edges(words)
                raw = (piece.astype(np.int64) << 32 | length).tobytes()
                ends = np.concatenate([[0], np.cumsum(sizes)]) * 8
                found = pa.array([raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([freq, found], names=["freq", "edges"])

    return counts.select("freq", "word").mapInArrow(run, "freq bigint, edges binary")


def _parts(batch: pa.RecordBatch, most: int = 1 << 16) -> Iterator[tuple[pa.Array, list[str]]]:
    """Rows with marked words, about ``most`` characters at once."""
    words = [WORD_START + w for w in batch.column(1).to_pylist()]
    a, size = 0, 0
    for b, word in enumerate(words, 1):
        size += len(word)
        if size >= most or b == len(words):
            yield batch.column(0).slice(a, b - a), words[a:b]
            a, size = b, 0


class Words:
    """Lattices of some words as flat arrays, of the pieces in ``scores`` only (NaN: not in the model).

    Nodes are numbered word by word, a word of n characters has n + 1. Edges are sorted by the place of their end in the
    word, so that step ``t`` of a sweep takes the edges of all words that end behind ``t`` characters.
    """

    def __init__(self, freq: np.ndarray, piece: np.ndarray, length: np.ndarray, counts: np.ndarray, scores: np.ndarray):
        word = np.repeat(np.arange(len(counts)), counts)
        score = scores[piece]
        kept = ~np.isnan(score)
        if not kept.all():
            piece, length, word, score = piece[kept], length[kept], word[kept], score[kept]
        single = length == 1
        end = np.cumsum(single) - single + word + 1
        sizes = np.bincount(word[single], minlength=len(counts))
        self.first = np.cumsum(sizes + 1) - sizes - 1
        self.last = self.first + sizes
        place = end - self.first[word]
        order = np.argsort(place.astype(np.uint16) if len(place) and place.max() < 1 << 16 else place, kind="stable")  # 16 bits sort faster
        self.piece, self.word, self.score = piece[order], word[order], score[order]
        self.end = end[order]
        self.start = self.end - length[order]
        self.nodes = int(sizes.sum()) + len(sizes)
        self.steps = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=1)[1:])])
        self.groups = np.flatnonzero(np.append(True, self.end[1:] != self.end[:-1])) if len(order) else order
        self.group_steps = np.searchsorted(self.groups, self.steps)
        self.freq = freq

    def sweep(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Per step its edges, where the groups of edges with one end begin among them, and the groups' sizes."""
        for a, b, x, y in zip(self.steps[:-1], self.steps[1:], self.group_steps[:-1], self.group_steps[1:], strict=True):
            begins = self.groups[x:y] - a
            yield slice(a, b), begins, np.diff(begins, append=b - a)

    def expected(self) -> np.ndarray:
        """The probability of each edge over all segmentations of its word.

        Forward, the share of each edge among the ways to its end; backward, the probability of each node. Neither can run
        out of range.
        """
        forward = np.zeros(self.nodes)
        share = np.empty(len(self.piece))
        for at, begins, sizes in self.sweep():
            ways = forward[self.start[at]] + self.score[at]
            most = np.maximum.reduceat(ways, begins)
            ways = np.exp(ways - np.repeat(most, sizes))
            total = np.add.reduceat(ways, begins)
            forward[self.end[at.start + begins]] = most + np.log(total)
            share[at] = ways / np.repeat(total, sizes)
        node = np.zeros(self.nodes)
        node[self.last] = 1.0
        for a, b in zip(self.steps[-2::-1], self.steps[:0:-1], strict=True):
            share[a:b] *= node[self.end[a:b]]
            node[self.start[a:b]] += share[a:b]  # edges with one end have different starts
        return share

    def used(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces and words of the edges on the likeliest paths; of equal ones those with the earliest starts."""
        top, back = np.zeros(self.nodes), np.zeros(self.nodes, np.int64)
        for at, begins, sizes in self.sweep():
            ways = top[self.start[at]] + self.score[at]
            most = np.maximum.reduceat(ways, begins)
            nodes = self.end[at.start + begins]
            top[nodes] = most
            hits = np.flatnonzero(ways == np.repeat(most, sizes))[::-1]
            back[self.end[at.start + hits]] = at.start + hits  # the first of a group is written last
        nodes = self.last[self.last > self.first]
        while len(nodes):
            edge = back[nodes]
            yield self.piece[edge], self.word[edge]
            nodes = self.start[edge]
            nodes = nodes[nodes > self.first[self.word[edge]]]


#: Edges that are worked on at once.
EDGES = 1 << 17


def _summed(lattice: DataFrame, pieces: list[str], model: UnigramModel, amounts, most: int) -> dict[str, int]:
    """Per piece of the model the sum of ``amounts(words)``, pairs of piece numbers and whole numbers; one row per piece
    and task is shuffled. A word adds at most ``most`` per occurrence and character."""
    scores = np.array([model.scores.get(p, math.nan) for p in pieces] + [model.unknown])
    shared = lattice.sparkSession.sparkContext.broadcast(scores)

    def rows(total: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["piece", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = shared.value
        total, load = np.zeros(len(scores), np.int64), 0
        for batch in batches:
            freq, found = batch.column(0).to_numpy(), batch.column(1)
            offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1].astype(np.int64) // 4
            flat = np.frombuffer(found.buffers()[2], np.int32) if offsets[-1] > offsets[0] else np.zeros(0, np.int32)
            a = 0
            while a < len(freq):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + 2 * EDGES, side="right")) - 1)
                own = flat[offsets[a] : offsets[b]]
                words = Words(freq[a:b], own[1::2], own[::2], np.diff(offsets[a : b + 1]) // 2, scores)
                adds = int((words.freq.astype(np.float64) * (words.last - words.first)).sum()) * most
                if load and load + adds > 1 << 62:
                    yield rows(total)
                    total[:], load = 0, 0
                load += adds
                for piece, n in amounts(words):
                    np.add.at(total, piece, n)
                a = b
        yield rows(total)

    out = lattice.mapInArrow(run, "piece bigint, n bigint").groupBy("piece").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    got = {pieces[r["piece"]]: int(r["n"]) for r in out.where(F.col("piece") < len(pieces)).collect()}
    shared.destroy()
    return got


def expected_counts(lattice: DataFrame, pieces: list[str], model: UnigramModel) -> dict[str, int]:
    """Expected occurrences of the model's pieces in all words, in units."""

    def amounts(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield words.piece, np.rint(words.expected() * UNIT).astype(np.int64) * words.freq[words.word]

    return _summed(lattice, pieces, model, amounts, UNIT)


def maximized(expected: dict[str, int], want: int = 0, least: float = 0.5) -> UnigramModel:
    """The M step with a sparse Dirichlet prior: pieces expected less than ``least`` times go, but for characters and
    the ``want`` pieces expected most."""
    order = sorted(expected, key=lambda p: (-expected[p], p))
    kept = {p: expected[p] / UNIT for k, p in enumerate(order) if k < want or expected[p] >= least * UNIT or len(p) == 1}
    total = digamma(sum(sorted(kept.values())))
    return UnigramModel({p: digamma(max(c, 1e-3)) - total for p, c in sorted(kept.items())})


def segment_counts(lattice: DataFrame, pieces: list[str], model: UnigramModel) -> dict[str, int]:
    """How often each piece is used in the likeliest segmentation of all words."""

    def amounts(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for piece, word in words.used():
            yield piece, words.freq[word]

    return _summed(lattice, pieces, model, amounts, 1)


def pruned(model: UnigramModel, used: dict[str, int], size: int) -> UnigramModel:
    """The ``size`` pieces whose loss would cost the corpus the most likelihood, and all characters.

    A lost piece is replaced by its likeliest other segmentation, whose pieces take over its occurrences.
    """
    total = sum(used.values())
    loss = {}
    for piece in model.scores:
        if len(piece) == 1:
            continue
        other = model.best(piece, without=piece)
        n = used.get(piece, 0)
        if not n or not other:
            loss[piece] = 0.0 if other else math.inf
            continue
        grown = total + n * (len(other) - 1)
        now = math.log(n / total)
        then = sum(math.log((used.get(p, 0) + n) / grown) for p in other)
        loss[piece] = n * (now - then)
    characters = [p for p in model.scores if len(p) == 1]
    keep = sorted(loss, key=lambda p: (-loss[p], p))[: max(0, size - len(characters))]
    return UnigramModel({p: model.scores[p] for p in sorted([*characters, *keep])})


def learn_unigram_em(
    counts: DataFrame, vocab_size: int, seed_size: int | None = None, max_piece_len: int = 16, shrink: float = 0.75, steps: int = 2,
) -> tuple[DataFrame, UnigramModel]:
    """A vocabulary of exactly ``vocab_size`` rows (piece, score): the reserved pieces at score 0, all characters, and the
    best longer pieces. It has fewer rows only if the corpus has fewer pieces, more only if it has more characters.

    From ``seed_size`` seeds (frequent substrings, and the characters) rounds of ``steps`` EM steps and a pruning to the share ``shrink``
    come near the size; the last pruning hits it. Words stay distributed, with their lattices of seeds, which all later
    models are subsets of; the driver holds the model only.
    """
    want = max(0, vocab_size - len(RESERVED_PIECES))
    counts = dealt(counts).checkpoint(eager=True)
    seeds = unigram_seed(counts, seed_size or 4 * vocab_size, max_piece_len, materialize=False)
    model = maximized({r["piece"]: int(r["freq"]) * UNIT for r in seeds.toLocalIterator()}, want)
    pieces = sorted(model.scores)
    lattice = lattices(counts, PieceTrie(pieces)).checkpoint(eager=True)
    while True:
        for _ in range(steps):
            found = expected_counts(lattice, pieces, model)
            model = maximized({p: found.get(p, 0) for p in model.scores}, want)
        if len(model.scores) <= want:
            break
        size = max(want, int(len(model.scores) * shrink))
        size = want if size <= 1.1 * want else size
        before = len(model.scores)
        model = pruned(model, segment_counts(lattice, pieces, model), size)
        if size == want or len(model.scores) == before:
            break
    rows = [(p, 0.0) for p in RESERVED_PIECES] + sorted(model.scores.items(), key=lambda x: (-x[1], x[0]))
    spark = counts.sparkSession
    return spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "score"]), "piece string, score double"), model


def encode_text(model: UnigramModel, text: str, cached) -> list[str]:
    out: list[str] = []
    for word in text.translate(_SPACES).split(" "):
        if word:
            out += cached(word)
    return out


_SPACES = str.maketrans({c: " " for c in WS_CHARS})


def _by_size(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and, unless it is one row, ``size`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < batch.num_rows:
        full = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, side="right"))
        b = max(a + 1, min(a + rows, full))
        yield batch.slice(a, b - a)
        a = b


class PieceCounter:
    """How many pieces words have; those of ``most`` words are remembered, a full memory starts afresh."""

    def __init__(self, model: UnigramModel, most: int = 500_000):
        pieces = sorted(model.scores)
        self.trie = PieceTrie(pieces)
        self.scores = np.array([model.scores[p] for p in pieces] + [model.unknown])
        self.known: dict[str, int] = {}
        self.most = most

    def of(self, texts: list[str]) -> list[int]:
        """The number of pieces of each text."""
        split = [[w for w in t.translate(_SPACES).split(" ") if w] for t in texts]
        distinct = set().union(*split)
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = list(distinct)
        for at in range(0, len(new), 8192):
            self.learn(new[at : at + 8192])
        get = self.known.__getitem__
        return [sum(map(get, words)) for words in split]

    def learn(self, new: list[str]) -> None:
        words = Words(np.ones(len(new), np.int64), *self.trie.edges([WORD_START + w for w in new]), self.scores)
        sizes = np.zeros(len(new), np.int64)
        for _, word in words.used():
            sizes[word] += 1  # a step takes one edge per word
        self.known.update(zip(new, sizes.tolist(), strict=True))


def encode_unigram(sentences: DataFrame, model: UnigramModel, id_col: str = "sid", text_col: str = "text", with_pieces: bool = True) -> DataFrame:
    """``(id, pieces, n_pieces)`` of every sentence by the model, seen words or not, in one pass without a shuffle.

    The model is broadcast; a task keeps the segmentations of its 100,000 latest words, or the piece counts of 500,000. A null or blank sentence has no pieces.
    """
    shared = sentences.sparkSession.sparkContext.broadcast(model)
    kind = sentences.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cached = lru_cache(100_000)(lambda word: m.best(WORD_START + word))
        counter = None if with_pieces else PieceCounter(m)
        for batch in batches:
            for part in _by_size(batch, 1024, 4 << 20):
                texts = [t or "" for t in part.column(1).to_pylist()]
                got = [encode_text(m, t, cached) for t in texts] if with_pieces else []
                sizes = pa.array([len(g) for g in got] if with_pieces else counter.of(texts), pa.int64())
                arrays = [part.column(0), pa.array(got, pa.list_(pa.string())), sizes] if with_pieces else [part.column(0), sizes]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "pieces", "n_pieces"] if with_pieces else [id_col, "n_pieces"])

    schema = f"{id_col} {kind}, " + ("pieces array<string>, " if with_pieces else "") + "n_pieces bigint"
    return sentences.select(id_col, sanitize(text_col).alias("text")).mapInArrow(run, schema)

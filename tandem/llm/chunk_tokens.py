"""Whole texts to ids with the tokenizers library, each distinct part of a text encoded once while a worker remembers it.

A word-level BPE that drops white space never joins ids across white space, nor between a
letter and an ASCII character that is no letter. So a text's ids are the ids of its parts
in order. They are cut by their bytes in arrays, and Arrow's dictionary encoding finds a
batch's distinct parts without a Python object per word.
"""

from __future__ import annotations

import json
import re
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tandem.llm.common import ragged

#: Letters of the Latin blocks, below U+0250, without the one whose lower case is two characters. A chunk ends between one of them and an ASCII
#: character that is no letter (never before an apostrophe's contraction: see ``PARTS``).
LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
PARTS = re.compile(rf"[{LATIN}]+(?=[\x00-\x40\x5b-\x60\x7b-\x7f]|\Z)|[\x21-\x26\x28-\x40\x5b-\x60\x7b-\x7e]+(?=[{LATIN}])|.+?(?<=[{LATIN}])(?=[\x00-\x40\x5b-\x60\x7b-\x7f])|.+", re.S)
LETTERS = re.compile(rf"[{LATIN}]+\Z")


def letters(part: str) -> bool:
    """Whether ``LETTERS`` matches; most parts are ASCII, which needs no pattern."""
    return part.isalpha() if part.isascii() else LETTERS.match(part) is not None


def parts_of(chunk: str) -> list[str]:
    """The parts of a chunk that is not all letters; the usual one is a word and one other character."""
    if chunk.isascii() and chunk[:-1].isalpha():
        return [chunk[:-1], chunk[-1]]
    return PARTS.findall(chunk)


#: Bytes of the longest part that is remembered.
LONG = 64
#: Kinds of bytes: of other characters, white space, Latin letters, ASCII characters from ! to ~ between which and a letter a part ends, other
#: ASCII ones, before which a letter's part ends.
OTHER, SPACE, LETTER, SIGN, BEFORE = range(5)
KINDS = bytes([SPACE if c in b"\t\n\v\f\r " else LETTER if chr(c).isalpha() else SIGN if 0x20 < c < 0x7F and c != 0x27 else BEFORE for c in range(128)] + [OTHER] * 128)
#: Whether a part begins between bytes of two kinds, at 8 * the first + the second.
BEGINS = bytes([k // 8 == SPACE or k in (8 * LETTER + SIGN, 8 * LETTER + BEFORE, 8 * SIGN + LETTER) for k in range(256)])


def byte_kinds(raw: np.ndarray) -> np.ndarray:
    """The kind of every byte of UTF-8 text.

    Of white space beyond ASCII, only U+0085 and U+00A0 are told; the rest stays inside of parts, where the tokenizer drops it.
    """
    kinds = np.frombuffer(bytearray(raw).translate(KINDS), np.uint8)
    first = np.flatnonzero((raw >= 0xC2) & (raw <= 0xC8))
    pair = raw[first].astype(np.int32) << 8 | raw[first + 1]
    latin = (pair >= 0xC380) & (pair != 0xC397) & (pair != 0xC3B7) & (pair != 0xC4B0)  # no × ÷ İ, see LATIN
    for some, kind in ((first[latin], LETTER), (first[(pair == 0xC285) | (pair == 0xC2A0)], SPACE)):
        kinds[some] = kinds[some + 1] = kind
    return kinds


def cut_parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts (large strings without nulls) in order, and the number of parts of each text."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    kinds = byte_kinds(raw)
    begins = np.ones(len(raw), bool)
    begins[1:] = np.frombuffer(((kinds[:-1] << 3) + kinds[1:]).tobytes().translate(BEGINS), bool)
    begins[ends[:-1][ends[:-1] < len(raw)]] = True
    kept = kinds != SPACE
    counts = np.diff(np.searchsorted(np.flatnonzero(begins & kept), ends))
    raw = raw[kept]
    at = np.append(np.flatnonzero(begins[kept]), len(raw)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)]), counts


#: Combining marks: a small letter may compose with one where its capital doesn't (U+01F0), so texts with them keep their capitals.
MARKS = "[\\x{300}-\\x{36f}]"


def added_pattern(tokenizer: Tokenizer) -> str | None:
    """A pattern of all texts that may hold an added token of the file; None if it has none."""
    tokens = tokenizer.get_added_tokens_decoder().values()
    if any(t.normalized for t in tokens):
        return ""  # they are found in the normalised text: any text may hold one
    return "|".join(re.escape(t.content) for t in tokens) or None


class ChunkEncoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    With ``added``, the file's added tokens in a text have their ids, as by the unchanged tokenizer, which
    encodes such texts whole; without, their strings are ordinary text. Parts of at most ``LONG`` bytes are remembered with
    their ids; when they are more than ``most``, the half of ``most`` that was used last stays.

    If the tokenizer lower-cases, texts without combining marks have A-Z lower-cased first. If it marks the ends of words,
    new parts of letters, each one word, are encoded as one text and cut behind the ids that end a word.
    """

    def __init__(self, path: str, most: int = 800_000, added: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = added_pattern(self.tokenizer) if added else None
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [parts["normalizer"] or {"type": ""}])]
        self.lowers = "Lowercase" in kinds and set(kinds) <= {"NFC", "Replace", "Lowercase"}
        suffix = parts["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
        self.most = most
        #: The place of each remembered part; by place, the number of its ids, all ids, and the batch that used it last.
        self.parts: dict[bytes, int] = {}
        self.lens, self.flat, self.used, self.batch = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64), 0

    def _learn(self, parts: list[bytes]) -> None:
        """Add parts to the memory."""
        texts = [p.decode() for p in parts]
        words, rest, order, lens, flat = [], [], [], [], []
        for k, part in enumerate(texts):
            (words if letters(part) else rest).append(k)
        if not self.ends.any():
            words, rest = [], words + rest
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([texts[k] for k in some])], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                rest += some  # more or fewer word ends than words
                continue
            order += some
            lens.append(np.diff(cuts, prepend=0))
            flat.append(ids)
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            got = [x.ids for x in self.tokenizer.encode_batch_fast([texts[k] for k in some], add_special_tokens=False)]
            order += some
            lens.append(np.array([len(x) for x in got], np.int64))
            flat.append(np.array([i for x in got for i in x], np.uint32))
        self.parts.update(zip([parts[k] for k in order], range(len(self.parts), len(self.parts) + len(order)), strict=True))
        self.lens, self.flat = np.concatenate([self.lens, *lens]), np.concatenate([self.flat, *flat])
        self.used = np.concatenate([self.used, np.zeros(len(order), np.int64)])

    def _forget(self, long: list[int]) -> None:
        """Forget the parts at the places ``long``, and those used least recently when there are too many."""
        stay = np.ones(len(self.parts), bool)
        stay[long] = False
        if len(stay) > self.most:
            stay[np.argsort(self.used, kind="stable")[: len(stay) - self.most // 2]] = False
        if not stay.all():
            self.parts = {p: k for k, p in enumerate(compress(self.parts, stay.tolist()))}
            self.flat, self.lens, self.used = self.flat[np.repeat(stay, self.lens)], self.lens[stay], self.used[stay]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each."""
        texts = texts.cast(pa.large_string()).fill_null("")
        texts = texts.take(pa.array(np.arange(len(texts))))  # ascii_lower wants offsets that begin at 0, a cast slice has others
        held = pc.match_substring_regex(texts, self.added) if self.added is not None else pa.array([False] * len(texts), pa.bool_())
        whole = texts.filter(held).to_pylist()
        if whole:
            texts = pc.if_else(held, pa.scalar("", pa.large_string()), texts)
        if self.lowers:
            texts = pc.if_else(pc.match_substring_regex(texts, MARKS), texts, pc.ascii_lower(texts))
        ids, counts = self._plain(texts)
        if whole:
            self.tokenizer.encode_special_tokens = False
            whole = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
            self.tokenizer.encode_special_tokens = True
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k, own in zip(np.flatnonzero(held.to_numpy(zero_copy_only=False)).tolist(), whole, strict=True):
                parts[k], counts[k] = own, len(own)
            ids = np.concatenate(parts)
        return ids, counts

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are cut into parts."""
        parts, n_parts = cut_parts(texts)
        parts = parts.dictionary_encode()
        codes, parts = np.asarray(parts.indices, dtype=np.int64), parts.dictionary.to_pandas(deduplicate_objects=False).tolist()  # faster than to_pylist
        known = self.parts
        got = list(map(known.get, parts))
        at = [k for k, place in enumerate(got) if place is None]
        new = [parts[k] for k in at]
        if new:
            self._learn(new)
        for k, p in zip(at, new, strict=True):
            got[k] = known[p]
        places = np.array(got, np.int64)
        self.batch += 1
        self.used[places] = self.batch
        lens = self.lens[places]
        ids = ragged(codes, (np.cumsum(self.lens) - self.lens)[places], lens, self.flat)
        self._forget([known[p] for p in new if len(p) > LONG])
        ends = np.concatenate([[0], np.cumsum(lens[codes])])
        at = np.concatenate([[0], np.cumsum(n_parts)])
        return ids, ends[at[1:]] - ends[at[:-1]]


_ENCODERS: dict[str, ChunkEncoder] = {}


def chunk_encoder(path: str) -> ChunkEncoder:
    """The worker's encoder of a tokenizer file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path, added=True)
    return _ENCODERS[path]

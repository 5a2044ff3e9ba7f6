import random
import sys

import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from tandem.llm.chunk_tokens import ChunkEncoder


def test_every_code_point_between_letters_has_its_ids():
    t, mine = Tokenizer.from_file(P.path("word_bpe_49k.json")), ChunkEncoder(P.path("word_bpe_49k.json"))
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for part in (points[:128], points[128:4096], *(points[a : a + 50_000] for a in range(4096, len(points), 50_000))):
        texts = [f"ab{chr(c)}cd {chr(c)} x{chr(c)}" for c in part]
        want = [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)]
        ids, n = mine.encode(pa.array(texts))
        at, wrong = 0, []
        for text, w, k in zip(texts, want, n.tolist(), strict=True):
            if ids[at : at + k].tolist() != w:
                wrong.append(text)
            at += k
        assert not wrong


def test_a_batch_with_odd_texts_keeps_all_ids():
    t, mine = Tokenizer.from_file(P.path("word_bpe_49k.json")), ChunkEncoder(P.path("word_bpe_49k.json"), most=6, added=True)
    texts = ["one two, three!", "ab\x1ccd \x1c x", None, "", "a <|endoftext|> b\x1d", "\x1f", "don't stop " * 3, "x" * 70 + " y", "one two, three!"]
    for _ in range(2):
        ids, counts = mine.encode(pa.array(texts))
        want = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])


def test_capitals_marks_and_slices_keep_the_librarys_ids():
    t, mine = Tokenizer.from_file(P.path("word_bpe_49k.json")), ChunkEncoder(P.path("word_bpe_49k.json"), most=200, added=True)
    draw = random.Random(5)
    letters = "aAbJjHhTtWwYySsKİIıßÅåſK'’.,!-0129 \n\t\x1c\x85̱̀̌̇̊ÀéŒΣςσяЖ中ǅŉǰ"
    for cut in range(20):
        texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(200)] + ["<|endoftext|> A b", "J̌ x", "It'S don'T", "a" * 3000, None, ""]
        ids, counts = mine.encode(pa.array(["Çé xyz"] * cut + texts, pa.string()).slice(cut))
        want = [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]


def test_parts_without_the_pattern_equal_the_pattern():
    import itertools

    from tandem.llm.chunk_tokens import LETTERS, PARTS, letters, parts_of

    for size in (1, 2, 3, 4):
        for chars in itertools.product("aZé'1,ſİ日", repeat=size):
            chunk = "".join(chars)
            assert letters(chunk) == bool(LETTERS.match(chunk))
            if not letters(chunk):
                assert parts_of(chunk) == PARTS.findall(chunk), chunk


class Recorder:
    """A tokenizer that notes the texts it encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.seen += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_parts_in_use_are_encoded_once_however_many_others_pass():
    t, mine = Tokenizer.from_file(P.path("word_bpe_49k.json")), ChunkEncoder(P.path("word_bpe_49k.json"), most=300)
    mine.tokenizer = Recorder(mine.tokenizer)
    draw = random.Random(2)
    for k in range(40):
        texts = [f"common{k}, {k}common; " + " ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(10)) for _ in range(5)] + ["日" * 400 + str(k)]
        ids, counts = mine.encode(pa.array(texts))
        want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
        assert len(mine.parts) == len(mine.lens) == len(mine.used) <= 300 and max(map(len, mine.parts)) <= 64
    assert sum(text.split().count("common") for text in mine.tokenizer.seen) == 1


def test_texts_without_parts_have_no_ids():
    mine = ChunkEncoder(P.path("word_bpe_49k.json"), added=True)
    for texts in ([], [""], [None], [" ", "\n\xa0\x85", ""], ["", None, "\u3000"]):
        ids, counts = mine.encode(pa.array(texts, pa.string()))
        assert ids.tolist() == [] and counts.tolist() == [0] * len(texts)


def test_parts_are_the_texts_without_white_space():
    from tandem.llm.chunk_tokens import cut_parts

    texts = ["", "don't, stop!", " a\xa0é×b", "", "xé.", "y日,z İ1a\x00b", "\t"]
    parts, counts = cut_parts(pa.array(["left out", *texts], pa.large_string()).slice(1))
    assert counts.tolist() == [0, 5, 2, 0, 2, 5, 0]
    assert [p.decode() for p in parts.to_pylist()] == ["don", "'t", ",", "stop", "!", "a", "é×b", "xé", ".", "y日,", "z", "İ1", "a", "\x00b"]

import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tandem.llm import id_planes, packing, piece_transducer, queries
from tandem.llm.chunk_tokens import ChunkEncoder
from tandem.llm.common import table
from tests_odd import ODD_TEXTS


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def tokenizer(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return t


def test_pieces_equal_the_library_and_round_trip(spark, sf):
    path = P.path("piece_bpe_32k.model")
    lib, mine = sentencepiece.SentencePieceProcessor(model_file=path), piece_transducer.PieceTransducer(path)
    for t in ODD_TEXTS:
        assert mine.encode(t) == lib.encode(t), t
        assert mine.decode(mine.encode(t)) == lib.decode(lib.encode(t)), t
    ids, n = mine.encode_all(pa.array([*ODD_TEXTS, None]))
    assert ids.tolist() == [i for t in ODD_TEXTS for i in lib.encode(t)] and n[-1] == 0
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    got = queries.op1_sentencepiece(spark, sf).collect()
    assert len(got) == len(texts) and all(list(r.ids) == lib.encode(texts[r.doc_id]) and r.round_trip for r in got)
    back = piece_transducer.decode_pieces(queries.op1_sentencepiece(spark, sf), path)
    assert {r.doc_id: r.text for r in back.collect()} == texts


def test_pieces_of_odd_tables(odd, empty):
    path = P.path("piece_bpe_32k.model")
    assert piece_transducer.encode_pieces(empty, path).count() == 0
    got = piece_transducer.encode_pieces(odd, path).collect()
    assert len(got) == 9 and {r.n_ids for r in got if r.doc_id in (1, 2)} == {0}


def test_chunks_equal_the_library():
    t, mine = tokenizer("word_bpe_49k.json"), ChunkEncoder(P.path("word_bpe_49k.json"), most=500)
    texts = [*ODD_TEXTS, "it's o'clock 'Tis \"'s!'s", "été Å", "İstanbul ΣΑΣ ſ K", "<|endoftext|> a<|startoftext|>"]
    random.seed(3)
    texts += ["".join(random.choice("aB'.,9 é́\n!sİΣ") for _ in range(30)) for _ in range(2000)]
    for part in (texts[:50], texts):
        ids, n = mine.encode(pa.array(part))
        want = [t.encode(x, add_special_tokens=False).ids for x in part]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for n, top in ((0, 9), (1, 2**32), (5000, 50_000), (131, 2**32)):
        ids = rng.integers(0, top, n, dtype=np.uint32)
        w = id_planes.PlaneWriter(bits, block=1000)
        counts = [n // 3, 0, n - n // 3]
        data = w.add([7, None, 9], np.array(counts), ids) + w.close() + b"\n"
        got = list(id_planes.read_planes(data))
        assert np.concatenate([g[3] for g in got]).tolist() == ids.tolist()
        assert np.concatenate([g[2] for g in got]).tolist() == counts
        with pytest.raises(ValueError):
            list(id_planes.read_planes(data[:-3]))


def test_id_files_equal_brute_force(spark, sf, odd, empty, tmp_path):
    t, start = tokenizer("word_bpe_49k.json"), 0
    got = {r.doc_id: r for r in queries.op7_id_planes(spark, sf).collect()}
    for r in sorted(table(spark, sf, "documents").collect(), key=lambda r: r.doc_id):
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    for name, frame, n in (("odd", odd, 9), ("empty", empty, 0)):
        path = str(tmp_path / name)
        id_planes.write_id_files(frame, path, P.path("word_bpe_49k.json"), bits=1, block=512)
        rows = id_planes.id_offsets(id_planes.read_id_files(spark, path)).collect()
        assert len(rows) == n and (n == 0 or sorted(r.start for r in rows)[1] == next(r.n_tokens for r in rows if r.start == 0))


def test_best_fit_finds_the_tightest_window():
    random.seed(5)
    sizes = np.array([random.randint(1, 50) for _ in range(400)])
    windows = packing.best_fit_decreasing(sizes, 50)
    free: list[int] = []
    for s in sorted(sizes.tolist(), reverse=True):
        fit = [f for f in free if f >= s]
        free.remove(min(fit)) if fit else None
        free.append((min(fit) if fit else 50) - s)
    assert sorted(50 - sum(sizes[w]) for w in windows) == sorted(free)


def check_packed(rows, want, capacity=2048):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, ids in want.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == crc(ids[at : at + r.length]) and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    used = []
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        used.append(at)
    padding = sum(capacity - u for u in used if u & (u - 1))
    assert padding <= 0.01 * sum(used)


def test_packing_equals_brute_force(spark, sf, odd, empty):
    t = tokenizer("byte_bpe_50k.json")
    want = {r.doc_id: [*t.encode(r.text or "", add_special_tokens=False).ids, 1] for r in table(spark, sf, "documents").collect()}
    check_packed(queries.op6_packing(spark, sf).collect(), want)
    paths = [P.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]
    assert packing.pack(empty, *paths).count() == 0
    rows = packing.pack(odd, *paths, with_ids=True).collect()
    assert all(crc(r.ids) == r.ids_crc32 for r in rows) and sum(r.length for r in rows if r.doc_id == 4) == 2 * 4
    same = spark.range(300).selectExpr("id as doc_id", "repeat('word ', 1200) as text")
    check_packed(packing.pack(same, *paths).collect(), {k: [*t.encode("word " * 1200).ids, 1] for k in range(300)})


def test_byte_encoder_equals_the_library():
    t, mine = tokenizer("byte_bpe_50k.json"), packing.byte_encoder(*[P.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")])
    for x in [*ODD_TEXTS, "<|endoftext|>", "z" * 6000]:
        assert mine(x).tolist() == t.encode(x, add_special_tokens=False).ids


def test_merges_by_heap_equal_plain_merges():
    mine, rng = piece_transducer.PieceTransducer(P.path("piece_bpe_32k.model")), random.Random(3)
    for n in (65, 90, 130):
        for letters in ("▁", "▁ab", "the▁in", "aeiou▁tnsr"):
            symbols = [rng.choice(letters) for _ in range(n)]
            want = list(symbols)
            while len(want) > 1:
                best = max(((mine.score[i], -k) for k in range(len(want) - 1) if (i := mine.ids.get(want[k] + want[k + 1])) is not None), default=None)
                if best is None:
                    break
                want[-best[1] : 2 - best[1]] = [want[-best[1]] + want[1 - best[1]]]
            assert mine.merged(symbols) == want
    assert sum(len(mine.text[i]) for i in mine.marks(200_000)) == 200_000

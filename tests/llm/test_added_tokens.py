import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from tandem.llm import id_planes, packing

TEXTS = ["hello <|endoftext|> world", "<|startoftext|>a  b<|endoftext|>", "plain text", "", None, "x<|endoftext|><|endoftext|>y"]


def test_added_tokens_have_the_ids_of_the_unchanged_tokenizer(spark, docs_frame, tmp_path):
    frame = docs_frame([(k, t, "en", "s") for k, t in enumerate(TEXTS)]).coalesce(1)
    words, byte = (Tokenizer.from_file(P.path(f"{x}.json")) for x in ("word_bpe_49k", "byte_bpe_50k"))
    want = [[*byte.encode(t or "", add_special_tokens=False).ids, 1] for t in TEXTS]
    got = packing.pack(frame, *[P.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")], with_ids=True).collect()
    parts = {}
    for r in sorted(got, key=lambda r: r.start):
        parts.setdefault(r.doc_id, []).extend(r.ids)
    assert [parts[k] for k in range(len(TEXTS))] == want
    path = str(tmp_path / "ids")
    id_planes.write_id_files(frame, path, P.path("word_bpe_49k.json"))
    want = [[*words.encode(t or "", add_special_tokens=False).ids, 1] for t in TEXTS]
    rows = sorted(id_planes.id_offsets(id_planes.read_id_files(spark, path)).collect(), key=lambda r: r.doc_id)
    assert [r.n_tokens for r in rows] == [len(x) for x in want] and want[0] and len(want[0]) == 4
    assert [r.start for r in rows] == [sum(map(len, want[:k])) for k in range(len(TEXTS))]
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in want]

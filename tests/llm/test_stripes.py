import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.llm import queries, stripes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(rows, longest=5):
    f = {}
    for lang, text in rows:
        here = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            here.update(tuple(w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    return f


def brute(rows, least, top, longest=5):
    out = []
    for lang, f in counts_of(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in often.items():
            inside = any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items())
            if not inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def made(spark, rows, parts=4):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id bigint, lang string, text string").repartition(parts)


TEXTS = [
    "", None, " ", "a", "A b a B", "a b. a b; a b", "a\tb  a b\n\na b", "É é a b É", "x\x00y a b", "日本 語 日本 語. 日本 語", "a　b a　b", "!?.", "a b c d e f g a b c d e f g",
    "x\x1cy x\x1cy", "o'x-y o'x-y a b",
]


@pytest.mark.parametrize(("least", "slot_bits", "n"), [(2, 24, 60), (5, 4, 400), (3, 12, 150)])
def test_phrases_equal_brute_force(spark, least, slot_bits, n):
    rnd = random.Random(least)
    rows = [(rnd.choice(["en", "en", "de", None, ""]), t) for t in TEXTS for _ in range(2)]
    for _ in range(n):
        words = rnd.choices("abcdefghij", weights=[90, 50, 30, 9, 8, 7, 6, 5, 4, 3], k=rnd.randint(1, 30))
        words += ["in", "the", "very", "end", "of", "it"] * rnd.randint(0, 1)
        rows.append((rnd.choice(["en", "de"]), "".join(w + rnd.choice([" ", " ", " ", "  ", ". ", "\n"]) for w in words)))
    got = stripes.collocations(made(spark, rows), least=least, top=25, slot_bits=slot_bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, 25)


def test_odd_and_empty_tables(spark, odd, empty):
    assert stripes.collocations(empty).count() == 0
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert sorted(map(tuple, stripes.collocations(odd).collect())) == brute(rows, 100, 2000)  # one text of 30,000 equal words
    none = made(spark, [("en", None), ("de", "")])
    assert stripes.collocations(none).count() == 0


def test_stripes_merge_element_by_element():
    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), rnd.choice(["p", "q r"]), rnd.randrange(3), [(rnd.choice("uvwxyz"), rnd.randint(1, 9)) for _ in range(rnd.randint(0, 5))]) for _ in range(300)]
    want = {}
    for lang, prefix, bucket, cells in rows:
        here = want.setdefault((lang, prefix, bucket), Counter())
        for w, n in cells:
            here[w] += n
    schema = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("bucket", pa.int32()), ("next", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])
    batches = [
        pa.RecordBatch.from_pylist([{"lang": a, "prefix": p, "bucket": s, "next": [c[0] for c in cells], "n": [c[1] for c in cells]} for a, p, s, cells in rows[k : k + 7]], schema=schema)
        for k in range(0, 300, 7)
    ]
    blocks = pa.Table.from_batches(list(stripes.packed(iter(batches), most=50))).sort_by("bucket")
    for least, totals in ((1, True), (60, False), (60, True)):
        got = [r for b in stripes.frequent(iter(blocks.to_batches(max_chunksize=3)), least, totals) for r in b.to_pylist()]
        assert sorted((r["lang"], r["prefix"], sorted(zip(r["next"], r["n"], strict=True)), r["total"]) for r in got) == sorted(
            (k[0], k[1], sorted((w, n) for w, n in c.items() if n >= least), sum(c.values())) for k, c in want.items() if totals or any(n >= least for n in c.values())
        )


def test_counts_past_64_bits_stay_exact(spark):
    big = spark.createDataFrame([(10**14 + 7, 10**14 + 9, 10**15 + 1, 10**15 + 3)], "a bigint, n bigint, l bigint, r bigint")
    got = big.select(stripes.score_of(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).first().s
    assert got == 1000 * (10**14 + 7) * (10**14 + 9) // ((10**15 + 1) * (10**15 + 3))


def test_slots_hold_at_least_the_power_asked(spark):
    table = np.zeros(1 << 8, np.uint8)
    rows = [("en", f"p{k}", 100 * (k + 1)) for k in range(300)]
    stripes.mark(table, spark.createDataFrame(rows, "lang string, phrase string, a bigint"), 1000)
    for lang, phrase, a in rows:
        h = stripes.crc32(f"{lang}\0".encode()) * stripes.STEP + stripes.crc32(phrase.encode())
        v = int(table[h % stripes.PRIME % len(table)])
        assert v >= 1 and a / 2 ** (v - 1) <= 1000


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({queries.OP12_SQL})").fetchall())
    assert want and sorted(map(tuple, queries.op12_collocations(spark, sf).select(*cols).collect())) == want

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tandem.llm import merkle, queries


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, fanout):
    """All levels of a plain hash tree."""
    tiers = [nodes]
    while len(tiers[-1]) > 1:
        tiers.append([h(tiers[-1][k : k + fanout]) for k in range(0, len(tiers[-1]), fanout)])
    return tiers


def siblings(tiers, at, fanout):
    out = []
    for tier in tiers[:-1]:
        run = range(at - at % fanout, min(at - at % fanout + fanout, len(tier)))
        out += [tier[k] for k in run if k != at]
        at //= fanout
    return out


def text_of(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows, fanout):
    """(leaf, subroot, root, path, folded) of rows (doc_id, source, lang, n_chars, text), in their order."""
    leaf = [h([text_of(v) for v in r]) for r in rows]
    shown = [
        h([text_of(v) for v in (*r[:3], r[3] + 1, r[4])]) if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf[k]
        for k, r in enumerate(rows)
    ]
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(r[2], []).append(k)
    order = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    places, trees = {}, {}
    for g in order:
        groups[g].sort(key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf[k]))
        places |= {k: at for at, k in enumerate(groups[g])}
        trees[g] = tree([leaf[k] for k in groups[g]], fanout)
    top = tree([trees[g][-1][0] for g in order], fanout)
    out = []
    for k, r in enumerate(rows):
        path = siblings(trees[r[2]], places[k], fanout) + siblings(top, order.index(r[2]), fanout)
        node, rest = shown[k], list(path)
        for tiers, at in ((trees[r[2]], places[k]), (top, order.index(r[2]))):
            for tier in tiers[:-1]:
                first = at - at % fanout
                n = min(fanout, len(tier) - first) - 1
                node, rest, at = h([*rest[: at - first], node, *rest[at - first : n]]), rest[n:], at // fanout
        out.append((leaf[k], trees[r[2]][-1][0], top[-1][0], path, node))
    return out


@pytest.mark.parametrize(("fanout", "block_levels", "round_levels", "n"), [(2, 1, 1, 21), (2, 2, 2, 67), (3, 1, 1, 40), (2, 12, 4, 70)])
def test_proofs_equal_a_plain_tree(spark, fanout, block_levels, round_levels, n):
    rnd = random.Random(n)
    langs = ["en", "en", "en", "é", "z", None, "", "single"]
    rows = [(k, rnd.choice(["a", None]), rnd.choice(langs), rnd.choice([None, 5, 9]), rnd.choice([None, "", "x" * k, "ü😀"])) for k in range(n)]
    rows += [rows[3], rows[3], (None, None, "en", 1, "t"), (None, None, None, None, None), (4, "other", rows[4][2], 7, "same id")]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    cols = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = merkle.leaf_hash(cols)
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf_hash([*cols[:3], F.col("n_chars") + 1, cols[4]])).otherwise(leaf)
    got = merkle.merkle_proofs(frame, leaf, claimed, fanout=fanout, block_levels=block_levels, round_levels=round_levels).collect()
    # equal rows stand next to each other, in any order
    want = sorted((repr(r[0]), *w) for r, w in zip(rows, brute(rows, fanout), strict=True))
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, list(r.path), r.folded_root) for r in got) == want
    assert all(r.verified == (r.folded_root == r.root) for r in got)


def test_tampered_rows_alone_fail(spark, odd, empty):
    rows = merkle.manifest(odd).collect()
    assert len(rows) == 9 and len({r.root for r in rows}) == 1
    # the null id is in no tampered class, ids 1 to 7 have no crc32 that 7 divides but for those below
    bad = {k for k in range(1, 8) if zlib.crc32(str(k).encode()) % 7 == 0}
    assert {r.doc_id for r in rows if not r.verified} == bad - {1}  # document 1 has no n_chars
    assert merkle.manifest(empty).count() == 0
    assert merkle.manifest(empty).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    same = spark.range(3000).selectExpr("7L as doc_id", "'s' as source", "'en' as lang", "1L as n_chars", "'x' as text")
    got = merkle.manifest(same).collect()
    assert len(got) == 3000 and len({(r.leaf, r.root) for r in got}) == 1


def test_merkle_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({queries.OP11_SQL})").fetchall())
    assert sorted(map(tuple, queries.op11_merkle(spark, sf).select(*cols).collect())) == want and not all(w[-1] for w in want)

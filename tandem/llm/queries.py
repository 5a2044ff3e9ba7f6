"""The queries of the llm operators, over their whole tables, and the SQL that some of them equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm import attention_mil, id_planes, impact_search, kd_shards, language, merkle, order_minhash, packing, piece_transducer, quality, secret_scan, stripes, warc
from tandem.llm.common import table
from tandem.session import shared_dir


def remainder(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; a null id has 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)), F.lit(0))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    return piece_transducer.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    path = shared_dir(spark, "llm-warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    rows = warc.read_warc(spark, path, payload=False).where(F.col("gap_end").isNull())
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, judged by who else has them."""
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit_language(docs, remainder() != 2)
    rows = docs.select("doc_id", (remainder() == 2).alias("held_out"), "text")
    return language.predict_language(rows, model, keep=("doc_id", "held_out"))


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every 50th vector."""
    return impact_search.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    json_path, ranks_path = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
    return packing.pack(table(spark, sf_dir, "documents"), json_path, ranks_path)


def op7_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written in plane files and read back."""
    path = shared_dir(spark, "llm-planes")
    id_planes.write_id_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return id_planes.id_offsets(id_planes.read_id_files(spark, path))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the cascade's verdict."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit_cascade(docs, quality.MORE))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near-duplicates."""
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal bytes."""
    return kd_shards.shard(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and verdict in a hash tree per language under one root."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language."""
    return stripes.collocations(table(spark, sf_dir, "documents"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score by a classifier of its passages."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    model = attention_mil.fit_quality(docs, table(spark, sf_dir, "labels"), ~held)
    return attention_mil.score_quality(docs.select("doc_id", held.alias("held_out"), "text"), model, keep=("doc_id", "held_out"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_warc, op3_secrets, op4_language, op5_search, op6_packing, op7_id_planes, op8_quality, op9_near_duplicates, op10_shards, op11_merkle,
        op12_collocations, op13_quality_classifier,
    )
}

OP2_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), s AS (
  SELECT page_id, octet_length(body) AS n, sha1(body) AS digest, max(page_id) OVER (PARTITION BY sha1(body)) AS last FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM s
"""

OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""

OP11_SQL = """
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [ascii(d), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))), 4294967295) % 7 = 0 AS tampered
  FROM (SELECT DISTINCT CAST(doc_id AS BIGINT) AS doc_id FROM documents WHERE doc_id IS NOT NULL)
), hashed AS (
  SELECT d.doc_id, d.lang,
    sha256(concat({doc_id}, {source}, {lang}, {n_chars}, {text})) AS leaf,
    CASE WHEN tampered AND n_chars IS NOT NULL THEN sha256(concat({doc_id}, {source}, {lang}, {more}, {text})) END AS claimed
  FROM documents d LEFT JOIN crc c ON c.doc_id = d.doc_id
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS rid FROM hashed
), low(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY pos) FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(concat(nodes[2 * i + 1], nodes[2 * i + 2]))) FROM low WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM low WHERE len(nodes) = 1
), top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY place) FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(concat(nodes[2 * i + 1], nodes[2 * i + 2]))) FROM top WHERE len(nodes) > 1
), walk(rid, lang, level, pos, node, path) AS (
  SELECT rid, lang, 0, pos, coalesce(claimed, leaf), '' FROM leaves
  UNION ALL
  SELECT w.rid, w.lang, w.level + 1, w.pos // 2,
    sha256(CASE WHEN w.pos % 2 = 0 THEN concat(w.node, l.nodes[w.pos + 2]) ELSE concat(l.nodes[w.pos], w.node) END),
    concat(w.path, CASE WHEN w.pos % 2 = 0 THEN l.nodes[w.pos + 2] ELSE l.nodes[w.pos] END)
  FROM walk w JOIN low l ON l.lang IS NOT DISTINCT FROM w.lang AND l.level = w.level AND len(l.nodes) > 1
), bottom AS (
  SELECT w.rid, s.place, w.node, w.path, s.subroot FROM walk w
  JOIN low l ON l.lang IS NOT DISTINCT FROM w.lang AND l.level = w.level AND len(l.nodes) = 1
  JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang
), climb(rid, level, pos, node, path) AS (
  SELECT rid, 0, place, node, path FROM bottom
  UNION ALL
  SELECT c.rid, c.level + 1, c.pos // 2,
    sha256(CASE WHEN c.pos % 2 = 0 THEN concat(c.node, t.nodes[c.pos + 2]) ELSE concat(t.nodes[c.pos], c.node) END),
    concat(c.path, CASE WHEN c.pos % 2 = 0 THEN t.nodes[c.pos + 2] ELSE t.nodes[c.pos] END)
  FROM climb c JOIN top t ON t.level = c.level AND len(t.nodes) > 1
)
SELECT d.doc_id, d.leaf, b.subroot, t.nodes[1] AS root, sha256(c.path) AS proof_sha256, c.node AS folded_root, c.node = t.nodes[1] AS verified
FROM climb c JOIN top t ON t.level = c.level AND len(t.nodes) = 1 JOIN leaves d ON d.rid = c.rid JOIN bottom b ON b.rid = c.rid
""".format(
    **{
        name: f"CASE WHEN d.{col} IS NULL THEN '-' ELSE concat(strlen(CAST({value} AS VARCHAR)), ':', CAST({value} AS VARCHAR)) END"
        for name, col, value in [(c, c, f"d.{c}") for c in ("doc_id", "source", "lang", "n_chars", "text")] + [("more", "n_chars", "(d.n_chars + 1)")]
    }
)

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), f AS (
  SELECT lang, m, list_slice(w, i, i + m - 1) AS p, count(*) AS a
  FROM words, range(1, 6) x(m), range(1, len(w) - m + 2) y(i) GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
), often AS (
  SELECT * FROM f WHERE a >= 100
), cuts AS (
  SELECT c.lang, c.p, c.m, c.a, k, l.a AS l, r.a AS r, n.n,
    CAST((1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM often c JOIN n USING (lang), range(1, 5) z(k)
  JOIN often l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, k)
  JOIN often r ON r.lang = c.lang AND r.p = list_slice(c.p, k + 1, c.m)
  WHERE c.m >= 2 AND k < c.m
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
  SELECT lang, list_slice(p, i, i + j - 1) AS p, max(a) AS most
  FROM often, range(2, 5) x(j), range(1, 5) y(i) WHERE j < m AND i + j - 1 <= m GROUP BY ALL
), kept AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, l, r, n, score
  FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.p = b.p WHERE s.most IS NULL OR s.most < b.a
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
) WHERE rank <= 2000
"""

ORACLES = {"op2_warc": OP2_SQL, "op5_search": OP5_SQL, "op11_merkle": OP11_SQL, "op12_collocations": OP12_SQL}

"""Stand-ins built from the driver tables (see FIXTURES.md).

* keyed collections and ``bitext(id, src, tgt)`` from ``conversations``: a ``user`` turn
  and the ``assistant`` turn that follows it share the id ``conv_id*1000 + turn``;
* line files from ``documents``: document ``2k`` is the source file and ``2k+1`` the
  target file of dataset ``k``, lines split on ``\\n``.

Each Spark builder has a DuckDB twin (``*_SQL``) used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators.align import align_collections, zip_lines
from tandem.session import read_table
from tandem.sources.lines import split_lines


def conversation_collections(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    conv = read_table(spark, sf_dir, "conversations")
    user = conv.where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    assistant = conv.where(F.col("role") == "assistant").select(
        (F.col("conv_id") * 1000 + F.col("turn") - 1).alias("id"), "text"
    )
    return {"user": user, "assistant": assistant}


def bitext(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = conversation_collections(spark, sf_dir)
    return align_collections(c, ["user", "assistant"]).select(
        "id", F.col("user").alias("src"), F.col("assistant").alias("tgt")
    )


def wide_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide ``(id, user, assistant)``; ``assistant`` is NULL when no reply follows."""
    c = conversation_collections(spark, sf_dir)
    u = c["user"].select("id", F.col("text").alias("user"))
    a = c["assistant"].select("id", F.col("text").alias("assistant"))
    return u.join(a, on="id", how="left")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line_no, line)``."""
    docs = read_table(spark, sf_dir, "documents")
    return split_lines(docs, "text", ["doc_id"])


def dataset_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source and target line tables ``(dataset, line_no, line)`` of the document pairs."""
    lines = document_lines(spark, sf_dir).withColumn("dataset", F.floor(F.col("doc_id") / 2).cast("bigint"))
    src = lines.where(F.col("doc_id") % 2 == 0).select("dataset", "line_no", "line")
    tgt = lines.where(F.col("doc_id") % 2 == 1).select("dataset", "line_no", "line")
    return src, tgt


def line_pairs(spark: SparkSession, sf_dir: str, mode: str = "matched") -> DataFrame:
    """Line pairs of neighbouring documents, whose line counts differ by design."""
    src, tgt = dataset_sides(spark, sf_dir)
    return zip_lines(src, tgt, mode=mode)


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as pairs: ``(id = k, src = doc 2k, tgt = doc 2k+1)``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    s = docs.where(F.col("doc_id") % 2 == 0).select(F.floor(F.col("doc_id") / 2).cast("bigint").alias("id"), F.col("text").alias("src"))
    t = docs.where(F.col("doc_id") % 2 == 1).select(F.floor(F.col("doc_id") / 2).cast("bigint").alias("id"), F.col("text").alias("tgt"))
    return s.join(t, on="id", how="inner")


# ---- DuckDB twins -----------------------------------------------------------------

USER_SQL = "(SELECT conv_id*1000+turn AS id, text FROM conversations WHERE role = 'user')"
ASSISTANT_SQL = "(SELECT conv_id*1000+turn-1 AS id, text FROM conversations WHERE role = 'assistant')"
BITEXT_SQL = f"(SELECT u.id, u.text AS src, a.text AS tgt FROM {USER_SQL} u JOIN {ASSISTANT_SQL} a ON a.id = u.id)"
WIDE_SQL = f"(SELECT u.id, u.text AS \"user\", a.text AS assistant FROM {USER_SQL} u LEFT JOIN {ASSISTANT_SQL} a ON a.id = u.id)"
DOC_LINES_SQL = """(SELECT doc_id, line_no, line FROM (
    SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS line_no, unnest(parts) AS line, len(parts) AS n
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL))
  WHERE NOT (line_no = n - 1 AND line = ''))"""
SRC_LINES_SQL = f"(SELECT doc_id // 2 AS dataset, line_no, line FROM {DOC_LINES_SQL} WHERE doc_id % 2 = 0)"
TGT_LINES_SQL = f"(SELECT doc_id // 2 AS dataset, line_no, line FROM {DOC_LINES_SQL} WHERE doc_id % 2 = 1)"
LINE_PAIRS_SQL = (
    f"(SELECT s.dataset, s.line_no, s.line AS src, t.line AS tgt FROM {SRC_LINES_SQL} s "
    f"JOIN {TGT_LINES_SQL} t ON s.dataset = t.dataset AND s.line_no = t.line_no)"
)
LINE_PAIRS_REPORT_SQL = (
    f"(SELECT coalesce(s.dataset, t.dataset) AS dataset, coalesce(s.line_no, t.line_no) AS line_no, "
    f"s.line AS src, t.line AS tgt FROM {SRC_LINES_SQL} s "
    f"FULL OUTER JOIN {TGT_LINES_SQL} t ON s.dataset = t.dataset AND s.line_no = t.line_no)"
)
DOC_PAIRS_SQL = (
    "(SELECT s.doc_id // 2 AS id, s.text AS src, t.text AS tgt FROM documents s "
    "JOIN documents t ON t.doc_id = s.doc_id + 1 WHERE s.doc_id % 2 = 0)"
)

"""From raw documents to packed sequences, in five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows that the stage
before it kept, and all but the last return the columns of documents. An empty table gives no rows; repeated rows
are treated alike, and one of them stays behind near_duplicates; further columns, whatever their names, pass
through all stages but the last. A null text has no language, so language_id rejects it.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tandem.llm import language, order_minhash, packing, quality, secret_scan  # noqa: E402
from tandem.llm.common import staged, table  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (null, or without letters) and those whose best language has a
    calibrated probability below 0.5 go. Learns from the labelled documents it is given."""
    return language.filter_language(docs, language.fit_language(docs, F.lit(True)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that any rule rejects go; the rules run in the order of rejection per cost."""
    return quality.filter_quality(docs, quality.fit_cascade(docs, quality.BASE + quality.MORE))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: that with the smallest id."""
    return order_minhash.one_per_class(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes. n_chars, if there is one, follows the new text."""
    out = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts as sequences of at most 2048 ids, with the ids of each piece."""
    json_path, ranks_path = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
    return packing.pack(docs, json_path, ranks_path, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packed),
]

#: Trained and iterative stages have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs

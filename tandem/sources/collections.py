"""Keyed collections, wide collections, language codes and the language dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_collection(
    spark: SparkSession,
    path: str,
    code: str | None = None,
    fmt: str = "parquet",
    id_col: str = "id",
    text_col: str = "text",
    lang_col: str = "lang",
    options: dict | None = None,
) -> DataFrame:
    """Keyed collection ``(id bigint, text string)``.

    One dataset per language, or one long dataset with a language column (``code``
    selects it; the filter is pushed to the scan). Any Spark source works through
    ``fmt``/``options`` (e.g. a document-store connector), nothing here depends on one.
    """
    df = spark.read.format(fmt).options(**(options or {})).load(path)
    return collection_of(df, code, id_col, text_col, lang_col)


def collection_of(df: DataFrame, code: str | None = None, id_col: str = "id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    if code is not None:
        df = df.where(F.col(lang_col) == F.lit(code))
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))


def read_wide(spark: SparkSession, path: str, codes, fmt: str = "parquet", id_col: str = "id") -> DataFrame:
    """Wide collection ``(id, <code1>, <code2>, ...)``; other fields are pruned at the scan."""
    return spark.read.format(fmt).load(path).select(F.col(id_col).alias("id"), *[F.col(c) for c in codes])


def list_languages(df: DataFrame, lang_col: str = "lang") -> DataFrame:
    """Language codes present in a long collection, with their row counts."""
    return df.groupBy(F.col(lang_col).alias("code")).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# A small language table for the codes the tests use (ISO 639-1 code,
# English name, native name). A full table is supplied by the user as CSV/JSON through
# ``read_language_dim``; ``external_key`` carries the extra key some codes need.
LANGUAGES = [
    ("ar", "Arabic", "العربية", None),
    ("de", "German", "Deutsch", None),
    ("en", "English", "English", None),
    ("es", "Spanish", "Español", None),
    ("fr", "French", "Français", None),
    ("hi", "Hindi", "हिन्दी", None),
    ("it", "Italian", "Italiano", None),
    ("ja", "Japanese", "日本語", None),
    ("ko", "Korean", "한국어", None),
    ("ru", "Russian", "Русский", None),
    ("zh", "Chinese (Simplified)", "简体中文", "zh-CN"),
    ("zt", "Chinese (Traditional)", "繁體中文", "zh-TW"),
]

DIM_SCHEMA = "code string, names map<string,string>, external_key string"


def language_dim(spark: SparkSession, rows=None) -> DataFrame:
    """The language dimension ``(code, names map<display_lang, name>, external_key)``."""
    rows = rows if rows is not None else LANGUAGES
    data = [(c, {"en": en, "native": nat}, k) for c, en, nat, k in rows]
    return spark.createDataFrame(data, DIM_SCHEMA)


def read_language_dim(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Load a user-supplied language table with the ``DIM_SCHEMA`` layout."""
    return spark.read.format(fmt).schema(DIM_SCHEMA).load(path)


def unpivot_names(dim: DataFrame) -> DataFrame:
    """``(code, display_lang, name)``: one row per display language."""
    return dim.select("code", F.explode("names").alias("display_lang", "name"))


def require_known_codes(spark: SparkSession, codes, dim: DataFrame | None = None) -> None:
    """Fail with the list of codes missing from the language table (a left anti join).

    ``codes`` is a list of codes or a DataFrame with a ``code`` column; only the unknown
    codes reach the driver, all of them.
    """
    from tandem.operators.align import check_known_codes

    dim = dim if dim is not None else language_dim(spark)
    df = codes if isinstance(codes, DataFrame) else spark.createDataFrame([(c,) for c in codes], "code string")
    unknown = [r["code"] for r in check_known_codes(df.select("code").distinct(), dim).collect()]
    if unknown:
        raise KeyError(f"unknown language codes: {sorted(unknown)}")

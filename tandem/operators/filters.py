"""Row filters and projections over collections and sentence pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.text import is_blank, is_missing, n_bytes, n_words, sanitize


def id_range(df: DataFrame, start, end, id_col: str = "id") -> DataFrame:
    """Half-open id range ``start <= id < end`` (pushed to the Parquet scan)."""
    c = F.col(id_col)
    return df.where((c >= F.lit(start)) & (c < F.lit(end)))


def project_rename(df: DataFrame, mapping: dict[str, str], drop_id: str | None = "id") -> DataFrame:
    """Select ``mapping`` columns under new names (old -> new), dropping the id."""
    cols = [F.col(old).alias(new) for old, new in mapping.items() if old != drop_id]
    return df.select(*cols)


def complete_rows(df: DataFrame, codes: Sequence[str], drop_when: str = "clean", squeeze: str = "full") -> DataFrame:
    """Keep rows where every language text is present, and clean the texts.

    ``drop_when="clean"`` (default) tests emptiness after cleaning, so a text of blanks
    is dropped. ``drop_when="raw"`` tests before cleaning (NULL or ''), which lets a
    whitespace-only text through as an empty line, like the original exporter.
    """
    if drop_when == "raw":
        keep = _all([~is_missing(c) for c in codes])
        return df.where(keep).select(*[sanitize(c, squeeze).alias(c) if c in codes else F.col(c) for c in df.columns])
    if drop_when != "clean":
        raise ValueError(f"unknown drop_when {drop_when!r}")
    cleaned = df.select(*[sanitize(c, squeeze).alias(c) if c in codes else F.col(c) for c in df.columns])
    return cleaned.where(_all([F.col(c).isNotNull() & (F.col(c) != F.lit("")) for c in codes]))


def drop_blank_pairs(df: DataFrame, cols: Sequence[str] = ("src", "tgt")) -> DataFrame:
    """Drop a pair when either side is NULL, empty or whitespace only (keeps alignment)."""
    return df.where(~_any([is_blank(c) for c in cols]))


def skip_empty(
    df: DataFrame, cols: Sequence[str] = ("src", "tgt"), level: str = "silent", observation=None
) -> DataFrame:
    """Empty-pair handling of the training loader: ``silent`` drops, ``warning`` drops and
    counts the dropped pairs into ``observation`` (a ``pyspark.sql.Observation``, read
    after the first action; no extra pass), ``error`` fails the job."""
    blank = _any([is_blank(c) for c in cols])
    if level == "warning" and observation is not None:
        df = df.observe(observation, F.coalesce(F.sum(F.when(blank, 1).otherwise(0)), F.lit(0)).alias("empty_pairs"))
    if level == "silent" or level == "warning":
        return df.where(~blank)
    if level == "error":
        return df.where(F.assert_true(~blank, F.lit("empty example found")).isNull())
    raise ValueError(f"unknown level {level!r}")


def filter_too_long(
    df: DataFrame, max_len: int = 5000, cols: Sequence[str] = ("src", "tgt"), unit: str = "words"
) -> DataFrame:
    """Keep pairs whose length on every side is at most ``max_len``.

    ``unit`` is ``words`` (whitespace tokens), ``chars``, or ``pieces`` (the ``n_<col>``
    columns produced by subword encoding).
    """
    conds = []
    for c in cols:
        if unit == "words":
            n = n_words(c)
        elif unit == "chars":
            n = F.char_length(c)
        elif unit == "pieces":
            n = F.col(f"n_{c}")
        else:
            raise ValueError(f"unknown unit {unit!r}")
        conds.append(n <= F.lit(max_len))
    return df.where(_all(conds))


def max_sentence_bytes(df: DataFrame, col: str = "text", limit: int = 8192) -> DataFrame:
    """Byte-length cap used before vocabulary learning."""
    return df.where(n_bytes(col) <= F.lit(limit))


def reverse_pairs(df: DataFrame, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """Swap the translation direction."""
    others = [F.col(c) for c in df.columns if c not in (src, tgt)]
    return df.select(*others, F.col(tgt).alias(src), F.col(src).alias(tgt))


def omit_reserved(df: DataFrame, piece_col: str = "piece", reserved: Sequence[str] | None = None) -> DataFrame:
    from tandem.operators.vocab import RESERVED_PIECES

    return df.where(~F.col(piece_col).isin(*(reserved or RESERVED_PIECES)))


def _all(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out

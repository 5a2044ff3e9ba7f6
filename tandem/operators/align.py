"""Joins that align sentences across languages: by key, by array lookup, by line position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_collections(
    collections: Mapping[str, DataFrame],
    codes: Sequence[str] | None = None,
    id_col: str = "id",
    text_col: str = "text",
) -> DataFrame:
    """N-way inner equi-join of keyed collections ``(id, text)`` on ``id``.

    The result has ``id`` plus one text column per code; an id missing from any
    collection drops the row. All joins share the key, so after the first exchange the
    chain keeps one hash partitioning (AQE may broadcast a side it measures as small).
    """
    codes = list(codes or collections.keys())
    if not codes:
        raise ValueError("at least one language code is needed")
    out = None
    for code in codes:
        side = collections[code].select(F.col(id_col).alias("id"), F.col(text_col).alias(code))
        out = side if out is None else out.join(side, on="id", how="inner")
    return out


def lookup_array(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, as_col: str
) -> DataFrame:
    """Left lookup: every left row gets the array of matching right rows (empty if none).

    The right side is grouped by key first (partial aggregation before the shuffle), then
    left-joined, so left rows are never multiplied.
    """
    payload = [c for c in right.columns if c != right_key]
    grouped = right.groupBy(F.col(right_key).alias("_tandem_k")).agg(
        F.collect_list(F.struct(*[F.col(c) for c in payload])).alias(as_col)
    )
    j = left.join(grouped, left[left_key] == grouped["_tandem_k"], "left").drop("_tandem_k")
    elem = grouped.schema[as_col].dataType
    return j.withColumn(as_col, F.coalesce(F.col(as_col), F.array().cast(elem)))


def lookup_unwind(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``unwind(lookup_array(...))`` without building arrays: the same rows as an inner
    equi-join, so no key's matches are ever gathered in one row or task."""
    return left.join(right, left[left_key] == right[right_key], "inner")


def unwind(df: DataFrame, array_col: str) -> DataFrame:
    """One row per array element; rows with an empty array are dropped (not kept as NULL)."""
    return df.withColumn(array_col, F.explode(F.col(array_col)))


def zip_lines(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str] = ("dataset", "line_no"),
    text_col: str = "line",
    mode: str = "strict",
) -> DataFrame:
    """Positional join of two line tables on ``(dataset, line_no)``.

    ``mode="strict"`` fails the job at the first surplus line of either side (NULL lines
    count as lines); ``mode="matched"`` keeps the positions that both sides have;
    ``mode="report"`` is a full outer join, so that a surplus line on either side shows up
    with NULL on the other.
    """
    if mode not in ("strict", "matched", "report"):
        raise ValueError(f"unknown mode {mode!r}")
    keys = list(keys)
    s = src.select(*keys, F.col(text_col).alias("src"))
    t = tgt.select(*keys, F.col(text_col).alias("tgt"))
    if mode != "strict":
        return s.join(t, on=keys, how="inner" if mode == "matched" else "full_outer")
    both = s.withColumn("_s", F.lit(True)).join(t.withColumn("_t", F.lit(True)), on=keys, how="full_outer")
    at = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    surplus = F.raise_error(F.concat(F.lit("surplus line without a counterpart at "), at)).cast("boolean")
    return both.where(F.when(F.col("_s") & F.col("_t"), F.lit(True)).otherwise(surplus)).drop("_s", "_t")


def lookup_dimension(df: DataFrame, dim: DataFrame, key: str, dim_key: str = "code", how: str = "left") -> DataFrame:
    """Equi-join a small dimension table (the language table has a fixed, tiny size)."""
    return df.join(F.broadcast(dim), df[key] == dim[dim_key], how)


def check_known_codes(codes_df: DataFrame, dim: DataFrame, code_col: str = "code", dim_key: str = "code") -> DataFrame:
    """Codes not present in the dimension (left anti join); empty when all are known."""
    return codes_df.join(F.broadcast(dim.select(F.col(dim_key).alias(code_col))), on=code_col, how="left_anti")

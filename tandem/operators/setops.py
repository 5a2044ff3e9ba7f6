"""Bag unions: concatenating datasets and pooling both sides for a shared vocabulary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat_datasets(parts: Mapping[str, DataFrame], dataset_col: str = "dataset") -> DataFrame:
    """Bag union of datasets with a ``dataset`` name column (order is by name, then line)."""
    out = None
    for name in sorted(parts):
        d = parts[name].withColumn(dataset_col, F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def shared_sentences(df: DataFrame, cols: Sequence[str] = ("src", "tgt"), id_col: str = "id") -> DataFrame:
    """``(id, side, text)``: every side of every pair, for learning one shared vocabulary.

    One ``stack`` projection, so the pair table is scanned once.
    """
    args = ", ".join(f"'{c}', `{c}`" for c in cols)
    return df.select(F.col(id_col), F.expr(f"stack({len(cols)}, {args}) as (side, text)"))

"""Exact-size train/validation splits and reproducible samples, built on positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.operators.position import permute


def train_valid_split(
    df: DataFrame, n_valid: int, id_col: str = "id", seed: int | str = 42, split_col: str = "split", pos_col: str = "pos"
) -> DataFrame:
    """First ``n_valid`` rows of the seeded permutation are ``valid``, the rest ``train``.

    Exact sizes without collecting anything: ``valid = min(n_valid, rows)``. Both sides
    of a pair move together because the permutation key depends on the id only.
    """
    p = permute(df, id_col=id_col, seed=seed, pos_col=pos_col)
    return p.withColumn(
        split_col, F.when(F.col(pos_col) < F.lit(n_valid), F.lit("valid")).otherwise(F.lit("train"))
    )


def sample_rows(df: DataFrame, n: int, id_col: str = "id", seed: int | str = 42, pos_col: str = "pos") -> DataFrame:
    """Exactly ``min(n, rows)`` rows in seeded-shuffled order (the vocabulary sample).

    Uses positions rather than ``orderBy().limit(n)``, so a sample of hundreds of
    millions of sentences never lands in one task, and only the rows of buckets that
    reach into the sample are shuffled.
    """
    return permute(df, id_col=id_col, seed=seed, pos_col=pos_col, limit=n)


def approx_sample(df: DataFrame, fraction: float, id_col: str = "id", seed: int | str = 42) -> DataFrame:
    """A seeded, map-only sample of about ``fraction`` of the rows (no shuffle at all)."""
    from tandem.functions.text import perm_key

    h = F.conv(F.substring(perm_key(seed, F.col(id_col)), 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
    return df.where(h < F.lit(fraction))

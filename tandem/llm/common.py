"""Helpers that the llm operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table, by Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back.

    It cuts the lineage, fixes row ids made by ``monotonically_increasing_id`` and lets
    adaptive execution split hot join keys, which it can't below a reused partitioning.
    """
    path = shared_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str) -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def appended(df: DataFrame, fields: str) -> T.StructType:
    """Schema of ``df`` plus ``fields``; a column of ``df`` with one of these names gives way."""
    new = T._parse_datatype_string(fields)
    names = {f.name.lower() for f in new}
    return T.StructType([f for f in df.schema if f.name.lower() not in names] + list(new))


def with_arrays(batch: pa.RecordBatch, keep: Sequence[str], arrays: Sequence[pa.Array], names: Sequence[str]) -> pa.RecordBatch:
    cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays([*cols, *arrays], names=[*keep, *names])


def ragged(codes: np.ndarray, starts: np.ndarray, lens: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Concatenate ``flat[starts[c] : starts[c] + lens[c]]`` over the codes c."""
    n = lens[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return flat[:0]
    at = np.repeat(starts[codes] - (ends - n), n)
    at += np.arange(total, dtype=at.dtype)
    return flat[at]


def small_batches(batches: Iterator[pa.RecordBatch], column: int, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds at most ``most`` bytes of the text column (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        size = np.frombuffer(texts.buffers()[1], dtype=np.int32 if pa.types.is_string(texts.type) or pa.types.is_binary(texts.type) else np.int64)
        ends = size[texts.offset : texts.offset + batch.num_rows + 1].astype(np.int64)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + most, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to

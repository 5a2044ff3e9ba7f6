"""Writers for aligned line files, train/valid splits, vocabularies and run manifests,
and the readers that bring aligned files back as pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.sources.lines import read_lines


def _unpivot(df: DataFrame, codes: Sequence[str], keep: Sequence[str]) -> DataFrame:
    args = ", ".join(f"'{c}', `{c}`" for c in codes)
    return df.select(*keep, F.expr(f"stack({len(codes)}, {args}) as (lang, text)"))


def write_aligned(
    df: DataFrame,
    codes: Sequence[str],
    out_dir: str,
    id_col: str = "id",
    shard_width: int = 100000,
    order_col: str | None = None,
    extra_partitions: Sequence[str] = (),
    name: str | None = None,
    mode: str = "replace",
) -> None:
    """Write one line file per language and shard: ``out_dir/[extra=..]/lang=<code>/shard=<s>/``.

    With ``name`` the language folders are ``lang=<name>.<code>``, the ``<base>.<code>``
    layout that pair discovery reads, so an export feeds the split plan directly. Shard
    folder names are zero-padded, so path order is shard order.

    All languages go through one unpivoted write, so every side is cut into the same
    shards (``floor(order / shard_width)``) and sorted the same way: line *i* of every
    language's shard file is the same row. A shard holds at most ``shard_width`` rows of
    a unique order key, so no file or task grows with a hot key. ``mode="replace"``
    empties the output first, so a re-run leaves no stale rows; ``mode="append_range"``
    replaces only the shards it writes, for an export in id ranges.
    """
    if mode not in ("replace", "append_range"):
        raise ValueError(f"unknown mode {mode!r}")
    order = order_col or id_col
    parts = list(extra_partitions)
    shard = F.format_string("%012d", F.floor(F.col(order) / F.lit(shard_width)))
    long = _unpivot(df.withColumn("shard", shard), codes, [*parts, "shard", order])
    if name is not None:
        long = long.withColumn("lang", F.concat(F.lit(f"{name}."), F.col("lang")))
    (
        long.repartition(*parts, "lang", "shard")
        .sortWithinPartitions(*parts, "lang", "shard", order)
        .select(*parts, "lang", "shard", "text")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if mode == "replace" else "dynamic")
        .option("maxRecordsPerFile", 0)  # one file per (lang, shard), whatever the session says
        .partitionBy(*parts, "lang", "shard")
        .option("lineSep", "\n")
        .text(out_dir)
    )


def read_aligned(
    spark: SparkSession,
    out_dir: str,
    codes: Sequence[str],
    extra_partitions: Sequence[str] = (),
    name: str | None = None,
) -> DataFrame:
    """Read files written by ``write_aligned`` back as ``(*extra, shard, line_no, <code>...)``."""
    keys = [*extra_partitions, "shard"]
    rel = F.regexp_extract(F.col("path"), r"((?:[^/]+=[^/]+/)+)[^/]+$", 1)
    folder = F.regexp_replace(F.col("path"), r"/[^/]+$", "")
    lines = read_lines(spark, out_dir, group=folder, recursive=True)
    cols = [F.regexp_extract(rel, rf"(?:^|/){k}=([^/]+)/", 1).alias(k) for k in [*extra_partitions, "lang"]]
    lines = lines.select(
        *cols,
        F.regexp_extract(rel, r"(?:^|/)shard=([^/]+)/", 1).cast("bigint").alias("shard"),
        "line_no",
        "line",
    )
    out = None
    for code in codes:
        value = code if name is None else f"{name}.{code}"
        side = lines.where(F.col("lang") == value).select(*keys, "line_no", F.col("line").alias(code))
        out = side if out is None else out.join(side, on=[*keys, "line_no"], how="full_outer")
    return out


def write_vocab(vocab: DataFrame, path: str, piece_col: str = "piece", value_col: str = "freq") -> None:
    """TSV ``piece<TAB>value`` lines in descending value order, one file.

    A vocabulary is bounded by its size parameter, so a single ordered file is fine; the
    text writer is used because a CSV writer would quote pieces.
    """
    (
        vocab.select(F.concat_ws("\t", F.col(piece_col), F.col(value_col).cast("string")).alias("value"), F.col(value_col).alias("_v"), F.col(piece_col).alias("_p"))
        .repartition(1)
        .sortWithinPartitions(F.col("_v").desc(), F.col("_p"))
        .select("value")
        .write.mode("overwrite")
        .option("lineSep", "\n")
        .text(path)
    )


def read_tsv_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``(piece, freq)`` from a TSV vocabulary; malformed lines are skipped."""
    parts = F.split(F.col("value"), "\t", 2)
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(parts.alias("_p"))
        .where(F.size("_p") == 2)
        .select(F.col("_p")[0].alias("piece"), F.col("_p")[1].try_cast("bigint").alias("freq"))
        .where(F.col("freq").isNotNull())
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The one-row run manifest as JSON."""
    manifest.coalesce(1).write.mode("overwrite").json(path)

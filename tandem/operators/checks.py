"""Counts, bounds, reports and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tandem.functions.text import is_blank


def count_rows(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(alias))


def id_bounds(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.agg(F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id"))


def first_last(df: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """Lowest and highest id with their value, by ``min_by``/``max_by`` (no sort)."""
    return df.agg(
        F.min(id_col).alias("first_id"),
        F.min_by(value_col, id_col).alias("first_value"),
        F.max(id_col).alias("last_id"),
        F.max_by(value_col, id_col).alias("last_value"),
    )


def bucket_counts(read: DataFrame, kept: DataFrame, start: int, gap: int = 100000, id_col: str = "id") -> DataFrame:
    """Per fixed-width id range ``[start + b*gap, start + (b+1)*gap)``: rows read and kept."""

    def per_bucket(df: DataFrame, name: str) -> DataFrame:
        b = F.floor((F.col(id_col) - F.lit(start)) / F.lit(gap)).cast("bigint")
        return df.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).cast("bigint").alias(name))

    r = per_bucket(read, "rows_read")
    k = per_bucket(kept, "rows_kept")
    out = r.join(k, on="bucket", how="full_outer").na.fill(0, ["rows_read", "rows_kept"])
    return out.select(
        "bucket",
        (F.lit(start) + F.col("bucket") * F.lit(gap)).cast("bigint").alias("range_start"),
        "rows_read",
        "rows_kept",
    )


def range_report(read: DataFrame, kept: DataFrame, gap: int = 100000, id_col: str = "id") -> DataFrame:
    """Every id range of an export, empty ones too: ``(bucket, range_start, range_end, rows_read, rows_kept)``.

    Ranges are ``gap`` wide from the least id of ``read`` on; the last one holds the greatest
    id and ends behind it (a further range, which could hold no id, is left out). The ranges
    are made, not found, and the counts joined to them; one row with the two bounds is
    collected. An empty collection has no ranges.
    """
    b = id_bounds(read, id_col).first()
    spark = read.sparkSession
    low, high = b.min_id or 0, b.max_id or 0
    n = 0 if b.min_id is None else (high - low) // gap + 1
    start = F.lit(low) + F.col("id") * F.lit(gap)
    spine = spark.range(n).select(
        F.col("id").alias("bucket"), start.alias("range_start"), F.least(start + F.lit(gap), F.lit(high + 1)).alias("range_end")
    )
    counts = bucket_counts(read, kept, low, gap, id_col).drop("range_start")
    return spine.join(counts, on="bucket", how="left").na.fill(0, ["rows_read", "rows_kept"])


def export_report(wide: DataFrame, codes: Sequence[str], squeeze: str = "full") -> DataFrame:
    """One row from one pass over the driving side left-joined to its partners.

    ``rows_in``: driving rows; ``rows_joined``: rows with every partner present;
    ``rows_kept``: joined rows whose cleaned texts are all non-empty.
    """
    from tandem.functions.text import sanitize

    joined = F.lit(True)
    kept = F.lit(True)
    for c in codes:
        joined = joined & F.col(c).isNotNull()
        kept = kept & F.col(c).isNotNull() & (sanitize(c, squeeze) != F.lit(""))

    def n(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    out = wide.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_in"), n(joined).alias("rows_joined"), n(kept).alias("rows_kept")
    )
    return out.withColumn("dropped_no_partner", F.col("rows_in") - F.col("rows_joined")).withColumn(
        "dropped_empty", F.col("rows_joined") - F.col("rows_kept")
    )


def observe_export(df: DataFrame, codes: Sequence[str], name: str = "export") -> tuple[DataFrame, Observation]:
    """Attach row counters that are filled in while a write runs (no extra pass)."""
    obs = Observation(name)
    blank = F.lit(False)
    for c in codes:
        blank = blank | is_blank(c)
    return (
        df.observe(
            obs,
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.when(blank, 1).otherwise(0)).alias("blank_rows"),
        ),
        obs,
    )


def alignment_report(pairs: DataFrame, key: str = "dataset") -> DataFrame:
    """Per dataset, from a report-mode (full outer) zip: non-blank lines per side, lines
    blank on one side only, surplus lines, and whether the dataset is aligned."""
    s_blank = is_blank("src")
    t_blank = is_blank("tgt")
    has_s = F.col("src").isNotNull()
    has_t = F.col("tgt").isNotNull()

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    out = pairs.groupBy(key).agg(
        n(has_s).alias("src_lines"),
        n(has_t).alias("tgt_lines"),
        n(has_s & ~s_blank).alias("src_nonblank"),
        n(has_t & ~t_blank).alias("tgt_nonblank"),
        n(has_s & has_t & s_blank & ~t_blank).alias("src_only_blank"),
        n(has_s & has_t & t_blank & ~s_blank).alias("tgt_only_blank"),
        n(has_s & ~has_t).alias("src_surplus"),
        n(has_t & ~has_s).alias("tgt_surplus"),
    )
    return out.withColumn(
        "aligned",
        (F.col("src_surplus") == 0)
        & (F.col("tgt_surplus") == 0)
        & (F.col("src_only_blank") == 0)
        & (F.col("tgt_only_blank") == 0),
    )


def assert_aligned(report: DataFrame) -> None:
    """Strict mode: fail when any dataset is misaligned (the report is one row per dataset)."""
    bad = report.where(~F.col("aligned")).limit(20).collect()
    if bad:
        raise ValueError(f"misaligned datasets: {[r.asDict() for r in bad]}")


def dedup_pairs(df: DataFrame, key: str = "pair", id_col: str = "id", cols: Sequence[str] = ("src", "tgt")) -> DataFrame:
    """Keep the lowest-id row for every distinct pair (or distinct ``src``/``tgt``).

    The aggregate works partially before the shuffle, so a text repeated millions of
    times is reduced map-side; the result does not depend on partitioning.
    """
    if key == "pair":
        keys = list(cols)
    elif key in cols:
        keys = [key]
    else:
        raise ValueError(f"unknown key {key!r}")
    rest = [c for c in df.columns if c not in keys and c != id_col]
    if not rest:  # min of a number hash-aggregates; min_by's struct buffer would sort whole texts
        return df.groupBy(*keys).agg(F.min(id_col).alias(id_col)).select(id_col, *keys)
    best = F.min_by(F.struct(F.col(id_col), *[F.col(c) for c in rest]), F.col(id_col)).alias("_best")
    g = df.groupBy(*keys).agg(best)
    return g.select(F.col(f"_best.{id_col}").alias(id_col), *keys, *[F.col(f"_best.{c}").alias(c) for c in rest])

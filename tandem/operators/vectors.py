"""Element-wise mean of named weight vectors (checkpoint averaging), re-aimed as an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_mean(
    weights: DataFrame,
    group_col: str = "grp",
    name_col: str = "name",
    step_col: str = "step",
    vec_col: str = "w",
    chunk: int = 4096,
    fp32: bool = False,
    check: bool = True,
) -> DataFrame:
    """Mean of ``vec_col`` over all steps of each ``(group, name)``.

    Input rows are ``(group, name, step, w array<number>)``. Per group, the names of its
    first step define the key set: names seen only later are ignored, a name missing
    from a later step is an error. The mean runs on ``(group, name, index)`` with partial
    aggregation, and vectors are rebuilt in chunks of at most ``chunk`` elements, so no
    task ever holds a whole large tensor. Output: ``(group, name, chunk, w array<double>)``.
    """
    g, n, s = F.col(group_col), F.col(name_col), F.col(step_col)
    first = weights.groupBy(group_col).agg(F.min(step_col).alias("_s0"), F.countDistinct(step_col).alias("_steps"))
    keys = weights.join(first, on=group_col).where(s == F.col("_s0")).select(group_col, name_col, "_steps").distinct()
    w = weights.join(keys, on=[group_col, name_col], how="inner")
    if check:
        missing = (
            w.groupBy(group_col, name_col, "_steps")
            .agg(F.countDistinct(step_col).alias("_seen"))
            .where(F.col("_seen") != F.col("_steps"))
            .limit(20)
            .collect()
        )
        if missing:
            raise ValueError(f"names missing from some steps: {[r.asDict() for r in missing]}")
    elem = F.col("_v").cast("float").cast("double") if fp32 else F.col("_v").cast("double")
    long = (
        w.select(g, n, F.posexplode(vec_col).alias("_i", "_v"))
        .groupBy(group_col, name_col, "_i")
        .agg(F.avg(elem).alias("_m"))
    )
    return (
        long.withColumn("chunk", F.floor(F.col("_i") / F.lit(chunk)).cast("bigint"))
        .groupBy(group_col, name_col, "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("_i", "_m"))).alias("_c"))
        .select(group_col, name_col, "chunk", F.transform("_c", lambda x: x["_m"]).alias(vec_col))
    )


def explode_chunks(means: DataFrame, group_col: str, name_col: str, vec_col: str = "w", chunk: int = 4096) -> DataFrame:
    """Back to ``(group, name, dim, value)`` rows."""
    return means.select(
        group_col,
        name_col,
        F.col("chunk"),
        F.posexplode(vec_col).alias("_p", "value"),
    ).select(group_col, name_col, (F.col("chunk") * F.lit(chunk) + F.col("_p")).cast("bigint").alias("dim"), "value")

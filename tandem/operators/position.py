"""Positions without a single-partition window.

``global_position`` gives every row its dense 0-based rank in a total order. It never
sorts the whole table in one task: rows are grouped into buckets whose key is monotone
in the order, bucket sizes are counted (a small table), a running sum over that small
table gives each bucket its first position, and ``row_number`` runs inside each bucket.
The full rows are shuffled once, on the bucket key, for the row numbering; the count
pass reads only the columns the bucket needs and aggregates partially before its own
small shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.functions.text import perm_key
from tandem.session import shared_dir

_B = "_tandem_bkt"
_OFF = "_tandem_off"
_N = "_tandem_n"


def md5_bucket(key, hex_chars: int = 5) -> Column:
    """Bucket of an md5-hex sort key: its first ``hex_chars`` digits (16**k buckets)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.substring(k, 1, hex_chars)


def range_bucket(col, width: int) -> Column:
    """Bucket of a numeric sort key: ``floor(col / width)`` (NULL keys share bucket -1)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.floor(c / F.lit(width)).cast("bigint"), F.lit(-1).cast("bigint"))


def _running_offsets(counts: DataFrame, parts: list[str], super_bucket) -> DataFrame:
    """First position of every bucket: a running sum over the (small) bucket count table.

    With ``super_bucket`` (a monotone, coarser function of the bucket) the sum is done in
    two levels, so no window ever holds more than one super bucket's buckets or the
    super-bucket table itself.
    """
    before = Window.unboundedPreceding
    if super_bucket is None:
        running = Window.partitionBy(*parts).orderBy(_B).rowsBetween(before, -1)
        return counts.select(*parts, _B, F.coalesce(F.sum(_N).over(running), F.lit(0)).cast("bigint").alias(_OFF))
    s = "_tandem_sup"
    # the count table is read twice below; write it once (it is one row per bucket)
    # instead of recomputing it from the source for each read
    c = counts.checkpoint(eager=True).withColumn(s, super_bucket(F.col(_B)))
    local = Window.partitionBy(*parts, s).orderBy(_B).rowsBetween(before, -1)
    c = c.withColumn("_tandem_loc", F.coalesce(F.sum(_N).over(local), F.lit(0)))
    sup = c.groupBy(*parts, s).agg(F.sum(_N).alias("_tandem_sn"))
    outer = Window.partitionBy(*parts).orderBy(s).rowsBetween(before, -1)
    sup = sup.select(*parts, s, F.coalesce(F.sum("_tandem_sn").over(outer), F.lit(0)).alias("_tandem_so"))
    return c.join(sup, on=[*parts, s]).select(
        *parts, _B, (F.col("_tandem_so") + F.col("_tandem_loc")).cast("bigint").alias(_OFF)
    )


def global_position(
    df: DataFrame,
    order_cols: Sequence,
    bucket: Column,
    partition_by: Sequence[str] = (),
    pos_col: str = "pos",
    super_bucket=None,
    limit: int | None = None,
    broadcast_offsets: bool = False,
) -> DataFrame:
    """Add ``pos_col``: the 0-based rank of each row by ``order_cols`` within ``partition_by``.

    ``bucket`` must be non-decreasing in ``order_cols`` (e.g. a prefix of the key, or
    ``floor(id / width)``), and should bound the rows per bucket; its values must be
    non-NULL. ``order_cols`` must be a total order for the result to be deterministic.
    ``super_bucket`` (Column -> Column over the bucket) enables the two-level offset sum
    when the number of buckets itself grows with the data. With ``limit`` only rows with
    ``pos < limit`` are kept, and buckets that start at or after it are dropped before
    any row is shuffled. ``broadcast_offsets`` is for callers whose bucket count has a
    fixed bound (e.g. 16**k md5 prefixes); otherwise AQE chooses by measured size.
    """
    parts = list(partition_by)
    keyed = df.withColumn(_B, bucket)
    counts = keyed.groupBy(*parts, _B).agg(F.count(F.lit(1)).alias(_N))
    offsets = _running_offsets(counts, parts, super_bucket)
    if limit is not None:
        offsets = offsets.where(F.col(_OFF) < F.lit(limit))
    # joined before the row shuffle: AQE broadcasts the offsets when it measures them
    # small, and with a limit the join also drops the rows of later buckets
    joined = keyed.join(F.broadcast(offsets) if broadcast_offsets else offsets, on=[*parts, _B], how="inner")
    within = Window.partitionBy(*parts, _B).orderBy(*order_cols)
    out = joined.withColumn(
        pos_col, (F.col(_OFF) + F.row_number().over(within) - F.lit(1)).cast("bigint")
    ).drop(_B, _OFF)
    return out if limit is None else out.where(F.col(pos_col) < F.lit(limit))


def ranked(
    df: DataFrame,
    order_cols: Sequence,
    partition_by: Sequence[str] = (),
    pos_col: str = "pos",
    total_col: str | None = None,
    parts: int | None = None,
    uniform_key: str | None = None,
) -> DataFrame:
    """``global_position`` in one pass over the input: range partitions, counts, offsets.

    The rows are range-partitioned once by ``(*partition_by, *order_cols)``, sorted within
    their partitions and written to the shared folder. A row's position is then its index
    inside its file (Parquet's row index) plus the rows of the files before: a table of one
    row per file and group, counted from the written key columns. No window ever runs over
    rows, and the input is run for one exchange instead of once to count and once to number.

    Rows that tie in the whole key are split between tasks only if the last order column
    tells them apart. ``uniform_key`` names a hex digest that leads the order: its
    partitions then come from its first eight digits, without the sampling job of a range
    partitioning. ``total_col`` adds the number of rows of the group.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(p).asc_nulls_first() for p in partition_by] + [F.col(c) if isinstance(c, str) else c for c in order_cols]
    if uniform_key is not None:
        share = F.conv(F.substring(uniform_key, 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
        dealt = df.repartitionById(parts, F.coalesce(F.floor(share * parts).cast("int"), F.lit(0)))
    else:
        dealt = df.repartitionByRange(parts, *keys)
    path = shared_dir(spark, "ranked")
    dealt.sortWithinPartitions(*keys).withColumn(_B, F.spark_partition_id()).write.parquet(path)
    schema = T.StructType([*df.schema, T.StructField(_B, T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias("_tandem_file"), F.col("_metadata.row_index").alias("_tandem_row"))
    return _numbered(rows, list(partition_by), [_B, "_tandem_file"], pos_col, total_col)


def _numbered(rows: DataFrame, parts: list[str], place: list[str], pos_col: str, total_col: str | None) -> DataFrame:
    """Positions of rows whose order is ``(*place, _tandem_row)``: a small table of counts per
    place and group, its running sum, and a null-safe join back."""
    counts = rows.groupBy(*parts, *place).agg(F.count(F.lit(1)).alias(_N), F.min("_tandem_row").alias("_tandem_first"))
    before = Window.partitionBy(*parts).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(c).alias(f"_tandem_k{i}") for i, c in enumerate([*parts, *place])]
    offset = (F.coalesce(F.sum(_N).over(before), F.lit(0)) - F.col("_tandem_first")).alias(_OFF)
    total = [F.sum(_N).over(Window.partitionBy(*parts)).alias(total_col)] if total_col else []
    offsets = counts.select(*cols, offset, *total)
    same = F.lit(True)
    for i, c in enumerate([*parts, *place]):
        same = same & rows[c].eqNullSafe(offsets[f"_tandem_k{i}"])
    out = rows.join(offsets, same)
    names = [c for c in rows.columns if c not in (*place, "_tandem_row")]
    return out.select(*names, (F.col("_tandem_row") + F.col(_OFF)).cast("bigint").alias(pos_col), *([total_col] if total_col else []))


def permute(
    df: DataFrame,
    id_col: str = "id",
    seed: int | str = 42,
    pos_col: str = "pos",
    key_col: str | None = None,
    hex_chars: int = 5,
    limit: int | None = None,
) -> DataFrame:
    """Seeded global permutation: rank rows by ``md5('<seed>:<id>')``, ties by id.

    The same seed gives the same order for every language side and every run, so the
    permutation never needs to be stored.
    """
    key = key_col or "_tandem_key"
    keyed = df.withColumn(key, perm_key(seed, F.col(id_col)))
    order = [F.col(key), F.col(id_col)]
    if limit is None:
        out = ranked(keyed, order, pos_col=pos_col, uniform_key=key)
    else:
        # a sample shuffles only the rows of the buckets that reach into it
        out = global_position(
            keyed,
            order,
            md5_bucket(key, hex_chars),
            pos_col=pos_col,
            limit=limit,
            # at most 16**hex_chars offset rows (about a million for 5): a proven bound
            broadcast_offsets=hex_chars <= 5,
        )
    return out if key_col else out.drop(key)


def position_by_id(
    df: DataFrame, id_col: str = "id", width: int = 100000, pos_col: str = "pos", super_width: int = 65536
) -> DataFrame:
    """Rank rows by a numeric id (the sorted-export order) with id-range buckets; bucket
    offsets are summed in two levels, so a wide id span never lands in one task."""
    return global_position(
        df,
        [F.col(id_col)],
        range_bucket(id_col, width),
        pos_col=pos_col,
        super_bucket=lambda b: F.floor(b / F.lit(super_width)),
    )


def latest_n(
    df: DataFrame, by: Sequence[str], order_desc: Sequence[str], n: int, rank_col: str = "rank"
) -> DataFrame:
    """Keep the last ``n`` rows per group by descending order (ties broken by later columns).

    ``row_number() <= n`` lets Catalyst insert a partial window group limit before the
    shuffle, so a hot group is cut to ``n`` rows per map task before it is exchanged.
    """
    w = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order_desc])
    return (
        df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
        .where(F.col(rank_col) <= F.lit(n))
    )


def cap_per_group(
    df: DataFrame,
    group_col: str,
    order_cols: Sequence,
    bucket: Column,
    max_rows: int,
    pos_col: str = "pos",
    super_bucket=None,
) -> DataFrame:
    """First ``max_rows`` rows of every group in ``order_cols`` order (0 = no cap)."""
    return global_position(
        df,
        order_cols,
        bucket,
        partition_by=[group_col],
        pos_col=pos_col,
        super_bucket=super_bucket,
        limit=max_rows if max_rows > 0 else None,
    )


def line_bucket(keys: Sequence[str], line_col: str = "line_no", block: int = 4096) -> Column:
    """Bucket for ordering lines by ``(*keys, line_no)``: at most ``block`` lines each."""
    return F.struct(*[F.col(k) for k in keys], F.floor(F.col(line_col) / F.lit(block)).cast("bigint").alias("blk"))


def line_super_bucket(keys: Sequence[str], width: int = 65536):
    """Coarser bucket for ``line_bucket``: the keys with the last (numeric) one divided by ``width``."""

    def sup(b: Column) -> Column:
        head = [b[k].alias(k) for k in keys[:-1]]
        return F.struct(*head, F.floor(b[keys[-1]] / F.lit(width)).cast("bigint").alias(keys[-1]))

    return sup

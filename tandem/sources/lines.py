"""Line sources: texts split on ``\\n`` only, line files read with their line numbers,
file listings and discovery of ``<base>.<code>`` file pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def split_lines(df: DataFrame, text_col: str, keys: Sequence[str], line_col: str = "line") -> DataFrame:
    """One row per line of a text, split on ``\\n`` only (``\\r`` stays in the line).

    A text that ends in ``\\n`` has no extra empty last line (file semantics); an empty
    or NULL text has no lines.
    """
    parts = F.split(F.col(text_col), "\n", -1)
    exploded = df.select(*keys, F.size(parts).alias("_n"), F.posexplode(parts).alias("line_no", line_col))
    last_empty = (F.col("line_no") == F.col("_n") - 1) & (F.col(line_col) == F.lit(""))
    return exploded.where(~last_empty).select(*keys, F.col("line_no").cast("bigint").alias("line_no"), line_col)


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], group: Column | None = None, recursive: bool = False
) -> DataFrame:
    """Read text files as ``(path, group, line_no, line)`` with exact 0-based line numbers.

    Lines split on ``\\n`` only. Line numbers come without any per-row Python and without
    a single-task sort: each input split is read in order by one task, so a row's index
    inside its split is ``monotonically_increasing_id() - min(id of split)``; a running
    sum over the small per-split count table gives each split its first line number.
    ``group`` (a Column over ``path``) numbers lines across several files of one logical
    file, e.g. the part files of a Spark output folder, in path order; default: the path.
    """
    reader = spark.read.option("lineSep", "\n")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    raw = reader.text(list(paths) if not isinstance(paths, str) else paths)
    scanned = raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_m"),
        F.col("value").alias("line"),
    )
    grp = group if group is not None else F.col("path")
    scanned = scanned.withColumn("group", grp)
    blocks = scanned.groupBy("group", "path", "_blk").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0")
    )
    before = Window.partitionBy("group").orderBy("path", "_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "group", "path", "_blk", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    # one row per split, which the driver lists in any case; broadcast, so that no line is shuffled for its number
    return scanned.join(F.broadcast(blocks), on=["group", "path", "_blk"]).select(
        "path",
        "group",
        (F.col("_off") + F.col("_m") - F.col("_m0")).cast("bigint").alias("line_no"),
        "line",
    )


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of a folder path, as file listings report it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length, entry)`` for every file under ``folder``; ``content`` is never read.

    ``entry`` is the top-level name inside ``folder`` (a file, or a folder of part files),
    with a Hive-style ``key=`` prefix removed.
    """
    root = qualify(spark, folder)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )
    rel = F.substring(F.col("path"), len(root) + 2, 1 << 30)
    entry = F.regexp_replace(F.regexp_extract(rel, r"^([^/]+)", 1), r"^[^=]+=", "")
    return files.withColumn("entry", entry)


def discover_pairs(
    spark: SparkSession, folder: str, src_code: str, tgt_code: str, listing: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Match ``<base>.<src_code>`` entries with ``<base>.<tgt_code>`` partners.

    Returns ``(pairs, orphans)``: pairs ``(base, src_entry, tgt_entry, src_bytes,
    tgt_bytes, src_files, tgt_files)`` and the source entries without a partner.
    """
    files = listing if listing is not None else list_files(spark, folder)
    ent = files.groupBy("entry").agg(
        F.sum("length").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("files")
    )
    ent = ent.select(
        "entry",
        "bytes",
        "files",
        F.regexp_extract("entry", r"^(.*)\.([^.]+)$", 1).alias("base"),
        F.regexp_extract("entry", r"^(.*)\.([^.]+)$", 2).alias("code"),
    )
    src = ent.where(F.col("code") == src_code).select(
        "base", F.col("entry").alias("src_entry"), F.col("bytes").alias("src_bytes"), F.col("files").alias("src_files")
    )
    tgt = ent.where(F.col("code") == tgt_code).select(
        "base", F.col("entry").alias("tgt_entry"), F.col("bytes").alias("tgt_bytes"), F.col("files").alias("tgt_files")
    )
    pairs = src.join(tgt, on="base", how="inner")
    orphans = src.join(tgt, on="base", how="left_anti")
    return pairs, orphans


def line_stats(lines: DataFrame, keys: Sequence[str], line_col: str = "line") -> DataFrame:
    """Per file: line count, last line, byte size (each line plus its ``\\n``)."""
    return lines.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_lines"),
        F.max_by(F.col(line_col), F.col("line_no")).alias("last_line"),
        F.sum(F.octet_length(F.col(line_col)) + F.lit(1)).cast("bigint").alias("n_bytes"),
    )


def list_checkpoints(spark: SparkSession, folder: str, suffix: str = ".pt", exclude: str = "averaged.pt", rule: str = "step") -> DataFrame:
    """``(path, length, step)`` of the model checkpoints in a folder (file contents are
    never read); the averaged model is left out. See ``step_number`` for the rules."""
    from tandem.functions.text import step_number

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select("path", "length")
    return files.where(~F.col("path").contains(exclude)).withColumn("step", step_number(F.col("path"), rule))

"""End-to-end plans: export aligned files, split line files, prepare training data.

Each plan is ordinary DataFrame code; Catalyst sees the whole chain as one plan up to
the sink, so filters reach the scans and only the needed columns are read.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tandem.operators import align, checks, filters, position, setops, split, unigram, vocab
from tandem.sources import lines as L
from tandem.sources import sinks


def export_aligned(
    collections: Mapping[str, DataFrame],
    codes: Sequence[str],
    out_dir: str | None = None,
    drop_when: str = "clean",
    squeeze: str = "full",
    shard_width: int = 100000,
    name: str | None = None,
) -> tuple[DataFrame, dict | None]:
    """Keyed collections -> N-way join -> completeness filter + cleaning -> aligned files.

    Returns the cleaned ``(id, <code>...)`` rows and, when ``out_dir`` is given, the row
    counters gathered by ``observe`` while the files (one per language and id shard)
    were written, with the write's wall-clock seconds and rows per second.
    """
    joined = align.align_collections(collections, codes)
    kept = filters.complete_rows(joined, codes, drop_when=drop_when, squeeze=squeeze)
    if out_dir is None:
        return kept, None
    observed, obs = checks.observe_export(kept, codes)
    started = time.perf_counter()
    sinks.write_aligned(observed, codes, out_dir, shard_width=shard_width, name=name)
    metrics = dict(obs.get)
    metrics["seconds"] = time.perf_counter() - started
    metrics["rows_per_second"] = metrics.get("rows", 0) / metrics["seconds"] if metrics["seconds"] > 0 else None
    return kept, metrics


def read_pair_files(
    spark: SparkSession, folder: str, src_code: str, tgt_code: str, strict: bool = False
) -> DataFrame:
    """Discover ``<base>.<src>``/``<base>.<tgt>`` pairs and zip their lines by number.

    ``(dataset, line_no, src, tgt)`` in report mode (a surplus line has NULL on the
    other side); ``strict=True`` raises on any misaligned dataset instead.
    """
    pairs, _ = L.discover_pairs(spark, folder, src_code, tgt_code)
    root = L.qualify(spark, folder)
    rel = F.substring(F.col("path"), len(root) + 2, 1 << 30)
    entry = F.regexp_replace(F.regexp_extract(rel, r"^([^/]+)", 1), r"^[^=]+=", "")
    entries = pairs.select(F.col("base").alias("dataset"), F.col("src_entry").alias("entry"), F.lit("src").alias("side")).unionByName(
        pairs.select(F.col("base").alias("dataset"), F.col("tgt_entry").alias("entry"), F.lit("tgt").alias("side"))
    )
    lines = L.read_lines(spark, folder, group=entry, recursive=True).withColumnRenamed("group", "entry")
    tagged = lines.join(entries, on="entry", how="inner")
    src = tagged.where(F.col("side") == "src").select("dataset", "line_no", "line")
    tgt = tagged.where(F.col("side") == "tgt").select("dataset", "line_no", "line")
    zipped = align.zip_lines(src, tgt, mode="report")
    if strict:
        checks.assert_aligned(checks.alignment_report(zipped))
        zipped = zipped.where(F.col("src").isNotNull() & F.col("tgt").isNotNull())
    return zipped


def shuffle_split(
    pairs: DataFrame, n_valid: int, max_lines: int = 0, seed: int | str = 42, block: int = 4096, strict: bool = False, texts: bool = True
) -> DataFrame:
    """Blank-pair drop -> per-dataset cap -> ordered concat -> seeded permutation -> split.

    Input ``(dataset, line_no, src, tgt)``; output adds ``cpos`` (position in the
    concatenation ordered by dataset then line), ``pos`` (permuted position) and
    ``split``. Every step is positional and exact, none runs in a single task. A line
    without a counterpart is left out, or, with ``strict``, an error before anything is split.
    Without ``texts`` the rows lose ``src`` and ``tgt`` once blank pairs are out, so that no text is shuffled
    or written for the positions.
    """
    both = F.col("src").isNotNull() & F.col("tgt").isNotNull()
    # seen while the rows are written for their positions, so the check costs no pass of its own
    seen = Observation()
    at = F.concat_ws(", ", F.col("dataset").cast("string"), F.col("line_no").cast("string"))
    if strict:
        pairs = pairs.observe(seen, F.min(F.when(~both, at)).alias("alone"))
    kept = filters.drop_blank_pairs(pairs.where(both))
    if not texts:
        kept = kept.drop("src", "tgt")
    if max_lines > 0:
        kept = position.cap_per_group(
            kept,
            "dataset",
            [F.col("line_no")],
            F.floor(F.col("line_no") / F.lit(block)),
            max_lines,
            pos_col="_dpos",
            super_bucket=lambda b: F.floor(b / F.lit(65536)),
        ).drop("_dpos")
    concat = position.ranked(kept, [F.col("dataset"), F.col("line_no")], pos_col="cpos")
    if strict and seen.get["alone"] is not None:
        raise ValueError(f"line without a counterpart at {seen.get['alone']}")
    return split.train_valid_split(concat, n_valid, id_col="cpos", seed=seed)


def write_splits(df: DataFrame, out_dir: str, shard_width: int = 100000) -> None:
    """Write ``split=<train|valid>/lang=<src|tgt>/shard=<s>/`` files in permuted order."""
    sinks.write_aligned(
        df, ["src", "tgt"], out_dir, id_col="pos", shard_width=shard_width, extra_partitions=["split"]
    )


def training_vocabulary(
    pairs: DataFrame,
    vocab_size: int = 50000,
    corpus_size: int = 200000000,
    max_bytes: int = 8192,
    model: str = "unigram",
    rounds: int = 2,
    seed: int | str = 42,
) -> DataFrame:
    """Shared vocabulary of both sides: byte cap -> seeded sample -> word table -> model.

    ``model="unigram"`` gives ``vocab_size`` rows ``(piece, score)``, with ``rounds`` EM steps between prunings. ``model="bpe"`` gives
    ``vocab_size`` rows if the corpus has enough pairs to merge: the reserved pieces (score
    0), the merges (``score = -rank``) and, below them, the characters.
    """
    shared = setops.shared_sentences(pairs.select("cpos", "src", "tgt"), id_col="cpos")
    shared = shared.select((F.col("cpos") * 2 + F.when(F.col("side") == "tgt", 1).otherwise(0)).alias("sid"), "text")
    sample = split.sample_rows(filters.max_sentence_bytes(shared, "text", max_bytes), corpus_size, id_col="sid", seed=seed)
    counts = vocab.word_counts(sample)
    if model == "unigram":
        return unigram.learn_unigram_em(counts, vocab_size, steps=rounds)[0]
    chars = counts.select(F.explode(vocab.initial_symbols(F.col("word"))).alias("piece")).distinct()
    merges, _ = vocab.learn_bpe(counts, max(0, vocab_size - chars.count() - len(vocab.RESERVED_PIECES)))
    merges = merges.select(F.col("merged").alias("piece"), (-F.col("rank")).cast("double").alias("score"))
    reserved = counts.sparkSession.createDataFrame([(p, 0.0) for p in vocab.RESERVED_PIECES], "piece string, score double")
    chars = chars.select("piece", F.lit(-float(vocab_size)).alias("score"))
    return reserved.unionByName(merges).unionByName(chars.join(merges, "piece", "left_anti"))


def resolve_pair(codes: Sequence[str], reverse: bool = False, default_src: str = "en") -> tuple[str, str]:
    """Translation direction from one or two codes: one code means ``default_src -> code``;
    ``reverse`` swaps the direction."""
    if len(codes) == 1:
        src, tgt = default_src, codes[0]
    elif len(codes) == 2:
        src, tgt = codes[0], codes[1]
    else:
        raise ValueError(f"expected one or two language codes, got {list(codes)}")
    return (tgt, src) if reverse else (src, tgt)


def apply_steps(df: DataFrame, steps) -> DataFrame:
    """Apply an ordered list of ``DataFrame -> DataFrame`` steps (the loader's transform
    list); Catalyst still sees one plan."""
    for step in steps:
        df = df.transform(step)
    return df

"""Corpus BLEU (Papineni et al., 2002) over ``(id, hyp, ref)``, counted within the rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.text import words


def clipped_matches(hyp: list[str], ref: list[str], max_n: int) -> list[int]:
    """Per n the matches of the two multisets of n-grams, then per n the hypothesis's n-grams, then the reference's words."""
    matches, totals = [], []
    for n in range(1, max_n + 1):
        h, r = (Counter(zip(*[toks[k:] for k in range(n)], strict=False)) for toks in (hyp, ref))
        matches.append((h & r).total())
        totals.append(h.total())
    return [*matches, *totals, len(ref)]


def corpus_bleu(pairs: DataFrame, id_col: str = "id", hyp_col: str = "hyp", ref_col: str = "ref", max_n: int = 4) -> DataFrame:
    """One row: ``bleu, bp, p1..p<max_n>, hyp_len, ref_len`` (whitespace tokens, one reference).

    Every pair is counted within its row: a task intersects the two multisets of n-grams
    and adds up, so a batch yields one row of sums and no n-gram is shuffled.
    """
    names = [f"m{n}" for n in range(1, max_n + 1)] + [f"t{n}" for n in range(1, max_n + 1)] + ["ref_len"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [0] * len(names)
            for at in range(0, batch.num_rows, 256):  # few rows at a time become Python objects
                part = batch.slice(at, 256)
                for hyp, ref in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for k, x in enumerate(clipped_matches(hyp or [], ref or [], max_n)):
                        sums[k] += x
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in sums], names=names)

    tokens = pairs.select(words(hyp_col).alias("h"), words(ref_col).alias("r"))
    sums = tokens.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    one = sums.agg(*[total(c).cast("double").alias(c) for c in names[:-1]], total("ref_len").cast("bigint").alias("ref_len"))
    one = one.withColumn("hyp_len", F.col("t1").cast("bigint"))
    ps = [F.when(F.col(f"t{n}") > 0, F.col(f"m{n}") / F.col(f"t{n}")).otherwise(F.lit(0.0)) for n in range(1, max_n + 1)]
    c, r = F.col("hyp_len").cast("double"), F.col("ref_len").cast("double")
    bp = F.when(c > r, F.lit(1.0)).when(c == 0, F.lit(0.0)).otherwise(F.exp(F.lit(1.0) - r / c))
    logs = None
    any_zero = F.lit(False)
    for p in ps:
        logs = F.log(p) if logs is None else logs + F.log(p)
        any_zero = any_zero | (p <= 0)
    bleu = F.when(any_zero, F.lit(0.0)).otherwise(bp * F.exp(logs / F.lit(float(max_n))))
    out = one.select(
        F.round(bleu, 6).alias("bleu"),
        F.round(bp, 6).alias("bp"),
        *[F.round(p, 6).alias(f"p{i + 1}") for i, p in enumerate(ps)],
        "hyp_len",
        "ref_len",
    )
    return out

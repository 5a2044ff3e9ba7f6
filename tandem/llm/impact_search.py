"""Exact top-k inner-product search on an impact-ordered index, score at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import staged

LEVELS = 16
#: Rounds of posting segments between two tests of whether the search may stop.
ROUNDS = 8
#: A power of two, so that sums with it are exact in doubles.
FRACTION = 2.0**-12


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``(vec_id, v)`` with v = floor(scale * x), x as double; vectors that are null, empty or hold a
    null or non-finite component, or have a null key, take no part."""
    x = F.col(vector).cast("array<double>")
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(fine & F.col(key).isNotNull())
    return rows.select(F.col(key).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("bigint")).alias("v"))


class ImpactIndex:
    """Postings of one block of vectors: per dimension, row numbers in order of quantised impact.

    A segment is a dimension's rows of one level. The level's largest and smallest component
    bound the segment's contribution to any query's score from above.
    """

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors, (self.n, self.dims) = vectors, vectors.shape
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        width = (high - low) // levels + 1
        level = (vectors - low) // width
        self.rows = np.argsort(level, axis=0, kind="stable").T.copy()
        ranked = np.take_along_axis(level.T, self.rows, axis=1)
        self.starts = np.stack([np.searchsorted(r, np.arange(levels + 1)) for r in ranked])
        self.filled = np.nonzero(self.starts[:, 1:] > self.starts[:, :-1])
        self.low, self.high = (np.zeros((self.dims, levels), vectors.dtype) for _ in range(2))
        for d, k in zip(*self.filled, strict=True):
            values = vectors[self.rows[d, self.starts[d, k] : self.starts[d, k + 1]], d]
            self.low[d, k], self.high[d, k] = values.min(), values.max()
        self.least, self.most = low, high

    def top(self, query: np.ndarray, k: int, skip: np.ndarray, few: int | None = None) -> np.ndarray:
        """Row numbers that hold the k highest scores among the rows not to be skipped, and maybe others.

        Segments are taken by descending bound on their contribution. After a round with the next
        bound ``rest``, a row's score is at most what its segments sum up to plus, for
        every dimension it was not met in, ``rest`` or that dimension's best bound if that is
        less. A row is out only if this is below the k-th best exact score seen so far. The
        search stops when few rows are left in, or no segment is.
        """
        few = max(4 * k, self.n // 4) if few is None else few
        bound = np.where(query[:, None] > 0, query[:, None] * self.high, query[:, None] * self.low)
        dims, levels = self.filled
        bounds = bound[dims, levels]
        order = np.argsort(-bounds, kind="stable")
        dims, levels, bounds = dims[order], levels[order], bounds[order]
        best = np.where(query > 0, query * self.most, query * self.least)
        starts, ends = self.starts[dims, levels], self.starts[dims, levels + 1]
        lens = ends - starts
        both, total, met = np.zeros(self.n), np.zeros(self.n), np.zeros(self.n)
        small = self.dims < 1 / FRACTION and np.abs(bound).max(axis=1).astype(float).sum() < 1 << 38
        least, slack = None, 1e-12 * float(np.abs(best).astype(float).sum())  # of sums in doubles
        edges = np.linspace(0, len(order), ROUNDS + 1).astype(int)
        for at, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if a < b:
                rows = np.concatenate([self.rows[d, x:y] for d, x, y in zip(dims[a:b].tolist(), starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])
                if small:  # one pass: sums in the whole part, numbers met in the fraction
                    both += np.bincount(rows, np.repeat(bounds[a:b] + FRACTION, lens[a:b]), self.n)
                    total = np.floor(both)
                    met = (both - total) / FRACTION
                else:
                    total += np.bincount(rows, np.repeat(bounds[a:b], lens[a:b]), self.n)
                    met += np.bincount(rows, minlength=self.n)
            if at + 1 < ROUNDS // 3:
                continue
            rest = bounds[b] if b < len(bounds) else 0
            unseen = best < rest  # no row was met in these
            most = total + (best[unseen].sum() + slack) + (self.dims - unseen.sum() - met) * float(rest)
            most[skip] = -np.inf
            seeds = np.argpartition(-most, min(4 * k, self.n - 1))[: 4 * k]
            seeds = seeds[most[seeds] > -np.inf]
            if len(seeds) >= k:
                score = np.sort(self.vectors[seeds] @ query)[-k]
                least = score if least is None else max(score, least)
            left = np.flatnonzero(most > -np.inf) if least is None else np.flatnonzero(most >= least)
            if len(left) <= few:
                break
        return left


def block_top(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row, score) of each query's k best rows in a block, ties to smaller ids; its own id is out."""
    index = ImpactIndex(vectors)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    by_id = np.argsort(ids, kind="stable")
    own = ids[by_id]
    for q in range(len(queries)):
        a, b = np.searchsorted(own, query_ids[q], "left"), np.searchsorted(own, query_ids[q], "right")
        rows = index.top(queries[q], k, by_id[a:b])
        scores = vectors[rows] @ queries[q]
        best = np.lexsort((ids[rows], -scores))[:k]
        out.append((np.full(len(best), q), rows[best], scores[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, int),) * 3


def exact_top_k(
    rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256,
    block_rows: int = 16_384, query_rows: int = 1024,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest integer inner products for every query row.

    Candidates are the vectors of the query's length but those with its own id. Repeated rows are
    candidates each, equal query rows count as one query; ties go to the smaller id.
    An empty table gives no rows. The inner products must fit 64 bits.

    Vectors and queries are dealt into blocks of bounded size; a task meets one block of each, so
    neither side is ever whole in a task or broadcast. Each pair of blocks gives k rows
    a query, and the ranking of a query sees k rows a block.
    """
    whole = whole_vectors(rows, key, vector, scale).withColumns({"dims": F.size("v"), "rid": F.monotonically_increasing_id()})
    asks = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks")).where("asks").select("vec_id").distinct()
    whole = staged(whole, "search-vectors")
    asked = staged(whole.join(asks, "vec_id", "left_semi").select("vec_id", "v", "dims").distinct(), "search-queries")
    n_vb, n_qb = max(1, -(-whole.count() // block_rows)), max(1, -(-asked.count() // query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    vectors = whole.select("dims", deal("rid", n_vb).alias("vb"), every(n_qb).alias("qb"), "vec_id", "v")
    queries = asked.select("dims", every(n_vb).alias("vb"), deal("vec_id", n_qb).alias("qb"), "vec_id", "v")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        left, right = left.sort_values("vec_id", kind="stable"), right.sort_values("vec_id", kind="stable")
        ids, query_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        q, r, score = block_top(np.stack(left["v"].to_numpy()).astype(np.int64), ids, np.stack(right["v"].to_numpy()).astype(np.int64), query_ids, k)
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[r], "score": score})

    by = ["dims", "vb", "qb"]
    found = vectors.groupBy(*by).cogroup(queries.groupBy(*by)).applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

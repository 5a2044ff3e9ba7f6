"""K-d tree sharding in DataFrame functions: weighted medians along the widest dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import staged, text_of

BINS = 1024


@dataclass
class Node:
    """A box of the tree. ``cut`` holds (column, below) pairs: a row goes left if it comes first
    in the order of the columns before the place where the search for the median ended."""

    name: int
    bytes: int
    axis: str | None = None
    cut: list[tuple[str, int]] | None = None


def _extents(rows: DataFrame, axes: list[str]) -> dict[int, dict]:
    cols = [F.sum("size").alias("bytes")]
    for a in axes:
        cols += [F.min(a).alias(f"lo_{a}"), F.max(a).alias(f"hi_{a}")]
    return {r["node"]: r.asDict() for r in rows.groupBy("node").agg(*cols).collect()}


def _medians(rows: DataFrame, nodes: dict[int, dict], axis: dict[int, str], tolerance: float) -> dict[int, list[tuple[str, int]]]:
    """For each node the cut nearest below half of its bytes.

    The weighted median is searched by histograms of ``BINS`` bins, refined within the bin
    that holds it: along the node's axis, then, at one value of the axis, along the texts' hash,
    and, within one text's copies, along the row number. The search of a node ends when
    the bin's bytes are below ``tolerance`` of the node's. One job refines all nodes; a job brings
    nodes x BINS numbers to the driver, whatever the input.
    """
    order = {n: [axis[n], "hash", "rid"] for n in nodes}
    state = {n: {"level": 0, "fixed": [], "lo": nodes[n][f"lo_{axis[n]}"], "hi": nodes[n][f"hi_{axis[n]}"], "left": 0} for n in nodes}
    done: dict[int, list[tuple[str, int]]] = {}
    while state:
        bins, cols = F.lit(None).cast("long"), sorted({c for n in state for c in order[n]})
        for n, s in state.items():
            col = F.col(order[n][s["level"]])
            here = (F.col("node") == n) & col.between(s["lo"], s["hi"])
            for c, v in s["fixed"]:
                here &= F.col(c) == v
            bins = F.when(here, F.floor((col - F.lit(s["lo"])) / F.lit((s["hi"] - s["lo"]) // BINS + 1))).otherwise(bins)
        counted = rows.select("node", "size", bins.alias("bin"), *cols).where("bin is not null").groupBy("node", "bin")
        counted = counted.agg(F.sum("size").alias("b"), *[f(c).alias(f"{k}_{c}") for c in cols for k, f in (("lo", F.min), ("hi", F.max))])
        by_node: dict[int, list] = {}
        for r in counted.collect():
            by_node.setdefault(r["node"], []).append(r)
        for n in list(state):
            s, half = state[n], nodes[n]["bytes"] / 2
            col, at = order[n][s["level"]], s["left"]
            for r in sorted(by_node[n], key=lambda r: r["bin"]):
                if at + r["b"] >= half:
                    break
                at += r["b"]
            low, high = r[f"lo_{col}"], r[f"hi_{col}"]
            if r["b"] <= tolerance * nodes[n]["bytes"] or (low == high and s["level"] == 2):
                # the nearer edge of the last bin
                done[n] = [*s["fixed"], (col, low if half - at <= r["b"] / 2 else high + 1)]
                del state[n]
            elif low == high:
                nxt = order[n][s["level"] + 1]
                state[n] = {"level": s["level"] + 1, "fixed": [*s["fixed"], (col, low)], "lo": r[f"lo_{nxt}"], "hi": r[f"hi_{nxt}"], "left": at}
            else:
                state[n] = s | {"lo": low, "hi": high, "left": at}
    return done


def _before(cut: list[tuple[str, int]]) -> Column:
    """Whether a row comes before the cut in the order of its columns."""
    (col, value), *rest = cut
    if not rest:
        return F.col(col) < F.lit(value)
    return (F.col(col) < F.lit(value)) | ((F.col(col) == F.lit(value)) & _before(rest))


def kd_shards(rows: DataFrame, axes: list[str], depth: int, tolerance: float = 5e-4) -> tuple[DataFrame, list[dict[int, Node]]]:
    """``rows`` (node, size, hash, rid and the axes, all whole numbers) with each row's leaf in ``node``.

    Every level splits all boxes, each along the axis on which its extent is the largest share
    of the whole table's, at the weighted median. If copies of a text (one hash) agree on
    all axes, a cut runs through them only if they weigh more than the tolerance.
    """
    whole, tree = None, []
    for _ in range(depth):
        nodes = _extents(rows, [*axes, "hash", "rid"])
        if not nodes:
            break
        whole = whole or next(iter(nodes.values()))
        share = lambda e, a: (e[f"hi_{a}"] - e[f"lo_{a}"]) / max(1, whole[f"hi_{a}"] - whole[f"lo_{a}"])  # noqa: B023, E731
        axis = {n: max(axes, key=lambda a: (share(e, a), -axes.index(a))) for n, e in nodes.items()}  # noqa: B023
        cuts = _medians(rows, nodes, axis, tolerance)
        child = F.col("node") * 2
        for n, cut in cuts.items():
            child = F.when((F.col("node") == n) & ~_before(cut), F.lit(2 * n + 1)).when(F.col("node") == n, F.lit(2 * n)).otherwise(child)
        rows = rows.withColumn("node", child)
        tree.append({n: Node(n, int(e["bytes"]), axis[n], cuts[n]) for n, e in nodes.items()})
    return rows, tree


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", rows_per_bin: int = 20_000) -> DataFrame:
    """Put all rows into ``shards`` leaves (a power of two) of nearly equal bytes.

    Per row: key, size (UTF-8 bytes plus 1; null: 1), text_crc32, law ``bytes``, shard, slot
    (gapless from 0 within the shard) and a null grown_shard. The tree's axes are the
    size, the source and the language; copies of a text all take the least of their sources and languages, so
    they share a shard unless they weigh more than the tolerance. Repeated rows take separate slots; one long text is
    never cut, so it alone can make shards uneven. An empty table gives no rows.

    Texts are read once; the tree is built on a narrow written table. Slots come from counts per
    shard and bin and a window within a bin, so no task holds a shard.
    """
    if shards & (shards - 1) or shards < 1:
        raise ValueError("the number of shards must be a power of two")
    t = text_of(text)
    code = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(t) + 1).cast("bigint").alias("size"), F.crc32(t).alias("crc"), code(source).alias("source"),
        code(lang).alias("lang"), F.shiftrightunsigned(F.xxhash64(t), 2).alias("hash"), F.monotonically_increasing_id().alias("rid"),
    ).withColumn("node", F.lit(0))
    rows = staged(rows, "shards")
    texts = rows.groupBy("hash").agg(*[f(c).alias(f"{k}_{c}") for c in ("source", "lang") for k, f in (("least", F.min), ("most", F.max))])
    torn = texts.where("least_source < most_source or least_lang < most_lang").select("hash", "least_source", "least_lang")
    rows = rows.join(torn, "hash", "left").withColumns({c: F.coalesce(f"least_{c}", c) for c in ("source", "lang")}).drop("least_source", "least_lang")
    rows = staged(rows, "shards-whole")
    placed, _ = kd_shards(rows, ["size", "source", "lang"], shards.bit_length() - 1)
    bins = max(1, rows.count() // rows_per_bin)
    placed = staged(placed.select("key", "size", "crc", F.col("node").cast("int").alias("shard"), "rid", F.pmod(F.xxhash64("rid"), F.lit(bins)).alias("bin")), "shards-placed")
    counts = placed.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("rid"))
    placed = placed.withColumn("at", inside - 1).join(counts, ["shard", "bin"])
    return placed.select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("at")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

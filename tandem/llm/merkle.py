"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups' roots, and the proof of every row.

Upper levels come from a butterfly exchange. The leaves lie in aligned blocks, each hashed within a task.
Then, round by round, aligned groups of blocks swap the roots of their subtrees, and every block hashes
the ancestors itself. After the last round each block holds the root and the upper part of its
rows' proofs, so nothing is passed down the tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import staged
from tandem.operators.position import ranked


def digest(parts: list[str]) -> str:
    """Lower-case hex SHA-256 of digests concatenated as text."""
    return sha256("".join(parts).encode()).hexdigest()


def climb(nodes: list[str], at: int, total: int, levels: int, fanout: int) -> tuple[str, list[str]]:
    """Ancestor and siblings of ``nodes[at]``, ``levels`` levels up or as far as the tree goes.

    ``nodes`` is an aligned run of one level of a tree whose whole level has ``total`` nodes;
    siblings come level by level, those of a level from left to right.
    """
    path: list[str] = []
    for _ in range(levels):
        if total == 1:
            break
        first = at - at % fanout
        path += nodes[first:at] + nodes[at + 1 : first + fanout]
        nodes = [digest(nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
        at, total = at // fanout, -(-total // fanout)
    return nodes[at], path


def block_paths(leaves: list[str], total: int, levels: int, fanout: int) -> list[list[str]]:
    """For each leaf of a block its siblings inside the block, bottom up."""
    tiers = [leaves]
    while len(tiers) <= levels and total > 1:
        tiers.append([digest(tiers[-1][k : k + fanout]) for k in range(0, len(tiers[-1]), fanout)])
        total = -(-total // fanout)
    out = []
    for at in range(len(leaves)):
        path: list[str] = []
        for tier in tiers[:-1]:
            first = at - at % fanout
            path += tier[first:at] + tier[at + 1 : first + fanout]
            at //= fanout
        out.append(path)
    return out


def fold(node: str, at: int, total: int, path: list[str], fanout: int) -> str:
    """The root that follows from a node, its place among ``total`` and its siblings."""
    used = 0
    while total > 1:
        first = at - at % fanout
        run = min(fanout, total - first) - 1
        left, others = at - first, path[used : used + run]
        node = digest([*others[:left], node, *others[left:]])
        used, at, total = used + run, at // fanout, -(-total // fanout)
    return node


def blocks_of(leaves: DataFrame, members: list[str], size: int) -> DataFrame:
    """``leaves`` (grp, pos, n, ``members``) as rows (grp, idx, n, rows), each of ``size`` leaves."""
    block = F.floor(F.col("pos") / F.lit(size)).cast("bigint").alias("idx")
    return leaves.groupBy("grp", block, "n").agg(F.array_sort(F.collect_list(F.struct("pos", *members))).alias("rows"))


def _climbed(rows: DataFrame, levels: int, fanout: int) -> DataFrame:
    """Rows (grp, idx, blocks, total, at, nodes, path) to (grp, idx, blocks, node, path)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 16):  # few blocks at a time become Python objects
                b = batch.slice(k, 16)
                up = []
                for nodes, at, total, before in zip(*(b[c].to_pylist() for c in ("nodes", "at", "total", "path")), strict=True):
                    node, path = climb(nodes, at, total, levels, fanout)
                    up.append((node, None if before is None else before + path))
                cols = [b["grp"], b["idx"], b["blocks"], pa.array([x[0] for x in up], pa.string()), pa.array([x[1] or [] for x in up], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=["grp", "idx", "blocks", "node", "path"])

    return rows.mapInArrow(run, "grp string, idx bigint, blocks bigint, node string, path array<string>")


def butterfly(blocks: DataFrame, fanout: int, block_levels: int, round_levels: int) -> DataFrame:
    """``blocks`` (grp, idx, n leaves, rows) to (grp, idx, node, path): the group's root and the siblings above the block.

    A round lifts every block ``round_levels`` levels. In it a block meets ``group`` subtrees at
    most: its own and those of its aligned group, each from the block that holds the same
    place in that subtree (in the last, smaller one: the place modulo its size, so that its blocks share
    the load). The number of rounds grows with the logarithm of the blocks; a round shuffles one
    digest per block and partner. One number comes to the driver.
    """
    size, group = fanout**block_levels, fanout**round_levels
    state = blocks.select(
        "grp", "idx", F.ceil(F.col("n") / F.lit(size)).cast("bigint").alias("blocks"), F.lit(0).alias("at"), F.col("n").alias("total"),
        F.col("rows.node").alias("nodes"), F.lit(None).cast("array<string>").alias("path"),  # every leaf finds its siblings in the block later
    )
    state = staged(_climbed(state, block_levels, fanout), "merkle-state")
    most = state.agg(F.max("blocks")).first()[0] or 1
    span = 1  # blocks in a subtree
    while span < most:
        tree = F.floor(F.col("idx") / F.lit(span)).cast("bigint")
        total = F.ceil(F.col("blocks") / F.lit(span)).cast("bigint")
        low = tree - tree % group
        asked = state.select(
            "grp", "idx", "blocks", tree.alias("tree"), total.alias("total"), "path",
            F.explode(F.sequence(low, F.least(low + group, total) - 1)).alias("other"),
        )
        there = F.least(F.lit(span), F.col("blocks") - F.col("other") * span)
        asked = asked.withColumn("partner", F.col("other") * span + (F.col("idx") - F.col("tree") * span) % there)
        held = state.select(F.col("grp").alias("g"), F.col("idx").alias("i"), F.col("node").alias("theirs"))
        met = asked.join(held, (F.col("grp") == F.col("g")) & (F.col("partner") == F.col("i")))
        met = met.groupBy("grp", "idx", "blocks", "tree", "total").agg(
            F.array_sort(F.collect_list(F.struct("other", "theirs"))).alias("met"), F.first("path").alias("path")
        )
        rows = met.select("grp", "idx", "blocks", (F.col("tree") % group).cast("int").alias("at"), "total", F.col("met.theirs").alias("nodes"), "path")
        state = staged(_climbed(rows, round_levels, fanout), "merkle-state")
        span *= group
    return state.select("grp", "idx", "node", "path")


def tree_of(leaves: DataFrame, members: list[str], fanout: int, block_levels: int, round_levels: int) -> DataFrame:
    """``leaves`` (grp, pos, n, node, ``members``) as block rows (grp, idx, n, rows, root, path)."""
    blocks = staged(blocks_of(leaves, ["node", *members], fanout**block_levels), "merkle-blocks")
    roots = butterfly(blocks, fanout, block_levels, round_levels).select(
        F.col("grp").alias("g"), F.col("idx").alias("i"), F.col("node").alias("root"), "path"
    )
    return blocks.join(roots, (F.col("grp") == F.col("g")) & (F.col("idx") == F.col("i"))).drop("g", "i")


def encoded(col: Column) -> Column:
    """A value as text: ``-`` if null, else its number of UTF-8 bytes, a colon and the value."""
    s = col.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(cols: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in cols]), 256)


def merkle_proofs(
    docs: DataFrame, leaf: Column, claimed: Column, group: str = "lang", key: str = "doc_id", fanout: int = 2, block_levels: int = 12, round_levels: int = 4,
) -> DataFrame:
    """(key, leaf, subroot, root, path, folded_root, verified) of every row of ``docs``.

    ``leaf`` is the row's true digest, ``claimed`` the digest of the row as somebody shows it.
    Leaves stand by key (nulls first; equal keys by digest, so repeated rows have neighbouring leaves)
    within their group; groups by name, null first. ``path`` holds the siblings up to the root over
    all groups, left to right and bottom up; ``folded_root`` follows from the claimed leaf and them.
    An empty table gives no rows; other columns of ``docs`` don't matter.

    Rows are ranked without a window. A task holds ``fanout ** block_levels`` leaves.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(grp.alias("grp"), F.col(key).alias("key"), leaf.alias("node"), claimed.alias("claimed"), F.monotonically_increasing_id().alias("rid"))
    rows = staged(rows.withColumn("claimed", F.when(F.col("claimed") != F.col("node"), F.col("claimed"))), "merkle-leaves")
    placed = ranked(rows, [F.col("key").asc_nulls_first(), "node", "rid"], ["grp"], total_col="n").drop("rid")
    blocks = tree_of(placed, ["key", "claimed"], fanout, block_levels, round_levels)

    subroots = blocks.where(F.col("idx") == 0).select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node"))
    tops = tree_of(ranked(staged(subroots, "merkle-subroots"), ["name"], ["grp"], total_col="n"), ["name"], fanout, block_levels, round_levels)

    def top_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                inner = block_paths([r["node"] for r in b["rows"]], b["n"], block_levels, fanout)
                rows = [{"name": r["name"], "place": r["pos"], "groups": b["n"], "root": b["root"], "top": p + b["path"]} for r, p in zip(b["rows"], inner, strict=True)]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("name", pa.string()), ("place", pa.int64()), ("groups", pa.int64()), ("root", pa.string()), ("top", pa.list_(pa.string()))]))

    tops = tops.mapInArrow(top_paths, "name string, place bigint, groups bigint, root string, top array<string>")
    tops = staged(tops, "merkle-tops")
    upper = blocks.select("grp", "idx", "n", F.col("root").alias("subroot"), "path").join(tops, F.col("grp") == F.col("name")).drop("name")
    leaves = blocks.select(F.col("grp").alias("g"), F.col("idx").alias("i"), "rows")
    whole = leaves.join(upper, (F.col("g") == F.col("grp")) & (F.col("i") == F.col("idx"))).drop("g", "i")

    kind = docs.schema[key].dataType

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                b = batch.slice(k, 1).to_pylist()[0]
                rows, sub, root = b["rows"], b["subroot"], b["root"]
                inner = block_paths([r["node"] for r in rows], b["n"], block_levels, fanout)
                paths, folded = [], []
                for r, p in zip(rows, inner, strict=True):
                    below = p + b["path"]
                    paths.append(below + b["top"])
                    up = fold(r["node"] if r["claimed"] is None else r["claimed"], r["pos"], b["n"], below, fanout)
                    folded.append(fold(up, b["place"], b["groups"], b["top"], fanout))
                # the key column goes as it came
                keys = batch.column("rows").slice(k, 1).flatten().field("key")
                arrays = [
                    keys, pa.array([r["node"] for r in rows], pa.string()), pa.array([sub] * len(rows), pa.string()), pa.array([root] * len(rows), pa.string()),
                    pa.array(paths, pa.list_(pa.string())), pa.array(folded, pa.string()), pa.array([x == root for x in folded], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "leaf", "subroot", "root", "path", "folded_root", "verified"])

    out = whole.mapInArrow(finish, f"key {kind.simpleString()}, leaf string, subroot string, root string, path array<string>, folded_root string, verified boolean")
    return out.withColumnRenamed("key", key)


def manifest(docs: DataFrame) -> DataFrame:
    """Proofs of all documents against their own rows, every seventh (by crc32 of the id) tampered with: n_chars is one more.

    A row: doc_id, leaf, subroot, root, proof_sha256 (of the siblings, concatenated), folded_root, verified.
    A null id is in no tampered class; a null n_chars stays null, so its row verifies.
    """
    cols = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = leaf_hash(cols)
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    claimed = F.when(tampered, leaf_hash([*cols[:3], more, cols[4]])).otherwise(leaf)
    proofs = merkle_proofs(docs, leaf, claimed)
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path", ""), 256).alias("proof_sha256"), "folded_root", "verified")

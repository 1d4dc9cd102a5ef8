"""A Merkle manifest of a table: one tree per group of rows, and one over the groups' roots.

A level of a tree is the text of its digests, one after the other. ``BLOCK`` consecutive nodes, aligned, are one row
that holds its levels as such texts, so the parents of a level are the digests of its substrings of ``FAN`` digests,
and a node's siblings are the substrings on both sides of it. The blocks' last digests are the nodes of the next rank of
blocks, until a tree fits one block. Proofs are handed down the same way: a block's row is joined with the path above it, one
row a block, and unfolds into its nodes. No task ever holds more of a tree than one block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.llm.ranks import placed
from bodega.llm.shared import store

FAN = 16
LEVELS = 3
BLOCK = FAN**LEVELS
DIGEST = 64
RUN = FAN * DIGEST
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BITS = FAN.bit_length() - 1
_PATH = "array<struct<left: string, right: string>>"


def digest(values: Sequence[Column]) -> Column:
    """The digest of a row: every value as ``-`` if null, else its UTF-8 byte count, a colon and the value."""

    def stated(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[stated(value) for value in values]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` has with the siblings in ``path``."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step.left, node, step.right), 256))


def siblings(path: Column) -> Column:
    """All siblings of ``path``, level by level and left to right, as one text of digests."""
    return F.array_join(F.transform(path, lambda step: F.concat(step.left, step.right)), "")


@dataclass(frozen=True)
class Forest:
    """Blocks of all trees by rank, and the root of every tree with the rank of the block that ends in it."""

    ranks: list[DataFrame]
    tops: DataFrame


def _parents(level: str) -> str:
    run = f"substring({level}, run * {RUN} + 1, {RUN})"
    runs = f"transform(sequence(0, (length({level}) - 1) DIV {RUN}), run -> sha2({run}, 256))"
    return f"CAST(array_join({runs}, '') AS BINARY)"


def _blocks(nodes: DataFrame, label: str) -> DataFrame:
    """Rows (tree, place, total, node, item) as blocks with their levels, as far as the tree still has several nodes."""
    block = F.expr(f"place DIV {BLOCK}").alias("block")
    held = F.sort_array(F.collect_list(F.struct("place", "node", "item"))).alias("held")
    blocks = nodes.groupBy("tree", "total", block).agg(held)
    blocks = blocks.withColumn(
        "height", F.expr(f"IF(total > 1, (length(bin(total - 1)) + {_BITS - 1}) DIV {_BITS}, 0)")
    )
    blocks = blocks.withColumn("level0", F.expr("CAST(array_join(transform(held, x -> x.node), '') AS BINARY)"))
    for k in range(1, LEVELS + 1):
        blocks = blocks.withColumn(f"level{k}", F.expr(f"IF(height >= {k}, {_parents(f'level{k - 1}')}, NULL)"))
    top = F.coalesce(*[F.col(f"level{k}") for k in range(LEVELS, -1, -1)]).cast("string").alias("top")
    items = F.expr("transform(held, x -> x.item)").alias("items")
    return store(blocks.select("tree", "total", "block", "height", items, *[f"level{k}" for k in range(LEVELS)], top), label)


def forest(nodes: DataFrame, label: str) -> Forest:
    """The trees over rows (tree, place, total, node, item)."""
    ranks = [_blocks(nodes, f"{label}_0")]
    while (ranks[-1].agg(F.max("total")).first()[0] or 0) > BLOCK:
        above = ranks[-1].filter(F.col("total") > BLOCK)
        total = F.expr(f"(total + {BLOCK - 1}) DIV {BLOCK}").alias("total")
        item = F.lit(None).cast("string").alias("item")
        nodes = above.select("tree", F.col("block").alias("place"), total, F.col("top").alias("node"), item)
        ranks.append(_blocks(nodes, f"{label}_{len(ranks)}"))
    ended = (
        blocks.filter(F.col("total") <= BLOCK).select("tree", "top", F.lit(rank).alias("rank"))
        for rank, blocks in enumerate(ranks)
    )
    return Forest(ranks, reduce(DataFrame.union, ended))


def _side(level: str, index: str, side: str) -> str:
    """The substring left or right of digest ``index`` in its run."""
    run = f"substring({level}, ({index} DIV {FAN}) * {RUN} + 1, {RUN})"
    at = f"({index} % {FAN}) * {DIGEST}"
    cut = f"substring({run}, 1, {at})" if side == "left" else f"substring({run}, {at} + {DIGEST + 1}, {RUN})"
    return f"CAST({cut} AS STRING)"


def _step(level: str, index: str, height: str) -> str:
    """One step of a path as an array, empty where the tree ends below it."""
    step = f"struct({_side(level, index, 'left')} AS left, {_side(level, index, 'right')} AS right)"
    return f"IF({height}, array({step}), CAST(array() AS {_PATH}))"


def _unfolded(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of blocks: (tree, place, item, node, subroot, root, path), ``above`` having a row per block."""
    steps = [_step(f"level{k}", f"(run DIV {FAN ** (k - 1)})", f"height > {k}") for k in range(1, LEVELS)]
    run = f"""struct(run, substring(level0, run * {RUN} + 1, {RUN}) AS digests,
        slice(items, run * {FAN} + 1, {FAN}) AS items, concat({", ".join(steps)}, path) AS path)"""
    runs = F.expr(f"explode(transform(sequence(0, (length(level0) - 1) DIV {RUN}), run -> {run}))").alias("run")
    rows = blocks.join(above, ["tree", "block"]).select("tree", "block", "height", "subroot", "root", runs)
    rows = rows.select("*", F.posexplode("run.items").alias("k", "item"))
    return rows.select(
        "tree",
        F.expr(f"block * {BLOCK} + run.run * {FAN} + k").alias("place"),
        "item",
        F.expr(f"CAST(substring(run.digests, k * {DIGEST} + 1, {DIGEST}) AS STRING)").alias("node"),
        "subroot",
        "root",
        F.expr(f"concat({_step('run.digests', 'k', 'height > 0')}, run.path)").alias("path"),
    )


def paths(trees: Forest, above: DataFrame) -> DataFrame:
    """Every node of the lowest rank with its path; ``above`` has what lies above each tree (tree, subroot, root, path)."""
    last = len(trees.ranks) - 1
    tops = trees.tops.select("tree", "rank").join(above, "tree")
    upper = None
    for rank in range(last, -1, -1):
        own = tops.filter(F.col("rank") == rank)
        own = own.select("tree", F.lit(0).cast("long").alias("block"), "subroot", "root", "path")
        if upper is not None:
            own = own.union(upper.select("tree", F.col("place").alias("block"), "subroot", "root", "path"))
        upper = _unfolded(trees.ranks[rank], own)
    return upper


def manifest(docs: DataFrame, leaf: Column, group: str = "source", order: str = "doc_id", keep: Sequence[Column] = ()) -> DataFrame:
    """Every row's proof: ``others`` (``keep``), leaf, subroot, root and path (siblings left and right, leaf to root).

    Rows of one ``group`` are the leaves of a tree, by ``order`` (nulls first; rows of equal ``order`` by leaf, so that
    the digests do not depend on partitions). The groups' roots, by group (null first, then by bytes), are the leaves of
    the last tree. ``FAN`` consecutive nodes have a parent while there are several. A tree of one leaf is that leaf, and an
    empty table gives no rows. Null values are part of ``leaf`` as its maker states them; repeated rows are leaves of their own;
    other columns of ``docs`` play no part.
    """
    # 's' keeps every group behind the null one, and the empty group apart from it.
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n")).alias("tree")
    item = F.struct(*keep) if keep else F.struct(F.col(order))
    leaves = store(docs.select(tree, F.col(order).alias("at"), leaf.alias("node"), item.alias("item")), "merkle_leaves")
    nodes = placed(leaves, "tree", ["at", "node"], "merkle_places")
    groups = forest(nodes.select("tree", "place", "total", "node", "item"), "merkle_group")
    roots = groups.tops.select(F.lit("").alias("all"), F.col("tree").alias("item"), F.col("top").alias("node"))
    roots = placed(roots, "all", ["item"], "merkle_roots")
    whole = forest(roots.select(F.col("all").alias("tree"), "place", "total", "node", "item"), "merkle_root")
    over = whole.tops.select("tree", F.lit(None).cast("string").alias("subroot"), F.col("top").alias("root"))
    over = over.withColumn("path", F.expr(f"CAST(array() AS {_PATH})"))
    above = paths(whole, over).select(F.col("item").alias("tree"), F.col("node").alias("subroot"), "root", "path")
    # One row per group, which every rank of blocks asks for.
    above = store(above, "merkle_above")
    rows = paths(groups, above)
    return rows.select(F.col("item").alias("others"), F.col("node").alias("leaf"), "subroot", "root", "path")

"""Connected components of links between long ids, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm.shared import discard, store


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest id that is reachable.

    Large-star and small-star rounds in turn, which shorten every path by a constant factor, until nothing changes;
    then every edge leads to the smallest node. No node's neighbours are gathered: each round takes minima,
    which tasks prepare, and joins them back. Links to itself and repeated links do no harm; no links, no rows.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = store(links.select(a, b).filter("a != b").distinct(), "links")
    before = _print(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a != b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        lower = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b")
        shorter = store(lower.union(lowest.select("a", F.col("low").alias("b"))).distinct(), "links")
        discard(edges)
        edges, last, before = shorter, before, _print(shorter)
        if last == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)

"""Connected components of links kept as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Links in a file of a round's table.
FILE_LINKS = 1_000_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b, both bigint, any direction): the smallest node it reaches.

    Rounds of linking each node's larger neighbours to its smallest one, and
    then its smaller ones, until nothing changes. Every step is a min per node
    and a join, so a node with many links is pre-aggregated and never gathered;
    each round is written to the shared folder, so a lost executor costs one
    round, and only a count reaches the driver.
    """
    edges = written(_oriented(links, "a", "b").distinct(), "links")
    seen = _signature(edges)
    while seen[0]:
        # Larger neighbours of every node are linked to the smallest node around it.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a")
        large = _oriented(large, "b", "m").distinct()  # edges run from the larger node a to the smaller b
        # Smaller neighbours of every node, and the node, are linked to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = large.join(low, "a")
        moved = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = low.select("a", F.col("m").alias("b"))
        # Rounds never add links, so the last count says how many files the next table needs.
        edges = written(kept.unionByName(moved).distinct().coalesce(-(-seen[0] // FILE_LINKS)), "links")
        before, seen = seen, _signature(edges)
        if seen == before:
            break
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    tops = edges.select(F.col("b").alias("a")).distinct().join(roots, "a", "left_anti").select("a", F.col("a").alias("root"))
    return roots.unionByName(tops).withColumnRenamed("a", "node")


def _signature(edges: DataFrame) -> tuple[int, int]:
    """Number of links and a hash of their set, to see whether a round changed anything."""
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def _oriented(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))

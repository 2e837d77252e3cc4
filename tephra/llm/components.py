"""Connected components of a link table, on Spark.

Alternating large-star and small-star steps (Kiveris et al., "Connected components in
MapReduce and beyond"): each step links neighbours to the smallest id around them, by
aggregates and joins only, so a node with very many links is split like any skewed key.
Every round is written to the shared checkpoint folder; only a count and a checksum
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import written

MAX_ROUNDS = 60


def _to_smallest(links: DataFrame, only_smaller: bool) -> DataFrame:
    """``links`` is (u, v). The smallest id at and around u; every v (above u, or below) is linked to it."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(smallest, "u").withColumn("m", F.least("u", "m"))
    if only_smaller:  # links hold v < u: link u and all its v to the smallest
        near = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = smallest.select("u", F.col("m").alias("v"))
        out = near.union(own)
    else:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of an undirected link table with columns ``a, b``.

    The component is the smallest node reachable. Loops and repeated links are harmless.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "components")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both, only_smaller=False)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = written(_to_smallest(down, only_smaller=True), "components")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.hash("u", "v").cast("long"))
        ).first()
        if now == state:
            # Stable: every node but the smallest of its component has one link, to that one.
            roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        state = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")

"""Connected components of a graph whose edges live in a table, by alternating stars.

Each round replaces a node's edges by edges to the smallest node it sees: first for larger neighbours, then for
smaller ones. The number of rounds grows with the logarithm of the longest path. The smallest neighbour is an
aggregate, so a node with a third of all edges combines before the shuffle; it is stored, so that the join back is
one between two stored tables, which Spark splits where a key is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.storage import materialize


def _star(edges: DataFrame, least: DataFrame, larger_only: bool) -> DataFrame:
    joined = edges.join(least, "u")
    if larger_only:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    below = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(joined.select("u", F.col("m").alias("v")))


def _round(edges: DataFrame, n: int) -> DataFrame:
    """`edges`, of which there are `n`, after both stars."""
    both = materialize(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges", 2 * n)
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = materialize(_star(both, materialize(least, "least", 2 * n), True).distinct(), "edges", 2 * n)
    least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least", 2 * n)
    small = _star(large, least, False).filter("u <> v").distinct()
    return materialize(small, "edges", 2 * n)


def _checksum(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, its smallest reachable node, for every node with an edge (columns `u`, `v`: long).

    Loops and repeated edges are allowed; null ends are not. No edges give an empty table.
    """
    now = materialize(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = None
    while (state := _checksum(now)) != before and state[0]:
        before = state
        now = _round(now, state[0])
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

"""Do two loads hold the same rows, and which keys differ?

Rows go to leaves, equal ranges of the hash of their key, and each leaf of a table gets the number of its rows and two
sums of row hashes. The sums do not depend on the order of the rows, count repeated rows, and combine before the shuffle,
so a tree over the leaves is their sums again. Each load stores its tree once, beside its rows in the order of leaves.

Two loads are compared from the top: only children of nodes that differ are looked at on the next level, and only the
leaves that are left have their rows read, which are compared key by key. Equal loads cost one row each.

NULLs are values here, in keys as in other columns. Two different sets of rows pass as equal with a chance of about 1 in
2**128 a leaf.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sinks.table_set import Writing

LEAF, LEVEL, NODE = "_leaf", "level", "node"
SUMS = ("n", "sum1", "sum2")

# Statuses of a key.
ONLY_FIRST, ONLY_SECOND, CHANGED = "only in first", "only in second", "changed"


@dataclass(frozen=True)
class Shape:
    """`fanout` to the power of `depth` leaves; about `rows` / 100,000 of them keep a leaf's rows within a small task."""

    fanout: int = 16
    depth: int = 3

    @property
    def leaves(self) -> int:
        return self.fanout**self.depth


def _hash(seed: int, columns: Sequence[str]) -> Column:
    """Of all columns, with a place for each NULL; the hash function alone passes over them."""
    return F.xxhash64(F.lit(seed), *columns, *[F.col(c).isNull() for c in columns])


def _leaf(keys: Sequence[str], leaves: int) -> Column:
    return F.pmod(_hash(0, keys), F.lit(leaves)).cast("int")


def in_leaves(df: DataFrame, keys: Sequence[str], shape: Shape = Shape()) -> DataFrame:
    """The rows in the order of their leaves, as they should be stored. One key's rows are cut where they are many."""
    placed = df.withColumn(LEAF, _leaf(keys, shape.leaves)).withColumn("_cut", _hash(1, df.columns))
    return placed.repartitionByRange(LEAF, "_cut").sortWithinPartitions(LEAF).drop("_cut")


def tree(stored: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """`level` (0 is the top), `node` and the sums of its rows, from a table of `in_leaves`; nodes without rows are left
    out. The rows are read once."""
    columns = sorted(c for c in stored.columns if c != LEAF)
    hashes = [F.sum(_hash(seed, columns).cast("decimal(38,0)")).alias(name) for seed, name in ((1, "sum1"), (2, "sum2"))]
    leaves = stored.groupBy(LEAF).agg(F.count(F.lit(1)).alias("n"), *hashes)
    # At most `depth` + 1 rows a leaf.
    steps = [
        F.struct(F.lit(level).alias(LEVEL), F.floor(F.col(LEAF) / F.lit(shape.fanout ** (shape.depth - level))).cast("int").alias(NODE))
        for level in range(shape.depth + 1)
    ]
    nodes = leaves.select(F.inline(F.array(*steps)), *SUMS)
    return nodes.groupBy(LEVEL, NODE).agg(*[F.sum(name).cast("decimal(38,0)").alias(name) for name in SUMS])


def store(writing: Writing, name: str, df: DataFrame, keys: Sequence[str], shape: Shape = Shape()) -> list[str]:
    """Write a table in the order of its leaves, and its tree as `<name>_tree`; returns both names."""
    stored = writing.write(name, in_leaves(df, keys, shape))
    writing.write(f"{name}_tree", tree(stored, shape).repartitionByRange(LEVEL, NODE).sortWithinPartitions(LEVEL, NODE))
    return [name, f"{name}_tree"]


def differing_leaves(first: DataFrame, second: DataFrame, shape: Shape = Shape()) -> list[int]:
    """The leaves in which two stored trees differ. A level reads the children of the nodes that differ above it.

    The list is bounded by the leaves, a number each.
    """
    nodes = [0]
    for level in range(shape.depth + 1):
        at = F.col(LEVEL) == level
        wanted = at if level == 0 else at & F.col(NODE).isin(nodes)
        both = first.filter(wanted).unionByName(second.filter(wanted).select(LEVEL, NODE, *[(-F.col(c)).alias(c) for c in SUMS]))
        left = both.groupBy(NODE).agg(*[F.sum(c).alias(c) for c in SUMS]).filter(" or ".join(f"{c} <> 0" for c in SUMS))
        found = [row[NODE] for row in left.select(NODE).collect()]
        if not found or level == shape.depth:
            return sorted(found)
        nodes = [node * shape.fanout + child for node in found for child in range(shape.fanout)]
    return []


def differing_keys(
    first: DataFrame, second: DataFrame, keys: Sequence[str], leaves: Sequence[int]
) -> DataFrame:
    """The keys whose rows differ between two tables of `in_leaves`, with `status`, and the rows of each (`rows_first`,
    `rows_second`). Only the given leaves are read: their row groups by the order of the files, and nothing if there are none.
    """
    columns = sorted(c for c in first.columns if c != LEAF)
    if columns != sorted(c for c in second.columns if c != LEAF):
        raise ValueError("the loads have different columns")

    def counted(df: DataFrame, mine: int) -> DataFrame:
        sign = F.lit(1 if mine == 0 else -1)
        hashes = [(sign * _hash(seed, columns).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]
        sides = [F.lit(int(mine == side)).cast("long").alias(name) for side, name in enumerate(("rows_first", "rows_second"))]
        return df.filter(F.col(LEAF).isin(list(leaves))).select(*keys, *hashes, *sides)

    # Both sides in one aggregate: rows combine before the shuffle, a key with any number of rows is one row a task.
    names = ("h1", "h2", "rows_first", "rows_second")
    both = counted(first, 0).unionByName(counted(second, 1)).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])
    differs = (F.col("h1") != 0) | (F.col("h2") != 0) | (F.col("rows_first") != F.col("rows_second"))
    status = F.when(F.col("rows_second") == 0, ONLY_FIRST).when(F.col("rows_first") == 0, ONLY_SECOND).otherwise(CHANGED)
    return both.filter(differs).select(*keys, status.alias("status"), "rows_first", "rows_second")

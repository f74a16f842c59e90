"""Merkle manifest of a dataset: a leaf a row, a tree a group, a tree over the groups, and a proof for every row.

A leaf is the SHA-256 of a row's fields, each with its length in front. Within a group the leaves go by id; runs of
`fanout` nodes become the hash of their digests until one is left, the group's subroot. The subroots, in the order of
the groups, are the leaves of the last tree, whose top is the root. All digests are lowercase hex.

How it is built: leaves are range-sorted once and numbered within their group, and aligned blocks of a power of
`fanout` leaves become partitions, each with the subtree over its own leaves. From there on it is a butterfly: in
round r the partitions whose numbers differ in digit r alone, `fanout` of them, swap the roots of their subtrees, and
each hashes the parent for itself. So every partition knows all siblings above it after the last round, and nothing
is sent down again. A group's partitions are padded with empty ones to a power of `fanout`; an empty partition takes
part without a digest, and so passes on what a shorter last run needs. The groups are the partitions of the last tree.

Blocks, rounds and the last tree are bounded by `block_leaves` and `fanout` rows a task's group, whatever the size of a
group of rows. A round moves one row a partition, with the siblings found so far.

Defined results: a null field is `-`; a null group is a group of its own and the first; null ids come first. Rows of
one id go by their leaves, so equal rows are interchangeable. A lone leaf is its own subroot, a lone subroot the root,
and a row alone has the hash of the empty text as proof. An empty table gives an empty manifest. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.numbering import number_rows, sorted_ranges, with_arrival
from ledgerloom.storage import materialize

# Parameters: most leaves of a block, about so many leaves of a range of the sort, rounds run as one job.
BLOCK_LEAVES = 1024
RANGE_LEAVES = 500_000
ROUNDS_A_JOB = 6

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its UTF-8 byte count in front; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def leaf_rows(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    id_column: str = "doc_id",
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """`id`, `grp`, `key` (the group as text, never null), `leaf`, and `altered`: the leaf of the row as it would be with
    the given values, where `where` holds, else null."""
    values = [docs[name] for name in fields]
    changed = [(altered or {}).get(name, docs[name]) for name in fields]
    tampered = F.when(where, leaf_of(*changed)) if altered and where is not None else F.lit(None).cast("string")
    return docs.select(
        docs[id_column].alias("id"),
        docs[group].alias("grp"),
        field(docs[group]).alias("key"),
        leaf_of(*values).alias("leaf"),
        tampered.alias("altered"),
    )


def placed_leaves(leaves: DataFrame) -> DataFrame:
    """Stored leaves with `place` in their group, from 0, and `n`, the leaves of the group."""
    spark = leaves.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), leaves.count() // RANGE_LEAVES + 1)
    ordered = sorted_ranges(
        with_arrival(leaves), ["grp", "id", "leaf"], "_arrival", derived=["key", "altered"], ranges=ranges
    )
    # A row per range and group that meet: ranges plus groups at most.
    pieces = ordered.groupBy("key", "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("key")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "key",
        "_range",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(group).alias("n"),
    )
    joined = ordered.join(materialize(starts, "starts"), ["key", "_range"])
    return joined.withColumn("place", F.col("_place") + F.col("_shift")).drop("_range", "_place", "_shift")


def levels_above(nodes: list[str], fanout: int, height: int) -> list[list[str]]:
    """The nodes and `height` levels above them; a last run may be shorter."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([sha256("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def height_of(n: int, fanout: int) -> int:
    """Levels between `n` nodes and the one at the top."""
    height = 0
    while n > 1:
        n, height = -(-n // fanout), height + 1
    return height


def _block_height(block_leaves: int, fanout: int) -> int:
    height = 1
    while fanout ** (height + 1) <= block_leaves:
        height += 1
    return height


def blocks_of(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    """Stored partitions: `key`, `part`, `n`, the leaves in order as `items`, and `node`, the top of their subtree."""
    item = F.struct("place", "id", "leaf", "altered")
    part = F.floor(F.col("place") / F.lit(fanout**height)).cast("long").alias("part")
    blocks = placed.groupBy("key", part).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))

    def run(batches):
        for batch in batches:
            nodes = []
            for n, items in zip(batch.column("n").to_pylist(), batch.column("items").to_pylist()):
                top = min(height, height_of(n, fanout))
                nodes.append(levels_above([item["leaf"] for item in items], fanout, top)[-1][0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.string())], [*batch.schema.names, "node"])

    return materialize(blocks.mapInArrow(run, T.StructType([*blocks.schema, T.StructField("node", T.StringType())])), "blocks")


def _padded(parts: DataFrame, fanout: int) -> tuple[DataFrame, int]:
    """The partitions of each tree with empty ones up to a power of `fanout`, and the rounds of the widest tree."""
    trees = parts.groupBy("tree").agg(F.count(F.lit(1)).alias("real"))
    most = trees.agg(F.max("real")).first()[0] or 0
    rounds = height_of(most, fanout)
    width = F.lit(1).cast("long")
    for r in range(rounds):
        width = F.when(F.col("real") > F.lit(fanout**r), F.lit(fanout ** (r + 1)).cast("long")).otherwise(width)
    sized = trees.withColumn("width", width)
    empty = sized.filter("width > real").select(
        "tree", F.explode(F.sequence("real", F.col("width") - 1)).alias("part"), F.lit(None).cast("string").alias("node")
    )
    path = F.array().cast("array<array<string>>").alias("path")
    every = parts.select("tree", "part", "node").unionByName(empty)
    return every.join(materialize(sized.select("tree", "width"), "trees"), "tree").select("*", path), rounds


def _swap(state: DataFrame, r: int, fanout: int) -> DataFrame:
    """Round r: partitions that differ in digit r alone swap their nodes, and each hashes the parent."""
    step = F.lit(fanout**r).cast("long")
    digit = F.floor(F.col("part") / step) % fanout
    around = [F.floor(F.col("part") / (step * fanout)).alias("_above"), (F.col("part") % step).alias("_below")]
    member = F.struct(digit.alias("digit"), "part", "width", "node", "path")
    swapped = state.groupBy("tree", *around).agg(F.sort_array(F.collect_list(member)).alias("members"))
    present = swapped.withColumn("present", F.filter("members", lambda m: m["node"].isNotNull()))
    each = present.select("tree", F.explode("members").alias("own"), "present")
    own = F.col("own")
    nodes = F.transform("present", lambda m: m["node"])
    others = F.transform(F.filter("present", lambda m: m["digit"] != own["digit"]), lambda m: m["node"])
    goes_on = own["width"] > step
    parent = F.when(F.size("present") > 0, F.sha2(F.array_join(nodes, "").cast("binary"), 256))
    return each.select(
        "tree",
        own["part"].alias("part"),
        own["width"].alias("width"),
        F.when(goes_on, parent).otherwise(own["node"]).alias("node"),
        F.when(goes_on, F.concat(own["path"], F.array(others))).otherwise(own["path"]).alias("path"),
    )


def butterfly(parts: DataFrame, fanout: int) -> DataFrame:
    """`tree`, `part`, `node` (the top of the tree) and `path` (the siblings of each round, left to right) for stored
    partitions of trees, each tree's numbered from 0."""
    state, rounds = _padded(parts, fanout)
    for r in range(rounds):
        state = _swap(state, r, fanout)
        if (r + 1) % ROUNDS_A_JOB == 0:
            state = materialize(state, "round")
    real = parts.select("tree", "part")
    return materialize(state.drop("width").join(real, ["tree", "part"]), "tops")


def fold(leaf: str, place: int, path: Sequence[Sequence[str]], fanout: int) -> str:
    """The top of a tree from one of its leaves, its place, and its siblings level by level."""
    node = leaf
    for siblings in path:
        place, digit = divmod(place, fanout)
        node = sha256("".join([*siblings[:digit], node, *siblings[digit:]]))
    return node


def _siblings(levels: list[list[str]], place: int, fanout: int) -> list[list[str]]:
    path = []
    for level in levels[:-1]:
        start = place - place % fanout
        path.append([node for i, node in enumerate(level[start : start + fanout], start) if i != place])
        place //= fanout
    return path


def manifest(leaves: DataFrame, fanout: int = 2, block_leaves: int = BLOCK_LEAVES, with_proofs: bool = False) -> DataFrame:
    """For every row of `leaf_rows`: `id`, `grp_key`, `place` in its group, `leaf`, `subroot`, `root`, `proof_sha256` (the
    hash of all siblings up to the root), `folded_root` (from the altered leaf, where there is one, and the siblings) and
    `verified` (whether that is the root). `with_proofs` adds `proof`, the siblings level by level, and `rank`, the place
    of the group among the groups."""
    if fanout < 2:
        raise ValueError("a run has two nodes at least")
    stored = materialize(leaves, "leaves")
    id_kind = stored.schema["id"].dataType
    height = _block_height(max(block_leaves, fanout), fanout)
    blocks = blocks_of(placed_leaves(stored), fanout, height)
    upper = butterfly(blocks.select(F.col("key").alias("tree"), "part", "node"), fanout)
    subroots = upper.filter("part = 0").select(F.col("tree").alias("key"), F.col("node").alias("subroot"))
    groups = stored.select("grp", "key").distinct()
    ranked = number_rows(groups, ["grp"], "number", derived=["key"]).select("key", (F.col("number") - 1).alias("rank"))
    tops = materialize(subroots.join(ranked, "key"), "subroots")
    last = butterfly(tops.select(F.lit("").alias("tree"), F.col("rank").alias("part"), F.col("subroot").alias("node")), fanout)
    top = last.select(F.col("part").alias("rank"), F.col("node").alias("root"), F.col("path").alias("top_path"))
    by_group = materialize(tops.join(top, "rank"), "roots")
    paths = upper.select(F.col("tree").alias("key"), "part", "path")
    whole = blocks.join(paths, ["key", "part"]).join(by_group, "key")
    whole = whole.select("key", "n", "items", "path", "subroot", "rank", "root", "top_path")
    texts = [T.StructField(name, T.StringType()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    out = [T.StructField("id", id_kind), T.StructField("grp_key", T.StringType()), T.StructField("place", T.LongType())]
    out += [*texts, T.StructField("verified", T.BooleanType())]
    if with_proofs:
        paths_kind = T.ArrayType(T.ArrayType(T.StringType()))
        out += [T.StructField("proof", paths_kind), T.StructField("rank", T.LongType())]
    names = [f.name for f in out]

    def run(batches):
        for batch in batches:
            kinds = {"id": batch.schema.field("items").type.value_type.field("id").type, "place": pa.int64(), "rank": pa.int64()}
            kinds |= {"verified": pa.bool_(), "proof": pa.list_(pa.list_(pa.string()))}
            for i in range(batch.num_rows):
                rows = _block_rows(batch.slice(i, 1).to_pylist()[0], fanout, height)
                columns = [pa.array([row[name] for row in rows], kinds.get(name, pa.string())) for name in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return whole.mapInArrow(run, T.StructType(out))


def _block_rows(block: dict, fanout: int, height: int) -> list[dict]:
    """The manifest rows of one block: its subtree, and what the butterfly brought from above it."""
    items = block["items"]
    levels = levels_above([item["leaf"] for item in items], fanout, min(height, height_of(block["n"], fanout)))
    above = block["path"]
    shared = "".join("".join(run) for run in [*above, *block["top_path"]])
    rows = []
    for i, item in enumerate(items):
        below = _siblings(levels, i, fanout)
        subroot = fold(item["altered"] or item["leaf"], item["place"], [*below, *above], fanout)
        folded = fold(subroot, block["rank"], block["top_path"], fanout)
        rows.append({
            "id": item["id"], "grp_key": block["key"], "place": item["place"], "leaf": item["leaf"],
            "subroot": block["subroot"], "root": block["root"],
            "proof_sha256": sha256("".join(map("".join, below)) + shared),
            "folded_root": folded, "verified": folded == block["root"],
            "proof": [*below, *above, *block["top_path"]], "rank": block["rank"],
        })
    return rows

"""SimHash near duplicates by meet-in-the-middle ball hashing.

A fingerprint stands for all variants of it with up to half of the allowed differing bits flipped. Two fingerprints
within the allowed distance share a variant, and two that share one are within it. Variants are shuffled by some of
their bits: a row goes out for each bucket that a fingerprint's variants reach, with the fingerprint, and the bucket
expands its variants in memory, at most `AT_ONCE` at a time, sorts them and links the owners of equal ones. So a
fingerprint with 2,081 variants is shuffled a few dozen times. Equal fingerprints are merged first; of the pairs in a
bucket only a spanning forest leaves it, which keeps every connection, so no group is spread into its pairs.

Defined results: a null text counts as empty; texts without words have fingerprint zero and link like others; texts
shorter than a shingle are hashed whole. Rows may repeat; a null id takes part but is never a component's smallest
id unless all of its ids are null. Other columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.text import in_slices, lower_words, whole_row, with_text
from ledgerloom.storage import materialize

BITS = 64
SEED = 42
# Variants a bucket has on average, and those expanded at a time: some 50 bytes each, for every task of an executor.
VARIANTS = 2_000_000
AT_ONCE = 500_000
HASH_BLOCK = 1 << 16


def fingerprint(words: list[bytes], shingle: int = 4) -> int:
    """The SimHash of the shingles as an unsigned integer: a bit is set where over half of the hashes set it."""
    import xxhash

    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), HASH_BLOCK):
        spans = zip(starts[at : at + HASH_BLOCK].tolist(), ends[at : at + HASH_BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    packed = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(packed.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_column: str = "doc_id") -> DataFrame:
    """`id_column` and `fp`, the fingerprint as a signed 64-bit integer."""

    def run(batches):
        for batch in in_slices(batches):
            texts = batch.column("text").to_pylist()
            found = np.array([fingerprint(lower_words(text), shingle) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(id_column), found.view(np.int64)], [id_column, "fp"])

    narrow = with_text(docs, id_column, "text")
    return narrow.mapInArrow(run, T.StructType([narrow.schema[id_column], T.StructField("fp", T.LongType(), False)]))


def _flips(positions: list[int], most: int) -> np.ndarray:
    """Masks with up to `most` of the positions set, the empty one first."""
    masks = [np.zeros(1, np.uint64)]
    singles = np.array([1 << p for p in positions], np.uint64)
    level, last = masks[0], np.full(1, -1)
    for _ in range(most):
        grown = [(level[last < i] | single, i) for i, single in enumerate(singles)]
        last = np.concatenate([np.full(len(g), i) for g, i in grown]) if grown else np.zeros(0, int)
        level = np.concatenate([g for g, _ in grown]) if grown else np.zeros(0, np.uint64)
        masks.append(level)
    return np.concatenate(masks)


def _ball(free: int, radius: int) -> int:
    return sum(math.comb(free, k) for k in range(radius + 1))


def _linked(pairs: np.ndarray, n: int) -> np.ndarray:
    """For each of `n` places the smallest one that `pairs` of places connect it with."""
    label = np.arange(n, dtype=np.int32)
    while len(pairs):
        least = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], least)
        np.minimum.at(new, pairs[:, 1], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _link_variants(variants: np.ndarray, owners: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """Places of fingerprints that connect all owners of equal variants, each pair verified."""
    order = np.argsort(variants)
    variants, owners = variants[order], owners[order]
    same = variants[1:] == variants[:-1]
    at = np.flatnonzero(same) + 1
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    first = owners[starts[np.searchsorted(starts, at, "right") - 1]]
    packed = np.unique((first.astype(np.int64) << 32) | owners[at])
    pairs = np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1).astype(np.int32)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pairs[np.bitwise_count(fps[pairs[:, 0]] ^ fps[pairs[:, 1]]) <= distance]


def _count(left: np.ndarray, free: int) -> int:
    """Variants of fingerprints that may still flip `left` of the free bits each."""
    flips, sizes = np.unique(left, return_counts=True)
    return sum(int(n) * _ball(free, int(k)) for k, n in zip(flips, sizes))


def _collisions(
    fps: np.ndarray, centres: np.ndarray, left: np.ndarray, free: list[int], distance: int, limit: int
) -> Iterator[np.ndarray]:
    """Pairs of places in `fps` linked in one bucket. `centres` are the fingerprints moved into it, `left` the flips they
    may still do.

    What has too many variants is divided by its next free bit, the half with fewer variants done first: so the halves
    that wait are few, and no more than `limit` variants are in memory.
    """
    waiting = [(np.arange(len(fps), dtype=np.int32), centres, left.astype(np.int8), free)]
    while waiting:
        who, centres, left, free = waiting.pop()
        if _count(left, len(free)) > limit and free:
            bit, free = np.uint64(1 << free[0]), free[1:]
            halves = []
            for value in (np.uint64(0), bit):
                stays = (centres & bit) == value
                keep = stays | (left > 0)
                moved = np.where(stays, centres, centres ^ bit)[keep]
                halves.append((who[keep], moved, (left - ~stays)[keep], free))
            waiting += sorted(halves, key=lambda half: -_count(half[2], len(free)))
            continue
        variants, owners, at = np.empty(_count(left, len(free)), np.uint64), [], 0
        for k in np.unique(left):
            some, masks = np.flatnonzero(left == k), _flips(free, int(k))
            end = at + len(some) * len(masks)
            np.bitwise_xor(centres[some][:, None], masks[None, :], out=variants[at:end].reshape(len(some), len(masks)))
            owners.append(np.repeat(who[some], len(masks)))
            at = end
        if at:
            yield _link_variants(variants, np.concatenate(owners), fps, distance)


def _forest(found: Iterator[np.ndarray], n: int) -> np.ndarray:
    """Pairs of `n` places that connect what the found ones connect: each place but the smallest of its group, and that.

    Found pairs are merged whenever more of them wait than there are places, so dense groups do not pile up.
    """
    label, waiting, size = np.arange(n, dtype=np.int32), [], 0
    for pairs in found:
        waiting.append(pairs)
        size += len(pairs)
        if size > n:
            label = _linked(label[np.concatenate(waiting)], n)[label]
            waiting, size = [], 0
    if size:
        label = _linked(label[np.concatenate(waiting)], n)[label]
    moved = np.flatnonzero(label != np.arange(n))
    return np.stack([moved, label[moved]], axis=1)


def _bucket_bits(distinct: DataFrame, radius: int, variants: int) -> tuple[list[int], int]:
    """All bit positions, most evenly set first, and how many of them number the buckets."""
    sums = [F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(BITS)]
    row = distinct.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    n = row["n"]
    positions = sorted(range(BITS), key=lambda i: (abs(2 * (row[f"b{i}"] or 0) - n), i))
    return positions, min(32, max(6, math.ceil(math.log2(max(1, n * _ball(BITS, radius) / variants)))))


def near_pairs(distinct: DataFrame, distance: int = 4, variants: int = VARIANTS) -> DataFrame:
    """Pairs `u`, `v` of distinct fingerprints (column `fp`) that connect exactly what lies within `distance` bits.

    `distance` is even: balls of half of it meet in exactly the pairs that are that near.
    """
    if distance % 2:
        raise ValueError("the distance of the balls' centres must be even")
    radius = distance // 2
    positions, n_bits = _bucket_bits(distinct, radius, variants)
    chosen, free = positions[:n_bits], positions[n_bits:]

    def key_of(fps):
        return sum(((fps >> np.uint64(p)) & np.uint64(1)).astype(np.int64) << i for i, p in enumerate(chosen))

    def spread(batches):
        flips = _flips(list(range(n_bits)), min(radius, n_bits)).astype(np.int64)
        for batch in in_slices(batches, 4096):
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            buckets = (key_of(fps.view(np.uint64))[:, None] ^ flips[None, :]).ravel()
            yield pa.RecordBatch.from_arrays([buckets, np.repeat(fps, len(flips))], ["bucket", "fp"])

    def meet(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        moves = key_of(fps) ^ group.column("bucket")[0].as_py()
        mask = sum(((moves >> i) & 1).astype(np.uint64) << np.uint64(p) for i, p in enumerate(chosen))
        left = radius - np.bitwise_count(moves).astype(np.int64)
        found = _collisions(fps, fps ^ mask, left, free, distance, min(2 * variants, AT_ONCE))
        pairs = fps.view(np.int64)[_forest(found, len(fps))]
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    spread_out = distinct.mapInArrow(spread, "bucket long, fp long")
    return spread_out.groupBy("bucket").applyInArrow(meet, "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_column: str = "doc_id", variants: int = VARIANTS
) -> DataFrame:
    """`id_column`, `fp` and `component_id`, the smallest id reachable over links, for every row."""
    marked = materialize(fingerprints(docs, shingle, id_column), "fingerprints")
    n = marked.count()
    distinct = materialize(marked.groupBy("fp").agg(F.min(id_column).alias("first_id")), "distinct", n)
    members = connected_components(near_pairs(distinct.select("fp"), distance, variants))
    labelled = distinct.join(members.withColumnRenamed("node", "fp"), "fp", "left")
    labelled = materialize(labelled.withColumn("label", F.coalesce("component", "fp")), "labelled", n)
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    joined = labelled.join(materialize(smallest, "smallest", n), "label")
    of_fp = materialize(joined.select("fp", "component_id"), "of_fp", n)
    return marked.join(of_fp, "fp").select(id_column, "fp", "component_id")


def hex_fingerprint(fp) -> Column:
    """A signed fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_per_group(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_column: str = "doc_id", variants: int = VARIANTS
) -> DataFrame:
    """One row of `docs`, all columns, of each group: the one with the smallest id, of equal ids with the smallest digest
    of the text, of equal texts with the smallest hash of the row.

    Rows with one id but unrelated texts belong to groups of their own. Rows without an id cannot be referred to and stay.
    """
    # The id alone does not tell rows apart; with the text it does, as far as groups go. Rows with an id come first.
    digest = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    key = F.struct(docs[id_column].isNull().alias("no_id"), docs[id_column].alias("id"), digest.alias("digest"))
    rows = docs.select(key.alias("key"), whole_row(docs).alias("row"))
    keyed = docs.select(key.alias("key"), docs["text"].alias("text"))
    groups = near_duplicates(keyed, shingle, distance, "key", variants)
    keep = groups.filter((F.col("key") == F.col("component_id")) & ~F.col("key.no_id")).select("key").distinct()
    named = rows.filter(~F.col("key.no_id")).join(keep, "key", "left_semi")
    order = F.xxhash64("row")
    kept = named.groupBy("key").agg(F.min_by("row", order).alias("row")).select("row")
    return kept.unionByName(rows.filter(F.col("key.no_id")).select("row")).select("row.*")

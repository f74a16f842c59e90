import random
from pathlib import Path

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.components import connected_components
from ledgerloom.storage import FEW_FILES, scratch_path


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(keys, near):
    label = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for i in range(len(keys)):
            low = min([label[i], *[label[j] for j in range(len(keys)) if near(keys[i], keys[j])]])
            changed |= low != label[i]
            label[i] = low
    return label


def texts(n, seed=3):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 260))) for _ in range(n // 3)]
    out = list(base)
    for t in base:
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        out += [" ".join(words), t.upper() + "  "]
    return out


def test_fingerprints_and_groups_equal_brute_force(spark, documents):
    rows = [(10 + i, t) for i, t in enumerate(texts(120))]
    rows += [(1, None), (2, ""), (3, "  \n "), (4, "one two"), (5, "ONE TWO"), (6, "x " * 70_000), (10, rows[0][1])]
    got = simhash.near_duplicates(documents(rows)).select("doc_id", "component_id", simhash.hex_fingerprint("fp").alias("h"))
    fps = [brute_fingerprint(t) for _, t in rows]
    label = brute_groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    ids = [r[0] for r in rows]
    smallest = {k: min(i for i, g in zip(ids, label) if g == k) for k in set(label)}
    expected = sorted((i, smallest[g], f"{f:016x}") for i, g, f in zip(ids, label, fps))
    assert sorted(map(tuple, got.collect())) == expected
    assert len(set(label)) < len(rows) - 40


def test_pairs_at_every_distance(spark):
    """Rings of fingerprints at 3, 4 and 5 bits: the first two connect, the last one does not."""
    rng = np.random.default_rng(1)
    fps, expected = [], 0
    for distance in (3, 4, 5):
        for _ in range(40):
            one = int(rng.integers(0, 2**63)) * 2 + 1
            flips = rng.choice(64, distance, replace=False)
            fps += [one, one ^ sum(1 << int(f) for f in flips)]
            expected += distance <= 4
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    assert simhash.near_pairs(frame).distinct().count() == expected
    # Buckets that are divided again and again hold the same pairs.
    assert simhash.near_pairs(frame, variants=500).distinct().count() == expected


def test_dense_group_leaves_a_forest(spark):
    """All fingerprints within two bits of one are mutually near; only connecting pairs leave the buckets."""
    centre = 0x0123456789ABCDEF
    near = {centre} | {centre ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)}
    frame = spark.createDataFrame([(f if f < 2**63 else f - 2**64,) for f in near], "fp long")
    pairs = simhash.near_pairs(frame)
    assert pairs.count() < 30 * len(near)
    members = connected_components(pairs)
    assert members.count() == len(near)
    assert members.select("component").distinct().count() == 1


def test_kept_rows(spark, documents):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(5, long), (3, long.upper()), (9, long + " end"), (1, "other text entirely"), (1, "other text entirely"), (None, long)]
    kept = simhash.keep_one_per_group(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (True, 0)]


def test_one_id_on_unrelated_texts_keeps_each_group(spark, documents):
    rng = np.random.default_rng(9)
    text = lambda: " ".join(f"w{n}" for n in rng.integers(0, 10**6, 80))
    one, two, three = text(), text(), text()
    rows = [(1, one), (1, two), (2, one), (1, one), (None, three), (7, three), (8, ""), (8, None)]
    for order in (rows, rows[::-1]):
        kept = simhash.keep_one_per_group(documents(order)).collect()
        assert sorted(((r.doc_id or 0), r.text or "") for r in kept) == sorted([(1, one), (1, two), (0, three), (7, three), (8, "")])
    assert {r["a.b"] for r in kept} == {r["_keep_id"] for r in kept} == {"y"}


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_pairs(spark.createDataFrame([(1,)], "fp long"), distance=3)


def test_empty(spark, documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.keep_one_per_group(documents([])).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 300)]
    frame = spark.createDataFrame([*path, *star, (5, 5), (160, 7), (7, 160), (-4, -9)], "u long, v long")
    got = dict(map(tuple, connected_components(frame).collect()))
    assert got == {**{i: 7 for i in [*range(100, 161), *range(200, 300), 7]}, -4: -9, -9: -9}


def test_variants_expand_a_bounded_number_at_a_time(monkeypatch):
    """A bucket of mutually near fingerprints is divided until its parts are small, and still links them all."""
    centre = 0x0123456789ABCDEF
    fps = np.array([centre] + [centre ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)], np.uint64)
    sizes, link = [], simhash._link_variants

    def watched(variants, *others):
        sizes.append(len(variants))
        return link(variants, *others)

    monkeypatch.setattr(simhash, "_link_variants", watched)
    left = np.full(len(fps), 2)
    found = simhash._collisions(fps, fps, left, list(range(64)), 4, 50_000)
    assert simhash._forest(found, len(fps))[:, 1].tolist() == [0] * (len(fps) - 1)
    assert max(sizes) <= 50_000 and sum(sizes) == len(fps) * simhash._ball(64, 2)


def test_small_tables_are_few_files(spark, documents):
    """The tables of a few dozen fingerprints, although the shuffles have many partitions."""
    folders = lambda: set(Path(scratch_path(spark, "x")).parent.glob("*"))
    before = folders()
    held = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        rows = [(i, t) for i, t in enumerate(texts(300))]
        assert simhash.near_duplicates(documents(rows)).count() == len(rows)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    files = {f: len(list(f.glob("*.parquet"))) for f in folders() - before}
    # The first edges are stored before their number is known.
    many = sorted(f.name.split("-")[0] for f, n in files.items() if n > FEW_FILES)
    assert len(files) > 10 and many in ([], ["edges"])

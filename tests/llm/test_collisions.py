import math

import numpy as np
import pytest

from ledgerloom.llm import collisions
from ledgerloom.llm.collisions import Search


def brute(rows, least=0.9):
    """Links and smallest reachable id by comparing all pairs."""
    good = [
        v is not None and len(v) > 0 and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for i, v in rows
    ]
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for (_, v), g in zip(rows, good)]
    near = [
        [j for j in range(len(rows)) if j != i and good[i] and good[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least]
        for i in range(len(rows))
    ]
    label = [r[0] for r in rows]
    for _ in rows:
        label = [min([label[i], *[label[j] for j in near[i]]]) if good[i] else label[i] for i in range(len(rows))]
    return sorted(((i is None, i or 0), len(n), label[k] or 0, i is not None and i == label[k]) for k, ((i, _), n) in enumerate(zip(rows, near)))


def found(spark, rows, search=Search()):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, unit string")
    got = collisions.near_vectors(frame, search).collect()
    return sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, r.component_id or 0, r.kept) for r in got)


def vectors(n, spread, seed, d=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, d))
    every = [c + spread * rng.normal(size=d) for c in centres for _ in range(3)]
    every += list(rng.normal(size=(n - len(every), d)))
    order = rng.permutation(len(every))
    return [(int(i), [float(np.float32(x)) for x in every[i]]) for i in order]


@pytest.mark.parametrize(("spread", "seed"), [(0.05, 1), (0.25, 2)])
def test_equals_all_pairs(spark, spread, seed):
    rows = vectors(240, spread, seed)
    assert found(spark, rows) == brute(rows)


def test_crowd_of_near_copies_is_counted_by_balls(spark):
    rng = np.random.default_rng(3)
    centre, other = rng.normal(size=(2, 24))
    rows = [(i, [float(np.float32(x)) for x in centre + 0.04 * rng.normal(size=24)]) for i in range(100, 420)]
    rows += [(i, [float(np.float32(x)) for x in centre + 0.33 * rng.normal(size=24)]) for i in range(420, 440)]
    rows += [(i, [float(np.float32(x)) for x in other]) for i in range(500, 530)]
    assert found(spark, rows, Search(hot=2)) == brute(rows)


def test_bad_vectors_copies_and_lengths(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]),
        (6, [float("inf"), 1.0, 1.0]), (9, one), (8, one), (8, one), (10, [2.0, 4.0, 6.0]), (11, [1.0, 2.0]),
        (12, [-1.0, -2.0, -3.0]), (None, one),
    ]
    assert found(spark, rows) == brute(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_calibration():
    tail, lines, crowd = collisions.calibrate(50_000, 64, Search())
    rng = np.random.default_rng(0)
    x = rng.normal(size=400_000)
    y = 0.9 * x + math.sqrt(0.19) * rng.normal(size=len(x))
    hit = (np.abs(x) >= tail) & (np.sign(x) * y >= tail) & (np.abs(x - y) <= 0.7)
    rate = collisions._collision_rate(0.9, tail, 0.7)
    assert hit.mean() == pytest.approx(rate, rel=0.15)
    assert (1 - rate) ** lines + lines * rate * (1 - rate) ** (lines - 1) <= 0.001
    assert crowd < 100


@pytest.mark.parametrize("spread", [0.04, 0.25, 0.31])
def test_crowd_with_the_largest_ids_is_not_compared_pair_by_pair(spark, spread, monkeypatch):
    """Background vectors hold the smallest ids; the crowd's cosines are about 1, 0.94 and 0.91."""
    rng = np.random.default_rng(4)
    stored = {}
    store = collisions.materialize
    monkeypatch.setattr(collisions, "materialize", lambda df, label: stored.setdefault(label, store(df, label)) if label == "passing" else store(df, label))
    centre = rng.normal(size=24)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=24)]) for i in range(400)]
    rows += [(i, [float(np.float32(x)) for x in centre + spread * rng.normal(size=24)]) for i in range(400, 700)]
    assert found(spark, rows, Search(hot=2)) == brute(rows)
    crowd = stored["passing"].filter("u >= 400 and v >= 400").count()
    assert crowd < 300 * 299 / 2 / 10

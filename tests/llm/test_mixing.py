import random
from fractions import Fraction

import pytest

from ledgerloom.llm import mixing
from ledgerloom.llm.mixing import Mix


def test_targets_stop_and_reshare():
    assert mixing.targets([10, 10, 10], [1, 1, 1], 3) == [10, 10, 10]
    found = mixing.targets([1, 100, 100], [3, 2, 1], 3)
    assert found == [3, Fraction(198 * 2, 3), Fraction(198, 3)]
    assert mixing.targets([0, 5], [1, 1], 3) == [0, 5]
    assert mixing.targets([0, 0], [1, 2], 3) == [0, 0]


@pytest.mark.parametrize("seed", range(8))
def test_apportionment_equals_seat_by_seat(seed):
    rng = random.Random(seed)
    claims = [rng.randrange(0, 50) for _ in range(9)]
    most = [rng.randrange(0, 40) for _ in range(9)]
    seats = rng.randrange(0, 90)
    given = [0] * 9
    for _ in range(seats):
        open_ = [i for i in range(9) if claims[i] and given[i] < most[i]]
        if not open_:
            break
        given[max(open_, key=lambda i: (Fraction(claims[i], 2 * given[i] + 1), -i))] += 1
    if sum(claims):
        assert mixing.apportion(seats, claims, most) == given


def rows(n=400, seed=4):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["b", "a", None, "Z", "é"]
    return [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(sources)) for i in range(n)]


def brute(data, mix):
    """Every word of every shard's line, taken as often as its block is."""
    sizes = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(names))]
    return names, sizes, dict(zip(names, mixing.targets([sizes[n] for n in names], weights, mix.max_epochs)))


def test_plan_meets_targets(spark, documents):
    data, mix = rows(), Mix(block_words=4, shard_words=500)
    got = mixing.mix_plan(documents(data), mix).collect()
    names, sizes, targets = brute(data, mix)
    source = {i: s for i, _, s in data}
    text = {i: t for i, t, _ in data}
    taken = dict.fromkeys(names, 0)
    assert len(got) == len(data)
    for r in got:
        s = source[r.doc_id]
        assert r.size == len(text[r.doc_id].split())
        assert (r.source_size, r.target) == (sizes[s], float(targets[s]))
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in names:
        assert abs(taken[s] - targets[s]) <= 3 * mix.block_words + 1, s
    again = mixing.mix_plan(documents(data).repartition(7), mix).collect()
    assert sorted(again) == sorted(got)


def test_a_shard_takes_whole_rounds_and_one_run_of_blocks(spark, documents):
    """One source: its target is its size, so every document is taken exactly once."""
    data = [(i, "w " * (i % 13), "only") for i in range(100)]
    got = mixing.mix_plan(documents(data), Mix(block_words=1)).collect()
    assert all(r.taken == r.size for r in got)


def test_overlap_arithmetic(spark):
    """Documents against a run of blocks that wraps round, word by word."""
    sized = spark.createDataFrame([(i, "s", 3 + i % 5) for i in range(30)], "_id long, _source string, _size long")
    total = sum(3 + i % 5 for i in range(30))
    for start, rest in ((0, 10), (total - 7, 20), (50, total - 1), (12, 0)):
        quotas = [("s", 0, total, 1, rest, start)]
        got = mixing._taken(sized, [("s", total, Fraction(total), 1)], quotas, Mix()).collect()
        chosen = {(start + k) % total for k in range(rest)}
        for r in got:
            line = range(r["_begin"], r["_begin"] + r["_size"])
            assert r["_taken"] == r["_size"] + sum(w in chosen for w in line)


def test_documents_of_the_mix(spark, documents):
    data, mix = rows(), Mix(block_words=4, shard_words=500)
    frame = documents(data)
    got = mixing.mix_documents(frame, mix)
    assert got.columns == frame.columns
    copies = {}
    for r in got.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for r in mixing.mix_plan(frame, mix).collect():
        assert abs(copies.get(r.doc_id, 0) * r.size - r.taken) <= r.size / 2


def test_rows_without_an_id_spread_over_shards(spark, documents):
    frame = documents([(None if i % 3 else 5, f"w{i} " * 40, "a") for i in range(300)])
    sized = mixing._sized(frame, "doc_id")
    mix = Mix(block_words=4, shard_words=500)
    placed = mixing._with_sources(sized, mixing._sources(sized, mix), mix)
    counts = [r["count"] for r in placed.groupBy("_shard").count().collect()]
    assert len(counts) > 15 and max(counts) < 40


def test_nulls_repeats_and_empty(spark, documents):
    data = [(1, None, "a"), (None, "x y", "a"), (None, "x y", "a"), (2, "", None), (3, "z " * 50_000, None), (3, "z", None)]
    got = mixing.mix_plan(documents(data)).collect()
    assert len(got) == 6
    assert sorted(r.size for r in got) == [0, 0, 1, 2, 2, 50_000]
    assert mixing.mix_plan(documents([])).count() == 0
    assert mixing.mix_documents(documents([])).count() == 0
    assert mixing.mix_documents(documents([(1, None)])).count() == 0

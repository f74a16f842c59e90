import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import content_tree
from ledgerloom.operators.content_tree import Shape, differing_keys, differing_leaves, in_leaves, tree
from ledgerloom.storage import materialize

SHAPE = Shape(fanout=4, depth=3)
COLUMNS = "k string, g int, v int, `w.x` string"


def load(spark, rows, shape=SHAPE):
    stored = materialize(in_leaves(spark.createDataFrame(rows, COLUMNS).withColumnRenamed("w.x", "w"), ["k", "g"], shape), "load")
    return stored, materialize(tree(stored, shape), "tree")


def make(n, seed=1):
    chance = random.Random(seed)
    return [(chance.choice(["a", "b", None]), chance.choice([None, *range(200)]), chance.choice([None, 1, 2]), chance.choice([None, "x"])) for _ in range(n)]


def brute(first, second):
    keys = {r[:2] for r in first + second}
    found = set()
    for key in keys:
        one, two = (sorted((r[2:] for r in rows if r[:2] == key), key=repr) for rows in (first, second))
        if one != two:
            status = "only in first" if not two else "only in second" if not one else "changed"
            found.add((*key, status, len(one), len(two)))
    return found


def compare(spark, first, second):
    (one, one_tree), (two, two_tree) = load(spark, first), load(spark, second)
    leaves = differing_leaves(one_tree, two_tree, SHAPE)
    return leaves, {tuple(r) for r in differing_keys(one, two, ["k", "g"], leaves).collect()}


def test_differences_are_the_keys_that_differ(spark):
    first = make(500)
    second = first[20:] + make(5, seed=9) + [first[30]] + [(r[0], r[1], 7, r[3]) for r in first[:3]]
    random.Random(2).shuffle(second)
    leaves, found = compare(spark, first, second)
    assert found == brute(first, second) and len({row[2] for row in found}) >= 2
    assert 0 < len(leaves) < SHAPE.leaves


def test_equal_loads_in_any_order_read_no_row(spark):
    rows = make(300)
    leaves, found = compare(spark, rows, rows[::-1])
    assert leaves == [] and found == set()


def test_nulls_repeats_and_swapped_values_count(spark):
    base = make(50)
    for more in ([("a", 1, None, "x")], [("a", 1, 1, None)], [base[0]], [(None, None, None, None)]):
        assert compare(spark, base, base + more)[1] == brute(base, base + more)
    assert compare(spark, [("a", 1, 1, None)], [("a", 1, None, "1")])[1] == {("a", 1, "changed", 1, 1)}


def test_rows_read_follow_the_differences(spark):
    rows = [("a", i, 1, None) for i in range(20_000)]
    (one, one_tree), (two, two_tree) = load(spark, rows), load(spark, [*rows[:-1], ("a", 19_999, 2, None)])
    leaves = differing_leaves(one_tree, two_tree, SHAPE)
    assert len(leaves) == 1
    read = one.filter(F.col("_leaf").isin(leaves))
    assert read.count() < 20_000 / SHAPE.leaves * 1.5
    plan = differing_keys(one, two, ["k", "g"], leaves)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(_leaf), EqualTo(_leaf," in plan or "PushedFilters: [In(_leaf," in plan


def test_empty_loads_and_other_columns(spark):
    rows = make(30)
    assert compare(spark, [], []) == ([], set())
    assert compare(spark, rows, [])[1] == brute(rows, [])
    one, _ = load(spark, rows)
    with pytest.raises(ValueError):
        differing_keys(one, one.withColumnRenamed("v", "u"), ["k", "g"], [])


def test_the_tree_sums_its_leaves(spark):
    _, nodes = load(spark, make(200))
    by_level = {r.level: r for r in nodes.groupBy("level").agg(F.sum("n").alias("n"), F.sum("sum1").alias("s")).collect()}
    assert sorted(by_level) == [0, 1, 2, 3] and {r.n for r in by_level.values()} == {200}
    assert len({r.s for r in by_level.values()}) == 1
    assert content_tree.Shape().leaves == 4096

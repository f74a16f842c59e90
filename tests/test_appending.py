import random

from pyspark.sql import functions as F

from ledgerloom.operators.appending import last_number, number_more, rank_more


def loads(seed=1):
    chance = random.Random(seed)
    row = lambda: (chance.choice(["A", "B", None]), chance.choice([1, 2, None]), chance.randint(0, 9))
    return [[row() for _ in range(n)] for n in (40, 0, 25, 60)]


def appended(spark, batches, slice_rows=7):
    stored, after, seen = None, 0, []
    for rows in batches:
        frame = spark.createDataFrame(rows, "k string, g int, v int")
        numbered = number_more(frame, ["k", "v"], "id", after)
        ranked = rank_more(numbered, stored, ["k", "g"], "id", "rank", slice_rows)
        stored = ranked if stored is None else stored.unionByName(ranked)
        after = last_number(stored, "id")
        seen.append(sorted(map(tuple, stored.collect()), key=repr))
    return seen


def test_earlier_numbers_and_ranks_stay(spark):
    seen = appended(spark, loads())
    for before, after in zip(seen, seen[1:]):
        assert set(before) <= set(after)
    assert [len(rows) for rows in seen] == [40, 40, 65, 125]


def test_numbers_follow_the_loads_and_ranks_the_numbers(spark):
    batches = loads(2)
    last = appended(spark, batches)[-1]
    rows = sorted((r[0], r[1:]) for r in last)
    assert [number for number, _ in rows] == list(range(1, 126))
    order = lambda r: (r[0] is not None, r[0] or "", r[2], r[1] is not None, r[1] or 0)
    expected = [r for batch in batches for r in sorted(batch, key=order)]
    assert [r[:3] for _, r in rows] == expected
    seen = {}
    for _, (k, g, _v, rank) in rows:
        seen[k, g] = seen.get((k, g), 0) + 1
        assert rank == seen[k, g]


def test_an_empty_first_load(spark):
    seen = appended(spark, [[], [("A", 1, 1)]])
    assert seen == [[], [(1, "A", 1, 1, 1)]]


def test_last_number_of_an_empty_table(spark):
    assert last_number(spark.range(0), "id") == 0
    assert last_number(spark.range(5).filter(F.col("id") < 4), "id") == 3

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import whitening

COLUMNS = "vec_id long, embedding array<float>, n int, x string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "i") for i, v in rows], COLUMNS).withColumn("a.b", F.lit(1))


def usable(rows):
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in fine]
    d = max(set(lengths), key=lambda length: (lengths.count(length), length), default=0)
    return [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in fine if len(v) == d]


def exact(rows):
    """Fit list, sums and the integer scatter matrix in plain integers."""
    fit = sorted({x for _, x in rows})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    matrix = [[n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    return fit, sums, matrix


def determinant(matrix):
    a, out = [[Fraction(v) for v in row] for row in matrix], Fraction(1)
    for k in range(len(a)):
        pivot = next((i for i in range(k, len(a)) if a[i][k]), None)
        if pivot is None:
            return Fraction(0)
        if pivot != k:
            a[k], a[pivot], out = a[pivot], a[k], -out
        out *= a[k][k]
        for i in range(k + 1, len(a)):
            factor = a[i][k] / a[k][k]
            a[i] = [x - factor * y for x, y in zip(a[i], a[k])]
    return out


@pytest.fixture(scope="module")
def vectors():
    chance = np.random.default_rng(5)
    values = chance.normal(size=(300, 8)) @ np.diag([3, 2, 1.5, 1, 0.5, 0.5, 0.2, 0.1]) + 0.3
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(values)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(None, rows[1][1]), (7, rows[2][1])]
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None), (2001, []), (2002, [nan] * 8), (2003, [inf] + [0.0] * 7), (2004, [None] + [1.0] * 7), (2005, [1.0] * 3)]
    return rows + [(2006, [-0.0] * 8), (2007, [0.0] * 8)]


def test_equals_a_plain_eigendecomposition(spark, vectors):
    kept = usable(vectors)
    fit, sums, matrix = exact(kept)
    n, d = len(fit), len(sums)
    values, columns = np.linalg.eigh(np.array(matrix, np.float64))
    got = whitening.whiten(frame(spark, vectors)).collect()
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n}
    assert sorted((str(r.vec_id), int(r.deviation)) for r in got if r.component == 1) == sorted(
        (str(i), sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept
    )
    for k in range(4):
        column = columns[:, d - 1 - k]
        column = column * np.sign(column[np.argmax(np.abs(column))])
        scale = math.sqrt(values[d - 1 - k]) / n
        expected = sorted(float((np.array(x) - np.array(sums) / n) @ column / scale) for _, x in kept)
        mine = sorted(r.whitened for r in got if r.component == k + 1)
        assert np.allclose(mine, expected, rtol=0, atol=1e-9)
        shares = {r.explained for r in got if r.component == k + 1}
        assert len(shares) == 1 and math.isclose(shares.pop(), values[d - 1 - k] / values.sum(), rel_tol=1e-12)
    assert {r.identity_error < 1e-9 for r in got} == {True}
    assert len({r.identity_error for r in got}) == 1


def test_partitions_change_nothing_that_is_exact(spark, vectors):
    pick = ("vec_id", "component", "n", "deviation")
    a = whitening.whiten(frame(spark, vectors)).select(*pick).collect()
    b = whitening.whiten(frame(spark, vectors[::-1]).repartition(9)).select(*pick).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_scatter_is_exact_for_large_entries(spark):
    rows = [(i, [float(2.0**k * (i % 5 - 2)) for k in (0, 30, 54, 60)]) for i in range(20)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    fit = whitening.integer_vectors(wide).select("x").distinct().collect()
    n, sums, products = whitening.scatter(spark.createDataFrame(fit))
    top, bottom = 2**63 - 1, -(2**63)
    x = [[max(bottom, min(top, int(256 * 2.0**k * m))) for k in (0, 30, 54, 60)] for m in range(-2, 3)]
    assert n == 5 and sums == [sum(c) for c in zip(*x)]
    assert products == [[sum(r[i] * r[j] for r in x) for j in range(4)] for i in range(4)]
    found = whitening.whiten(wide, k=1).collect()
    assert len(found) == 20 and all(r.deviation is None or r.deviation > 0 for r in found if r.vec_id % 5 != 2)


def test_polynomial_by_determinants(spark):
    chance = np.random.default_rng(2)
    for rank in (2, 5):
        x = chance.integers(-9, 9, (rank, 6)).astype(object)
        matrix = (x.T @ x).tolist()
        polynomial = whitening.characteristic_polynomial(spark, matrix)
        for t in range(-3, 4):
            less = [[(t if i == j else 0) - v for j, v in enumerate(row)] for i, row in enumerate(matrix)]
            assert sum(c * t**i for i, c in enumerate(polynomial)) == determinant(less)
        assert whitening.roots_above(polynomial, 0, 0) == min(rank, 6)


def test_roots_and_components_of_repeated_and_close_roots():
    chance = np.random.default_rng(4)
    turn = np.linalg.qr(chance.integers(-3, 4, (5, 5)))[0]
    assert turn.shape == (5, 5)
    # (t - 9)^3 (t - 5) t, and two roots that differ by one in 10^40.
    matrix = [[v if i == j else 0 for j in range(5)] for i, v in enumerate([9, 5, 9, 0, 9])]
    polynomial = [0, 0, 0, 0, 0, 1]
    polynomial = np.poly([9, 9, 9, 5, 0]).round().astype(int)[::-1].tolist()
    roots = whitening.largest_roots(polynomial, 5)
    assert [c for _, c in roots] == [0, 0, 0, 1] and [round(float(r), 12) for r, _ in roots] == [9, 9, 9, 5]
    basis = np.array(whitening.components(matrix, roots))
    assert np.allclose(basis @ basis.T, np.eye(4), atol=1e-14)
    assert np.allclose(np.abs(basis[3]), [0, 1, 0, 0, 0], atol=1e-14)
    big = 10**40
    close = [big * (big + 1), -(2 * big + 1), 1]
    assert [c for _, c in whitening.largest_roots(close, 2)] == [0, 1]
    pair = whitening.components([[big, 0], [0, big + 1]], whitening.largest_roots(close, 2))
    assert np.allclose(np.abs(pair), [[0, 1], [1, 0]], atol=1e-15)


def test_equal_eigenvalues_through_the_frame(spark):
    rows = [(i, [s * 0.5 if k == i // 2 else 0.0 for k in range(3)]) for i in range(6) for s in [1 - 2 * (i % 2)]]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 18 and all(abs(r.explained - 1 / 3) < 1e-15 and r.identity_error < 1e-12 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0])], [(1, [0.5, 1.0])] * 3])
def test_no_variance_gives_no_rows(spark, rows):
    found = whitening.whiten(frame(spark, rows))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_rank_limits_the_components(spark):
    got = whitening.whiten(frame(spark, [(i, [i / 256, 2 * i / 256, 0.5]) for i in range(10)])).collect()
    assert {r.component for r in got} == {1} and {r.explained for r in got} == {1.0}
    assert sorted(round(r.whitened, 9) for r in got) == sorted(round((i - 4.5) / math.sqrt(8.25), 9) for i in range(10))


def test_primes_and_remainders():
    assert [n for n in range(60) if whitening.is_prime(n)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]
    primes = whitening.primes_for(10**30)
    assert math.prod(primes) > 2 * 10**30
    values = [0, 1, -1, 10**30, -(10**30)]
    assert whitening.remaindered([(p, [v % p for v in values]) for p in primes]) == values
    for value in (0, 5, -5, 2**60, -(2**60), 2**200 + 3, -(2**200) - 3):
        assert sum(digit << (60 * place) for place, digit in whitening._limbs(value)) == value

"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

Each entry c becomes the integer x = floor(256 c). Over the distinct integer vectors, the fit list, tasks sum x and the
products x x' exactly; n times the products less the sums' products is an integer matrix, n squared times the covariance.

- Its characteristic polynomial: tasks reduce the matrix to Hessenberg form modulo one prime each and read the
  polynomial off it; Chinese remaindering of the residues gives the integer coefficients, enough primes being taken for
  the bound that the trace sets on them.
- Its largest roots: all roots are real, so the sign changes of the coefficients after a shift count the roots above a
  point exactly, repeated ones included. Halving intervals isolates each wanted root to `ROOT_BITS` bits. The same count
  at zero is the rank.
- Its components: the null space of the matrix less a root, by inverse iteration in fixed-point integers. A root is known
  far better than its distance to the next; roots that agree in nearly `CLUSTER_BITS` bits share a space, and get an
  orthonormal basis of it.

A component's sign makes its entry of largest size positive. Whitened values are the centred integers, projected, over
the root of the eigenvalue.

Only numbers of dimensions leave the tasks: sums of x and of its products, one polynomial a prime. Every table is read in
blocks; the fit list is combined before its shuffle, so copies of a vector meet as one row a task.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are vectors
of another length than most have (of equal lengths the longer). Entries whose integer passes 64 bits take the largest or
smallest one. Components are those with an eigenvalue above zero, so fewer than asked for where the rank is lower, and
none for a single vector or an empty table: no rows. Null or repeated ids stay as they are, equal vectors get equal rows,
other columns are not read.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.storage import materialize

# Parameters: steps of one in an entry; components; bits to which a root is known at first, and at most; bits by which the
# gap between two roots passes what is not known of them.
SCALE = 256
COMPONENTS = 4
ROOT_BITS, CLUSTER_BITS, GAP_BITS = 110, 400, 64

_LIMB = 60
_EXACT = 1 << 53


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """`id` and `x`, the integer vector, of usable rows of the commonest length."""
    entries = vectors[vector_column].cast("array<double>")
    narrow = vectors.select(vectors[id_column].alias("id"), entries.alias("c")).filter("size(c) > 0")
    finite = narrow.filter(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    lengths = finite.groupBy(F.size("c").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    whole = finite.filter(F.size("c") == (common[0].d if common else 0))
    return whole.select("id", F.transform("c", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as the rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max())))


def exact_products(x: np.ndarray) -> np.ndarray:
    """x'x in Python integers: sums that doubles hold exactly are taken as matrix products of doubles."""
    most = _largest(x)
    rows = (_EXACT - 1) // max(most * most, 1)
    if rows == 0:
        wide = x.astype(object)
        return wide.T @ wide
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for start in range(0, len(x), rows):
        part = x[start : start + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _limbs(value: int) -> list[tuple[int, int]]:
    """The value as digits of base 2**60, the last one with the sign."""
    digits, place = [], 0
    while not -(1 << _LIMB) < value < 1 << _LIMB:
        value, digit = divmod(value, 1 << _LIMB)
        digits.append((place, digit))
        place += 1
    return [*digits, (place, value)]


def scatter(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """The number of vectors, their sums, and the sums of their products, over a stored fit list."""

    def run(batches):
        count, sums, products = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                count += len(x)
                sums = sums + x.astype(object).sum(axis=0)
                products = products + exact_products(x)
        if count:
            d = len(sums)
            cells = [(-1, -1, count)] + [(i, -1, sums[i]) for i in range(d)]
            cells += [(i, j, products[i, j]) for i in range(d) for j in range(i + 1)]
            rows = [(i, j, place, digit) for i, j, value in cells for place, digit in _limbs(int(value)) if digit]
            columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "place", "digit"])

    parts = fit.select("x").mapInArrow(run, "i long, j long, place long, digit long")
    total = F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")
    cells: dict[tuple[int, int], int] = {}
    for row in parts.groupBy("i", "j", "place").agg(total).collect():
        cells[row.i, row.j] = cells.get((row.i, row.j), 0) + (int(row.digit) << (_LIMB * row.place))
    n = cells.get((-1, -1), 0)
    d = len(fit.select("x").first().x) if n else 0
    sums = [cells.get((i, -1), 0) for i in range(d)]
    return n, sums, [[cells.get((max(i, j), min(i, j)), 0) for j in range(d)] for i in range(d)]


def centred(n: int, sums: list[int], products: list[list[int]]) -> list[list[int]]:
    """n times the products less the products of the sums: n squared times the covariance."""
    d = len(sums)
    return [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo a prime below 2**31, constant first, through Hessenberg form."""
    a = np.array([[value % p for value in row] for row in matrix], np.int64)
    d = len(a)
    for k in range(1, d - 1):
        rows = np.nonzero(a[k:, k - 1])[0]
        if len(rows) == 0:
            continue
        pivot = k + int(rows[0])
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            a[:, [k, pivot]] = a[:, [pivot, k]]
        factors = a[k + 1 :, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1 :] = (a[k + 1 :] - factors[:, None] * a[k] % p) % p
        a[:, k] = (a[:, k] + (a[:, k + 1 :] * factors % p).sum(axis=1)) % p
    # The polynomial of each leading block from those of the smaller ones.
    leading = np.zeros((d + 1, d + 1), np.int64)
    leading[0, 0] = 1
    for k in range(1, d + 1):
        now = -a[k - 1, k - 1] * leading[k - 1] % p
        now[1:] += leading[k - 1, :-1]
        below, weights = 1, []
        for i in range(k - 1, 0, -1):
            below = below * int(a[i, i - 1]) % p
            weights.append(below * int(a[i - 1, k - 1]) % p)
        if weights:
            now -= (np.array(weights)[:, None] * leading[k - 2 :: -1] % p).sum(axis=0)
        leading[k] = now % p
    return leading[d].tolist()


def is_prime(n: int) -> bool:
    """By Miller and Rabin; these bases decide every n below 3.2 billion."""
    if n < 3 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        if n == base:
            return True
        power = pow(base, odd, n)
        if power not in (1, n - 1) and not any((power := power * power % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2**31 whose product passes twice the bound."""
    primes, product, candidate = [], 1, (1 << 31) - 1
    while product <= 2 * bound:
        if is_prime(candidate):
            primes.append(candidate)
            product *= candidate
        candidate -= 2
    return primes


def coefficient_bound(d: int, trace: int) -> int:
    """No coefficient is larger: with no root below zero, each is at most what equal roots would give."""
    return max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Integers from their residues modulo primes, each the one nearest to zero."""
    product = math.prod(p for p, _ in residues)
    weights = [(product // p) * pow(product // p, -1, p) for p, _ in residues]
    out = []
    for i in range(len(residues[0][1])):
        value = sum(w * found[i] for w, (_, found) in zip(weights, residues)) % product
        out.append(value - product if 2 * value > product else value)
    return out


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix), constant first, for a matrix without negative eigenvalues; a task takes some
    primes."""
    d = len(matrix)
    primes = primes_for(coefficient_bound(d, sum(matrix[i][i] for i in range(d))))

    def run(batches):
        for batch in batches:
            mine = [primes[i] for i in batch.column(0).to_pylist()]
            found = [polynomial_modulo(matrix, p) for p in mine]
            columns = [pa.array(mine, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["p", "residues"])

    tasks = min(len(primes), max(1, 4 * spark.sparkContext.defaultParallelism))
    residues = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "p long, residues array<long>").collect()
    return remaindered([(row.p, list(row.residues)) for row in residues])


def roots_above(polynomial: list[int], point: int, scale: int) -> int:
    """Roots above point / 2**scale, repeated ones counted as often, of a polynomial with real roots only."""
    d = len(polynomial) - 1
    shifted = [c << (scale * (d - i)) for i, c in enumerate(polynomial)]
    for start in range(d):
        for i in range(d - 1, start - 1, -1):
            shifted[i] += point * shifted[i + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def isolate(polynomial: list[int], rank: int, bits: int) -> tuple[int, int, int]:
    """(low, high, scale): the `rank`-th largest root, above zero, lies in (low, high] / 2**scale, known to `bits` bits."""
    low, high, scale = 0, -polynomial[-2], 0
    while not (low and (high - low) << bits <= low):
        if high - low < 2:
            low, high, scale = low << 16, high << 16, scale + 16
        middle = (low + high) // 2
        if roots_above(polynomial, middle, scale) >= rank:
            low = middle
        else:
            high = middle
    return low, high, scale


def _clear(above: tuple[int, int, int], below: tuple[int, int, int]) -> bool:
    """Whether the gap between two isolated roots is far wider than what is not known of them."""
    scale = max(above[2], below[2])
    (low, high), (least, most) = (tuple(end << (scale - s) for end in (a, b)) for a, b, s in (above, below))
    return low - most >= max(high - low, most - least) << GAP_BITS


def largest_roots(polynomial: list[int], k: int) -> list[tuple[Fraction, int]]:
    """The `k` largest roots above zero, each with the number of its cluster; roots that agree share one.

    The next root is isolated too, since the last component must stay clear of it.
    """
    found = [isolate(polynomial, j, ROOT_BITS) for j in range(1, min(k + 1, roots_above(polynomial, 0, 0)) + 1)]
    clusters = [0] * len(found)
    for j in range(1, len(found)):
        if not _clear(found[j - 1], found[j]):
            # Closer than that, they are looked at again with more bits.
            found[j - 1 : j + 1] = [isolate(polynomial, i + 1, CLUSTER_BITS) for i in (j - 1, j)]
        clusters[j] = clusters[j - 1] + _clear(found[j - 1], found[j])
    roots = [(Fraction(low + high, 1 << (scale + 1)), c) for (low, high, scale), c in zip(found, clusters)]
    return roots[:k]


class FixedPoint:
    """Elimination of a matrix less a root, in integers that are multiples of 2**-bits."""

    def __init__(self, matrix: list[list[int]], root: Fraction, bits: int) -> None:
        d = len(matrix)
        shift = (root.numerator << bits) // root.denominator
        a = [[(value << bits) - (shift if i == j else 0) for j, value in enumerate(row)] for i, row in enumerate(matrix)]
        self.a, self.bits, self.order = a, bits, list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[pivot] = a[pivot], a[k]
            self.order[k], self.order[pivot] = self.order[pivot], self.order[k]
            # The matrix is singular but for the error of the root: a vanished pivot is taken as the least number.
            a[k][k] = a[k][k] or 1
            head = a[k]
            for i in range(k + 1, d):
                if a[i][k]:
                    factor = (a[i][k] << bits) // head[k]
                    row = a[i]
                    row[k] = factor
                    for j in range(k + 1, d):
                        row[j] -= factor * head[j] >> bits

    def solve(self, b: list[int]) -> list[int]:
        d, bits = len(b), self.bits
        y = [b[i] for i in self.order]
        for i in range(d):
            y[i] -= sum(self.a[i][j] * y[j] for j in range(i)) >> bits
        for i in range(d - 1, -1, -1):
            rest = y[i] - (sum(self.a[i][j] * y[j] for j in range(i + 1, d)) >> bits)
            y[i] = (rest << bits) // self.a[i][i]
        return y


def _unit(y: list[int], others: list[list[int]], bits: int) -> list[int]:
    """The vector less its parts along the others, with length 2**bits."""
    size = max(map(abs, y)) or 1
    y = [(value << bits) // size for value in y]
    for _ in range(2):
        for v in others:
            along = sum(a * b for a, b in zip(y, v)) >> bits
            y = [a - (along * b >> bits) for a, b in zip(y, v)]
    length = math.isqrt(sum(value * value for value in y)) or 1
    return [(value << bits) // length for value in y]


def components(matrix: list[list[int]], roots: list[tuple[Fraction, int]]) -> list[list[float]]:
    """A unit vector for each root: inverse iteration from fixed starts, at right angles to those before it."""
    d, found, solver = len(matrix), [], None
    bits = 3 * CLUSTER_BITS
    for j, (root, cluster) in enumerate(roots):
        if solver is None or cluster != roots[j - 1][1]:
            solver = FixedPoint(matrix, root, bits)
        # Starts that no eigenvector is likely to be at right angles to, different for each component.
        y = [((i + 2) * (j + 3) * 0x9E3779B97F4A7C15 >> 7) % (1 << 20) - (1 << 19) for i in range(d)]
        y = _unit([value << 40 for value in y], found, bits)
        for _ in range(3):
            y = _unit(solver.solve(y), found, bits)
        found.append(y)
    out = []
    for y in found:
        largest = max(range(d), key=lambda i: (abs(y[i]), -i))
        sign = -1 if y[largest] < 0 else 1
        out.append([float(Fraction(sign * value, 1 << bits)) for value in y])
    return out


class Whitener:
    """The fitted numbers, of the size of the dimensions: count, sums, components, scales."""

    def __init__(self, n: int, sums: list[int], roots: list[Fraction], vectors: list[list[float]]) -> None:
        self.n, self.sums = n, sums
        self.vectors = np.array(vectors, np.float64).reshape(len(roots), len(sums))
        # Centred integers are n times the values, roots n squared times the variances: the root of a root is what is left.
        self.scales = np.array([_root_of(root) for root in roots])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, in 64 bits where they hold its squares' sum, else in Python integers."""
        most = _largest(x) * self.n + max(map(abs, self.sums))
        wide = x if most * most * x.shape[1] < 1 << 63 else x.astype(object)
        return wide * self.n - np.array(self.sums, wide.dtype)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return deviations.astype(np.float64) @ self.vectors.T / self.scales


def _root_of(value: Fraction) -> float:
    """The square root, to double precision."""
    return float(Fraction(math.isqrt((value.numerator << 256) // value.denominator), 1 << 128))


def fitted(fit: DataFrame, k: int = COMPONENTS) -> tuple[Whitener, list[float]]:
    """The whitener of a stored fit list, and the explained share of each component."""
    n, sums, products = scatter(fit)
    matrix = centred(n, sums, products)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if trace == 0:
        return Whitener(n, sums, [], []), []
    roots = largest_roots(characteristic_polynomial(fit.sparkSession, matrix), k)
    values = [root for root, _ in roots]
    return Whitener(n, sums, values, components(matrix, roots)), [float(value / trace) for value in values]


def identity_error(fit: DataFrame, whitener: Whitener) -> float:
    """The largest entry by which the covariance of the whitened fit list differs from the identity."""
    k = len(whitener.scales)

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = whitener.whitened(whitener.centred(_matrix(batch.column(0))))
                total += w.T @ w
        cells = [(i, j, total[i, j]) for i in range(k) for j in range(k)]
        kinds = (pa.int32(), pa.int32(), pa.float64())
        columns = [pa.array(column, kind) for column, kind in zip(zip(*cells), kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "s"])

    cells = fit.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return max(abs(row.s / whitener.n - (row.i == row.j)) for row in cells.collect())


def whiten(
    vectors: DataFrame, k: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """For every usable row and component: `id_column`, `component` (from 1), `n`, `deviation` (decimal, the sum of the
    squared entries of n x - S; null beyond 38 digits), `whitened`, `explained` and `identity_error`."""
    rows = integer_vectors(vectors, id_column, vector_column)
    fit = materialize(rows.select("x").distinct(), "fit")
    whitener, explained = fitted(fit, k)
    found = len(explained)
    out = T.StructType(
        [
            T.StructField(id_column, rows.schema["id"].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if found == 0:
        return rows.sparkSession.createDataFrame([], out)
    error = identity_error(fit, whitener)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            centred_rows = whitener.centred(_matrix(batch.column(1)))
            squares = (centred_rows * centred_rows).sum(axis=1)
            if squares.dtype == object:
                squares = [value if value < 10**38 else None for value in squares]
            times = np.repeat(np.arange(batch.num_rows), found)
            size = len(times)
            columns = [
                batch.column(0).take(pa.array(times)),
                pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(size, whitener.n, np.int64)),
                _decimals(squares).take(pa.array(times)),
                pa.array(whitener.whitened(centred_rows).reshape(-1)),
                pa.array(np.tile(np.array(explained), batch.num_rows)),
                pa.array(np.full(size, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, out.names)

    return rows.mapInArrow(run, out)


def _decimals(values) -> pa.Array:
    kind = pa.decimal128(38, 0)
    if isinstance(values, np.ndarray):
        return pa.array(values).cast(kind)
    from decimal import Decimal

    return pa.array([None if value is None else Decimal(int(value)) for value in values], kind)

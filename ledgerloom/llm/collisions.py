"""Embedding near duplicates by counting collisions on sorted one-dimensional projections.

Unit vectors are projected on random lines. On a line two vectors collide when one lies in the window around the
other; windows in the crowded middle say nothing about a pair, so only those beyond `tail` are opened, where about
`crowd` vectors remain. A pair at the cosine limit collides on a line with a known probability; the number of lines
is the smallest for which such a pair reaches `least` collisions with probability `recall`. Pairs that reach it are
verified by their cosine in double precision, so no pair below the limit is linked.

Equal vectors are merged first. A crowd of near copies would collide in all its pairs; so on a line that holds many
more vectors than expected, leaders are taken from its dense stretches, in a scattered order of the ids, and every
vector near them in place and within 1.5 times the limit's angle joins the cell of one. This is repeated for the vectors left
over, until no line is crowded or nothing joins. Those of a cell within half the angle of its leader form a ball: by
the triangle inequality all of a ball is linked, which is counted and not compared. All other pairs within a cell, and
those of cells that the angles do not keep apart, are compared as blocks of a matrix product spread over tasks, which
send sums and a spanning forest but no pairs. Lines count only pairs with at least one vector outside the cells.

Defined results: vectors that are null or zero, hold null or non-finite components, or have no id link with nothing;
vectors of different lengths do not link. Rows may repeat; each is a vector of its own. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.storage import materialize

LINES_AT_ONCE = 512
PAIRS_AT_ONCE = 1_000_000
# Measured: two microseconds against an eighth of a nanosecond.
COLLISION_COST = 15_000
# Vectors on a line from which a crowd of near copies is looked for, as a multiple of the expected ones and at least.
LEAST_CROWD = 24.0
# Width of the bins in which a line's dense stretches are looked for.
BIN = 0.3
# A cell of m vectors to compare is cut in the square root of m / CUT parts; a product takes so many rows at once.
CUT = 64
STRIP = 512
ROUNDS = 10


@dataclass(frozen=True)
class Search:
    cosine: float = 0.9
    recall: float = 0.999
    least: int = 2
    window: float = 0.7
    seed: int = 5
    slab_rows: int = 50_000
    hot: int = 8


def _collision_rate(cosine: float, tail: float, window: float) -> float:
    """Probability that a pair at `cosine` collides on a line: both beyond the tail on one side, within a window."""
    s = math.sqrt(1 - cosine**2)
    x = np.linspace(tail, tail + 6, 4001)
    below = np.array([_phi((v + window - cosine * v) / s) for v in x])
    above = np.array([_phi((max(tail, v - window) - cosine * v) / s) for v in x])
    density = np.exp(-(x**2) / 2) / math.sqrt(2 * math.pi)
    return float(2 * np.sum(density * (below - above)) * (x[1] - x[0]))


def _phi(x: float) -> float:
    return (1 + math.erf(x / math.sqrt(2))) / 2


def calibrate(n: int, dimensions: int, search: Search) -> tuple[float, int, float]:
    """Where the tail begins, the number of lines, and the vectors expected in a tail.

    Larger tails cost collisions, smaller ones more lines: their size balances both, and work grows as n to 1.5. A
    collision, which is shuffled and counted, costs as much as some `COLLISION_COST` products of a projection.
    """
    crowd = max(8.0, math.sqrt(n * dimensions / COLLISION_COST))
    share = min(0.02, crowd / max(n, 1))
    tail = NormalDist().inv_cdf(1 - share)
    rate = _collision_rate(search.cosine, tail, search.window)

    def missed(lines: int) -> float:
        return sum(math.comb(lines, k) * rate**k * (1 - rate) ** (lines - k) for k in range(search.least))

    low, high = search.least, search.least
    while missed(high) > 1 - search.recall:
        low, high = high, 2 * high
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if missed(middle) > 1 - search.recall else (low, middle)
    return tail, high, share * n


def _units(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `unit` (null for vectors that link with nothing)."""
    raw = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(vectors["vec_id"], vectors["embedding"]).select("vec_id", raw.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    norm = F.when((square > 0) & (square < F.lit(float("inf"))), F.sqrt(square))
    return rows.withColumn("norm", norm).select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.transform("v", lambda x: x / F.col("norm"))).alias("unit"), "norm"
    ).select("vec_id", F.when(F.col("norm").isNotNull(), F.col("unit")).alias("unit"))


def _lines(block: int, dimensions: int, lines: int, seed: int) -> np.ndarray:
    """The block's directions, one a column; the same in every task."""
    size = min(LINES_AT_ONCE, lines - block * LINES_AT_ONCE)
    return np.random.default_rng([seed, dimensions, block]).standard_normal((dimensions, size)).astype(np.float32)


def _tails(reps: DataFrame, tail: float, lines: int, slabs: int, seed: int) -> DataFrame:
    """Where each vector lies beyond a tail: `slab`, `line` (odd for the lower side), `place` and `rep`."""

    def run(batches):
        for batch in batches:
            ids = batch.column("rep").to_numpy(zero_copy_only=False)
            units = batch.column("unit")
            sizes = np.diff(units.offsets.to_numpy())
            flat = units.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for d in np.unique(sizes).tolist():
                who = np.flatnonzero(sizes == d)
                matrix = flat[starts[who][:, None] + np.arange(d)]
                for block in range(math.ceil(lines / LINES_AT_ONCE)):
                    places = matrix @ _lines(block, d, lines, seed)
                    rows, columns = np.nonzero(np.abs(places) >= tail)
                    value = places[rows, columns].astype(float)
                    line = ((block * LINES_AT_ONCE + columns) * 2 + (value < 0)).astype(np.int64) + 2 * lines * d
                    found = [(line // 2 % slabs).astype(np.int32), line, np.abs(value), ids[who[rows]]]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in found], ["slab", "line", "place", "rep"])

    return reps.select("rep", "unit").mapInArrow(run, "slab int, line long, place double, rep long")


def _each_line(table: pa.Table, *names: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of one line at a time, sorted by place."""
    line, place = (table.column(n).to_numpy() for n in ("line", "place"))
    columns = [table.column(n).to_numpy() for n in names]
    order = np.lexsort((place, line))
    line, place, columns = line[order], place[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else []
    for a, b in zip(starts, [*starts[1:], len(line)]):
        yield (place[a:b], *(c[a:b] for c in columns))


def _windows(query: np.ndarray, other: np.ndarray, window: float, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of query and other, both sorted, for all pairs within a window; with `own`, each pair once."""
    low = np.searchsorted(other, query - window, "left")
    high = np.searchsorted(other, query + window, "right")
    if own:
        low = np.arange(len(query)) + 1
    sizes = np.maximum(high - low, 0)
    first = np.repeat(np.arange(len(query)), sizes)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return first, np.repeat(low, sizes) + inside


def _line_pairs(place, rep, inside, window: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Colliding pairs of one line without those inside the cells."""
    rest = ~inside
    a, b = _windows(place[rest], place[rest], window, True)
    yield rep[rest][a], rep[rest][b]
    a, b = _windows(place[rest], place[inside], window, False)
    yield rep[rest][a], rep[inside][b]


def _collisions(tails: DataFrame, window: float) -> DataFrame:
    """`u`, `v` and `n`, collisions of each pair within one slab."""

    def counted(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        rows = rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        sums = np.add.reduceat(rows[:, 2], np.flatnonzero(new)) if len(rows) else np.zeros(0, np.int64)
        return np.column_stack([rows[new, :2], sums])

    def run(table: pa.Table) -> pa.Table:
        kept, waiting, size = [], [], 0
        for place, rep, inside in _each_line(table, "rep", "inside"):
            for a, b in _line_pairs(place, rep, inside, window):
                low, high = np.minimum(a, b), np.maximum(a, b)
                waiting.append(np.column_stack([low, high, np.ones(len(a), np.int64)]))
                size += len(a)
            if size > PAIRS_AT_ONCE:
                kept, waiting, size = [*kept, counted(waiting)], [], 0
        rows = counted([*kept, *waiting])
        return pa.table({"u": rows[:, 0], "v": rows[:, 1], "n": rows[:, 2]})

    return tails.groupBy("slab").applyInArrow(run, "u long, v long, n long")


def _scattered(ids: np.ndarray) -> np.ndarray:
    """The ids in an order of their own, the same on every line."""
    x = ids.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _leaders(tails: DataFrame, hot: float, window: float) -> DataFrame:
    """`u`, a vector on a crowded line, and `v`, one of two leaders of each dense stretch within a window of it."""

    def run(table: pa.Table) -> pa.Table:
        found = [np.zeros((0, 2), np.int64)]
        for place, rep in _each_line(table, "rep"):
            if len(rep) <= hot:
                continue
            bins, starts, sizes = np.unique(np.floor(place / BIN), return_index=True, return_counts=True)
            dense = np.flatnonzero(sizes >= min(sizes.mean(), hot / 8))
            for stretch in np.split(dense, np.flatnonzero(np.diff(bins[dense]) > 1) + 1):
                first, end = starts[stretch[0]], starts[stretch[-1]] + sizes[stretch[-1]]
                for leader in first + np.argsort(_scattered(rep[first:end]))[:2]:
                    near = rep[np.abs(place - place[leader]) <= window]
                    found.append(np.column_stack([near, np.full(len(near), rep[leader])]))
        rows = np.unique(np.concatenate(found), axis=0)
        return pa.table({"u": rows[:, 0], "v": rows[:, 1]})

    return tails.groupBy("slab").applyInArrow(run, "u long, v long").distinct()


def _cells(tails: DataFrame, reps: DataFrame, hot: float, search: Search) -> DataFrame:
    """`rep`, its `cell` (the leader), the `cosine` to it and its `kind`: 2 within half the angle, 1 within it, or 0."""
    spark = reps.sparkSession
    half, far = (math.cos(math.acos(search.cosine) * share) for share in (0.5, 1.5))
    cosine = F.col("cosine")
    kind = (cosine >= search.cosine).cast("int") + (cosine >= half + 1e-9).cast("int")
    members = spark.createDataFrame([], "rep long, cell long, cosine double, kind int")
    for _ in range(ROUNDS):
        outside = tails.join(members, "rep", "left_anti")
        offers = materialize(_leaders(outside, hot, search.window), "offers")
        if offers.isEmpty():
            break
        near = materialize(_verified(offers, reps, far).withColumn("kind", kind), "near")
        weight = near.groupBy("v").agg(F.sum("kind").alias("weight"), F.count("u").alias("size"))
        best = F.max(F.struct("kind", "weight", "v", "cosine")).alias("best")
        chosen = near.join(weight.filter(F.col("size") >= hot / 2), "v").groupBy("u").agg(best)
        joined = materialize(
            chosen.select(F.col("u").alias("rep"), F.col("best.v").alias("cell"), "best.cosine", "best.kind"), "joined"
        )
        if joined.isEmpty():
            break
        members = materialize(members.unionByName(joined), "cells")
    return members


def _compared(members: DataFrame, reps: DataFrame, search: Search) -> DataFrame:
    """`rep`, `other`, `n`: copies linked to a vector in one block (`other` null), or an edge of the block's forest.

    The blocks hold all pairs of the cells but those inside a ball and those of cells too far apart to link.
    """
    angle = math.acos(search.cosine)
    wide = F.acos(F.least(F.lit(1.0), F.min("cosine"))).alias("wide")
    sizes = members.groupBy("cell", "kind").agg(F.ceil(F.sqrt(F.count("rep") / CUT)).alias("parts"), wide)
    kinds = materialize(sizes.join(reps.select(F.col("rep").alias("cell"), "unit"), "cell"), "kinds")

    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(*[F.col(c).alias(f"{c}_{name}") for c in frame.columns])

    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot("unit_a", "unit_b"))))
    close = (F.size("unit_a") == F.size("unit_b")) & (apart <= F.col("wide_a") + F.col("wide_b") + angle + 1e-6)
    ordered = F.struct("cell_a", "kind_a") <= F.struct("cell_b", "kind_b")
    ball = (F.col("cell_a") == F.col("cell_b")) & (F.col("kind_a") == 2) & (F.col("kind_b") == 2)
    touching = side(kinds, "a").join(side(kinds, "b"), ordered & ~ball & close)

    def parts(name: str) -> Column:
        return F.explode(F.expr(f"sequence(0, int(parts_{name}) - 1)")).alias(f"part_{name}")

    pairs = touching.drop("unit_a", "unit_b").select("*", parts("a")).select("*", parts("b"))
    same = (F.col("cell_a") == F.col("cell_b")) & (F.col("kind_a") == F.col("kind_b"))
    pairs = pairs.filter(~same | (F.col("part_a") <= F.col("part_b")))
    block = F.struct(*[f"{c}_{n}" for n in "ab" for c in ("cell", "kind", "part")])
    ends = F.array(*[F.struct(*[F.col(f"{c}_{n}").alias(c) for c in ("cell", "kind", "part")]) for n in "ab"])
    told = materialize(pairs.select(F.xxhash64(block).alias("block"), ends.alias("ends")), "blocks")
    sent = told.select("block", F.posexplode("ends").alias("side", "end")).select("block", "side", "end.*")
    place = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part")
    members = members.join(kinds.select("cell", "kind", "parts"), ["cell", "kind"])
    rows = members.join(reps, "rep").select("cell", "kind", place, "rep", "unit", "copies")
    dealt = sent.join(rows, ["cell", "kind", "part"]).select("block", "side", "rep", "unit", "copies")
    return dealt.groupBy("block").applyInArrow(
        lambda table: _block(table, search.cosine), "rep long, other long, n long"
    )


def _block(table: pa.Table, cosine: float) -> pa.Table:
    """Links between the two sides of a block, which are the same rows where a part meets itself."""
    units = table.column("unit").combine_chunks()
    matrix = units.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)
    side, rep, copies = (table.column(c).to_numpy() for c in ("side", "rep", "copies"))
    a, b = (np.flatnonzero(side == n) for n in (0, 1))
    a, b = a[np.argsort(rep[a])], b[np.argsort(rep[b])]
    own = len(a) == len(b) and bool((rep[a] == rep[b]).all())
    link, weights = np.zeros((len(a), len(b)), bool), copies.astype(float)
    linked_a, linked_b = np.zeros(len(a)), np.zeros(len(b))
    for low in range(0, len(a), STRIP):
        strip = a[low : low + STRIP]
        near = matrix[strip] @ matrix[b].T >= cosine
        if own:
            near[np.arange(len(strip)), low + np.arange(len(strip))] = False
        link[low : low + STRIP] = near
        linked_a[low : low + STRIP] = near @ weights[b]
        linked_b += weights[strip] @ near
    found = [(rep[a], linked_a)] if own else [(rep[a], linked_a), (rep[b], linked_b)]
    who, sums = (np.concatenate(c) for c in zip(*found))
    nodes, roots = _forest(link)
    names = np.concatenate([rep[a], rep[b]])
    linked = sums > 0
    n = np.concatenate([sums[linked].astype(np.int64), np.zeros(len(nodes), np.int64)])
    other = pa.array(np.concatenate([np.zeros(linked.sum(), np.int64), names[roots]]), mask=np.arange(len(n)) < linked.sum())
    return pa.table({"rep": np.concatenate([who[linked], names[nodes]]), "other": other, "n": n})


def _forest(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row and column (counted on) with a link, a row that it is connected to."""
    rows, columns = (np.full(size, -1) for size in link.shape)
    for root in np.flatnonzero(link.any(axis=1)):
        new = np.array([root]) if rows[root] < 0 else np.zeros(0, int)
        while len(new):
            rows[new] = root
            reached = np.flatnonzero(link[new].any(axis=0) & (columns < 0))
            columns[reached] = root
            new = np.flatnonzero(link[:, reached].any(axis=1) & (rows < 0))
    labels = np.concatenate([rows, columns])
    nodes = np.flatnonzero(labels >= 0)
    return nodes, labels[nodes]


def _verified(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """The pairs `u`, `v` whose `cosine` is at least `least`."""

    def side(name: str) -> DataFrame:
        return reps.select(F.col("rep").alias(name), F.col("unit").alias(f"unit_{name}"))

    both = pairs.join(side("u"), "u").join(side("v"), "v")
    same = both.filter(F.size("unit_u") == F.size("unit_v"))
    return same.select("u", "v", _dot("unit_u", "unit_v").alias("cosine")).filter(F.col("cosine") >= least)


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def near_vectors(vectors: DataFrame, search: Search = Search()) -> DataFrame:
    """`vec_id`, `n_links`, `component_id` and `kept` for every row of `vectors` (`vec_id`, `embedding`)."""
    rows = materialize(_units(vectors), "units")
    usable = rows.filter("unit is not null")
    grouped = usable.groupBy("unit").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = materialize(grouped, "reps")
    n, dimensions = reps.agg(F.count(F.lit(1)), F.max(F.size("unit"))).first()
    tail, lines, crowd = calibrate(n, dimensions or 1, search)
    slabs = max(8, math.ceil(n * lines * 2 * (crowd / max(n, 1)) / search.slab_rows))
    tails = materialize(_tails(reps, tail, lines, slabs, search.seed), "tails")
    hot = search.hot * max(crowd, LEAST_CROWD)
    cells = _cells(tails, reps, hot, search)
    marked = tails.join(cells.select("rep", F.lit(True).alias("inside")), "rep", "left").fillna(False, ["inside"])
    counted = _collisions(marked, search.window).groupBy("u", "v").agg(F.sum("n").alias("n"))
    passing = materialize(counted.filter(F.col("n") >= search.least).select("u", "v"), "passing")
    links = materialize(_verified(passing, reps, search.cosine).select("u", "v"), "links")
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    copies = reps.select(F.col("rep").alias("v"), "copies")
    compared = materialize(_compared(cells, reps, search), "compared")
    sums = both.join(copies, "v").select(F.col("u").alias("rep"), F.col("copies").alias("n"))
    across = sums.unionByName(compared.select("rep", "n")).groupBy("rep").agg(F.sum("n").alias("across"))
    balls = cells.filter("kind = 2").select("rep", "cell")
    ball_sizes = balls.join(reps.select("rep", "copies"), "rep").groupBy("cell").agg(F.sum("copies").alias("ball_size"))
    inside = balls.join(ball_sizes, "cell").drop("cell")
    edges = links.unionByName(balls.select(F.col("rep").alias("u"), F.col("cell").alias("v"))).unionByName(
        compared.filter("other is not null").select(F.col("rep").alias("u"), F.col("other").alias("v"))
    )
    members = connected_components(edges).withColumnRenamed("node", "rep")
    classes = reps.join(across, "rep", "left").join(inside, "rep", "left").join(members, "rep", "left")
    n_links = F.coalesce("across", F.lit(0)) + F.coalesce("ball_size", F.col("copies")) - 1
    labelled = classes.select(
        "unit", n_links.alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    found = rows.join(materialize(labelled, "classes"), "unit", "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

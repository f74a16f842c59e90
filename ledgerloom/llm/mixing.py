"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

A source's target is its share of all words by weight, at most `max_epochs` times its own size; what lies above goes
to the others by weight. The mix is a number of blocks of `block_words` words each. Blocks go one by one to the
source with the highest quotient target / (2 × blocks + 1), which gives every source an integer quota, and a source's
quota goes to its shards the same way by their size. Documents of a shard lie in seeded order on a line of words
that is cut into blocks; the quota takes every block as often as it goes round, and the remaining blocks follow each
other from a seeded block on.

Only per-source and per-shard totals reach the driver: at most `MAX_SOURCES` sources (checked) and about `MAX_SHARDS`
shards. A shard holds a bounded share of a source, so a source with a third of all rows is ordered by many tasks.

Defined results: a null text has size 0, and such documents are never taken; null sources form one source, last in
order. Equal order keys are settled by id, size and text, so reruns agree. Rows may repeat; each counts. An empty table
gives an empty one. Other columns are kept by `mix_documents` and not read by `mix_plan`.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import WORD, whole_row
from ledgerloom.storage import materialize

MAX_SOURCES = 100_000
MAX_SHARDS = 20_000


@dataclass(frozen=True)
class Mix:
    """Weights by the order of sources, repeating; how often a source may be repeated; sizes of blocks and shards."""

    weights: Sequence[int] = (1, 2, 3)
    max_epochs: int = 3
    block_words: int = 64
    shard_words: int = 1 << 17
    seed: int = 20_240


def size_of(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[int], max_epochs: int) -> list[Fraction]:
    """Shares of the total by weight, none above `max_epochs` times its size."""
    total, held = sum(sizes), {}
    while True:
        rest = total - sum(held.values())
        weight = sum(w for i, w in enumerate(weights) if i not in held)
        over = [
            i
            for i, (size, w) in enumerate(zip(sizes, weights))
            if i not in held and Fraction(w * rest, weight) > max_epochs * size
        ]
        if not over:
            share = {i: Fraction(w * rest, weight) for i, w in enumerate(weights) if i not in held}
            return [Fraction(held[i]) if i in held else share[i] for i in range(len(sizes))]
        held |= {i: max_epochs * sizes[i] for i in over}


def apportion(seats: int, claims: Sequence[Fraction | int], most: Sequence[int] | None = None) -> list[int]:
    """Sainte-Laguë: seats go to the highest quotient claim / (2 × seats + 1); equal ones to the first.

    `most` limits the seats of each. Starting from claims rounded at the common divisor leaves only a few seats to
    give or take, so the work depends on the number of claims, not of seats.
    """
    total = sum(claims)
    most = [seats] * len(claims) if most is None else list(most)
    if not total:
        return [0] * len(claims)
    given = [min(m, math.floor(Fraction(c * seats, total) + Fraction(1, 2))) for c, m in zip(claims, most)]
    surplus = sum(given) - seats
    if surplus > 0:
        lowest = [(Fraction(c) / (2 * g - 1), -i) for i, (c, g) in enumerate(zip(claims, given)) if g]
        heapq.heapify(lowest)
        for _ in range(surplus):
            i = -heapq.heappop(lowest)[1]
            given[i] -= 1
            if given[i]:
                heapq.heappush(lowest, (Fraction(claims[i]) / (2 * given[i] - 1), -i))
        return given
    highest = [
        (-Fraction(c) / (2 * g + 1), i) for i, (c, g, m) in enumerate(zip(claims, given, most)) if c and g < m
    ]
    heapq.heapify(highest)
    for _ in range(-surplus):
        if not highest:
            break
        i = heapq.heappop(highest)[1]
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(highest, (-Fraction(claims[i]) / (2 * given[i] + 1), i))
    return given


def _sources(sized: DataFrame, mix: Mix) -> list[tuple]:
    """Source, size, target and number of shards, by code point, null last."""
    counted = sized.groupBy("_source").agg(F.sum("_size").alias("n"))
    rows = counted.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["_source"] is None, r["_source"] or ""))
    names, sizes = [r["_source"] for r in rows], [r["n"] for r in rows]
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(rows))]
    total = max(1, sum(sizes))
    shards = [
        max(1, min(math.ceil(size / mix.shard_words), math.ceil(MAX_SHARDS * size / total))) for size in sizes
    ]
    return list(zip(names, sizes, targets(sizes, weights, mix.max_epochs), shards))


def _keys(rows: DataFrame) -> list[str]:
    """What tells rows apart: the id, and the text's hash where the rows have it, since ids may be null or repeat."""
    return [name for name in ("_id", "_text") if name in rows.columns]


def _shard(mix: Mix, keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit(mix.seed), *keys), F.col("_shards")).cast("int")


def _hint(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A bounded table of totals, small enough for every executor."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def _with_sources(rows: DataFrame, sources: list[tuple], mix: Mix) -> DataFrame:
    table = [(name, size, float(target), shards) for name, size, target, shards in sources]
    schema = "_name string, _source_size long, _target double, _shards int"
    joined = rows.join(_hint(rows.sparkSession, table, schema), F.col("_source").eqNullSafe(F.col("_name")))
    return joined.withColumn("_shard", _shard(mix, _keys(rows)))


def _quotas(sized: DataFrame, sources: list[tuple], mix: Mix) -> list[tuple]:
    """Source, shard, words of the shard, full rounds, remaining words and the place where they start."""
    block = mix.block_words
    counted = _with_sources(sized, sources, mix).groupBy("_source", "_shard").agg(F.sum("_size").alias("n")).collect()
    by_source: dict[str | None, list[tuple[int, int]]] = {}
    for row in counted:
        by_source.setdefault(row["_source"], []).append((row["_shard"], row["n"]))
    seats = apportion(
        sum(size for _, size, _, _ in sources) // block,
        [target for _, _, target, _ in sources],
        [math.ceil(mix.max_epochs * size / block) for _, size, _, _ in sources],
    )
    quotas = []
    for place, (name, _, target, _) in enumerate(sources):
        shards = sorted(by_source[name])
        words = [n for _, n in shards]
        parts = apportion(seats[place], words, [math.ceil(mix.max_epochs * n / block) for n in words])
        for (shard, n), quota in zip(shards, parts):
            wanted = min(quota * block, mix.max_epochs * n)
            rounds, rest = divmod(wanted, n) if n else (0, 0)
            start = (mix.seed + 7919 * place + 104_729 * shard) % max(1, math.ceil(n / block)) * block
            quotas.append((name, shard, n, rounds, rest, min(start, max(0, n - 1))))
    return quotas


def _taken(rows: DataFrame, sources: list[tuple], quotas: list[tuple], mix: Mix) -> DataFrame:
    """`rows` (with `_id`, `_text`, `_source`, `_size`) and `_source_size`, `_target`, `_taken`."""
    placed = _with_sources(rows, sources, mix)
    schema = "_of string, _part int, _words long, _rounds long, _rest long, _start long"
    hint = _hint(rows.sparkSession, quotas, schema)
    same = F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_shard") == F.col("_part"))
    order = [F.xxhash64(F.lit(mix.seed + 1), F.col("_id")), *_keys(rows), "_size"]
    line = Window.partitionBy("_source", "_shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("_size").over(line)
    joined = placed.join(hint, same).withColumn("_end", end).withColumn("_begin", F.col("_end") - F.col("_size"))

    def inside(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("_end"), high) - F.greatest(F.col("_begin"), low))

    stop = F.col("_start") + F.col("_rest")
    once = inside(F.col("_start"), F.least(stop, F.col("_words"))) + inside(F.lit(0), stop - F.col("_words"))
    return joined.withColumn("_taken", F.col("_rounds") * F.col("_size") + once)


def _sized(docs: DataFrame, id_column: str) -> DataFrame:
    narrow = docs.select(
        docs[id_column].alias("_id"),
        F.xxhash64(docs["text"]).alias("_text"),
        docs["source"].alias("_source"),
        size_of(docs["text"]).alias("_size"),
    )
    return materialize(narrow, "sized")


def mix_plan(docs: DataFrame, mix: Mix = Mix(), id_column: str = "doc_id") -> DataFrame:
    """`id_column`, `size`, `source_size`, `target` and `taken`, the words the mix takes, for every row."""
    sized = _sized(docs, id_column)
    sources = _sources(sized, mix)
    if not sources:
        sources, quotas = [(None, 0, Fraction(0), 1)], [(None, 0, 0, 0, 0, 0)]
    else:
        quotas = _quotas(sized, sources, mix)
    taken = _taken(sized, sources, quotas, mix)
    names = {"_id": id_column, "_size": "size", "_source_size": "source_size", "_target": "target", "_taken": "taken"}
    return taken.select(*[F.col(a).alias(b) for a, b in names.items()])


def mix_documents(docs: DataFrame, mix: Mix = Mix(), id_column: str = "doc_id") -> DataFrame:
    """The rows of the mix, all columns: each as often as its taken words hold its size, to the nearest whole.

    Only the first and the last document of a shard's remaining blocks are cut by a block's edge and rounded.
    """
    sized = _sized(docs, id_column)
    sources = _sources(sized, mix)
    if not sources:
        return docs
    rows = docs.select(
        whole_row(docs).alias("_row"),
        docs[id_column].alias("_id"),
        F.xxhash64(docs["text"]).alias("_text"),
        docs["source"].alias("_source"),
        size_of(docs["text"]).alias("_size"),
    )
    taken = _taken(rows, sources, _quotas(sized, sources, mix), mix)
    times = F.when(F.col("_size") > 0, F.round(F.col("_taken") / F.col("_size"))).otherwise(0).cast("int")
    copies = taken.select("_row", F.explode(F.array_repeat(F.lit(0), times)))
    return copies.select(*[F.col("_row")[c].alias(c) for c in docs.columns])

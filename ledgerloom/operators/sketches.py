"""Profiles that loads keep, so that a profile of many loads reads no rows.

Each load stores one row a column: counts, a HyperLogLog sketch of the distinct values, a theta sketch for the overlap of
keys, and, for numbers, a KLL sketch of their order. Sketches of loads merge to the sketch of all of them. All are
aggregates with a bounded state, made in one pass over the load and combined before the shuffle.

Bounds, with the default sizes and 99 of 100 cases: distinct counts within 5 % (2**12 registers, 1.04 / 64 as standard
error), overlaps within 5 % of the larger side (2**14 entries), ranks within 2.65 % of the rows (k = 200).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.profile import PERCENTILES, numeric_columns, percentile_name

LG_REGISTERS, LG_ENTRIES, K = 12, 14, 200
DISTINCT_ERROR, OVERLAP_ERROR, RANK_ERROR = 0.05, 0.05, 0.0265


def sketch_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row a column: `column_name`, `row_count`, `null_count`, and the sketches `distinct_values`, `keys` and, for
    numbers, `quantiles`. NULLs are in no sketch. Values are sketched as text, numbers for `quantiles` as doubles."""
    columns = list(df.columns) if columns is None else list(columns)
    numbers = set(numeric_columns(df))
    aggregates = []
    for c in columns:
        text, number = F.col(c).cast("string"), F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")
        fields = [
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.hll_sketch_agg(text, LG_REGISTERS).alias("distinct_values"),
            F.theta_sketch_agg(text, LG_ENTRIES).alias("keys"),
            (F.kll_sketch_agg_double(number, K) if c in numbers else F.lit(None).cast("binary")).alias("quantiles"),
        ]
        aggregates.append(F.struct(F.lit(c).alias("column_name"), *fields).alias(f"c{len(aggregates)}"))
    wide = df.agg(*aggregates)
    return wide.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))])))


def merged(sketches: DataFrame) -> DataFrame:
    """One row a column for any number of loads' `sketch_columns`."""
    return sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_values").alias("distinct_values"),
        F.theta_union_agg("keys", LG_ENTRIES).alias("keys"),
        F.kll_merge_agg_double("quantiles", K).alias("quantiles"),
    )


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """Distinct non-NULL values per column, within the bound."""
    return merged(sketches).select(
        "column_name", "row_count", "null_count", F.hll_sketch_estimate("distinct_values").alias("distinct_count")
    )


def quantile_estimates(sketches: DataFrame, at: Sequence[float] = PERCENTILES) -> DataFrame:
    """Values whose rank is near each share, per numeric column with values."""
    numeric = merged(sketches.filter("quantiles is not null and row_count > null_count"))
    return numeric.select(
        "column_name",
        *[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q))).alias(percentile_name(q)) for q in at],
    )


def key_overlap(first: DataFrame, second: DataFrame, column: str, other: str | None = None) -> DataFrame:
    """How many values two tables' columns share, from their sketches alone: `first_values`, `second_values`, `shared`."""
    keys, both = F.col("keys"), None
    for mine, (sketches, name) in enumerate(((first, column), (second, other or column))):
        rows = sketches.filter(F.col("column_name") == name).select(F.lit(mine).alias("side"), "keys")
        both = rows if both is None else both.unionByName(rows)
    sides = [F.theta_union_agg(F.when(F.col("side") == i, keys), LG_ENTRIES).alias(n) for i, n in enumerate(("one", "two"))]
    return both.agg(*sides).select(
        F.theta_sketch_estimate("one").alias("first_values"),
        F.theta_sketch_estimate("two").alias("second_values"),
        F.theta_sketch_estimate(F.theta_intersection("one", "two")).alias("shared"),
    )

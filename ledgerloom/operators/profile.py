"""Profiles of a stored table: shape, types, NULLs, distinct values, numeric statistics."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.storage import materialize

PERCENTILES = (0.25, 0.5, 0.75)


def _per_column(wide: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one row with a struct per column into one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}`.{f}").alias(f) for f in fields]) for c in columns
    ]
    return wide.select(F.inline(F.array(*entries)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("long")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, in one pass."""
    wide = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("null_count")).alias(c) for c in df.columns])
    return _per_column(wide, df.columns, ["null_count"])


def column_info(df: DataFrame) -> DataFrame:
    """Position, type and non-NULL count per column, in one pass."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(i).cast("long").alias("position"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.count(f.name).alias("non_null_count"),
            ).alias(f.name)
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return _per_column(wide, df.columns, ["position", "data_type", "non_null_count"])


def distinct_counts(df: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Distinct non-NULL values per column: exact, or within `relative_error` in a single pass.

    Exact counts run as one branch per column, so each reads and shuffles only its own column of the stored
    table; one aggregate over all columns would shuffle every row once per column.
    """
    if relative_error is not None:
        wide = df.agg(
            *[
                F.struct(F.approx_count_distinct(c, relative_error).alias("distinct_count")).alias(c)
                for c in df.columns
            ]
        )
        return _per_column(wide, df.columns, ["distinct_count"])
    result = None
    for c in df.columns:
        row = df.agg(F.count_distinct(c).alias("distinct_count")).select(
            F.lit(c).alias("column_name"), "distinct_count"
        )
        result = row if result is None else result.unionByName(row)
    return result


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries: list[Column] = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*entries))).filter("value is not null")


def percentile_name(q: float) -> str:
    """`p25`, `p99_9`: the exact percentage, so that close percentiles keep names of their own."""
    return f"p{(Decimal(str(q)) * 100).normalize():f}".replace(".", "_")


def percentiles(df: DataFrame, columns: Sequence[str], at: Sequence[float] = PERCENTILES) -> DataFrame:
    """Exact percentiles with linear interpolation: one row per column, `p25`-style names.

    The built-in `percentile` keeps a map of all values in one task. Here equal values are counted first, the
    counts are sorted by range and stored, and only the ranges that hold a wanted rank are summed through.
    """
    counted = _values(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    laid = (
        counted.repartitionByRange("column_name", "value")
        .select("column_name", "value", "n", F.spark_partition_id().alias("_range"))
    )
    laid = materialize(laid, "value_counts")

    # One row per column and range: bounded by columns + shuffle partitions.
    sizes = laid.groupBy("column_name", "_range").agg(F.sum("n").alias("size"))
    whole = Window.partitionBy("column_name")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.select(
        "column_name",
        "_range",
        "size",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(whole).alias("total"),
    )
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(at)])
    position = (F.col("total") - 1) * F.col("q")
    ranks = (
        ranges.select("*", F.inline(wanted))
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))))
        .filter((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("size")))
        .select("column_name", "_range", "start", "i", "position", "rank")
    )
    needed = ranks.select("column_name", "_range", "start").distinct()
    within = Window.partitionBy("column_name", "_range").orderBy("value")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # `needed` and `ranks` hold at most two rows per column and percentile.
    placed = laid.join(F.broadcast(needed), ["column_name", "_range"]).select(
        "column_name", "_range", "value", "n", (F.col("start") + F.sum("n").over(upto)).alias("end")
    )
    hits = placed.join(F.broadcast(ranks), ["column_name", "_range"]).filter(
        (F.col("end") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("end"))
    )
    weight = 1 - F.abs(F.col("rank") - F.col("position"))
    by_rank = hits.groupBy("column_name").agg(
        *[
            F.sum(F.when(F.col("i") == i, F.col("value") * weight)).alias(percentile_name(q))
            for i, q in enumerate(at)
        ]
    )
    return by_rank


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum; one row per numeric column."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    fields = ["count", "mean", "std", "min", "max"]
    wide = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    moments = _per_column(wide, columns, fields)
    quartiles = percentiles(df, columns)
    return moments.join(F.broadcast(quartiles), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )

"""Running sums within a key, in the order of a dense row number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Row numbers covered by one slice of a split key, so the most rows a task holds for it.
SLICE_ROWS = 1_000_000


def running_sum(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], value: Column, name: str) -> DataFrame:
    """Sum of `value` over the rows of the key up to and including the current one."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(so_far))


def running_sum_sliced(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    value: Column,
    name: str,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`running_sum` for keys of any size.

    `order_by` must be a row number of the table (unique, and dense up to filtering), so that a slice of
    `slice_rows` numbers holds at most that many rows. The sum runs within each slice of a key, and the totals
    of the key's earlier slices, one row per key and slice, are added.
    """
    slices = F.floor((F.col(order_by) - 1) / F.lit(slice_rows)).cast("long")
    # One struct holds the keys: it is never NULL itself and equal where its fields are, NULL among them, so the join
    # is a plain one and reuses the windows' partitioning.
    sliced = df.withColumn("_key", F.struct(*keys)).withColumn("_slice", slices).withColumn("_value", value)
    parts = ["_key", "_slice"]
    local = running_sum(sliced, parts, order_by, F.col("_value"), "_local")
    totals = sliced.groupBy(*parts).agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("_total").over(earlier).alias("_before")
    offsets = totals.select(*parts, before).filter("_before is not null")
    total = F.coalesce(F.col("_local") + F.col("_before"), F.col("_local"), F.col("_before"))
    kind = local.schema["_local"].dataType
    return local.join(offsets, parts, "left").select(*df.columns, total.cast(kind).alias(name))

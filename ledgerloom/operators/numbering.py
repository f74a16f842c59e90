"""Dense numbers over a whole table, without a one-partition window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.storage import bucketed_scan, materialize, save_bucketed, scratch_path

# monotonically_increasing_id() keeps the row's place within its partition in the low 33 bits.
_PLACE_BITS = (1 << 33) - 1


def with_arrival(stored: DataFrame, name: str = "_arrival") -> DataFrame:
    """Mark each row with its place in a stored table.

    Only for narrow reads of files: there a repeated task meets the same rows in the same order, which is not
    so after a shuffle.
    """
    return stored.withColumn(name, F.monotonically_increasing_id())


def sorted_ranges(
    df: DataFrame,
    order_by: Sequence[str],
    arrival: str,
    order_only: Sequence[str] = (),
    derived: Sequence[str] = (),
    ranges: int | None = None,
    made: Mapping[str, Column] | None = None,
    together: bool = False,
) -> DataFrame:
    """The rows stored range by range in sort order, with `_range` and the row's `_place` in it.

    `together` stores them in buckets by `_range`, so that what groups by range and more moves no row.
    """
    carried = [c for c in df.columns if c != arrival]
    ordering = [*order_by, *[c for c in carried if c not in order_by and c not in derived], arrival]
    spread = df.repartitionByRange(*ordering) if ranges is None else df.repartitionByRange(ranges, *ordering)
    laid = (
        spread
        .sortWithinPartitions(*ordering)
        .select(
            *[c for c in carried if c not in order_only],
            *[column.alias(c) for c, column in (made or {}).items()],
            F.spark_partition_id().alias("_range"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias("_place"),
        )
    )
    if not together:
        return materialize(laid, "ranges")
    session = df.sparkSession
    buckets = ranges or int(session.conf.get("spark.sql.shuffle.partitions"))
    return bucketed_scan(session, save_bucketed(laid, scratch_path(session, "ranges"), ["_range"], buckets))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    arrival: str | None = None,
    order_only: Sequence[str] = (),
    derived: Sequence[str] = (),
    made: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add `name`: 1, 2, 3 … in `order_by` order, and return a frame over a stored table.

    All other columns break ties, so tied rows are exact copies and any order among them gives the same table.
    Copies are told apart by `arrival` (see `with_arrival`), so a range of the sort can be cut between two
    copies and a row repeated any number of times still spreads over many tasks. Without `arrival` the input
    is stored first, so that what leads to it runs once and not again for the sample of the sort; its files, one a task,
    then give the number of ranges, at least the session's shuffle partitions. Columns in `order_only` serve the sort and are not kept; columns in `derived` follow from
    others, break no ties and stay out of the sort key. Columns of `made` are computed from the others, `order_only` ones
    included, once the rows have moved.

    The rows move once, by range. Each range is stored with its rows' places; the number is then the place
    plus the sizes of the ranges before it, a table of one row per range.
    """
    ranges = numbered_ranges(df, order_by, name, arrival, order_only, derived, made)
    return ranges.drop("_range", "_start", "_size")


def numbered_ranges(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    arrival: str | None = None,
    order_only: Sequence[str] = (),
    derived: Sequence[str] = (),
    made: Mapping[str, Column] | None = None,
    together: bool = False,
) -> DataFrame:
    """`number_rows` with the range of the sort that the row is in: `_range`, the rows before it `_start` and in it `_size`.

    `together` as in `sorted_ranges`.
    """
    parts = None
    if arrival is None:
        arrival = "_arrival"
        stored = materialize(df, "unnumbered")
        parts = max(len(stored.inputFiles()), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        df = with_arrival(stored, arrival)
    ranges = sorted_ranges(df, order_by, arrival, order_only, derived, parts, made, together)
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # One row per range of the sort, so the broadcast is bounded by the number of shuffle partitions. It is
    # stored so that later reads of the numbers do not count the ranges again.
    kept = [c for c in ranges.columns if c not in ("_range", "_place")]
    return ranges.join(F.broadcast(materialize(starts, "starts")), "_range").select(
        (F.col("_start") + F.col("_place") + 1).alias(name), *kept, "_range", "_start", "_size"
    )

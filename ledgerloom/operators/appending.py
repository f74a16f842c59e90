"""Numbers and ranks that stay when rows are added.

A load numbers its own rows and starts where the loads before it ended, so a number once given is never given again
and never changes. Ranks within a key go on where earlier loads of that key stopped: only the counts of the keys that
the load holds are read, and no earlier row is ranked anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.numbering import number_rows
from ledgerloom.operators.running import SLICE_ROWS, running_sum_sliced
from ledgerloom.storage import materialize


def last_number(stored: DataFrame, name: str) -> int:
    """The greatest number given so far; 0 in an empty table. Parquet answers it from its footers."""
    return stored.agg(F.max(name)).first()[0] or 0


def number_more(
    rows: DataFrame,
    order_by: Sequence[str],
    name: str,
    after: int,
    arrival: str | None = None,
    order_only: Sequence[str] = (),
    derived: Sequence[str] = (),
    made: Mapping[str, Column] | None = None,
) -> DataFrame:
    """`number_rows` for the rows of one load, going on after the number `after`, over a stored table."""
    numbered = number_rows(rows, order_by, name, arrival, order_only, derived, made)
    return numbered.withColumn(name, F.col(name) + F.lit(after)) if after else numbered


def rank_more(
    rows: DataFrame,
    earlier: DataFrame | None,
    keys: Sequence[str],
    order_by: str,
    name: str,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add `name`: the row's rank in its key over all loads, in `order_by` order, for the rows of the latest load.

    `order_by` numbers the rows as `number_more` does, so all rows of `earlier` come first. A key of any size is ranked in
    slices. Earlier rows are counted by key, combined before the shuffle, and only for keys that the load holds.
    """
    local = running_sum_sliced(rows, keys, order_by, F.lit(1), name, slice_rows)
    if earlier is None:
        return local
    # One struct holds the keys, so that NULL keys meet too.
    key = F.struct(*keys).alias("_key")
    wanted = materialize(rows.select(key).distinct(), "keys")
    before = earlier.select(key).join(wanted, "_key", "left_semi").groupBy("_key").agg(F.count(F.lit(1)).alias("_before"))
    joined = local.withColumn("_key", key).join(materialize(before, "counts"), "_key", "left")
    kind = local.schema[name].dataType
    rank = (F.col(name) + F.coalesce("_before", F.lit(0))).cast(kind)
    return joined.withColumn(name, rank).select(*local.columns)

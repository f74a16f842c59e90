"""Groups of rows that share a key, and their first member."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import HOT_ROWS
from ledgerloom.storage import materialize


def first_of(columns: Sequence[str], name: str) -> Column:
    """Aggregate: the last of `columns`, taken from the row that is smallest in all of them.

    Unlike a window it combines before the shuffle, so a group of any size reaches its task as a few rows.
    """
    return F.min(F.struct(*columns))[columns[-1]].alias(name)


def join_repeated(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    spread_by: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join each row to the aggregates of its group, for groups of two rows or more.

    With `how="left"` rows that stand alone are kept with NULL aggregates. A group of `hot_rows` or more is
    split: its one aggregate row is repeated per salt and its members take a salt from `spread_by`.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *aggregates).filter("_n > 1")
    groups = materialize(counted, "groups")
    hot = groups.filter(F.col("_n") >= hot_rows)
    if hot.isEmpty():
        return df.join(groups.drop("_n"), list(keys), how)
    salts = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    # At most rows / hot_rows groups are hot. They are stored, so Spark knows their size and broadcasts them or not.
    split = materialize(hot.select(*keys, salts.alias("_salts")), "hot_groups")
    salted = df.join(split, list(keys), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int"), F.lit(0))
    )
    copies = F.when(F.col("_n") >= hot_rows, salts - 1).otherwise(0)
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies))).drop("_n")
    return salted.drop("_salts").join(repeated, [*keys, "_salt"], how).drop("_salt")

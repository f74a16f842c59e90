"""Finding the keys that are too big for one task.

Splitting decides only where rows are processed, never which rows: the operators that use these keys give the
same result for any set of hot keys, so the keys may be found from a sample. The set is stored once, so that
every branch of a plan splits alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.storage import materialize

# Rows one task may hold for one key before the key is split.
HOT_ROWS = 1_000_000
SAMPLE = 0.01


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, fraction: float = SAMPLE
) -> DataFrame:
    """Keys with about `hot_rows` rows or more, at most 2 × rows / `hot_rows` of them, as a stored table.

    The sample counts half of `hot_rows` as hot: at a million rows and one percent a key that reaches the
    limit is missed with a probability below 1e-300, and a missed key costs time only.
    """
    keyed = df.select(*keys)
    if fraction < 1:
        keyed = keyed.sample(fraction=fraction, seed=1)
        least = max(2, int(hot_rows * fraction / 2))
    else:
        least = hot_rows
    counted = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return materialize(counted.filter(F.col("_n") >= least).select(*keys), "hot_keys")

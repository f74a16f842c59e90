"""Foreign keys: resolving them, finding the ones that do not resolve, and appending the Unknown member.

These joins carry no hint. Spark broadcasts the master when its measured size allows; beyond that it sorts and
merges, and AQE splits the partitions of a key that dominates the fact side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.storage import materialize
from ledgerloom.values import UNKNOWN


class RepeatedKey(ValueError):
    """A table that must have one row per key has more."""


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Raise if a key repeats: joining such a master would multiply fact rows."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").limit(1).collect()
    if repeated:
        raise RepeatedKey(f"{table}: {repeated[0].asDict()}")


def resolve(fact: DataFrame, key: str, master: DataFrame, master_key: str, value: str, name: str) -> DataFrame:
    """Add `name`: the master's `value` for the fact's `key`, or UNKNOWN."""
    narrow = master.select(F.col(master_key).alias("_key"), F.col(value).alias("_value"))
    joined = fact.join(narrow, fact[key] == narrow["_key"], "left")
    return joined.withColumn(name, F.coalesce("_value", F.lit(UNKNOWN))).drop("_key", "_value")


def referred(master: DataFrame, master_key: str, value: str, facts: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """The key and `value` of the master's rows that the columns of the facts refer to, stored.

    `resolve` gives the same with them as with the whole master, whose other rows no fact meets. They are mostly far fewer,
    so that Spark may broadcast them where it would move every fact to a large master.
    """
    keys = None
    for fact, column in facts:
        found = fact.select(F.col(column).alias("_key"))
        keys = found if keys is None else keys.unionByName(found)
    narrow = master.select(master_key, value)
    return materialize(narrow.join(keys.distinct(), narrow[master_key] == F.col("_key"), "left_semi"), "referred")


def orphans(fact: DataFrame, key: str, master: DataFrame, master_key: str) -> DataFrame:
    """Fact rows whose key is not in the master."""
    narrow = master.select(F.col(master_key).alias("_key"))
    return fact.join(narrow, fact[key] == narrow["_key"], "left_anti")


def in_set(df: DataFrame, key: str, members: DataFrame, member_key: str, name: str) -> DataFrame:
    """Add boolean `name`: whether `key` is among the distinct values of `member_key`."""
    narrow = members.select(F.col(member_key).alias("_key")).distinct().withColumn("_found", F.lit(True))
    joined = df.join(narrow, df[key] == narrow["_key"], "left")
    return joined.withColumn(name, F.coalesce("_found", F.lit(False))).drop("_key", "_found")


def append_member(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Append one row with the given columns; the others are NULL."""
    row: list[Column] = [
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields
    ]
    return df.union(df.sparkSession.range(1).select(*row))


def table_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """One row a table: name and row count, and with `expected` also the count it should have."""
    result = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("Rows")).select(F.lit(name).alias("table_name"), "Rows")
        if expected is not None:
            want = F.lit(expected.get(name)).cast(T.LongType())
            row = row.withColumn("Expected", want).withColumn("Agrees", F.col("Rows") == want)
        result = row if result is None else result.unionByName(row)
    return result

"""Date rows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The planning calendar.
FIRST_DAY = datetime.date(2025, 1, 1)
LAST_DAY = datetime.date(2026, 12, 31)


def _days(frame: DataFrame, first: Column, last: Column) -> DataFrame:
    return frame.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("Date"))


def date_rows(
    spark: SparkSession, first: datetime.date = FIRST_DAY, last: datetime.date = LAST_DAY
) -> DataFrame:
    """One row a day, both ends included."""
    return _days(spark.range(1), F.lit(first), F.lit(last))


def date_rows_spanning(df: DataFrame, column: str) -> DataFrame:
    """One row a day from the earliest to the latest value of a date column."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return _days(ends.filter("first is not null"), F.col("first"), F.col("last"))


def date_rows_covering(
    columns: list[tuple[DataFrame, str]], first: datetime.date = FIRST_DAY, last: datetime.date = LAST_DAY
) -> DataFrame:
    """One row a day of the planning calendar, widened to the earliest and latest value of all the columns."""
    ends = None
    for df, column in columns:
        day = F.col(column).cast("date")
        part = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
        ends = part if ends is None else ends.unionByName(part)
    span = ends.agg(
        F.least(F.min("first"), F.lit(first)).alias("first"), F.greatest(F.max("last"), F.lit(last)).alias("last")
    )
    return _days(span, F.col("first"), F.col("last"))

"""Facts laid out by month, so that a question about some days reads the files of their months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import year_month

MONTH = "_month"


def month_of(day: Column) -> Column:
    """The month's folder; NULL for no date."""
    return year_month(day)


def write_by_month(df: DataFrame, path: str, date_column: str) -> None:
    """Store the rows in a folder a month, without a date in a folder of their own.

    A task writes a range of months, so there are about as many files as tasks, and a month with many rows is cut by a
    hash of the row and spreads over tasks.
    """
    placed = df.withColumn(MONTH, month_of(F.col(date_column)))
    spread = placed.repartitionByRange(MONTH, F.xxhash64(*df.columns))
    spread.write.partitionBy(MONTH).parquet(path)


def on_days(dated: DataFrame, date_column: str, days: DataFrame) -> DataFrame:
    """The rows on the given days (a calendar, filtered as wanted), with the calendar's columns.

    The join on the month lets Spark skip the folders of other months when it has read the days.
    """
    wanted = days.withColumn("_wanted", month_of(F.col("Date")))
    same = (dated[MONTH] == wanted["_wanted"]) & (dated[date_column] == wanted["Date"])
    return dated.join(wanted, same).drop(MONTH, "_wanted")

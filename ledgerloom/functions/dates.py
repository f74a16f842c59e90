"""Date parts of the calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(day: Column) -> list[Column]:
    return [
        day.alias("Date"),
        F.year(day).alias("YEAR"),
        F.quarter(day).alias("QuarterNum"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("QUARTER"),
        F.date_format(day, "MMMM").alias("MONTHNAME"),
        year_month(day).alias("YearMonth"),
    ]


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")

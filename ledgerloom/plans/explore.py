"""Ad-hoc questions to the PO line fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order, so that the answer is repeatable."""
    return df.orderBy(*order_by).limit(rows)


def count_above(df: DataFrame, column: str, limit) -> DataFrame:
    return df.agg(F.count_if(F.col(column) > limit).alias("row_count"))


def above(df: DataFrame, column: str, limit) -> DataFrame:
    return df.filter(F.col(column) > limit)


def large_orders(fact: DataFrame, amount=10000, quantity=20) -> DataFrame:
    large = (F.col("POAmount") > amount) & (F.col("OrderedQty") >= quantity)
    return fact.filter(large).select("LineNumber", "OrderedQty", "UnitPrice", "POAmount")


def in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def not_in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with any other value; a NULL is not in the list, so it stays."""
    return df.filter(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(column).between(low, high))


def top(df: DataFrame, column: str, ties: Sequence[str], rows: int = 5) -> DataFrame:
    """The largest rows by `column`; `ties` settles equal ones. Each task keeps only its own top rows."""
    return df.orderBy(F.desc(column), *ties).limit(rows)

"""Decimal columns. Casts round half away from zero; under ANSI mode a value that does not fit raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUANTITY = "decimal(12,2)"
PRICE = "decimal(12,2)"
AMOUNT = "decimal(14,2)"
COST = "decimal(12,1)"
PERCENT = "decimal(9,4)"
SHARE = "decimal(5,1)"


def amount(quantity: Column, unit_price: Column) -> Column:
    """Quantity × price, rounded once, at the end; decimal throughout so that no binary noise decides a cent.

    The product of these types has 38 digits, as many as a decimal can hold, so it is exact.
    """
    return (quantity.cast("decimal(16,4)") * unit_price.cast("decimal(21,11)")).cast(AMOUNT)


def share_of(part: Column, whole: Column) -> Column:
    """Percentage with one decimal."""
    return (F.lit(100).cast("decimal(4,1)") * part / whole).cast(SHARE)

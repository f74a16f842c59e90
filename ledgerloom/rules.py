"""Business rules. Finance owns the values; a caller may pass its own `Rules`."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule set in force.
CURRENCIES = ("USD", "CRC", "EUR")
PAYMENT_TERMS = ("Net15", "Net30", "Net45", "Net60")
PAYMENT_TERMS_FIX = {
    "N30": "Net30",
    "NET 30": "Net30",
    "30 DAYS": "Net30",
    "N45": "Net45",
    "NET45": "Net45",
    "N60": "Net60",
    "NET 15": "Net15",
}
PRICE_TOLERANCE = Decimal("0.05")


@dataclass(frozen=True)
class Rules:
    currencies: tuple[str, ...] = CURRENCIES
    payment_terms: tuple[str, ...] = PAYMENT_TERMS
    payment_terms_fix: dict[str, str] = field(default_factory=lambda: dict(PAYMENT_TERMS_FIX))
    price_tolerance: Decimal = PRICE_TOLERANCE

    def fixed_terms(self, terms: Column) -> Column:
        """The standard term for a known legacy spelling in any case, else NULL.

        The map is a handful of literals, so the lookup folds into the scan's projection and needs no join.
        """
        if not self.payment_terms_fix:
            return F.lit(None).cast("string")
        pairs = [F.lit(x) for pair in self.payment_terms_fix.items() for x in pair]
        return F.try_element_at(F.create_map(*pairs), F.upper(terms))

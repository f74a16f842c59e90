"""Report measures over the governed tables, the facts and the match."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import values
from ledgerloom.functions.numbers import share_of
from ledgerloom.plans.match import price_is_off
from ledgerloom.rules import PRICE_TOLERANCE
from ledgerloom.sinks.dated import on_days


def _share(part, whole):
    """Part of the whole with four decimals; NULL when there is nothing to divide by."""
    return F.try_divide(part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")).cast("decimal(9,4)")


def readiness(golden: DataFrame) -> DataFrame:
    """Golden records that are ready, that are not, and the share that is."""
    ready = F.count_if(F.col("MigrationStatus") == values.READY)
    every = F.count(F.lit(1))
    return golden.agg(
        every.alias("vendors"),
        ready.alias("ready"),
        (every - ready).alias("exceptions"),
        _share(ready, every).alias("ready_share"),
    )


def issues_by_rule(issues: DataFrame) -> DataFrame:
    return issues.groupBy("RuleID", "Severity").agg(F.count(F.lit(1)).alias("issue_count"))


def rescued_lines(po_lines: DataFrame, xref: DataFrame) -> DataFrame:
    """PO lines that only the cross-reference connects to a vendor, and their share of all lines."""
    merged = xref.filter(F.col("MatchType") == values.MERGED).select(
        F.col("LegacyVendorCode").alias("VendorAccount"), F.lit(True).alias("_merged")
    )
    per_code = po_lines.groupBy("VendorAccount").agg(F.count(F.lit(1)).alias("n"))
    rescued = F.coalesce(F.sum(F.when(F.col("_merged"), F.col("n"))), F.lit(0))
    every = F.coalesce(F.sum("n"), F.lit(0))
    return per_code.join(merged, "VendorAccount", "left").agg(
        every.alias("po_lines"), rescued.alias("rescued_lines"), _share(rescued, every).alias("rescued_share")
    )


def match_rate(match: DataFrame) -> DataFrame:
    matched = F.count_if(F.col("MatchStatus") == values.MATCHED)
    every = F.count(F.lit(1))
    return match.agg(
        every.alias("invoice_lines"), matched.alias("matched_lines"), _share(matched, every).alias("match_rate")
    )


def hold_list(match: DataFrame) -> DataFrame:
    """Invoice lines that must not be paid automatically."""
    return match.filter(F.col("MatchStatus") != values.MATCHED)


def amount_on_hold(match: DataFrame) -> DataFrame:
    return hold_list(match).agg(
        F.count(F.lit(1)).alias("lines_on_hold"),
        F.coalesce(F.sum("InvoiceAmount"), F.lit(0)).cast("decimal(24,2)").alias("amount_on_hold"),
    )


def exposure(match: DataFrame) -> DataFrame:
    """What price variances and duplicates would cost if paid: the price gap, and the whole copy."""
    at_risk = (
        F.when(F.col("MatchStatus") == values.PRICE_VARIANCE, F.col("PriceVarianceAmount"))
        .when(F.col("MatchStatus") == values.DUPLICATE, F.col("InvoiceAmount"))
    )
    return (
        match.filter(F.col("MatchStatus").isin(values.PRICE_VARIANCE, values.DUPLICATE))
        .groupBy("MatchStatus")
        .agg(F.count(F.lit(1)).alias("invoice_lines"), F.sum(at_risk).alias("exposure"))
    )


def secondary_price_issues(match: DataFrame, tolerance: Decimal = PRICE_TOLERANCE) -> DataFrame:
    """Lines held for another reason whose price is off as well."""
    off = price_is_off(F.col("InvoiceUnitPrice"), F.col("POUnitPrice"), tolerance)
    return match.filter(off & (F.col("MatchStatus") != values.PRICE_VARIANCE))


def monthly_spend(po_lines: DataFrame, dates: DataFrame) -> DataFrame:
    """PO amount by month of the calendar; days outside it are kept under a NULL month.

    Days are summed first, so the join is a row per day.
    """
    per_day = po_lines.groupBy("OrderDate").agg(F.sum("POAmount").alias("amount"))
    return (
        per_day.join(dates, per_day["OrderDate"] == dates["Date"], "left")
        .groupBy("YearMonth")
        .agg(F.sum("amount").cast("decimal(24,2)").alias("spend"))
    )


def spend_on_days(dated_lines: DataFrame, days: DataFrame) -> DataFrame:
    """PO amount by month of the given days, from PO lines stored by month: only the days' months are read."""
    lines = on_days(dated_lines, "OrderDate", days.select("Date", "YearMonth"))
    return lines.groupBy("YearMonth").agg(F.sum("POAmount").cast("decimal(24,2)").alias("spend"))


def spend_by_vendor(po_lines: DataFrame) -> DataFrame:
    return po_lines.groupBy("VendorAccount").agg(F.sum("POAmount").alias("spend"))


def top_vendors(po_lines: DataFrame, vendors: DataFrame, rows: int = 10) -> DataFrame:
    """The vendors with the most spend, most first.

    The few rows that are left go to the dimension, which has every account through its Unknown member.
    """
    most = spend_by_vendor(po_lines).orderBy(F.desc("spend"), "VendorAccount").limit(rows)
    names = vendors.select("VendorAccount", "VendorName", "MigrationStatus")
    named = names.join(F.broadcast(most), "VendorAccount")
    return named.select("VendorAccount", "spend", "VendorName", "MigrationStatus").orderBy(
        F.desc("spend"), "VendorAccount"
    )


def spend_by_item_group(po_lines: DataFrame, items: DataFrame) -> DataFrame:
    per_item = po_lines.groupBy("ItemNumber").agg(F.sum("POAmount").alias("amount"))
    return (
        per_item.join(items.select("ItemNumber", "ItemGroup"), "ItemNumber", "left")
        .groupBy("ItemGroup")
        .agg(F.sum("amount").cast("decimal(24,2)").alias("spend"))
    )


def spend_by_site(po_lines: DataFrame) -> DataFrame:
    return po_lines.groupBy("Site").agg(F.sum("POAmount").alias("spend"))


def blocked_vendor_spend(po_lines: DataFrame, vendors: DataFrame) -> DataFrame:
    """Spend with vendors that cannot be migrated yet: what to fix first. The Unknown member is no vendor."""
    blocked = vendors.filter(
        (F.col("MigrationStatus") == values.EXCEPTION) & (F.col("VendorAccount") != values.UNKNOWN)
    ).select("VendorAccount", "VendorName")
    return spend_by_vendor(po_lines).join(blocked, "VendorAccount")


def share_by(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of all rows per value, the total taken over the aggregate."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    total = counted.agg(F.sum("row_count")).scalar()
    return counted.select(column, "row_count", share_of(F.col("row_count"), total).alias("pct_of_rows"))

"""Golden records, the legacy-to-new cross-reference and the migration status."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import values
from ledgerloom.functions.text import account_code
from ledgerloom.operators.lookups import in_set
from ledgerloom.operators.numbering import number_rows, with_arrival
from ledgerloom.operators.skew import HOT_ROWS
from ledgerloom.plans import quality
from ledgerloom.rules import Rules
from ledgerloom.storage import materialize


def stored_survivors(
    vendors: DataFrame,
    rules: Rules,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Validated vendors with their survivor, written once: golden, xref and every issue rule read this."""
    checked = quality.validate_vendors(vendors, rules)
    survivors = quality.dedupe_by_key(checked, "TaxID", "CreatedDate", "VendorCode", hot_rows)
    return materialize(survivors, "survivors")


def golden_records(survivors: DataFrame) -> DataFrame:
    """The survivors with their own attributes, numbered in `VendorCode` order.

    `survivors` must be a stored table (`stored_survivors`).
    """
    kept = survivors.filter(F.col("VendorCode") == F.col("SurvivorCode")).drop(quality.ISSUES)
    numbered = number_rows(with_arrival(kept), ["VendorCode"], "_number", arrival="_arrival")
    return numbered.withColumn("VendorAccount", account_code(F.col("_number"))).drop("_number")


def cross_reference(survivors: DataFrame, golden: DataFrame) -> DataFrame:
    """One row per legacy code: its survivor, the survivor's account, and how they are related."""
    accounts = golden.select(F.col("VendorCode").alias("SurvivorCode"), "VendorAccount")
    merged = F.col("VendorCode") != F.col("SurvivorCode")
    return survivors.select("VendorCode", "SurvivorCode").join(accounts, "SurvivorCode").select(
        F.col("VendorCode").alias("LegacyVendorCode"),
        "SurvivorCode",
        "VendorAccount",
        F.when(merged, values.MERGED).otherwise(values.SELF).alias("MatchType"),
    )


def migration_status(golden: DataFrame, issues: DataFrame) -> DataFrame:
    """`Exception` where the golden row's own code has a blocking issue, else `Ready`."""
    blocking = issues.filter("IsBlocking")
    flagged = in_set(golden, "VendorCode", blocking, "RecordKey", "_blocked")
    status = F.when(F.col("_blocked"), values.EXCEPTION).otherwise(values.READY)
    return flagged.withColumn("MigrationStatus", status).drop("_blocked")


def vendor_golden(
    survivors: DataFrame, golden: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Golden records with their migration status, from stored survivors; no other governed table is written."""
    golden = golden_records(survivors) if golden is None else golden
    return migration_status(golden, quality.blocking_issues(survivors, hot_rows))


def govern_vendors(
    vendors: DataFrame,
    rules: Rules | None = None,
    detected_at: datetime.datetime | None = None,
    hot_rows: int = HOT_ROWS,
) -> dict[str, DataFrame]:
    """The three governed tables from staged vendors. An empty issue log is an empty table, not an error."""
    rules = rules or Rules()
    survivors = stored_survivors(vendors, rules, hot_rows)
    issues = materialize(quality.all_issues(survivors, detected_at, hot_rows), "dq_issues")
    golden = golden_records(survivors)
    return {
        "vendor_golden": migration_status(golden, issues),
        "vendor_xref": materialize(cross_reference(survivors, golden), "vendor_xref"),
        "dq_issues": issues,
    }


def vendor_xref(survivors: DataFrame, golden: DataFrame | None = None) -> DataFrame:
    """The cross-reference alone, stored: facts join it, and a stored table has a size to plan with."""
    golden = golden_records(survivors) if golden is None else golden
    return materialize(cross_reference(survivors, golden), "vendor_xref")

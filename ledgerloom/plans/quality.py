"""Vendor quality rules and the issue log."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas, values
from ledgerloom.functions.text import is_blank, is_email, normalize_name, strip
from ledgerloom.operators.groups import first_of, join_repeated
from ledgerloom.operators.skew import HOT_ROWS
from ledgerloom.rules import Rules

ISSUES = "_issues"


def issue(
    rule_id: str,
    severity: str,
    field: str,
    bad_value: Column,
    status: Column | None = None,
    blocking: bool = True,
) -> Column:
    """An issue of the current vendor as a struct of all issue fields but the time, which is one for the run
    (`as_issues` adds it); open and blocking unless said."""
    record = {
        "RuleID": F.lit(rule_id),
        "RuleDescription": F.lit(values.RULE_DESCRIPTIONS[rule_id]),
        "Severity": F.lit(severity),
        "Entity": F.lit(values.VENDOR_ENTITY),
        "RecordKey": F.col("VendorCode"),
        "FieldName": F.lit(field),
        "BadValue": bad_value,
        "Status": F.lit(values.OPEN) if status is None else status,
        "IsBlocking": F.lit(blocking),
    }
    return F.struct(*[value.alias(name) for name, value in record.items()])


def as_issues(records: DataFrame, detected_at: datetime.datetime | None = None) -> DataFrame:
    """The ten-column issue table from a frame of issue records."""
    moment = F.current_timestamp() if detected_at is None else F.lit(detected_at)
    return records.withColumn("DetectedAt", moment).to(schemas.ISSUE)


def no_issues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.ISSUE)


def vendor_row_rules(rules: Rules) -> list[Column]:
    """One column per row rule: an issue struct, or NULL where the vendor passes."""
    raw = {name: F.col(name) for name in ("TaxID", "Currency", "Email")}
    terms = strip(F.col("PaymentTerms"))
    fixed = rules.fixed_terms(terms)
    odd_terms = ~terms.isin(*rules.payment_terms)
    auto_fixed = F.concat(F.lit(values.AUTO_FIXED), fixed)
    return [
        F.when(is_blank(raw["TaxID"]), issue("VEN-001", values.HIGH, "TaxID", raw["TaxID"])),
        F.when(
            ~raw["Currency"].isin(*rules.currencies),
            issue("VEN-002", values.HIGH, "Currency", raw["Currency"]),
        ),
        F.when(
            ~is_email(strip(raw["Email"])),
            issue("VEN-003", values.LOW, "Email", raw["Email"], blocking=False),
        ),
        F.when(
            odd_terms & fixed.isNotNull(),
            issue("VEN-004", values.LOW, "PaymentTerms", terms, status=auto_fixed, blocking=False),
        ).when(odd_terms, issue("VEN-004", values.MEDIUM, "PaymentTerms", terms)),
    ]


def check_rows(df: DataFrame, rule_columns: Sequence[Column]) -> DataFrame:
    """Add the array of issues each row raises: any number of rules in one projection over one scan."""
    return df.withColumn(ISSUES, F.filter(F.array(*rule_columns), lambda found: found.isNotNull()))


def standard_terms(vendors: DataFrame, rules: Rules) -> DataFrame:
    """Replace known legacy payment terms; a valid term that is merely padded is left as it is."""
    terms = strip(F.col("PaymentTerms"))
    fixed = F.when(~terms.isin(*rules.payment_terms), rules.fixed_terms(terms))
    return vendors.withColumn("PaymentTerms", F.coalesce(fixed, F.col("PaymentTerms")))


def validate_vendors(vendors: DataFrame, rules: Rules) -> DataFrame:
    """Vendors with standard terms and their row issues; the input frame is unchanged.

    Staged text has '' for a missing value. A NULL from another source is taken as the same.
    """
    return standard_terms(check_rows(vendors.na.fill(""), vendor_row_rules(rules)), rules)


def row_issues(checked: DataFrame, detected_at: datetime.datetime | None = None) -> DataFrame:
    return as_issues(checked.select(F.inline(ISSUES)), detected_at)


def dedupe_by_key(
    df: DataFrame, key: str, order_by: str, id_column: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add `SurvivorCode`: for rows that share a non-blank `key`, the id of the earliest; else the row's own.

    Keys are compared as they stand. Rows without a key stay out of the shuffle.
    """
    keyed = df.filter(~is_blank(F.col(key)))
    survivor = first_of([order_by, id_column], "_survivor")
    merged = join_repeated(keyed, [key], [survivor], id_column, how="left", hot_rows=hot_rows)
    return merged.select(
        *df.columns, F.coalesce("_survivor", F.col(id_column)).alias("SurvivorCode")
    ).unionByName(df.filter(is_blank(F.col(key))).withColumn("SurvivorCode", F.col(id_column)))


def duplicate_key_issues(
    survivors: DataFrame, detected_at: datetime.datetime | None = None
) -> DataFrame:
    """One non-blocking issue per merged vendor."""
    found = issue(
        "VEN-005",
        values.HIGH,
        "TaxID",
        F.col("TaxID"),
        status=F.concat(F.lit(values.MERGED_INTO), F.col("SurvivorCode")),
        blocking=False,
    )
    merged = survivors.filter(F.col("VendorCode") != F.col("SurvivorCode"))
    return as_issues(merged.select(found.alias("issue")).select("issue.*"), detected_at)


def duplicate_name_issues(
    survivors: DataFrame, detected_at: datetime.datetime | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One blocking issue per survivor that shares its normalised name with an earlier one; nothing is merged."""
    alone = survivors.filter(F.col("VendorCode") == F.col("SurvivorCode")).select(
        "VendorCode", "VendorName", "CreatedDate", normalize_name(F.col("VendorName")).alias("_name")
    )
    first = first_of(["CreatedDate", "VendorCode"], "_first")
    named = join_repeated(alone, ["_name"], [first], "VendorCode", hot_rows=hot_rows)
    both = F.format_string(values.NAME_AND_FIRST, F.col("VendorName"), F.col("_first"))
    found = issue("VEN-006", values.MEDIUM, "VendorName", both)
    later = named.filter(F.col("VendorCode") != F.col("_first"))
    return as_issues(later.select(found.alias("issue")).select("issue.*"), detected_at)


def all_issues(
    survivors: DataFrame, detected_at: datetime.datetime | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Row rules, then duplicate keys, then duplicate names, as one table."""
    return (
        row_issues(survivors, detected_at)
        .unionByName(duplicate_key_issues(survivors, detected_at))
        .unionByName(duplicate_name_issues(survivors, detected_at, hot_rows))
    )


def blocking_issues(survivors: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The issues that keep a vendor from migrating: of the rules that can block, so no merged vendor is looked at."""
    found = row_issues(survivors).unionByName(duplicate_name_issues(survivors, hot_rows=hot_rows))
    return found.filter("IsBlocking")

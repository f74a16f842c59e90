"""CSV files for the target system and for the data owners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.values import READY


def import_rows(golden: DataFrame) -> DataFrame:
    """The accounts that are ready to load, in legacy-code order."""
    return (
        golden.filter(F.col("MigrationStatus") == READY)
        .orderBy("VendorCode")
        .select(F.col("VendorAccount").alias("VENDORACCOUNTNUMBER"))
    )


def exception_rows(issues: DataFrame) -> DataFrame:
    """Blocking issues, all ten fields as text: `True`/`False`, and a time to the second."""
    return (
        issues.filter("IsBlocking")
        .withColumn("IsBlocking", F.when(F.col("IsBlocking"), "True").otherwise("False"))
        .withColumn("DetectedAt", F.date_format("DetectedAt", "yyyy-MM-dd'T'HH:mm:ss"))
    )


def _write_csv(df: DataFrame, path: str, single_file: bool) -> None:
    if single_file:
        df = df.coalesce(1)
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    options = {"header": True, "emptyValue": "", "escape": '"', **spaces}
    df.write.mode("overwrite").options(**options).csv(path)


def write_import_file(golden: DataFrame, path: str, single_file: bool = False) -> None:
    """Part files in order. `single_file` only where the receiving system takes one file."""
    _write_csv(import_rows(golden), path, single_file)


def write_exceptions_file(issues: DataFrame, path: str, single_file: bool = False) -> None:
    """Row rules first by record, then possible duplicates."""
    ordered = issues.orderBy(F.col("RuleID") == "VEN-006", "RecordKey", "RuleID")
    _write_csv(exception_rows(ordered), path, single_file)

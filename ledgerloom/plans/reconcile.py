"""Do the stages agree, and what did not resolve?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lookups import orphans, table_counts
from ledgerloom.values import MERGED, UNKNOWN


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    return table_counts(tables, expected)


# Each fact and the staged table whose rows it must have.
FACTS = {
    "fact_po_line": "stg_po_line",
    "fact_receipt": "stg_receipt",
    "fact_invoice": "stg_invoice",
    "fact_three_way_match": "stg_invoice",
}


def fact_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each fact against the rows staged for it, from stored tables. A match short of invoices is reported here."""
    counts = None
    for fact, source in FACTS.items():
        rows, expected = tables[fact].agg(F.count(F.lit(1)).alias("n")), tables[source].agg(F.count(F.lit(1)).alias("n"))
        name, none = F.lit(fact).alias("table_name"), F.lit(None).cast("long")
        pair = rows.select(name, F.col("n").alias("Rows"), none.alias("Expected")).unionByName(
            expected.select(name, none.alias("Rows"), F.col("n").alias("Expected"))
        )
        counts = pair if counts is None else counts.unionByName(pair)
    both = counts.groupBy("table_name").agg(F.max("Rows").alias("Rows"), F.max("Expected").alias("Expected"))
    return both.withColumn("Agrees", F.col("Rows") == F.col("Expected"))


def orphan_vendors(po_lines: DataFrame, xref: DataFrame) -> DataFrame:
    """PO lines whose legacy vendor code is not in the cross-reference."""
    found = orphans(po_lines, "VendorAccount", xref, "LegacyVendorCode")
    return found.select("PurchaseOrderNumber", "LineNumber", "VendorAccount")


def orphan_items(po_lines: DataFrame, items: DataFrame) -> DataFrame:
    """PO lines whose item is not in the item master."""
    found = orphans(po_lines, "ItemNumber", items, "ItemNumber")
    return found.select("PurchaseOrderNumber", "LineNumber", "ItemNumber")


def merged_code_lines(po_lines: DataFrame, xref: DataFrame) -> DataFrame:
    """PO lines per merged legacy code and its account, most first: what the cross-reference rescued.

    The lines are counted by code before the join, so a code with any number of lines joins as one row.
    """
    per_code = po_lines.groupBy(F.col("VendorAccount").alias("LegacyVendorCode")).agg(
        F.count(F.lit(1)).alias("count_lines")
    )
    merged = xref.filter(F.col("MatchType") == MERGED)
    return (
        per_code.join(merged, "LegacyVendorCode")
        .groupBy("LegacyVendorCode", "VendorAccount")
        .agg(F.sum("count_lines").alias("count_lines"))
        .orderBy(F.desc("count_lines"), "LegacyVendorCode", "VendorAccount")
    )


def unknown_lines(fact: DataFrame, key: str) -> DataFrame:
    """Number of lines on the Unknown member; no row when there is none."""
    return fact.filter(F.col(key) == UNKNOWN).groupBy(key).agg(F.count(F.lit(1)).alias("line_count"))


def unmatched_invoices(invoices: DataFrame, po_lines: DataFrame) -> DataFrame:
    """Invoice lines without a PO line, which the match leaves out."""
    return invoices.join(po_lines.select("POLineKey"), "POLineKey", "left_anti")

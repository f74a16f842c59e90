"""Dimensions with Unknown members, and facts with resolved keys."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import values
from ledgerloom.functions import numbers
from ledgerloom.functions.dates import calendar_columns
from ledgerloom.functions.text import line_key
from ledgerloom.operators.appending import number_more
from ledgerloom.operators.lookups import append_member, resolve
from ledgerloom.sources.calendar import FIRST_DAY, LAST_DAY, date_rows

# What invoice lines are numbered by, before their other columns.
INVOICE_ORDER = ["InvoiceNumber", "PurchaseOrderNumber", "LineNumber"]
INVOICE_VALUES = ["InvoiceQty", "InvoiceUnitPrice", "InvoiceAmount", "InvoiceDate"]


def dim_vendor(golden: DataFrame) -> DataFrame:
    columns = golden.select(
        "VendorAccount",
        F.col("VendorCode").alias("LegacyVendorCode"),
        "VendorName",
        "TaxID",
        "Country",
        "Currency",
        "PaymentTerms",
        "Email",
        "Status",
        "MigrationStatus",
    )
    return append_member(
        columns,
        {
            "VendorAccount": values.UNKNOWN,
            "VendorName": values.UNKNOWN_VENDOR_NAME,
            "MigrationStatus": values.EXCEPTION,
        },
    )


def dim_item(items: DataFrame) -> DataFrame:
    columns = items.select(
        "ItemNumber",
        "Description",
        "ItemGroup",
        "UoM",
        F.col("StandardCost").cast(numbers.COST).alias("StandardCost"),
    )
    return append_member(
        columns,
        {
            "ItemNumber": values.UNKNOWN,
            "Description": values.UNKNOWN_ITEM_DESCRIPTION,
            "ItemGroup": values.UNKNOWN,
        },
    )


def dim_date(
    spark: SparkSession, first: datetime.date = FIRST_DAY, last: datetime.date = LAST_DAY
) -> DataFrame:
    return calendar(date_rows(spark, first, last))


def calendar(days: DataFrame) -> DataFrame:
    """Date parts for frames with a `Date` column."""
    return days.select(*calendar_columns(F.col("Date")))


def typed_po_lines(po_lines: DataFrame) -> DataFrame:
    """PO lines with their key and typed measures; vendor and item are still the staged codes."""
    return po_lines.select(
        line_key(F.col("PurchaseOrderNumber"), F.col("LineNumber")).alias("POLineKey"),
        "PurchaseOrderNumber",
        "LineNumber",
        "VendorAccount",
        "ItemNumber",
        F.col("OrderDate").cast("date").alias("OrderDate"),
        "Site",
        F.col("OrderedQuantity").cast(numbers.QUANTITY).alias("OrderedQty"),
        F.col("UnitPrice").cast(numbers.PRICE).alias("UnitPrice"),
        numbers.amount(F.col("OrderedQuantity"), F.col("UnitPrice")).alias("POAmount"),
    )


def with_known_item(lines: DataFrame, items: DataFrame) -> DataFrame:
    """The lines with an item of the master or the Unknown member."""
    known = resolve(lines, "ItemNumber", items, "ItemNumber", "ItemNumber", "_item")
    return known.withColumn("ItemNumber", F.col("_item")).select(*lines.columns)


def fact_po_line(po_lines: DataFrame, xref: DataFrame, items: DataFrame) -> DataFrame:
    """PO lines with the new vendor account and a known item; the legacy vendor code is not kept.

    The staged rows go through the lookups, which may move them; keys and amounts are made of what comes out.
    """
    vendors = resolve(po_lines, "VendorAccount", xref, "LegacyVendorCode", "VendorAccount", "_vendor")
    known = with_known_item(vendors.withColumn("VendorAccount", F.col("_vendor")).select(*po_lines.columns), items)
    return typed_po_lines(known)


def fact_receipt(receipts: DataFrame) -> DataFrame:
    return receipts.select(
        "ReceiptNumber",
        line_key(F.col("PurchaseOrderNumber"), F.col("LineNumber")).alias("POLineKey"),
        F.col("ReceivedQuantity").cast(numbers.QUANTITY).alias("ReceivedQty"),
        F.col("ReceiptDate").cast("date").alias("ReceiptDate"),
    )


def fact_invoice(invoices: DataFrame, xref: DataFrame, arrival: str | None = None, after: int = 0) -> DataFrame:
    """Invoice lines with the new vendor account, their PO line's key, typed amounts and `InvoiceLineID`, as a stored table.

    The vendor is resolved on the way to the sort that numbers the lines, so the rows are stored once, ready for
    the match; the key is made after the sort. See `number_rows` for `arrival`; the numbers go on after `after`.
    """
    vendors = resolve(invoices, "VendorAccount", xref, "LegacyVendorCode", "VendorAccount", "_vendor")
    typed = vendors.select(
        *INVOICE_ORDER,
        F.col("_vendor").alias("VendorAccount"),
        F.col("InvoiceQuantity").cast(numbers.QUANTITY).alias("InvoiceQty"),
        F.col("InvoiceUnitPrice").cast(numbers.PRICE).alias("InvoiceUnitPrice"),
        numbers.amount(F.col("InvoiceQuantity"), F.col("InvoiceUnitPrice")).alias("InvoiceAmount"),
        F.col("InvoiceDate").cast("date").alias("InvoiceDate"),
        *([arrival] if arrival else []),
    )
    key = {"POLineKey": line_key(F.col("PurchaseOrderNumber"), F.col("LineNumber"))}
    numbered = number_more(typed, INVOICE_ORDER, "InvoiceLineID", after, arrival, INVOICE_ORDER[1:], ["InvoiceAmount"], key)
    return numbered.select("InvoiceLineID", "InvoiceNumber", "VendorAccount", "POLineKey", *INVOICE_VALUES)

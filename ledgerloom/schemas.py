"""Column lists and types of the staged and governed tables."""

from __future__ import annotations

from pyspark.sql import types as T

VENDOR_COLUMNS = (
    "VendorCode",
    "VendorName",
    "TaxID",
    "Country",
    "Currency",
    "PaymentTerms",
    "Email",
    "Status",
    "CreatedDate",
)

ITEM_COLUMNS = ("ItemNumber", "Description", "ItemGroup", "UoM", "StandardCost")

PO_LINE = T.StructType(
    [
        T.StructField("PurchaseOrderNumber", T.StringType()),
        T.StructField("LineNumber", T.LongType()),
        T.StructField("VendorAccount", T.StringType()),
        T.StructField("ItemNumber", T.StringType()),
        T.StructField("OrderedQuantity", T.LongType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("OrderDate", T.StringType()),
        T.StructField("Site", T.StringType()),
    ]
)

RECEIPT = T.StructType(
    [
        T.StructField("ReceiptNumber", T.StringType()),
        T.StructField("PurchaseOrderNumber", T.StringType()),
        T.StructField("LineNumber", T.LongType()),
        T.StructField("ReceivedQuantity", T.LongType()),
        T.StructField("ReceiptDate", T.StringType()),
    ]
)

INVOICE = T.StructType(
    [
        T.StructField("InvoiceNumber", T.StringType()),
        T.StructField("VendorAccount", T.StringType()),
        T.StructField("PurchaseOrderNumber", T.StringType()),
        T.StructField("LineNumber", T.LongType()),
        T.StructField("InvoiceQuantity", T.LongType()),
        T.StructField("InvoiceUnitPrice", T.DoubleType()),
        T.StructField("InvoiceDate", T.StringType()),
    ]
)

ENTITIES = {
    "stg_po_line": ("PurchaseOrderLines", PO_LINE),
    "stg_receipt": ("ProductReceiptLines", RECEIPT),
    "stg_invoice": ("VendorInvoiceLines", INVOICE),
}

ISSUE = T.StructType(
    [
        T.StructField("RuleID", T.StringType()),
        T.StructField("RuleDescription", T.StringType()),
        T.StructField("Severity", T.StringType()),
        T.StructField("Entity", T.StringType()),
        T.StructField("RecordKey", T.StringType()),
        T.StructField("FieldName", T.StringType()),
        T.StructField("BadValue", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("IsBlocking", T.BooleanType()),
        T.StructField("DetectedAt", T.TimestampType()),
    ]
)

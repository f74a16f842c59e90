"""Three-way match: one status for every invoice line that has a PO line.

The usual PO line has a few invoice lines. All of that work shares one shuffle of the invoices by PO line: both
windows and the joins use it. PO lines with so many invoice lines that one task could not hold them are found
first and go a second way, in slices; the two results are united.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import values
from ledgerloom.functions import numbers
from ledgerloom.operators.numbering import number_rows
from ledgerloom.operators.running import SLICE_ROWS, running_sum, running_sum_sliced
from ledgerloom.operators.skew import HOT_ROWS, SAMPLE, hot_keys
from ledgerloom.rules import PRICE_TOLERANCE
from ledgerloom.storage import materialize

LINE = ["POLineKey"]
COPY = ["POLineKey", "VendorAccount", "InvoiceNumber"]
ORDER = ("InvoiceLineID",)

MATCH_COLUMNS = (
    "InvoiceLineID",
    "InvoiceNumber",
    "VendorAccount",
    "POLineKey",
    "InvoiceDate",
    "ItemNumber",
    "OrderedQty",
    "POUnitPrice",
    "ReceivedQty",
    "InvoiceQty",
    "InvoiceUnitPrice",
    "InvoiceAmount",
    "PriceVariancePct",
    "PriceVarianceAmount",
    "MatchStatus",
)


def receipt_totals(receipts: DataFrame) -> DataFrame:
    """Received quantity per PO line."""
    return receipts.groupBy("POLineKey").agg(F.sum("ReceivedQty").alias("ReceivedQty"))


def _first_copy_qty() -> Column:
    return F.when(F.col("DupRank") == 1, F.col("InvoiceQty")).otherwise(F.lit(0).cast(numbers.QUANTITY))


def _usual(invoices: DataFrame, order_by: Sequence[str] = ORDER) -> DataFrame:
    return _in_place(invoices.repartition(*LINE), order_by)


def _in_place(together: DataFrame, order_by: Sequence[str] = ORDER) -> DataFrame:
    """For invoices that are partitioned by PO line.

    Copies agree in the columns that make them copies, so those order none of them; named in the order of `order_by`, where
    it begins with them, they let both sums use one sort.
    """
    copy = [*LINE, *[c for c in order_by if c in COPY[1:]], *[c for c in COPY[1:] if c not in order_by]]
    within = [c for c in order_by if c not in COPY] or list(order_by)
    ranked = running_sum(together, copy, within, F.lit(1), "DupRank")
    return running_sum(ranked, LINE, order_by, _first_copy_qty(), "CumInvoicedQty")


def _sliced(invoices: DataFrame, slice_rows: int, order_by: Sequence[str] = ORDER) -> DataFrame:
    order = order_by[0]
    if len(order_by) > 1:
        order = "_order"
        invoices = number_rows(invoices, order_by, order, derived=["POLineKey", "InvoiceAmount"])
    ranked = running_sum_sliced(invoices, COPY, order, F.lit(1), "DupRank", slice_rows)
    # The second sum reads its input twice.
    ranked = materialize(ranked, "ranked")
    return running_sum_sliced(ranked, LINE, order, _first_copy_qty(), "CumInvoicedQty", slice_rows)


def with_running_quantities(
    invoices: DataFrame,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
    fraction: float = SAMPLE,
) -> DataFrame:
    """Add `DupRank`, the copy number of a line of one vendor's invoice, and `CumInvoicedQty`, the quantity
    invoiced on the PO line so far by first copies of any vendor."""
    hot = hot_keys(invoices, LINE, hot_rows, fraction)
    if hot.isEmpty():
        return _usual(invoices)
    rest = _usual(invoices.join(hot, LINE, "left_anti"))
    split = _sliced(invoices.join(hot, LINE, "left_semi"), slice_rows)
    return rest.unionByName(split).select(*invoices.columns, "DupRank", "CumInvoicedQty")


def price_is_off(invoice_price: Column, po_price: Column, tolerance: Decimal = PRICE_TOLERANCE) -> Column:
    """|invoice − PO| / PO above the tolerance, unrounded, written without the division.

    Against a PO price of zero any other price is off; dividing would fail the whole run for one such line.
    """
    gap = F.abs(invoice_price - po_price)
    above = (po_price > 0) & (gap > F.lit(tolerance) * po_price)
    return above | ((po_price == 0) & (gap > 0))


def _statuses(
    ranked: DataFrame, po_lines: DataFrame, totals: DataFrame, tolerance: Decimal, carried: Sequence[str]
) -> DataFrame:
    orders = po_lines.select("POLineKey", "ItemNumber", "OrderedQty", F.col("UnitPrice").alias("POUnitPrice"))
    lines = ranked.join(orders, "POLineKey").join(totals, "POLineKey", "left")
    received = F.coalesce("ReceivedQty", F.lit(0).cast(numbers.QUANTITY))
    invoice_price, po_price = F.col("InvoiceUnitPrice"), F.col("POUnitPrice")
    gap = invoice_price - po_price
    status = (
        F.when(F.col("DupRank") > 1, values.DUPLICATE)
        .when(F.col("VendorAccount") == values.UNKNOWN, values.UNKNOWN_VENDOR)
        .when(received == 0, values.NO_RECEIPT)
        .when(F.col("CumInvoicedQty") > received, values.QTY_VARIANCE)
        .when(price_is_off(invoice_price, po_price, tolerance), values.PRICE_VARIANCE)
        .otherwise(values.MATCHED)
    )
    return lines.select(
        "*",
        received.alias("_received"),
        F.try_divide(gap, po_price).cast(numbers.PERCENT).alias("PriceVariancePct"),
        (gap * F.col("InvoiceQty")).cast(numbers.AMOUNT).alias("PriceVarianceAmount"),
        status.alias("MatchStatus"),
    ).select(*[F.col("_received").alias(c) if c == "ReceivedQty" else c for c in MATCH_COLUMNS], *carried)


def three_way_match(
    invoices: DataFrame,
    po_lines: DataFrame,
    receipts: DataFrame,
    tolerance: Decimal = PRICE_TOLERANCE,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
    fraction: float = SAMPLE,
    carried: Sequence[str] = (),
    order_by: Sequence[str] = ORDER,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The match table. Invoice lines without a PO line are left out (`reconcile.unmatched_invoices` has them).

    `po_lines` must have one row per `POLineKey`. `PriceVariancePct` is NULL against a PO price of zero. Columns of the
    invoices named in `carried` go along. Invoice lines rank in the order of their numbers, or of the columns `order_by`,
    which must tell them all apart. `hot` gives the hot PO lines where they are known already.
    """
    totals = receipt_totals(receipts)
    if hot is None:
        hot = hot_keys(invoices, LINE, hot_rows, fraction)
    if hot.isEmpty():
        return _statuses(_usual(invoices, order_by), po_lines, totals, tolerance, carried)
    rest = _statuses(_usual(invoices.join(hot, LINE, "left_anti"), order_by), po_lines, totals, tolerance, carried)
    # One PO line and one total per hot key, so these are about as few as the keys; stored, they have a known size.
    hot_lines = materialize(po_lines.join(hot, LINE, "left_semi"), "hot_lines")
    hot_receipts = receipt_totals(receipts.join(hot, LINE, "left_semi"))
    hot_totals = materialize(hot_receipts, "hot_totals")
    split = _sliced(invoices.join(hot, LINE, "left_semi"), slice_rows, order_by)
    return rest.unionByName(_statuses(split, hot_lines, hot_totals, tolerance, carried))


def match_in_place(
    invoices: DataFrame, po_lines: DataFrame, receipts: DataFrame, tolerance: Decimal = PRICE_TOLERANCE
) -> DataFrame:
    """The match of facts that are stored in equal buckets by PO line (`sinks.together`) and have no hot one."""
    return _statuses(_in_place(invoices), po_lines, receipt_totals(receipts), tolerance, ())


def match_in_slices(
    invoices: DataFrame,
    po_lines: DataFrame,
    receipts: DataFrame,
    tolerance: Decimal = PRICE_TOLERANCE,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The match of hot PO lines alone: few keys with any number of rows each."""
    return _statuses(_sliced(invoices, slice_rows), po_lines, receipt_totals(receipts), tolerance, ())


def status_summary(match: DataFrame) -> DataFrame:
    """Lines, amount and share of all lines per status, most lines first."""
    by_status = match.groupBy("MatchStatus").agg(
        F.count(F.lit(1)).alias("InvoiceLines"), F.sum("InvoiceAmount").alias("Amount")
    )
    # Six rows at most, so the window without a partition is over a fixed size.
    everything = F.sum("InvoiceLines").over(Window.partitionBy())
    share = numbers.share_of(F.col("InvoiceLines"), everything)
    return by_status.withColumn("PctOfLines", share).orderBy(F.desc("InvoiceLines"), "MatchStatus")

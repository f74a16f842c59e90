"""The whole run over staged tables: govern, model, match."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from ledgerloom.operators.lookups import referred, require_unique
from ledgerloom.operators.numbering import with_arrival
from ledgerloom.operators.skew import hot_keys
from ledgerloom.plans import match, reconcile, star
from ledgerloom.plans.master import govern_vendors
from ledgerloom.rules import Rules
from ledgerloom.runlog import RunLog
from ledgerloom.sinks.table_set import TableSet, Version
from ledgerloom.sinks.tables import AUDIT_COLUMNS, load_tables
from ledgerloom.sources.calendar import date_rows, date_rows_covering
from ledgerloom.storage import materialize, scratch_of_a_run, shuffles_end_with_writes


def require_unique_keys(staged: dict[str, DataFrame]) -> None:
    """Masters and PO lines must have unique keys, or facts would multiply. The cross-reference has one row a vendor."""
    require_unique(staged["stg_vendor"], ["VendorCode"], "stg_vendor")
    require_unique(staged["stg_item"], ["ItemNumber"], "stg_item")
    require_unique(staged["stg_po_line"], ["PurchaseOrderNumber", "LineNumber"], "stg_po_line")


def _calendar_days(staged: dict[str, DataFrame], calendar: tuple[datetime.date, datetime.date] | None) -> DataFrame:
    if calendar is not None:
        return date_rows(staged["stg_po_line"].sparkSession, *calendar)
    dated = {"stg_po_line": "OrderDate", "stg_receipt": "ReceiptDate", "stg_invoice": "InvoiceDate"}
    return date_rows_covering([(staged[table], column) for table, column in dated.items()])


def dimensions_and_facts(
    staged: dict[str, DataFrame],
    governed: dict[str, DataFrame],
    calendar: tuple[datetime.date, datetime.date] | None = None,
) -> dict[str, DataFrame]:
    """Three dimensions and three facts from stored tables. Masters and PO lines must have unique keys.

    The calendar spans the given days, without them the planning calendar and every date of the facts.
    """
    items, po_lines, invoices = staged["stg_item"], staged["stg_po_line"], staged["stg_invoice"]
    named = [(po_lines, "VendorAccount"), (invoices, "VendorAccount")]
    xref = referred(governed["vendor_xref"], "LegacyVendorCode", "VendorAccount", named)
    return {
        "dim_vendor": star.dim_vendor(governed["vendor_golden"]),
        "dim_item": star.dim_item(items),
        "dim_date": star.calendar(_calendar_days(staged, calendar)),
        "fact_po_line": star.fact_po_line(po_lines, xref, items),
        "fact_receipt": star.fact_receipt(staged["stg_receipt"]),
        "fact_invoice": star.fact_invoice(with_arrival(invoices), xref, arrival="_arrival"),
    }


def run(
    staged: dict[str, DataFrame],
    warehouse: str | None,
    rules: Rules | None = None,
    started_at: datetime.datetime | None = None,
    run_log: RunLog | None = None,
    staged_source: str = "LegacyERP+ProcurementAPI",
    governed_source: str = "MasterData",
    calendar: tuple[datetime.date, datetime.date] | None = None,
) -> dict[str, DataFrame]:
    """Full reload: staged, governed and modelled tables, every one replaced and audited.

    They are parquet folders under `warehouse`, or catalog tables without one. Each stage reads the tables the stage
    before it wrote. One timestamp serves the whole run. Keys are checked before the first table is replaced. The
    last two tables say what was left out: invoice lines without a PO line, and rows per fact against rows staged.

    Invoices are stored in buckets by PO line, so the match and what it leaves out read them where they lie; with hot PO
    lines they are stored as they come, and the match moves and splits them. What a stage keeps for itself goes when its
    tables are there.
    """
    rules = rules or Rules()
    started_at = started_at or datetime.datetime.now().replace(microsecond=0)
    done: dict[str, DataFrame] = {}

    def load(tables: dict[str, DataFrame], source: str, together: tuple[str, ...] = ()) -> None:
        loaded = load_tables(tables, warehouse, source, run_log, started_at, together, match.LINE)
        for name, written in loaded.items():
            done[name] = written.drop(*AUDIT_COLUMNS)

    spark = staged["stg_po_line"].sparkSession
    with shuffles_end_with_writes(spark):
        with scratch_of_a_run(spark):
            # Stored first, so that what leads to the PO lines runs once, and not for the check and again for the load.
            staged = {**staged, "stg_po_line": materialize(staged["stg_po_line"], "stg_po_line")}
            require_unique_keys(staged)
            load(staged, staged_source)
        with scratch_of_a_run(spark):
            load(govern_vendors(done["stg_vendor"], rules, started_at), governed_source)
        with scratch_of_a_run(spark):
            modelled = dimensions_and_facts(done, done, calendar)
            hot = hot_keys(modelled["fact_invoice"], match.LINE)
            any_hot = not hot.isEmpty()
            load(modelled, governed_source, () if any_hot else ("fact_invoice",))
            facts = done["fact_invoice"], done["fact_po_line"], done["fact_receipt"]
            if any_hot:
                matched = match.three_way_match(*facts, rules.price_tolerance, hot=hot)
            else:
                matched = match.match_in_place(*facts, rules.price_tolerance)
            load({"fact_three_way_match": matched}, governed_source)
            left_out = reconcile.unmatched_invoices(done["fact_invoice"], done["fact_po_line"])
            load({"unmatched_invoice": left_out}, governed_source)
            load({"reconciliation": reconcile.fact_counts(done)}, governed_source)
    return done


def publish_run(staged: dict[str, DataFrame], tables: TableSet, **options) -> Version:
    """`run` into a folder of its own, made the set's next version when the last table is there.

    Readers of the set see the tables of one run, all of them or none; a run that stops changes nothing for them.
    """
    writing = tables.begin()
    done = run(staged, writing.folder, **options)
    return writing.publish(replaced=done)

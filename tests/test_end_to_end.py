"""The whole run over a small extract with every kind of fault, its results worked out by hand."""

import datetime
from decimal import Decimal as D

import pytest

from ledgerloom import schemas
from ledgerloom.plans import explore, kpis, match, reconcile
from ledgerloom.plans.run import run
from ledgerloom.runlog import RunLog
from ledgerloom.sinks import files
from ledgerloom.sources.registry import stage_all
from test_main import write_csv, write_pages

VENDORS = [
    ("L01", "Acme Inc", "US-1", "US", "USD", "Net30", "ap@acme.com", "Active", "2018-01-01"),
    ("L02", "Bolt GmbH", "DE-2", "DE", "EUR", "N45", "ap@bolt.de", "Active", "2018-02-01"),
    ("L03", "Cargo LLC", "", "US", "USD", "Net30", "ap@cargo.com", "Active", "2018-03-01"),
    ("L04", "Delta Co", "US-4", "US", "COL", "Net30", "ap@delta.com", "Active", "2018-04-01"),
    ("L05", "Echo S.A.", "CR-5", "CR", "CRC", "2% 10 Net 30", "ap@echo.cr", "Active", "2018-05-01"),
    ("L06", "Fox Ltd", "US-6", "US", "USD", "Net60", "", "Active", "2018-06-01"),
    ("L07", "Golf", "US-7", "US", "USD", "Net15", "ask", "Active", "2018-07-01"),
    ("L08", "ACME", "US-8", "US", "USD", "Net30", "ap@acme.org", "Active", "2020-01-01"),
    ("L09", "Bolt Tools", "DE-2", "DE", "EUR", "Net45", "ap@bolt.de", "Blocked", "2019-01-01"),
    ("L10", "Golf Clubs", "US-7", "US", "USD", "Net15", "ap@golf.com", "Active", "2017-01-01"),
]
ITEMS = [("I1", "Bolt", "HARDWARE", "EA", "1.5"), ("I2", "Nut", "HARDWARE", "EA", "0.5"), ("I3", "Drill", "TOOLS", "EA", "9")]
ORDERS = [
    ("P1", 1, "L01", "I1", 100, 150.0, "2025-01-10", "S1"),
    ("P1", 2, "L01", "I2", 10, 20.5, "2025-01-10", "S1"),
    ("P2", 1, "L09", "I3", 40, 300.0, "2025-02-01", "S2"),
    ("P3", 1, "L99", "I1", 5, 10.0, "2025-02-15", "S1"),
    ("P4", 1, "L03", "I9", 8, 100.0, "2025-03-01", "S2"),
    ("P5", 1, "L07", "I2", 30, 45.0, "2025-03-10", "S2"),
    ("P6", 1, "L06", "I1", 4, 2600.0, "2025-03-20", "S1"),
]
RECEIPTS = [
    ("R1", "P1", 1, 60, "2025-01-20"),
    ("R2", "P1", 1, 40, "2025-01-21"),
    ("R3", "P1", 2, 10, "2025-01-21"),
    ("R4", "P2", 1, 30, "2025-02-10"),
    ("R5", "P3", 1, 5, "2025-02-20"),
    ("R6", "P5", 1, 30, "2025-03-15"),
    ("R7", "P6", 1, 0, "2025-03-25"),
]
BILLS = [
    ("B1", "L01", "P1", 1, 100, 150.0, "2025-01-25"),
    ("B2", "L01", "P1", 2, 10, 21.52, "2025-01-25"),  # 4.98 % off
    ("B3", "L02", "P2", 1, 40, 300.0, "2025-02-12"),  # 30 received
    ("B4", "L99", "P3", 1, 5, 10.0, "2025-02-22"),
    ("B5", "L03", "P4", 1, 8, 100.0, "2025-03-05"),  # nothing received
    ("B6", "L07", "P5", 1, 10, 45.0, "2025-03-16"),
    ("B6", "L10", "P5", 1, 10, 45.0, "2025-03-17"),  # the same vendor under its other code
    ("B7", "L10", "P5", 1, 10, 50.0, "2025-03-18"),  # 11 % off
    ("B8", "L06", "P6", 1, 4, 3000.0, "2025-03-28"),  # a receipt of nothing, and 15 % off
    ("B9", "L01", "P7", 1, 1, 5.0, "2025-04-01"),  # no such order
]
COUNTS = {
    "stg_vendor": 10,
    "stg_item": 3,
    "stg_po_line": 7,
    "stg_receipt": 7,
    "stg_invoice": 10,
    "vendor_golden": 8,
    "vendor_xref": 10,
    "dq_issues": 9,
    "dim_vendor": 9,
    "dim_item": 4,
    "dim_date": 730,
    "fact_po_line": 7,
    "fact_receipt": 7,
    "fact_invoice": 10,
    "fact_three_way_match": 9,
    "unmatched_invoice": 1,
    "reconciliation": 4,
}


@pytest.fixture(scope="module")
def log():
    return RunLog()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, log):
    folder = tmp_path_factory.mktemp("extract")
    write_csv(folder / "legacy_vendors.csv", schemas.VENDOR_COLUMNS, VENDORS)
    write_csv(folder / "legacy_items.csv", schemas.ITEM_COLUMNS, ITEMS)
    for table, rows in (("stg_po_line", ORDERS), ("stg_receipt", RECEIPTS), ("stg_invoice", BILLS)):
        write_pages(folder, table, rows, size=3)
    staged = stage_all(spark, str(folder), str(folder))
    moment = datetime.datetime(2026, 1, 2, 3, 4, 5)
    return run(staged, str(tmp_path_factory.mktemp("warehouse")), started_at=moment, run_log=log)


def pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.select(*columns).collect()}


def test_row_counts(tables, spark, log):
    assert reconcile.row_counts(tables, COUNTS).filter("not Agrees").collect() == []
    assert pairs(log.frame(spark), "table_name", "row_count") == set(COUNTS.items())


def test_issues(tables):
    assert pairs(tables["dq_issues"], "RuleID", "RecordKey", "IsBlocking") == {
        ("VEN-001", "L03", True),
        ("VEN-002", "L04", True),
        ("VEN-003", "L06", False),
        ("VEN-003", "L07", False),
        ("VEN-004", "L02", False),
        ("VEN-004", "L05", True),
        ("VEN-005", "L07", False),
        ("VEN-005", "L09", False),
        ("VEN-006", "L08", True),
    }


def test_merges_go_to_the_oldest(tables):
    merged = tables["vendor_xref"].filter("MatchType <> 'Self'")
    assert pairs(merged, "LegacyVendorCode", "SurvivorCode", "VendorAccount") == {
        ("L07", "L10", "VEND-00008"),
        ("L09", "L02", "VEND-00002"),
    }


def test_match_summary(tables):
    summary = match.status_summary(tables["fact_three_way_match"]).collect()
    assert [(r.MatchStatus, r.InvoiceLines, r.Amount, r.PctOfLines) for r in summary] == [
        ("Matched", 3, D("15665.20"), D("33.3")),
        ("No receipt", 2, D("12800.00"), D("22.2")),
        ("Duplicate invoice", 1, D("450.00"), D("11.1")),
        ("Price variance", 1, D("500.00"), D("11.1")),
        ("Qty variance", 1, D("12000.00"), D("11.1")),
        ("Unknown vendor", 1, D("50.00"), D("11.1")),
    ]


def test_orphans_and_unknown(tables):
    po, xref, fact = tables["stg_po_line"], tables["vendor_xref"], tables["fact_po_line"]
    orphans = reconcile.orphan_vendors(po, xref)
    assert pairs(orphans, "PurchaseOrderNumber", "LineNumber", "VendorAccount") == {("P3", 1, "L99")}
    assert pairs(reconcile.orphan_items(po, tables["stg_item"]), "PurchaseOrderNumber", "ItemNumber") == {("P4", "I9")}
    assert reconcile.unknown_lines(fact, "VendorAccount").first().line_count == 1
    assert reconcile.unknown_lines(fact, "ItemNumber").first().line_count == 1
    lines = reconcile.merged_code_lines(po, xref).collect()
    assert [(r.LegacyVendorCode, r.count_lines) for r in lines] == [("L07", 1), ("L09", 1)]
    assert pairs(tables["unmatched_invoice"], "InvoiceNumber") == {("B9",)}
    assert pairs(tables["reconciliation"], "table_name", "Rows", "Expected", "Agrees") == {
        ("fact_po_line", 7, 7, True),
        ("fact_receipt", 7, 7, True),
        ("fact_invoice", 10, 10, True),
        ("fact_three_way_match", 9, 10, False),
    }


def test_measures(tables):
    ready = kpis.readiness(tables["vendor_golden"]).first()
    assert (ready.vendors, ready.ready, ready.exceptions) == (8, 4, 4)
    hold = kpis.amount_on_hold(tables["fact_three_way_match"]).first()
    assert (hold.lines_on_hold, hold.amount_on_hold) == (6, D("25800.00"))
    rescued = kpis.rescued_lines(tables["stg_po_line"], tables["vendor_xref"]).first()
    assert (rescued.po_lines, rescued.rescued_lines) == (7, 2)
    fact = tables["fact_po_line"]
    assert pairs(kpis.spend_by_site(fact), "Site", "spend") == {("S1", D("25655.00")), ("S2", D("14150.00"))}
    top = kpis.top_vendors(fact, tables["dim_vendor"]).collect()
    assert [(r.VendorAccount, r.spend) for r in top] == [
        ("VEND-00001", D("15205.00")),
        ("VEND-00002", D("12000.00")),
        ("VEND-00006", D("10400.00")),
        ("VEND-00008", D("1350.00")),
        ("VEND-00003", D("800.00")),
        ("UNKNOWN", D("50.00")),
    ]
    blocked = kpis.blocked_vendor_spend(fact, tables["dim_vendor"])
    assert pairs(blocked, "VendorAccount", "spend") == {("VEND-00003", D("800.00"))}
    second = kpis.secondary_price_issues(tables["fact_three_way_match"]).collect()
    assert [(r.InvoiceNumber, r.MatchStatus) for r in second] == [("B8", "No receipt")]
    months = kpis.monthly_spend(fact, tables["dim_date"])
    assert pairs(months, "YearMonth", "spend") == {
        ("2025-01", D("15205.00")),
        ("2025-02", D("12050.00")),
        ("2025-03", D("12550.00")),
    }


def test_questions(tables):
    fact = tables["fact_po_line"]
    assert explore.count_above(fact, "POAmount", 10000).first().row_count == 3
    assert explore.large_orders(fact).count() == 2
    assert explore.in_range(fact, "UnitPrice", 100, 500).count() == 3
    assert explore.in_list(fact, "LineNumber", [2]).count() == 1
    assert explore.not_in_list(fact, "LineNumber", [2]).count() == 6
    top = explore.top(fact, "POAmount", ["POLineKey"]).collect()
    assert [r.POLineKey for r in top] == ["P1-1", "P2-1", "P6-1", "P5-1", "P4-1"]


def test_files(tables, tmp_path):
    files.write_import_file(tables["vendor_golden"], str(tmp_path / "import"), single_file=True)
    (part,) = (tmp_path / "import").glob("part-*.csv")
    ready = ["VEND-00001", "VEND-00002", "VEND-00006", "VEND-00008"]
    assert part.read_text().splitlines() == ["VENDORACCOUNTNUMBER", *ready]
    files.write_exceptions_file(tables["dq_issues"], str(tmp_path / "exceptions"), single_file=True)
    (part,) = (tmp_path / "exceptions").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[1] == "VEN-001,Missing Tax ID,High,Vendor,L03,TaxID,,Open,True,2026-01-02T03:04:05"
    assert {line.split(",")[0] for line in lines[1:]} == {"VEN-001", "VEN-002", "VEN-004", "VEN-006"}
    assert len(lines) == 5

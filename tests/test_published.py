"""The whole run over the published extract with its published results.

The extract is not part of this repository. Point `LEDGERLOOM_MASTERS` at the folder with the two CSV masters and
`LEDGERLOOM_PAGES` at the folder with the JSON pages; without both, this file is not collected. `test_end_to_end.py`
runs the same checks on an extract of its own.
"""

import datetime
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import explore, kpis, match, reconcile
from ledgerloom.plans.run import run
from ledgerloom.sinks import files
from ledgerloom.runlog import RunLog
from ledgerloom.sources.registry import stage_all

MASTERS = os.environ["LEDGERLOOM_MASTERS"]
PAGES = os.environ["LEDGERLOOM_PAGES"]


@pytest.fixture(scope="module")
def log():
    return RunLog()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, log):
    staged = stage_all(spark, MASTERS, PAGES)
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    return run(staged, warehouse, started_at=datetime.datetime(2026, 1, 2, 3, 4, 5), run_log=log)


def pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.select(*columns).collect()}


def test_row_counts(tables, spark, log):
    expected = {
        "stg_vendor": 43,
        "stg_item": 24,
        "stg_po_line": 372,
        "stg_receipt": 327,
        "stg_invoice": 336,
        "vendor_golden": 41,
        "vendor_xref": 43,
        "dq_issues": 11,
        "dim_vendor": 42,
        "dim_item": 25,
        "dim_date": 730,
        "fact_po_line": 372,
        "fact_receipt": 327,
        "fact_invoice": 336,
        "fact_three_way_match": 336,
        "unmatched_invoice": 0,
        "reconciliation": 4,
    }
    counts = reconcile.row_counts(tables, expected)
    assert counts.filter("not Agrees").collect() == []
    assert pairs(log.frame(spark), "table_name", "row_count") == set(expected.items())


def test_issues(tables):
    by_rule = tables["dq_issues"].groupBy("RuleID", "IsBlocking").count()
    assert pairs(by_rule, "RuleID", "IsBlocking", "count") == {
        ("VEN-001", True, 2),
        ("VEN-002", True, 1),
        ("VEN-003", False, 2),
        ("VEN-004", False, 2),
        ("VEN-004", True, 1),
        ("VEN-005", False, 2),
        ("VEN-006", True, 1),
    }


def test_merges(tables):
    merged = tables["vendor_xref"].filter("MatchType <> 'Self'")
    assert pairs(merged, "LegacyVendorCode", "SurvivorCode", "VendorAccount") == {
        ("LV0041", "LV0002", "VEND-00002"),
        ("LV0042", "LV0009", "VEND-00009"),
    }


def test_match_summary(tables):
    summary = match.status_summary(tables["fact_three_way_match"]).collect()
    assert [(r.MatchStatus, r.InvoiceLines, r.Amount) for r in summary] == [
        ("Matched", 247, Decimal("2947102.90")),
        ("No receipt", 38, Decimal("417685.72")),
        ("Price variance", 26, Decimal("476216.75")),
        ("Qty variance", 16, Decimal("139434.74")),
        ("Duplicate invoice", 6, Decimal("58250.70")),
        ("Unknown vendor", 3, Decimal("11247.52")),
    ]
    assert summary[0].PctOfLines == Decimal("73.5")


def test_orphans_and_unknown(tables):
    po, xref = tables["stg_po_line"], tables["vendor_xref"]
    assert pairs(reconcile.orphan_vendors(po, xref), "PurchaseOrderNumber", "LineNumber", "VendorAccount") == {
        ("PO-25007", 1, "LV9999"),
        ("PO-25088", 1, "LV9999"),
        ("PO-25088", 2, "LV9999"),
    }
    assert pairs(reconcile.orphan_items(po, tables["stg_item"]), "PurchaseOrderNumber", "ItemNumber") == {
        ("PO-25040", "ITM-9999")
    }
    fact = tables["fact_po_line"]
    assert reconcile.unknown_lines(fact, "VendorAccount").first().line_count == 3
    assert reconcile.unknown_lines(fact, "ItemNumber").first().line_count == 1
    lines = reconcile.merged_code_lines(po, xref).collect()
    assert [(r.LegacyVendorCode, r.count_lines) for r in lines] == [("LV0042", 15), ("LV0041", 7)]
    assert reconcile.unmatched_invoices(tables["fact_invoice"], fact).count() == 0


def test_measures(tables):
    ready = kpis.readiness(tables["vendor_golden"]).first()
    assert (ready.vendors, ready.ready, ready.exceptions) == (41, 36, 5)
    hold = kpis.amount_on_hold(tables["fact_three_way_match"]).first()
    assert (hold.lines_on_hold, hold.amount_on_hold) == (89, Decimal("1102835.43"))
    rescued = kpis.rescued_lines(tables["stg_po_line"], tables["vendor_xref"]).first()
    assert (rescued.po_lines, rescued.rescued_lines) == (372, 22)
    sites = kpis.spend_by_site(tables["fact_po_line"])
    assert pairs(sites, "Site", "spend") == {
        ("CR-HER", Decimal("2281387.22")),
        ("US-MAR", Decimal("2289474.81")),
    }
    top = kpis.top_vendors(tables["fact_po_line"], tables["dim_vendor"]).orderBy(F.desc("spend")).collect()
    assert top[0].spend == Decimal("359115.20")
    assert sum(r.MigrationStatus == "Exception" for r in top) == 2
    second = kpis.secondary_price_issues(tables["fact_three_way_match"]).collect()
    assert [r.MatchStatus for r in second] == ["No receipt"]


def test_questions(tables):
    fact = tables["fact_po_line"]
    assert explore.count_above(fact, "POAmount", 10000).first().row_count == 108
    assert explore.large_orders(fact).count() == 44
    assert explore.in_range(fact, "UnitPrice", 100, 500).count() == 140
    assert explore.in_list(fact, "LineNumber", [1, 2]).count() == 261
    assert explore.not_in_list(fact, "LineNumber", [1, 2]).count() == 372 - 261
    top = explore.top(fact, "POAmount", ["POLineKey"]).collect()
    assert [(r.POLineKey, r.POAmount) for r in top] == [
        ("PO-25010-1", Decimal("123730.78")),
        ("PO-25048-3", Decimal("112100.00")),
        ("PO-25142-2", Decimal("110613.90")),
        ("PO-25134-1", Decimal("102293.62")),
        ("PO-25124-2", Decimal("94686.68")),
    ]


def test_files(tables, spark, tmp_path):
    files.write_import_file(tables["vendor_golden"], str(tmp_path / "import"), single_file=True)
    (part,) = (tmp_path / "import").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[:4] == ["VENDORACCOUNTNUMBER", "VEND-00001", "VEND-00002", "VEND-00003"]
    assert len(lines) == 37
    files.write_exceptions_file(tables["dq_issues"], str(tmp_path / "exceptions"), single_file=True)
    (part,) = (tmp_path / "exceptions").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == (
        "RuleID,RuleDescription,Severity,Entity,RecordKey,FieldName,BadValue,Status,IsBlocking,DetectedAt"
    )
    assert lines[1] == "VEN-001,Missing Tax ID,High,Vendor,LV0004,TaxID,,Open,True,2026-01-02T03:04:05"
    assert [line.split(",")[0] for line in lines[1:]] == ["VEN-001", "VEN-004", "VEN-002", "VEN-001", "VEN-006"]
    assert '"Possible duplicate (same name, different Tax ID)"' in lines[5]

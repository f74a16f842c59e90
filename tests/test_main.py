"""The whole run over a small extract written here, twice: a rerun replaces every table."""

import csv
import datetime
import json
from decimal import Decimal

import pytest

from ledgerloom import schemas
from ledgerloom.__main__ import main
from ledgerloom.operators.lookups import RepeatedKey
from ledgerloom.plans import kpis
from ledgerloom.plans.run import publish_run, run
from ledgerloom.sinks import tables as sink
from ledgerloom.sinks.table_set import TableSet
from ledgerloom.sources.registry import register_views, stage_all

VENDORS = [
    ("L1", "Acme, LLC", "US-1", "US", "USD", "Net30", "ap@acme.com", "Active", "2019-01-01"),
    ("L2", "Acme Tools", "US-1", "US", "USD", "N30", "ap@acme.com", "Active", "2020-01-01"),
    ("L3", "Beta S.A.", "", "CR", "CRC", "Net15", "", "Active", "2020-02-01"),
    ("L4", "Acme", "US-4", "US", "EUR", "Net60", "ap@x.org", "Blocked", "2021-01-01"),
]
ITEMS = [("I1", "Bolt", "HARDWARE", "EA", "3.25"), ("I2", "Nut", "HARDWARE", "EA", "")]
ORDERS = [
    ("P1", 1, "L1", "I1", 10, 2.5, "2025-01-05", "S1"),
    ("P1", 2, "L2", "I9", 4, 10.0, "2025-01-05", "S2"),
    ("P2", 1, "L9", "I1", 1, 7.0, "2025-02-01", "S1"),
]
RECEIPTS = [("R1", "P1", 1, 6, "2025-01-10"), ("R2", "P1", 1, 4, "2025-01-11"), ("R3", "P2", 1, 1, "2025-02-02")]
BILLS = [
    ("B1", "L1", "P1", 1, 10, 2.5, "2025-01-20"),
    ("B1", "L2", "P1", 1, 10, 2.5, "2025-01-20"),
    ("B2", "L2", "P1", 2, 4, 10.0, "2025-01-21"),
    ("B3", "L9", "P2", 1, 1, 7.0, "2025-02-03"),
    ("B4", "L1", "P7", 1, 1, 1.0, "2025-02-04"),
]


def write_csv(path, columns, rows):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(columns)
        writer.writerows(rows)


def write_pages(folder, table, rows, size=2):
    entity, element = schemas.ENTITIES[table]
    pages = [rows[i : i + size] for i in range(0, len(rows), size)]
    for n, page in enumerate(pages, 1):
        body = {"@odata.context": "x", "value": [dict(zip(element.names, row)) for row in page]}
        if n < len(pages):
            body["@odata.nextLink"] = f"https://host.example/{entity}_page{n + 1}.json"
        (folder / f"{entity}_page{n}.json").write_text(json.dumps(body, indent=1))


@pytest.fixture
def extract(tmp_path):
    items = [row if row[4] else (*row[:4], "1.05") for row in ITEMS]
    write_csv(tmp_path / "legacy_vendors.csv", schemas.VENDOR_COLUMNS, VENDORS)
    write_csv(tmp_path / "legacy_items.csv", schemas.ITEM_COLUMNS, items)
    write_pages(tmp_path, "stg_po_line", ORDERS)
    write_pages(tmp_path, "stg_receipt", RECEIPTS)
    write_pages(tmp_path, "stg_invoice", BILLS)
    return tmp_path


def test_run(spark, extract, capsys):
    arguments = ["--masters", str(extract), "--pages", str(extract), "--single-file"]
    arguments += ["--warehouse", str(extract / "warehouse"), "--files", str(extract / "files")]
    for _ in range(2):
        main(arguments)
    printed = capsys.readouterr().out
    assert "[extract] VendorInvoiceLines: 5 rows in 3 pages" in printed
    assert "[extract] legacy_vendors: 4 rows" in printed
    assert "[load] fact_invoice: 5 rows" in printed
    assert "[check] fact_three_way_match: 4 of 5 rows, not all" in printed
    assert "[check] 1 invoice lines have no PO line" in printed
    assert "[files] 1 vendors ready | 2 sent to review" in printed

    def table(name):
        return spark.read.parquet(str(extract / "warehouse" / name))

    golden = {r.VendorCode: (r.VendorAccount, r.MigrationStatus) for r in table("vendor_golden").collect()}
    assert golden == {
        "L1": ("VEND-00001", "Ready"),
        "L3": ("VEND-00002", "Exception"),
        "L4": ("VEND-00003", "Exception"),
    }
    po = {r.POLineKey: (r.VendorAccount, r.ItemNumber, r.POAmount) for r in table("fact_po_line").collect()}
    assert po == {
        "P1-1": ("VEND-00001", "I1", Decimal("25.00")),
        "P1-2": ("VEND-00001", "UNKNOWN", Decimal("40.00")),
        "P2-1": ("UNKNOWN", "I1", Decimal("7.00")),
    }
    matched = table("fact_three_way_match").orderBy("InvoiceLineID").collect()
    # B4 has no PO line. B1 came twice, under two codes of one vendor.
    assert [(r.InvoiceNumber, r.MatchStatus) for r in matched] == [
        ("B1", "Matched"),
        ("B1", "Duplicate invoice"),
        ("B2", "No receipt"),
        ("B3", "Unknown vendor"),
    ]
    assert {r._SourceSystem for r in table("stg_vendor").collect()} == {"LegacyERP+ProcurementAPI"}
    assert table("dim_item").filter("ItemNumber = 'UNKNOWN'").count() == 1
    (part,) = (extract / "files" / "vendor_import").glob("part-*.csv")
    assert part.read_text().splitlines() == ["VENDORACCOUNTNUMBER", "VEND-00001"]
    (part,) = (extract / "files" / "blocking_issues").glob("part-*.csv")
    assert [line.split(",")[0] for line in part.read_text().splitlines()] == ["RuleID", "VEN-001", "VEN-006"]


def test_run_into_the_catalog(spark, extract):
    tables = run(stage_all(spark, str(extract), str(extract)), None)
    assert {t.name for t in spark.catalog.listTables()} >= set(tables)
    stored = spark.sql("select distinct _SourceSystem from fact_three_way_match").collect()
    assert [r._SourceSystem for r in stored] == ["MasterData"]
    for name in tables:
        spark.sql(f"alter table {name} rename to kept_{name}")
    tables = {name: spark.read.table(f"kept_{name}") for name in tables}
    register_views(tables)
    orphans = spark.sql(
        "select o.PurchaseOrderNumber from stg_po_line o left join vendor_xref x"
        " on x.LegacyVendorCode = o.VendorAccount where x.LegacyVendorCode is null"
    ).collect()
    assert [r.PurchaseOrderNumber for r in orphans] == ["P2"]
    for name in tables:
        spark.catalog.dropTempView(name)
        spark.sql(f"drop table kept_{name}")


def test_line_breaks_in_masters(spark, extract):
    broken = [(VENDORS[0][0], "Acme,\nLLC", *VENDORS[0][2:]), *VENDORS[1:]]
    write_csv(extract / "legacy_vendors.csv", schemas.VENDOR_COLUMNS, broken)
    staged = stage_all(spark, str(extract), str(extract), multi_line=True)
    assert {r.VendorName for r in staged["stg_vendor"].collect()} >= {"Acme,\nLLC", "Beta S.A."}


def test_calendar_covers_the_facts(spark, extract):
    late = [(*row[:6], "2027-03-01", row[7]) for row in ORDERS]
    write_pages(extract, "stg_po_line", late)
    tables = run(stage_all(spark, str(extract), str(extract)), str(extract / "warehouse"))
    months = {r.YearMonth for r in kpis.monthly_spend(tables["fact_po_line"], tables["dim_date"]).collect()}
    assert months == {"2027-03"}
    assert tables["unmatched_invoice"].count() == 1
    days = (datetime.date(2025, 1, 1), datetime.date(2025, 1, 31))
    tables = run(stage_all(spark, str(extract), str(extract)), str(extract / "other"), calendar=days)
    assert tables["dim_date"].count() == 31


def test_a_repeated_item_stops_the_run(spark, extract):
    write_csv(extract / "legacy_items.csv", schemas.ITEM_COLUMNS, [("I1", "Bolt", "HARDWARE", "EA", "1")] * 2)
    with pytest.raises(RepeatedKey, match="stg_item"):
        run(stage_all(spark, str(extract), str(extract)), str(extract / "stopped"))
    assert not (extract / "stopped").exists()


def test_a_published_run_is_seen_whole_or_not_at_all(spark, extract, monkeypatch):
    tables = TableSet(spark, str(extract / "set"))
    first = publish_run(stage_all(spark, str(extract), str(extract)), tables)
    assert len(first.tables) == 17 and tables.read("fact_three_way_match").count() == 4
    quantities = lambda version=None: {r.InvoiceQuantity for r in tables.read("stg_invoice", version).collect()}
    before = quantities()
    write_pages(extract, "stg_invoice", [(*bill[:4], 99, *bill[5:]) for bill in BILLS])
    staged = stage_all(spark, str(extract), str(extract))
    write = sink.replace_parquet
    for stop in (0, 9, 16):
        written = []

        def failing(df, path):
            if len(written) == stop:
                raise OSError("stopped")
            written.append(path)
            write(df, path)

        monkeypatch.setattr(sink, "replace_parquet", failing)
        with pytest.raises(OSError):
            publish_run(staged, tables)
        assert tables.current() == first and quantities() == before
    monkeypatch.setattr(sink, "replace_parquet", write)
    second = publish_run(staged, tables)
    assert quantities() == {99} and quantities(first) == before
    assert {r.InvoiceQty for r in tables.read("fact_three_way_match").collect()} == {99}
    assert len(tables.remove_before(second.number)) == 17 + 9 + 16

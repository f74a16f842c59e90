"""Registered queries against their SQL, and invariants of the modelled tables, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.adapters.tpch import ProcureToPay
from ledgerloom.checks.compare import connect, differences
from ledgerloom.checks.oracles import ORACLES
from ledgerloom.checks.queries import QUERIES
from ledgerloom.plans import kpis, master, reconcile

FOLDER = os.environ.get("LEDGERLOOM_TABLES", "/root/testdata/sf0.001")

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")

SAMPLE = (
    "src_paged_json",
    "src_csv_text",
    "snk_exceptions_file",
    "win_surrogate_key",
    "win_running_quantity",
    "profile_numeric",
    "profile_distinct",
    "dq_issues",
    "vendor_golden",
    "vendor_xref",
    "fact_po_line",
    "three_way_match",
    "match_summary",
    "rec_unmatched_invoices",
    "kpi_top_vendors",
    "kpi_monthly_spend_of_run",
    "rec_run",
    "sca_exact_amount",
    "snk_published_set",
    "win_append_numbers",
    "match_incremental",
    "src_page_stream",
    "rec_content_diff",
    "profile_sketch_distinct",
    "profile_key_overlap",
)
# No blocked vendor of the smallest tables has spend.
LARGER = {"kpi_blocked_vendor_spend": os.environ.get("LEDGERLOOM_LARGER_TABLES", "/root/testdata/sf0.01")}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@needs_tables
@pytest.mark.parametrize("name", [*SAMPLE, *LARGER])
def test_query_equals_its_sql(spark, name):
    folder = LARGER.get(name, FOLDER)
    rows, found = differences(spark, connect(folder), name, folder)
    assert found == []
    assert rows > 0


@pytest.fixture(scope="module")
def p2p(spark):
    return ProcureToPay(spark, FOLDER)


@needs_tables
def test_every_invoice_line_has_one_status_or_no_order(p2p):
    staged = p2p.invoices.count()
    matched = p2p.match.cache()
    assert matched.filter("MatchStatus is null").count() == 0
    assert matched.select("InvoiceLineID").distinct().count() == matched.count()
    assert matched.count() + reconcile.unmatched_invoices(p2p.fact_invoice, p2p.fact_po_line).count() == staged
    hold = kpis.amount_on_hold(matched).first()
    paid = matched.filter("MatchStatus = 'Matched'").agg(F.sum("InvoiceAmount").alias("a")).first().a
    total = matched.agg(F.sum("InvoiceAmount").alias("a")).first().a
    assert hold.amount_on_hold + paid == total
    matched.unpersist()


@needs_tables
def test_xref_covers_every_code_and_only_golden_accounts(p2p):
    governed = master.govern_vendors(p2p.vendors)
    xref, golden = governed["vendor_xref"], governed["vendor_golden"]
    codes = p2p.vendors.select(F.col("VendorCode").alias("LegacyVendorCode"))
    assert codes.join(xref, "LegacyVendorCode", "left_anti").isEmpty()
    assert xref.count() == codes.count()
    assert xref.join(golden, "VendorAccount", "left_anti").isEmpty()
    assert xref.filter("MatchType = 'Self'").count() == golden.count()


@needs_tables
def test_a_second_run_gives_the_same_tables(p2p):
    first, second = master.govern_vendors(p2p.vendors), master.govern_vendors(p2p.vendors)
    for name in first:
        columns = [c for c in first[name].columns if c != "DetectedAt"]
        a, b = first[name].select(*columns), second[name].select(*columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@needs_tables
def test_all_kinds_of_faults_occur(p2p):
    statuses = {r.MatchStatus for r in p2p.match.select("MatchStatus").distinct().collect()}
    assert len(statuses) == 6
    assert reconcile.orphan_vendors(p2p.po_lines, p2p.xref).count() > 0
    assert reconcile.orphan_items(p2p.po_lines, p2p.items).count() > 0
    assert reconcile.unmatched_invoices(p2p.fact_invoice, p2p.fact_po_line).count() > 0


@needs_tables
def test_every_row_of_the_tables_is_read(p2p):
    lineitems = p2p.table("lineitem").count()
    assert p2p.invoices.count() == p2p.receipts.count() == lineitems
    assert p2p.vendors.count() == p2p.table("supplier").count() + p2p.table("customer").count()
    assert p2p.items.count() == p2p.table("part").count()
    ordered = p2p.po_lines.agg(F.sum("OrderedQuantity")).first()[0]
    assert ordered == p2p.table("lineitem").agg(F.sum("l_quantity")).first()[0]


@needs_tables
@pytest.mark.parametrize("name", ["flt_large_orders", "kpi_monthly_spend", "prj_columns", "kpi_spend_by_site"])
def test_plans_that_need_no_stored_table_start_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"building {name}", "")
    ProcureToPay(spark, FOLDER).table("lineitem")
    for table in ("part", "orders"):
        ProcureToPay(spark, FOLDER).table(table)
    spark.sparkContext.setJobGroup(f"built {name}", "")
    QUERIES[name](spark, FOLDER)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"built {name}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


@needs_tables
def test_top_vendors_come_in_order(spark):
    rows = QUERIES["kpi_top_vendors"](spark, FOLDER).collect()
    assert [(-r.spend, r.VendorAccount) for r in rows] == sorted((-r.spend, r.VendorAccount) for r in rows)
    assert len(rows) == 10


@pytest.fixture
def joins_by_sort(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def _tables(spark, folder, lines):
    """Tables of `lines`: order, line, part, supplier, quantity and status of lineitems; an order and a part each."""
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_linestatus string"
    spark.createDataFrame(lines, columns).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(k, "1995-01-01") for k in sorted({row[0] for row in lines if row[0] is not None})]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate string").write.parquet(f"{folder}/orders.parquet")
    parts = [(k, f"p{k}", "t", 1.5) for k in sorted({row[2] for row in lines})]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    return ProcureToPay(spark, str(folder))


LINES = [(1, 1, 5, 2, 3.0, "O"), (1, 1, 4, 9, 4.0, "F"), (1, 2, 5, 2, 1.0, "O"), (None, 1, 4, 2, 1.0, "O"), (2, None, 4, 2, 6.0, "O")]


def test_lineitems_move_once_to_their_order(spark, tmp_path, joins_by_sort):
    lines = _tables(spark, tmp_path, LINES).po_lines
    rows = sorted((r.PurchaseOrderNumber, r.LineNumber or 0, r.ItemNumber, r.OrderedQuantity, r.Site) for r in lines.collect())
    assert rows == [("PO-1", 1, "ITM-4", 7, "SITE-F"), ("PO-1", 2, "ITM-5", 1, "SITE-O"), ("PO-2", 0, "ITM-4", 6, "SITE-O")]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in plan
    physical = lines._jdf.queryExecution().sparkPlan().toString()
    assert "l_linenumber" in physical
    executed = lines._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert not [line for line in executed.splitlines() if "Exchange hashpartitioning(l_orderkey" in line and "l_linenumber" in line]


def test_pages_land_compressed_and_read_the_same(spark, tmp_path):
    from ledgerloom.adapters.tpch import land_pages
    from ledgerloom.sources.paged_json import read_pages

    df = spark.range(25).select("id", F.concat(F.lit("text "), "id").alias("t"))
    pattern = land_pages(df, "E", str(tmp_path / "pages"), ["id"], 10)
    files = list((tmp_path / "pages").glob("page=E_page*/*.gz"))
    assert len(files) == 3 and all(f.read_bytes()[:2] == b"\x1f\x8b" for f in files)
    rows = read_pages(spark, "", "E", df.schema, files=pattern).select("element.*").collect()
    assert sorted(map(tuple, rows)) == [(i, f"text {i}") for i in range(25)]


def test_stored_tables_are_packed(spark, tmp_path):
    from ledgerloom.sinks.tables import replace_parquet

    replace_parquet(spark.range(3), str(tmp_path / "t"))
    assert [f for f in (tmp_path / "t").glob("*.zstd.parquet")]


def test_a_published_table_is_the_source_of_its_totals(spark, tmp_path, monkeypatch):
    from ledgerloom.sinks.table_set import Writing

    sources = []
    write = Writing.write
    monkeypatch.setattr(Writing, "write", lambda self, name, df: sources.append(df.inputFiles()) or write(self, name, df))
    _tables(spark, tmp_path, LINES)
    assert QUERIES["snk_published_set"](spark, str(tmp_path)).count() == 6
    assert len(sources) == 2 and all("stg_po_line" in path for found in sources for path in found)

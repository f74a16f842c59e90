import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.plans import explore, kpis, reconcile, star

D = Decimal
DAY = datetime.date


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def po_fact(spark, rows):
    """(key, vendor, item, day, site, quantity, price)"""
    typed = [(k, v, i, d, s, D(q), D(p), D(q) * D(p)) for k, v, i, d, s, q, p in rows]
    return spark.createDataFrame(
        typed,
        "POLineKey string, VendorAccount string, ItemNumber string, OrderDate date, Site string,"
        " OrderedQty decimal(12,2), UnitPrice decimal(12,2), POAmount decimal(14,2)",
    )


ROWS = [
    ("k1", "A", "I1", DAY(2025, 1, 31), "N", 10, 100),
    ("k2", "A", "UNKNOWN", DAY(2025, 2, 1), "S", 1, 500),
    ("k3", "B", "I1", DAY(2025, 2, 28), "N", 2, 50),
    ("k4", "UNKNOWN", "I2", DAY(2024, 2, 1), "N", 3, 1),
]


def test_spend(spark):
    fact = po_fact(spark, ROWS)
    items = spark.createDataFrame([("I1", "HW"), ("I2", "HW"), ("UNKNOWN", "UNKNOWN")], "ItemNumber string, ItemGroup string")
    assert rows_of(kpis.spend_by_item_group(fact, items)) == [("HW", D("1103.00")), ("UNKNOWN", D("500.00"))]
    assert rows_of(kpis.spend_by_site(fact)) == [("N", D("1103.00")), ("S", D("500.00"))]
    monthly = kpis.monthly_spend(fact, star.dim_date(spark))
    assert rows_of(monthly) == [("2025-01", D("1000.00")), ("2025-02", D("600.00")), (None, D("3.00"))]
    vendors = spark.createDataFrame(
        [("A", "Acme", "Ready"), ("B", "Beta", "Exception"), ("UNKNOWN", "?", "Exception")],
        "VendorAccount string, VendorName string, MigrationStatus string",
    )
    assert rows_of(kpis.top_vendors(fact, vendors, 2)) == [
        ("A", D("1500.00"), "Acme", "Ready"),
        ("B", D("100.00"), "Beta", "Exception"),
    ]
    assert rows_of(kpis.blocked_vendor_spend(fact, vendors)) == [("B", D("100.00"), "Beta")]


def test_measures_of_nothing(spark):
    golden = spark.createDataFrame([], "VendorCode string, MigrationStatus string")
    assert tuple(kpis.readiness(golden).first()) == (0, 0, 0, None)
    match = spark.createDataFrame([], "MatchStatus string, InvoiceAmount decimal(14,2)")
    assert tuple(kpis.match_rate(match).first()) == (0, 0, None)
    assert tuple(kpis.amount_on_hold(match).first()) == (0, D("0.00"))
    po = spark.createDataFrame([], "VendorAccount string")
    xref = spark.createDataFrame([], "LegacyVendorCode string, VendorAccount string, MatchType string")
    assert tuple(kpis.rescued_lines(po, xref).first()) == (0, 0, None)
    assert reconcile.merged_code_lines(po, xref).count() == 0


def test_exposure_and_hold(spark):
    match = spark.createDataFrame(
        [
            ("Matched", D("10"), D("9")),
            ("Price variance", D("20"), D("-2")),
            ("Price variance", D("30"), D("5")),
            ("Duplicate invoice", D("40"), D("1")),
            ("No receipt", D("50"), D("1")),
        ],
        "MatchStatus string, InvoiceAmount decimal(14,2), PriceVarianceAmount decimal(14,2)",
    )
    assert rows_of(kpis.exposure(match)) == [("Duplicate invoice", 1, D("40.00")), ("Price variance", 2, D("3.00"))]
    assert tuple(kpis.amount_on_hold(match).first()) == (4, D("140.00"))
    assert kpis.hold_list(match).count() == 4
    assert tuple(kpis.match_rate(match).first()) == (5, 1, D("0.2000"))


def test_rescued_lines_and_unknown(spark):
    po = spark.createDataFrame([("OLD",)] * 3 + [("SELF",), ("LOST",)], "VendorAccount string")
    xref = spark.createDataFrame(
        [("OLD", "N1", "Merged by Tax ID"), ("SELF", "N1", "Self")],
        "LegacyVendorCode string, VendorAccount string, MatchType string",
    )
    assert tuple(kpis.rescued_lines(po, xref).first()) == (5, 3, D("0.6000"))
    assert rows_of(reconcile.merged_code_lines(po, xref)) == [("OLD", "N1", 3)]
    fact = po_fact(spark, ROWS)
    assert rows_of(reconcile.unknown_lines(fact, "VendorAccount")) == [("UNKNOWN", 1)]
    assert reconcile.unknown_lines(fact.filter("VendorAccount = 'A'"), "VendorAccount").count() == 0


def test_questions(spark):
    fact = po_fact(spark, ROWS)
    assert [r.POLineKey for r in explore.top(fact, "POAmount", ["POLineKey"], 2).collect()] == ["k1", "k2"]
    assert [r.POLineKey for r in explore.head(fact, ["POLineKey"], 3).collect()] == ["k1", "k2", "k3"]
    assert explore.count_above(fact, "POAmount", 100).first().row_count == 2
    assert explore.above(fact, "POAmount", 100).count() == 2
    assert rows_of(explore.in_range(fact, "UnitPrice", 50, 100).select("POLineKey")) == [("k1",), ("k3",)]
    nullable = spark.createDataFrame([(1,), (3,), (None,)], "n int")
    assert rows_of(explore.in_list(nullable, "n", [1, 2])) == [(1,)]
    assert rows_of(explore.not_in_list(nullable, "n", [1, 2])) == [(3,), (None,)]


def test_dimensions(spark):
    items = spark.createDataFrame([("I1", "Bolt", "HW", "EA", "3367.55")], "ItemNumber string, Description string, ItemGroup string, UoM string, StandardCost string")
    assert rows_of(star.dim_item(items)) == [
        ("I1", "Bolt", "HW", "EA", D("3367.6")),
        ("UNKNOWN", "** Item not in master **", "UNKNOWN", None, None),
    ]
    days = star.dim_date(spark)
    assert days.dtypes == [
        ("Date", "date"),
        ("YEAR", "int"),
        ("QuarterNum", "int"),
        ("QUARTER", "string"),
        ("MONTHNAME", "string"),
        ("YearMonth", "string"),
    ]
    may = days.filter(F.col("Date") == DAY(2026, 5, 9)).first()
    assert tuple(may) == (DAY(2026, 5, 9), 2026, 2, "Q2", "May", "2026-05")

import random
from decimal import Decimal

import pytest

from ledgerloom.plans import kpis, match, reconcile, star
from ledgerloom.rules import Rules

D = Decimal


def invoices(spark, rows):
    """(id, invoice, vendor, line, quantity, price)"""
    typed = [(i, n, v, k, D(q), D(p), D(q) * D(p)) for i, n, v, k, q, p in rows]
    return spark.createDataFrame(
        typed,
        "InvoiceLineID long, InvoiceNumber string, VendorAccount string, POLineKey string,"
        " InvoiceQty decimal(12,2), InvoiceUnitPrice decimal(12,2), InvoiceAmount decimal(14,2)",
    ).selectExpr("*", "date'2025-01-01' as InvoiceDate")


def po_lines(spark, rows):
    """(line, price)"""
    typed = [(k, "I", D(10), D(p)) for k, p in rows]
    return spark.createDataFrame(
        typed, "POLineKey string, ItemNumber string, OrderedQty decimal(12,2), UnitPrice decimal(12,2)"
    )


def receipts(spark, rows):
    return spark.createDataFrame([(k, D(q)) for k, q in rows], "POLineKey string, ReceivedQty decimal(12,2)")


def statuses(df):
    return {r.InvoiceLineID: r.MatchStatus for r in df.collect()}


def test_each_status_and_its_priority(spark):
    bills = invoices(
        spark,
        [
            (1, "A", "V", "ok", 5, 100),
            (2, "A", "V", "ok", 5, 100),  # a copy
            (3, "B", "UNKNOWN", "none", 5, 200),  # unknown before no receipt
            (4, "C", "V", "none", 5, 200),  # no receipt before price
            (5, "D", "V", "zero", 5, 100),  # receipts that sum to zero
            (6, "E", "V", "part", 6, 200),  # quantity before price
            (7, "F", "V", "price", 5, "105.01"),
            (8, "G", "V", "price", 5, "94.99"),
            (9, "H", "V", "edge", 5, "105.00"),
            (10, "I", "V", "edge", 5, "95.00"),
            (11, "J", "V", "no order", 5, 100),
        ],
    )
    orders = po_lines(spark, [(k, 100) for k in ("ok", "none", "zero", "part", "price", "edge")])
    arrived = receipts(
        spark, [("ok", 3), ("ok", 2), ("zero", 4), ("zero", -4), ("part", 5), ("price", 10), ("edge", 10)]
    )
    result = match.three_way_match(bills, orders, arrived)
    assert result.columns == list(match.MATCH_COLUMNS)
    assert statuses(result) == {
        1: "Matched",
        2: "Duplicate invoice",
        3: "Unknown vendor",
        4: "No receipt",
        5: "No receipt",
        6: "Qty variance",
        7: "Price variance",
        8: "Price variance",
        9: "Matched",
        10: "Matched",
    }
    priced = {r.InvoiceLineID: (r.PriceVariancePct, r.PriceVarianceAmount) for r in result.collect()}
    assert priced[7] == (D("0.0501"), D("25.05"))
    assert priced[8] == (D("-0.0501"), D("-25.05"))
    assert priced[4] == (D("1.0000"), D("500.00"))
    assert dict(result.dtypes)["PriceVariancePct"] == "decimal(9,4)"
    left_out = reconcile.unmatched_invoices(bills, orders).collect()
    assert [r.InvoiceLineID for r in left_out] == [11]
    secondary = kpis.secondary_price_issues(result).collect()
    assert {r.InvoiceLineID for r in secondary} == {3, 4, 6}


def test_running_quantity_counts_first_copies_of_all_vendors(spark):
    bills = invoices(
        spark,
        [
            (1, "A", "V", "k", 4, 100),
            (2, "A", "V", "k", 4, 100),  # adds nothing
            (3, "A", "W", "k", 4, 300),  # another vendor, price off: still adds
            (4, "B", "UNKNOWN", "k", 2, 100),  # still adds
            (5, "C", "V", "k", 1, 100),
        ],
    )
    result = match.three_way_match(bills, po_lines(spark, [("k", 100)]), receipts(spark, [("k", 10)]))
    assert statuses(result) == {
        1: "Matched",
        2: "Duplicate invoice",
        3: "Price variance",
        4: "Unknown vendor",
        5: "Qty variance",
    }
    running = {r.InvoiceLineID: r.CumInvoicedQty for r in match.with_running_quantities(bills).collect()}
    assert running == {1: 4, 2: 4, 3: 8, 4: 10, 5: 11}


def test_po_price_of_zero(spark):
    bills = invoices(spark, [(1, "A", "V", "k", 1, 5), (2, "B", "V", "k", 1, 0)])
    result = match.three_way_match(bills, po_lines(spark, [("k", 0)]), receipts(spark, [("k", 10)]))
    assert statuses(result) == {1: "Price variance", 2: "Matched"}
    assert {r.PriceVariancePct for r in result.collect()} == {None}


def test_tolerance_comes_from_the_rules(spark):
    bills = invoices(spark, [(1, "A", "V", "k", 1, 109)])
    rules = Rules(price_tolerance=D("0.10"))
    tables = po_lines(spark, [("k", 100)]), receipts(spark, [("k", 10)])
    assert statuses(match.three_way_match(bills, *tables, rules.price_tolerance)) == {1: "Matched"}
    assert statuses(match.three_way_match(bills, *tables)) == {1: "Price variance"}


def brute_force(bills, prices, received):
    """The statuses by walking the lines in order."""
    seen, running, result = set(), {}, {}
    for i, number, vendor, line, quantity, price in sorted(bills, key=lambda b: b[0]):
        copy = (number, vendor, line) in seen
        seen.add((number, vendor, line))
        if not copy:
            running[line] = running.get(line, 0) + quantity
        if line not in prices:
            continue
        got = received.get(line, 0)
        if copy:
            status = "Duplicate invoice"
        elif vendor == "UNKNOWN":
            status = "Unknown vendor"
        elif got == 0:
            status = "No receipt"
        elif running[line] > got:
            status = "Qty variance"
        elif abs(D(price) - D(prices[line])) / D(prices[line]) > D("0.05"):
            status = "Price variance"
        else:
            status = "Matched"
        result[i] = status
    return result


@pytest.mark.parametrize("hot_rows, slice_rows", [(1_000_000, 1_000_000), (40, 25), (1, 3)])
def test_split_lines_match_like_the_others(spark, hot_rows, slice_rows):
    rng = random.Random(11)
    keys = ["hot"] * 10 + ["warm"] * 4 + [f"k{i}" for i in range(12)] + ["no order"]
    bills = [
        (
            i + 1,
            # A third of the hot line's invoices are copies of one invoice.
            "COPY" if rng.random() < 0.3 else f"N{rng.randrange(120)}",
            rng.choice(["V", "V", "V", "W", "UNKNOWN"]),
            rng.choice(keys),
            rng.randrange(1, 4),
            rng.choice([100, 103, 109]),
        )
        for i in range(600)
    ]
    prices = {k: 100 for k in keys if k != "no order"}
    received = {"hot": 300, "warm": 60, **{f"k{i}": i * 3 for i in range(12)}}
    result = match.three_way_match(
        invoices(spark, bills),
        po_lines(spark, prices.items()),
        receipts(spark, received.items()),
        hot_rows=hot_rows,
        slice_rows=slice_rows,
        fraction=1.0,
    )
    assert result.count() == len(statuses(result))
    assert statuses(result) == brute_force(bills, prices, received)
    ranks = match.with_running_quantities(invoices(spark, bills), hot_rows, slice_rows, 1.0)
    plain = match.with_running_quantities(invoices(spark, bills))
    columns = ["InvoiceLineID", "DupRank", "CumInvoicedQty"]
    assert sorted(map(tuple, ranks.select(*columns).collect())) == sorted(
        map(tuple, plain.select(*columns).collect())
    )
    assert ranks.dtypes == plain.dtypes


def test_summary_adds_up(spark):
    bills = invoices(spark, [(i, f"N{i}", "V", "k", 1, 100) for i in range(1, 4)])
    result = match.three_way_match(bills, po_lines(spark, [("k", 100)]), receipts(spark, [("k", 2)]))
    summary = match.status_summary(result).collect()
    assert [(r.MatchStatus, r.InvoiceLines, r.Amount, r.PctOfLines) for r in summary] == [
        ("Matched", 2, D(200), D("66.7")),
        ("Qty variance", 1, D(100), D("33.3")),
    ]


def test_same_invoice_under_two_merged_codes_is_a_copy(spark):
    staged = spark.createDataFrame(
        [("N", "OLD1", "P", 1, 1, 10.0, "2025-01-01"), ("N", "OLD2", "P", 1, 1, 10.0, "2025-01-01")],
        "InvoiceNumber string, VendorAccount string, PurchaseOrderNumber string, LineNumber long,"
        " InvoiceQuantity long, InvoiceUnitPrice double, InvoiceDate string",
    )
    xref = spark.createDataFrame([("OLD1", "NEW"), ("OLD2", "NEW")], "LegacyVendorCode string, VendorAccount string")
    fact = star.fact_invoice(staged, xref)
    assert sorted(r.InvoiceLineID for r in fact.collect()) == [1, 2]
    ranked = match.with_running_quantities(fact)
    assert sorted((r.VendorAccount, r.DupRank) for r in ranked.collect()) == [("NEW", 1), ("NEW", 2)]

"""What a batch of the incremental match moves, sorts and leaves behind."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.plans import match, star
from ledgerloom.sinks.table_set import TableSet
from ledgerloom.streaming import incremental_match
from ledgerloom.streaming.incremental_match import CHANGES, IncrementalMatch, follow, read_changes

ORDER = ["InvoiceNumber", "VendorAccount", "InvoiceQty", "InvoiceUnitPrice", "InvoiceDate", "InvoiceLineID"]


def staged(spark, first, last):
    """Orders `first` to `last`, two invoice lines each and a copy of one, and receipts of the orders before."""
    n = range(first, last)
    bills = [(f"B{i}", "L1", f"P{i}", 1, q, 2.5, "2025-03-03") for i in n for q in (1, 2, 2)]
    return {
        "invoice": spark.createDataFrame(bills, CHANGES["invoice"]),
        "receipt": spark.createDataFrame([(f"R{i}", f"P{i}", 1, 9, "2025-03-02") for i in range(max(0, first - 20), first + 1)], CHANGES["receipt"]),
        "po_line": spark.createDataFrame([(f"P{i}", 1, "L1", "I1", 3, 2.5, "2025-03-01", "S") for i in n], CHANGES["po_line"]),
    }


@pytest.fixture(scope="module")
def masters(spark):
    xref = spark.createDataFrame([("L1", "V1"), ("L2", "V2")], "LegacyVendorCode string, VendorAccount string")
    return xref, spark.createDataFrame([("I1",)], "ItemNumber string")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


def whole(spark, masters, batches):
    facts = None
    for rows in batches:
        facts = rows if facts is None else {k: facts[k].unionByName(rows[k]) for k in rows}
    bills = star.fact_invoice(facts["invoice"], masters[0])
    return match.three_way_match(bills, star.fact_po_line(facts["po_line"], *masters), star.fact_receipt(facts["receipt"]))


def plain(df):
    return sorted(map(repr, df.drop("InvoiceLineID").collect()))


def test_few_and_many_touched_lines_give_the_same_match(spark, masters, tmp_path, monkeypatch):
    batches = [staged(spark, 0, 60), staged(spark, 60, 64), staged(spark, 64, 120)]
    expected = plain(whole(spark, masters, batches))
    for name, few in (("usual", incremental_match.FEW), ("few", 1e9), ("many", -1)):
        monkeypatch.setattr(incremental_match, "FEW", few)
        target = IncrementalMatch(TableSet(spark, str(tmp_path / name)), *masters, buckets=4)
        for number, rows in enumerate(batches):
            target.apply(number, rows)
        assert plain(target.current()) == expected, name


def test_invoice_lines_move_and_sort_once_for_lookup_and_match(spark, masters, tmp_path, monkeypatch):
    seen = []
    three_way = match.three_way_match

    def noted(*args, **options):
        seen.append(three_way(*args, **options))
        return seen[-1]

    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        monkeypatch.setattr(incremental_match.match, "three_way_match", noted)
        target = IncrementalMatch(TableSet(spark, str(tmp_path / "s")), *masters, buckets=4)
        target.apply(0, staged(spark, 0, 60))
        target.apply(1, staged(spark, 60, 120))
        plan = physical(seen[1])
    finally:
        for name in names:
            spark.conf.unset(name)
    # The lookup's moves by PO line serve the match, which asks for none of its own.
    assert "Exchange hashpartitioning" in plan and "REPARTITION_BY_COL" not in plan
    line = [row for row in plan.splitlines() if "Sort [POLineKey" in row and "InvoiceNumber" in row]
    assert len(line) == 1


def test_a_batch_from_files_stores_no_copy_of_its_lines_and_leaves_no_scratch(spark, masters, tmp_path, monkeypatch):
    paths = []
    path_of = storage.scratch_path
    monkeypatch.setattr(storage, "scratch_path", lambda s, label: paths.append(path_of(s, label)) or paths[-1])
    folder = str(tmp_path / "landed")
    target = IncrementalMatch(TableSet(spark, str(tmp_path / "state")), *masters, buckets=4)
    batches = [staged(spark, 0, 30), staged(spark, 30, 60)]
    for rows in batches:
        for entity, frame in rows.items():
            frame.repartition(3).write.mode("append").parquet(f"{folder}/{entity}")
        follow(read_changes(spark, folder), target, f"{folder}/checkpoint").awaitTermination()
    assert paths and not [p for p in paths if "unnumbered" in p or os.path.exists(p)]
    assert target.tables.read("fact_invoice").select("InvoiceLineID").distinct().count() == 180
    assert target.tables.read("fact_invoice").agg(F.max("InvoiceLineID")).first()[0] == 180
    assert plain(target.current()) == plain(whole(spark, masters, batches))

"""What a full run stores, moves and leaves behind."""

import os

import pytest
from ledgerloom import schemas, storage
from ledgerloom.operators.lookups import referred, resolve
from ledgerloom.plans import match, reconcile
from ledgerloom.plans import run as full_run
from ledgerloom.plans.match import MATCH_COLUMNS


@pytest.fixture
def staged(spark):
    vendors = [(f"L{n}", f"N{n}", f"T{n}", "X", "USD", "Net30", f"a@b{n}.example", "Active", "2020-01-01") for n in range(6)]
    orders = [(f"P{n}", 1, f"L{n % 8}", f"I{n % 5}", 3, 2.5, "2025-03-01", "S") for n in range(40)]
    receipts = [(f"R{n}", f"P{n}", 1, 3, "2025-03-02") for n in range(0, 40, 2)]
    # The last ten name no PO line.
    bills = [(f"B{n}", f"L{n % 8}", f"P{n % 50}", 1, 1, 2.5, "2025-03-03") for n in range(100)]
    return {
        "stg_vendor": spark.createDataFrame(vendors, list(schemas.VENDOR_COLUMNS)),
        "stg_item": spark.createDataFrame([(f"I{n}", "d", "g", "EA", "1.0") for n in range(4)], list(schemas.ITEM_COLUMNS)),
        "stg_po_line": spark.createDataFrame(orders, schemas.PO_LINE),
        "stg_receipt": spark.createDataFrame(receipts, schemas.RECEIPT),
        "stg_invoice": spark.createDataFrame(bills, schemas.INVOICE),
    }


def moves(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return plan.count("Exchange hashpartitioning")


@pytest.fixture
def joins_by_sort(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_the_match_and_what_it_leaves_out_move_no_invoice(spark, staged, tmp_path, joins_by_sort):
    done = full_run.run(staged, str(tmp_path / "w"))
    facts = done["fact_invoice"], done["fact_po_line"], done["fact_receipt"]
    # The PO lines and the receipt totals, and for the rest the keys of the PO lines.
    assert moves(match.match_in_place(*facts)) == 2
    assert moves(reconcile.unmatched_invoices(*facts[:2])) == 1
    assert done["fact_three_way_match"].count() == 80 and done["unmatched_invoice"].count() == 20
    plain = match.three_way_match(*[spark.read.parquet(str(tmp_path / "w" / t)) for t in ("fact_invoice", "fact_po_line", "fact_receipt")])
    stored = done["fact_three_way_match"].select(*MATCH_COLUMNS)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("catalog", [False, True])
def test_a_second_run_replaces_the_first(spark, staged, tmp_path, catalog):
    where = None if catalog else str(tmp_path / "w")
    full_run.run(staged, where)
    done = full_run.run({**staged, "stg_invoice": staged["stg_invoice"].limit(30)}, where)
    assert done["fact_invoice"].count() == 30
    assert sorted(r.InvoiceLineID for r in done["fact_invoice"].collect()) == list(range(1, 31))
    for name in done if catalog else ():
        spark.sql(f"drop table {name}")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_hot_po_lines_give_the_same_tables(spark, staged, tmp_path, monkeypatch):
    usual = full_run.run(staged, str(tmp_path / "usual"))
    all_keys = full_run.hot_keys

    monkeypatch.setattr(full_run, "hot_keys", lambda df, keys: all_keys(df, keys, 2, 1.0))
    hot = full_run.run(staged, str(tmp_path / "hot"))
    for name in ("fact_invoice", "fact_three_way_match", "unmatched_invoice", "reconciliation"):
        assert sorted(map(repr, hot[name].collect())) == sorted(map(repr, usual[name].collect())), name
    assert all_keys(usual["fact_invoice"], match.LINE, 2, 1.0).count() == 50


def test_a_run_stores_invoices_once_to_number_them_and_leaves_no_scratch(spark, staged, tmp_path, monkeypatch):
    labels = []
    path_of = storage.scratch_path
    monkeypatch.setattr(storage, "scratch_path", lambda session, label: labels.append(path_of(session, label)) or labels[-1])
    full_run.run(staged, str(tmp_path / "w"))
    assert labels and not [p for p in labels if "unnumbered" in p]
    assert not [p for p in labels if os.path.exists(p)]
    assert spark.conf.get(storage.SHUFFLE_CLEANUP, None) != "true"


def test_lookups_of_referred_rows_give_what_the_whole_master_gives(spark):
    master = spark.createDataFrame([(f"K{n}", f"V{n}") for n in range(50)] + [(None, "V"), ("K1", "W")], "k string, v string")
    fact = spark.createDataFrame([("K1",), ("K7",), ("X",), (None,), ("K7",)], "code string")
    other = spark.createDataFrame([("K9",), (None,)], "code string")
    few = referred(master, "k", "v", [(fact, "code"), (other, "code")])
    assert sorted(map(tuple, few.collect())) == [("K1", "V1"), ("K1", "W"), ("K7", "V7"), ("K9", "V9")]
    for rows in (fact, other):
        whole, part = (resolve(rows, "code", m, "k", "v", "r") for m in (master, few))
        assert sorted(map(repr, part.collect())) == sorted(map(repr, whole.collect()))

import random
import uuid

import pytest
from test_incremental_match import extract, frames

from ledgerloom.plans import match, star
from ledgerloom.sinks.together import drop_together, match_together, store_together


@pytest.fixture(scope="module")
def facts(spark):
    rows = extract(11, orders=60)
    chance = random.Random(1)
    # One PO line with more invoice lines than all others.
    hot = [(f"B{chance.randint(0, 40)}", "L1", "P1", 1, 1, 2.5, "2025-01-01") for _ in range(200)]
    rows["invoice"] += [(0, bill) for bill in hot]
    staged = frames(spark, rows, range(3))
    xref = spark.createDataFrame([("L1", "V1"), ("L2", "V2")], "LegacyVendorCode string, VendorAccount string")
    items = spark.createDataFrame([("I1",)], "ItemNumber string")
    return {
        "fact_invoice": star.fact_invoice(staged["invoice"], xref),
        "fact_po_line": star.fact_po_line(staged["po_line"], xref, items),
        "fact_receipt": star.fact_receipt(staged["receipt"]),
    }


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def prefix(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    drop_together(spark, name)


def test_no_fact_moves(spark, facts, prefix):
    assert len(store_together(facts, prefix, buckets=3)) == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        stored = match_together(spark, prefix)
        found = rows_of(stored)
        plan = stored._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert found == rows_of(match.three_way_match(facts["fact_invoice"], facts["fact_po_line"], facts["fact_receipt"]))


def test_hot_lines_are_kept_apart_and_sliced(spark, facts, prefix):
    names = store_together(facts, prefix, buckets=3, hot_rows=100, fraction=1)
    assert len(names) == 6
    assert spark.read.table(f"{prefix}_fact_invoice").filter("POLineKey = 'P1-1'").isEmpty()
    assert spark.read.table(f"{prefix}_hot_fact_invoice").select("POLineKey").distinct().count() == 1
    whole = match.three_way_match(facts["fact_invoice"], facts["fact_po_line"], facts["fact_receipt"])
    assert rows_of(match_together(spark, prefix, slice_rows=16)) == rows_of(whole)

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators.lookups import RepeatedKey
from ledgerloom.plans import match, star
from ledgerloom.sinks.table_set import TableSet
from ledgerloom.streaming import incremental_match
from ledgerloom.streaming.incremental_match import CHANGES, IncrementalMatch, follow, read_changes


def extract(seed, orders=25):
    """Staged rows of random procurement, copies and faults included, with the batch each arrives in."""
    chance = random.Random(seed)
    rows = {"invoice": [], "receipt": [], "po_line": []}
    day = lambda: f"2025-0{chance.randint(1, 9)}-1{chance.randint(0, 9)}"
    for n in range(orders):
        po, quantity, price = f"P{n}", chance.randint(1, 9), chance.choice([1.0, 2.5, 9.99])
        if n % 6:
            rows["po_line"].append((po, 1, chance.choice(["L1", "L2", "L9"]), "I1", quantity, price, day(), "S"))
        for _ in range(chance.randint(0, 2)):
            rows["receipt"].append((f"R{chance.randint(0, 99)}", po, 1, chance.randint(0, 9), day()))
        for _ in range(chance.randint(0, 4)):
            bill = (f"B{chance.randint(0, 9)}", chance.choice(["L1", "L2", "L9"]), po, 1, chance.randint(1, 5), price * chance.choice([1, 1, 1.04, 1.2]), day())
            rows["invoice"] += [bill] * chance.choice([1, 1, 2])
    return {entity: [(chance.randint(0, 2), row) for row in found] for entity, found in rows.items()}


@pytest.fixture(scope="module")
def masters(spark):
    xref = spark.createDataFrame([("L1", "V1"), ("L2", "V2")], "LegacyVendorCode string, VendorAccount string")
    return xref, spark.createDataFrame([("I1",)], "ItemNumber string")


def frames(spark, rows, batches):
    return {
        entity: spark.createDataFrame([row for batch, row in rows[entity] if batch in batches], CHANGES[entity])
        for entity in CHANGES
    }


def full(spark, masters, rows, batches):
    staged = frames(spark, rows, batches)
    xref, items = masters
    return match.three_way_match(
        star.fact_invoice(staged["invoice"], xref), star.fact_po_line(staged["po_line"], xref, items), star.fact_receipt(staged["receipt"])
    )


def plain(df):
    return sorted(map(repr, df.drop("InvoiceLineID").collect()))


def test_every_batch_gives_what_one_run_over_all_so_far_gives(spark, masters, tmp_path):
    rows = extract(1)
    target = IncrementalMatch(TableSet(spark, str(tmp_path / "state")), *masters, buckets=4)
    for batch in range(3):
        assert target.apply(batch, frames(spark, rows, [batch]))
        assert plain(target.current()) == plain(full(spark, masters, rows, range(batch + 1)))
    statuses = {r.MatchStatus for r in target.current().collect()}
    assert len(statuses) >= 5
    kept = target.current().select("InvoiceLineID").distinct().count() + target.unmatched().count()
    assert kept == len(rows["invoice"])


def test_a_batch_that_comes_again_changes_nothing(spark, masters, tmp_path):
    rows = extract(2, orders=8)
    target = IncrementalMatch(TableSet(spark, str(tmp_path / "state")), *masters, buckets=2)
    target.apply(0, frames(spark, rows, [0, 1]))
    before = sorted(map(repr, target.current().collect()))
    assert not target.apply(0, frames(spark, rows, [0, 1]))
    assert sorted(map(repr, target.current().collect())) == before
    assert target.applied().number == 1


def test_a_batch_that_stops_leaves_nothing_and_can_be_repeated(spark, masters, tmp_path, monkeypatch):
    rows = extract(3, orders=8)
    target = IncrementalMatch(TableSet(spark, str(tmp_path / "state")), *masters, buckets=2)
    target.apply(0, frames(spark, rows, [0]))
    before = plain(target.current())
    whole = incremental_match.match.three_way_match

    def stops(*args, **options):
        raise OSError("stopped")

    monkeypatch.setattr(incremental_match.match, "three_way_match", stops)
    with pytest.raises(OSError):
        target.apply(1, frames(spark, rows, [1, 2]))
    assert plain(target.current()) == before
    monkeypatch.setattr(incremental_match.match, "three_way_match", whole)
    assert target.apply(1, frames(spark, rows, [1, 2]))
    assert plain(target.current()) == plain(full(spark, masters, rows, range(3)))


def test_numbers_stay_and_compaction_keeps_the_rows(spark, masters, tmp_path):
    rows = extract(4, orders=12)
    tables = TableSet(spark, str(tmp_path / "state"))
    target = IncrementalMatch(tables, *masters, buckets=2)
    numbers = {}
    for batch in range(3):
        target.apply(batch, frames(spark, rows, [batch]))
        found = {r.InvoiceLineID: repr(r[1:]) for r in tables.read("fact_invoice").drop("bucket").collect()}
        assert numbers.items() <= found.items()
        numbers = found
    assert sorted(numbers) == list(range(1, len(rows["invoice"]) + 1))
    before = sorted(map(repr, target.current().collect()))
    version = target.compact()
    assert all(len(folders) == 1 for folders in version.tables.values())
    assert sorted(map(repr, target.current().collect())) == before
    assert tables.read("match").count() == len(before)
    tables.remove_before(version.number)
    assert sorted(map(repr, target.current().collect())) == before
    assert not target.apply(2, frames(spark, rows, [2]))


def test_a_po_line_arrives_once(spark, masters, tmp_path):
    rows = extract(5, orders=4)
    target = IncrementalMatch(TableSet(spark, str(tmp_path / "state")), *masters, buckets=2)
    target.apply(0, frames(spark, rows, range(3)))
    with pytest.raises(RepeatedKey):
        target.apply(1, frames(spark, rows, range(3)))


def test_a_stream_of_files_and_a_restart(spark, masters, tmp_path):
    rows = extract(6, orders=10)
    folder = str(tmp_path / "landed")
    tables = TableSet(spark, str(tmp_path / "state"))
    for batch in range(3):
        for entity, frame in frames(spark, rows, [batch]).items():
            frame.coalesce(1).write.mode("append").parquet(f"{folder}/{entity}")
        target = IncrementalMatch(tables, *masters, buckets=2)
        follow(read_changes(spark, folder), target, f"{folder}/checkpoint").awaitTermination()
        assert plain(target.current()) == plain(full(spark, masters, rows, range(batch + 1)))
    assert tables.current().notes["batches"] == {"changes": 2}
    assert [f.name for f in schemas.INVOICE] == [f.name for f in read_changes(spark, folder).schema["invoice"].dataType]


def test_files_hold_ranges_of_buckets(spark, masters, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables = TableSet(spark, str(tmp_path / "state"))
    IncrementalMatch(tables, *masters, buckets=16).apply(0, frames(spark, extract(7, orders=60), [0, 1]))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = tables.read("fact_invoice").withColumn("file", F.input_file_name())
    spans = sorted(
        (r.low, r.high) for r in stored.groupBy("file").agg(F.min("bucket").alias("low"), F.max("bucket").alias("high")).collect()
    )
    assert len(spans) > 1 and all(one[1] <= two[0] for one, two in zip(spans, spans[1:]))
    plan = tables.read("fact_invoice").filter(F.col("bucket").isin([3, 5]))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(bucket, [3,5])]" in plan


def test_rows_rank_by_columns_as_by_numbers_hot_or_not(spark, masters):
    staged = frames(spark, extract(5, orders=40), range(3))
    bills = star.fact_invoice(staged["invoice"], masters[0])
    facts = star.fact_po_line(staged["po_line"], *masters), star.fact_receipt(staged["receipt"])
    order = ["InvoiceNumber", "VendorAccount", "InvoiceQty", "InvoiceUnitPrice", "InvoiceDate", "InvoiceLineID"]
    by_number = sorted(map(repr, match.three_way_match(bills, *facts).collect()))
    assert sorted(map(repr, match.three_way_match(bills, *facts, order_by=order).collect())) == by_number
    split = match.three_way_match(bills, *facts, hot_rows=3, slice_rows=4, fraction=1, order_by=order)
    assert sorted(map(repr, split.collect())) == by_number


def test_a_batch_numbers_its_own_lines_only_and_moves_no_fact_to_store_it(spark, masters, tmp_path, monkeypatch):
    rows = extract(6, orders=10)
    target = IncrementalMatch(TableSet(spark, str(tmp_path / "state")), *masters, buckets=4)
    plans = []
    laid_out = incremental_match._laid_out

    def noted(df):
        plans.append(df)
        return laid_out(df)

    monkeypatch.setattr(incremental_match, "_laid_out", noted)
    for batch in range(2):
        target.apply(batch, frames(spark, rows, [batch]))
    assert len(plans) == 6
    for df in plans:
        assert "rangepartitioning" not in laid_out(df)._jdf.queryExecution().executedPlan().toString()
    current = target.current()._jdf.queryExecution().optimizedPlan().toString()
    assert current.count("Union") == 1 and plain(target.current()) == plain(full(spark, masters, rows, range(2)))

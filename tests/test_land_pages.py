import json
import gzip
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import storage
from ledgerloom.adapters.tpch import land_pages
from ledgerloom.operators.numbering import numbered_ranges, with_arrival

ELEMENT = T.StructType([T.StructField("k", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("day", T.StringType())])


def landed(folder):
    """Elements and next link of each page, by its number."""
    found = {}
    for path in folder.glob("page=E_page*/*.txt.gz"):
        number = int(path.parent.name.removeprefix("page=E_page"))
        assert number not in found
        (line,) = gzip.decompress(path.read_bytes()).decode().splitlines()
        page = json.loads(line)
        found[number] = [tuple(e.get(f.name) for f in ELEMENT.fields) for e in page["value"]], page.get("@odata.nextLink")
    return found


def rows_of(n):
    """Copies, a key with many rows and a NULL among them."""
    return [(None if i == 3 else f"k{i * 7 % 41 if i % 3 else 5:02d}", i % 4, f"2025-01-{i % 5 + 1:02d}") for i in range(n)]


@pytest.mark.parametrize("arrival", [None, "_arrival"])
@pytest.mark.parametrize("n, page_rows", [(203, 10), (200, 10), (7, 10), (40, 1)])
def test_pages_are_the_rows_in_order_whatever_their_ranges(spark, tmp_path, n, page_rows, arrival):
    df = spark.createDataFrame(rows_of(n), "k string, price int, day string").repartition(5)
    df = df.withColumn("day", F.col("day").cast("date")).withColumn("price", F.col("price").cast("decimal(12,2)"))
    df = storage.materialize(df, "rows")
    land_pages(with_arrival(df) if arrival else df, "E", str(tmp_path / "p"), ["k"], page_rows, ELEMENT, arrival)
    pages = landed(tmp_path / "p")
    order = sorted(rows_of(n), key=lambda row: (row[0] is not None, row))
    expected = [(k, float(price), day) for k, price, day in order]
    assert sorted(pages) == list(range(1, -(-n // page_rows) + 1))
    assert [row for number in sorted(pages) for row in pages[number][0]] == expected
    links = [pages[number][1] for number in sorted(pages)]
    assert links == [f"https://host.example/data/E_page{i + 2}.json" for i in range(len(pages) - 1)] + [None]


def test_a_page_within_a_range_is_made_where_it_lies(spark):
    df = storage.materialize(spark.range(500).withColumn("t", F.lit("x")), "rows")
    rows = numbered_ranges(df, ["id"], "n", together=True)
    pages = rows.groupBy("_range", F.floor(F.col("n") / 10)).agg(F.collect_list("id"))
    plan = pages._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Exchange hashpartitioning" not in plan
    assert sorted(i for row in pages.collect() for i in row[2]) == list(range(500))
    spans = rows.groupBy("_range", "_start", "_size").agg(F.min("n"), F.max("n"), F.count("n")).collect()
    assert len(spans) > 1
    assert all(r[3] == r["_start"] + 1 and r[4] == r["_start"] + r["_size"] and r[5] == r["_size"] for r in spans)


def test_landing_leaves_the_pages_alone(spark, tmp_path, monkeypatch):
    paths = []
    for module in ("ledgerloom.storage", "ledgerloom.operators.numbering"):
        path_of = storage.scratch_path
        monkeypatch.setattr(f"{module}.scratch_path", lambda s, label, f=path_of: paths.append(f(s, label)) or paths[-1])
    land_pages(spark.range(95).select("id"), "E", str(tmp_path / "p"), ["id"], 10)
    assert len([f for f in (tmp_path / "p").glob("page=E_page*/*.txt.gz")]) == 10
    assert len(paths) >= 3 and not [p for p in paths if os.path.exists(p)]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]

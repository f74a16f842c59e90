import json

import pytest
from pyspark.sql import types as T

from ledgerloom.sinks.table_set import TableSet
from ledgerloom.streaming.page_stream import PageLoads, _open_ends, follow_pages, page_headers

ELEMENT = T.StructType([T.StructField("n", T.LongType())])


class Landing:
    """A folder of pages, and the loads that follow it."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "pages").mkdir()
        self.tables = TableSet(spark, str(folder / "set"))

    def land(self, entity, number, last=False, name=None, rows=2, link=None):
        link = link or f"https://host.example/data/{entity}_page{number + 1}.json"
        page = {"value": [{"n": 10 * number + i, "other": "x"} for i in range(rows)]} | ({} if last else {"@odata.nextLink": link})
        (self.folder / "pages" / (name or f"{entity}_page{number}.json")).write_text(json.dumps(page, indent=1))

    def follow(self):
        elements = {"A": ("stg_a", ELEMENT), "B": ("stg_b", ELEMENT)}
        loads = PageLoads(self.tables, str(self.folder / "pages"), elements)
        headers = page_headers(self.spark, str(self.folder / "pages"))
        query = follow_pages(headers, loads, str(self.folder / "checkpoint"), buckets=2)
        query.awaitTermination()
        return loads

    def loaded(self):
        return {t: sorted(r.n for r in df.collect()) for t, df in self.tables.read_all().items() if t.startswith("stg")}

    def open_ends(self, entity):
        row = PageLoads(self.tables, "", {}).totals().filter(f"entity = '{entity}'").first()
        return {name: value for name, value in row.asDict().items() if value and name not in ("entity", "closed")}


def test_chains_close_in_any_order_over_restarts(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    landing.land("A", 3, last=True)
    landing.land("A", 1)
    landing.land("B", 2, last=True)
    landing.follow()
    assert landing.loaded() == {}
    assert landing.open_ends("A") == {"pages": 2, "last_pages": 1, "missing": 1, "unlinked": 1}
    landing.land("B", 1)
    landing.land("A", 1, name="A_page1_again.json", rows=9)
    landing.follow()
    assert landing.loaded() == {"stg_b": [10, 11, 20, 21]}
    landing.land("A", 2)
    loads = landing.follow()
    assert landing.loaded() == {"stg_a": [10, 11, 20, 21, 30, 31], "stg_b": [10, 11, 20, 21]}
    log = landing.tables.read("page_log").collect()
    refused = [r.file for r in log if not r.accepted]
    assert len(refused) == 1 and "A_page1" in refused[0] and len(log) == 6
    assert {r.entity: r.closed for r in loads.totals().collect()} == {"A": True, "B": True}
    batch = landing.tables.current().notes["batch"]
    assert batch == 2 and not loads.apply(landing.tables.read("page_log"), batch)


@pytest.mark.parametrize(
    ("pages", "fault"),
    [
        ([(1, {"link": "https://host.example/other"})], "bad_links"),
        ([(1, {}), (2, {"link": "https://host.example/A_page1"})], "backward"),
        ([(1, {"link": "https://host.example/A_page3"}), (2, {}), (3, {"last": True})], "too_many_links"),
    ],
)
def test_faults_hold_an_entity_back(spark, tmp_path, pages, fault):
    landing = Landing(spark, tmp_path)
    for number, options in pages:
        landing.land("A", number, **options)
    landing.follow()
    assert landing.loaded() == {} and fault in landing.open_ends("A")


def test_open_ends():
    assert _open_ends(True, 0, True) == (0, 0, 0)
    assert _open_ends(True, 0, False) == (0, 1, 0)
    assert _open_ends(False, 1, False) == (1, 0, 0)
    assert _open_ends(True, 1, True) == (0, 0, 1)
    assert _open_ends(True, 2, False) == (0, 0, 1)


def test_a_batch_reads_sums_and_keeps_state_in_few_tasks(spark, tmp_path):
    landing = Landing(spark, tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        for number in (1, 2, 3):
            landing.land("A", number, last=number == 3)
            landing.follow()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "32"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    version = landing.tables.current()
    assert len(version.tables["page_sums"]) == 1 and len(version.tables["page_totals"]) == 3
    sums = landing.tables.read("page_sums").collect()
    assert [(r.entity, r.pages, r.last_pages, r.missing) for r in sums] == [("A", 3, 1, 0)]
    assert landing.loaded() == {"stg_a": [10, 11, 20, 21, 30, 31]}
    assert '"spark.sql.shuffle.partitions":"8"' in (tmp_path / "checkpoint" / "offsets" / "0").read_text()

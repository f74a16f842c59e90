import json

import pytest

from ledgerloom import schemas
from ledgerloom.sources.calendar import date_rows, date_rows_spanning
from ledgerloom.sources.csv_text import read_text_csv
from ledgerloom.sources.paged_json import IncompletePages, page_manifest, read_entity, read_pages

ENTITY = "ProductReceiptLines"


def write_page(folder, number, rows, following=None, name=ENTITY):
    page = {"@odata.context": "ignored", "value": rows}
    if rows is None:
        del page["value"]
    if following is not None:
        page["@odata.nextLink"] = f"https://host.example/data/{name}_page{following}.json"
    (folder / f"{name}_page{number}.json").write_text(json.dumps(page, indent=1))


def receipt(number):
    return {
        "ReceiptNumber": f"R{number}",
        "PurchaseOrderNumber": "P1",
        "LineNumber": 1,
        "ReceivedQuantity": number,
        "ReceiptDate": "2025-01-01",
    }


def read(spark, folder):
    return read_entity(spark, str(folder), ENTITY, schemas.RECEIPT)


def test_pages_are_read_as_one_table(spark, tmp_path):
    write_page(tmp_path, 1, [receipt(1), receipt(2)], 2)
    write_page(tmp_path, 2, [receipt(3)], 3)
    write_page(tmp_path, 3, [])
    rows = read(spark, tmp_path)
    assert rows.schema == schemas.RECEIPT
    assert sorted(r.ReceivedQuantity for r in rows.collect()) == [1, 2, 3]


def test_manifest(spark, tmp_path):
    write_page(tmp_path, 1, [receipt(1), receipt(2)], 2)
    write_page(tmp_path, 2, [receipt(3)])
    pages = read_pages(spark, str(tmp_path), ENTITY, schemas.RECEIPT)
    manifest = page_manifest(pages, ENTITY).orderBy("page").collect()
    assert [tuple(r) for r in manifest] == [
        (ENTITY, f"{ENTITY}_page1", f"{ENTITY}_page2", 2),
        (ENTITY, f"{ENTITY}_page2", None, 1),
    ]


def test_one_empty_page_is_an_empty_entity(spark, tmp_path):
    write_page(tmp_path, 1, [])
    assert read(spark, tmp_path).count() == 0


@pytest.mark.parametrize(
    "pages, fault",
    [
        ([(1, [receipt(1)], 2)], "missing pages"),
        ([(2, [receipt(1)], None)], "no first page"),
        ([(1, [receipt(1)], None), (2, [receipt(2)], None)], "last pages other than one"),
        ([(1, None, None)], "pages without rows array"),
        ([(1, [], None), (2, [], 3), (3, [], 2)], "backward links"),
        ([(1, [], 3), (2, [], 3), (3, [], None)], "pages with too many links"),
        ([(1, [receipt(1)], 2), (2, [receipt(2)], 1)], "last pages other than one"),
        ([(1, [receipt(1)], None), (3, [receipt(2)], 4), (4, [], 3)], "backward links"),
    ],
)
def test_incomplete_pages_stop_the_load(spark, tmp_path, pages, fault):
    for page in pages:
        write_page(tmp_path, *page)
    with pytest.raises(IncompletePages, match=fault):
        read(spark, tmp_path)


def write_opaque(folder, links):
    """Three pages whose links are tokens."""
    for n, link in enumerate(links, 1):
        page = {"value": [receipt(n)]}
        if link:
            page["@odata.nextLink"] = link
        (folder / f"{ENTITY}_page{n}.json").write_text(json.dumps(page))


def test_opaque_links_need_to_be_placed(spark, tmp_path):
    base = "https://host.example/data?$skiptoken="
    write_opaque(tmp_path, [f"{base}100", f"{base}200", None])
    with pytest.raises(IncompletePages, match="links to no known page': 2"):
        read(spark, tmp_path)
    landed = [(f"{base}100", f"{ENTITY}_page2"), (f"{base}200", f"{ENTITY}_page3")]
    links = spark.createDataFrame(landed, "link string, page string")
    rows = read_entity(spark, str(tmp_path), ENTITY, schemas.RECEIPT, links=links)
    assert rows.count() == 3
    wrong = spark.createDataFrame([landed[0], (landed[1][0], f"{ENTITY}_page2")], "link string, page string")
    with pytest.raises(IncompletePages, match="pages with too many links"):
        read_entity(spark, str(tmp_path), ENTITY, schemas.RECEIPT, links=wrong)


def test_a_broken_page_stops_the_load(spark, tmp_path):
    write_page(tmp_path, 1, [receipt(1)], 2)
    (tmp_path / f"{ENTITY}_page2.json").write_text('{"value": [{"ReceiptNumber": "R2"')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read(spark, tmp_path)


def test_a_page_landed_twice_stops_the_load(spark, tmp_path):
    write_page(tmp_path, 1, [receipt(1)])
    copy = tmp_path / f"{ENTITY}_page1 (2).json"
    copy.write_text((tmp_path / f"{ENTITY}_page1.json").read_text())
    with pytest.raises(IncompletePages, match="repeated pages"):
        read(spark, tmp_path)


def test_csv_is_text_with_blanks(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text('a,b,c\n1,,"x, y"\n" 2 ","say ""hi""",\n')
    rows = read_text_csv(spark, str(path), ["a", "b", "c"]).collect()
    assert [tuple(r) for r in rows] == [("1", "", "x, y"), (" 2 ", 'say "hi"', "")]


def test_csv_line_breaks_need_multi_line(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text('a,b\n1,"x\ny"\n')
    rows = read_text_csv(spark, str(path), ["a", "b"], multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "x\ny")]
    with pytest.raises(Exception):
        read_text_csv(spark, str(path), ["a", "b"]).collect()


def test_csv_with_another_header_raises(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("a,z\n1,2\n")
    with pytest.raises(Exception):
        read_text_csv(spark, str(path), ["a", "b"]).collect()


def test_calendar(spark):
    days = date_rows(spark)
    assert days.count() == 730
    assert [str(r.Date) for r in days.orderBy("Date").collect()][::729] == ["2025-01-01", "2026-12-31"]
    some = spark.sql("select date'2024-02-28' as d union all select date'2024-03-01'")
    assert date_rows_spanning(some, "d").count() == 3
    assert date_rows_spanning(some.limit(0), "d").count() == 0

"""The five staged tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import schemas
from ledgerloom.runlog import RunLog
from ledgerloom.sources.csv_text import read_text_csv
from ledgerloom.sources.paged_json import read_entity

MASTERS = {
    "stg_vendor": ("legacy_vendors", schemas.VENDOR_COLUMNS),
    "stg_item": ("legacy_items", schemas.ITEM_COLUMNS),
}


def stage_all(
    spark: SparkSession,
    master_dir: str,
    page_dir: str,
    run_log: RunLog | None = None,
    multi_line: bool = False,
    links: DataFrame | None = None,
    page_files: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Vendors and items (CSV) and PO, receipt and invoice lines (paged JSON).

    The pages are parsed, stored and checked here; the CSV masters are read, and counted for the log, when a result
    asks for them. `multi_line` allows line breaks in their quoted values; `links` places next links that do not
    name their page; `page_files` gives a file pattern for entities whose pages are not plain files of `page_dir`.
    """
    master_dir = master_dir.rstrip("/")
    staged = {}
    for table, (file, columns) in MASTERS.items():
        rows = read_text_csv(spark, f"{master_dir}/{file}.csv", columns, multi_line)
        staged[table] = rows if run_log is None else run_log.observe(rows, "extract", file)
    for table, (entity, element) in schemas.ENTITIES.items():
        files = (page_files or {}).get(entity)
        staged[table] = read_entity(spark, page_dir, entity, element, files, run_log, links)
    return staged


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

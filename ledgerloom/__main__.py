"""The full run from the command line or `spark-submit`.

    python -m ledgerloom --masters DIR --pages DIR --files DIR [--warehouse DIR] [--single-file] [--multi-line]
                         [--links FILE] [--master local[*]]

Reads the CSV masters and the JSON pages, writes every staged, governed and modelled table under the warehouse
folder and the import and exception files under the files folder, and prints row counts, the reconciliation and the
match summary.
"""

from __future__ import annotations

import argparse

from ledgerloom.plans import kpis, match
from ledgerloom.plans.run import run
from ledgerloom.runlog import RunLog
from ledgerloom.session import build_session
from ledgerloom.sinks import files
from ledgerloom.sources.csv_text import read_text_csv
from ledgerloom.sources.registry import stage_all
from ledgerloom.storage import scratch_of_a_run


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerloom")
    parser.add_argument("--masters", required=True, help="folder with the vendor and item CSV files")
    parser.add_argument("--pages", required=True, help="folder with the JSON pages")
    parser.add_argument("--warehouse", help="folder for the tables; the catalog of the session without it")
    parser.add_argument("--files", required=True, help="folder for the import and exception files")
    parser.add_argument("--single-file", action="store_true", help="one CSV part each, for receivers that need it")
    parser.add_argument("--multi-line", action="store_true", help="quoted values of the CSV files hold line breaks")
    parser.add_argument("--links", help="CSV of link,page for next links that do not name their page")
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    options = parser.parse_args(arguments)

    spark = build_session("ledgerloom", options.master)
    log = RunLog()
    links = read_text_csv(spark, options.links, ["link", "page"]) if options.links else None
    with scratch_of_a_run(spark):
        staged = stage_all(spark, options.masters, options.pages, log, options.multi_line, links)
        tables = run(staged, options.warehouse, run_log=log)
    folder = options.files.rstrip("/")
    files.write_import_file(tables["vendor_golden"], f"{folder}/vendor_import", options.single_file)
    files.write_exceptions_file(tables["dq_issues"], f"{folder}/blocking_issues", options.single_file)

    for row in log.frame(spark).collect():
        pages = "" if row.page_count is None else f" in {row.page_count} pages"
        print(f"[{row.stage}] {row.table_name}: {row.row_count} rows{pages}")
    for row in tables["reconciliation"].collect():
        print(f"[check] {row.table_name}: {row.Rows} of {row.Expected} rows{'' if row.Agrees else ', not all'}")
    left_out = tables["unmatched_invoice"].count()
    print(f"[check] {left_out} invoice lines have no PO line and are not in the match")
    ready = kpis.readiness(tables["vendor_golden"]).first()
    print(f"[files] {ready.ready} vendors ready | {ready.exceptions} sent to review")
    for row in match.status_summary(tables["fact_three_way_match"]).collect():
        print(f"[match] {row.MatchStatus}: {row.InvoiceLines} lines, {row.Amount}, {row.PctOfLines} %")


if __name__ == "__main__":
    main()

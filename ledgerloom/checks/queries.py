"""Every operator as a query over a folder of parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.adapters.tpch import ProcureToPay, land_pages
from ledgerloom.functions import numbers
from ledgerloom.functions.dates import year_month
from ledgerloom.functions.text import account_code, is_blank, is_email, line_key, normalize_name, strip
from ledgerloom.operators import content_tree, profile, sketches
from ledgerloom.operators.appending import last_number, number_more, rank_more
from ledgerloom.operators.groups import first_of
from ledgerloom.operators.lookups import in_set, resolve
from ledgerloom.operators.numbering import number_rows, with_arrival
from ledgerloom.plans import explore, kpis, master, match, quality, reconcile, star
from ledgerloom.plans.run import run
from ledgerloom.rules import Rules
from ledgerloom.runlog import RunLog
from ledgerloom.sinks import files
from ledgerloom.sinks.dated import write_by_month
from ledgerloom.sinks.table_set import TableSet
from ledgerloom.sinks.tables import load_tables, replace_parquet, replace_table
from ledgerloom.sinks.together import match_together as stored_match
from ledgerloom.sinks.together import store_together
from ledgerloom.sources.calendar import date_rows_spanning
from ledgerloom.sources.csv_text import read_text_csv
from ledgerloom.sources.paged_json import page_faults, page_manifest, read_entity, read_pages
from ledgerloom.sources.registry import MASTERS, register_views, stage_all
from ledgerloom.sources.tables import read_parquet, read_table
from ledgerloom.storage import COMPRESSION, materialize, scratch_path
from ledgerloom.streaming.incremental_match import CHANGES, IncrementalMatch, follow, read_changes
from ledgerloom.streaming.page_stream import PageLoads, follow_pages, page_headers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

PAGE_ROWS = 5000


def query(build: Callable[[ProcureToPay], DataFrame]) -> Callable[[ProcureToPay], DataFrame]:
    """Register `build` under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(ProcureToPay(spark, sf_dir))
    return build


# Sources


def _landed_po_lines(p2p: ProcureToPay) -> str:
    lines = p2p.po_lines.withColumn("UnitPrice", F.col("UnitPrice").cast("double"))
    order = ["PurchaseOrderNumber", "LineNumber"]
    folder = scratch_path(p2p.spark, "pages")
    return land_pages(lines, "PurchaseOrderLines", folder, order, PAGE_ROWS)


@query
def src_paged_json(p2p):
    pattern = _landed_po_lines(p2p)
    return read_entity(p2p.spark, "", "PurchaseOrderLines", schemas.PO_LINE, files=pattern)


@query
def src_page_stream(p2p):
    """The same rows, loaded by a stream over the landing pages, four a batch or a sixteenth of them, once their chain has
    closed."""
    entity, pattern = "PurchaseOrderLines", _landed_po_lines(p2p)
    tables = TableSet(p2p.spark, scratch_path(p2p.spark, "staged"))
    loads = PageLoads(tables, "", {entity: ("stg_po_line", schemas.PO_LINE)}, {entity: pattern})
    pages = len(p2p.spark.read.schema("value string").text(pattern).inputFiles())
    headers = page_headers(p2p.spark, "", pattern, files_a_batch=max(4, pages // 16))
    follow_pages(headers, loads, scratch_path(p2p.spark, "checkpoint")).awaitTermination()
    return tables.read("stg_po_line")


@query
def src_page_manifest(p2p):
    pattern = _landed_po_lines(p2p)
    pages = read_pages(p2p.spark, "", "PurchaseOrderLines", schemas.PO_LINE, files=pattern)
    return page_manifest(pages, "PurchaseOrderLines")


@query
def src_page_totals(p2p):
    pattern = _landed_po_lines(p2p)
    log = RunLog()
    read_entity(p2p.spark, "", "PurchaseOrderLines", schemas.PO_LINE, files=pattern, run_log=log)
    return log.frame(p2p.spark)


@query
def src_page_faults(p2p):
    """Faults of the landed pages when one page in the middle of the chain is missing."""
    pattern = _landed_po_lines(p2p)
    pages = read_pages(p2p.spark, "", "PurchaseOrderLines", schemas.PO_LINE, files=pattern)
    manifest = page_manifest(pages, "PurchaseOrderLines")
    return page_faults(manifest.filter("page <> 'PurchaseOrderLines_page2'"), "PurchaseOrderLines")


def _staged_files(p2p: ProcureToPay) -> tuple[str, dict[str, str]]:
    """The staged tables landed as the files that `stage_all` reads."""
    masters, pages = scratch_path(p2p.spark, "masters"), scratch_path(p2p.spark, "entities")
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for table, (file, columns) in MASTERS.items():
        rows = p2p.staged[table].select(*columns)
        rows.write.option("header", True).option("escape", '"').options(**spaces).csv(f"{masters}/{file}.csv")
    files = {}
    lineitems = with_arrival(p2p.table("lineitem"))
    marked = {"stg_receipt": p2p.receipts_of(lineitems, "_arrival"), "stg_invoice": p2p.invoices_of(lineitems, "_arrival")}
    for table, (entity, element) in schemas.ENTITIES.items():
        order = [f.name for f in element.fields if f.name.endswith("Number")]
        rows, arrival = (marked[table], "_arrival") if table in marked else (p2p.staged[table], None)
        # Days were made texts; as days they are narrower on the way to their page, which has the text again.
        rows = rows.withColumns({f.name: F.col(f.name).cast("date") for f in element.fields if f.name.endswith("Date")})
        files[entity] = land_pages(rows, entity, f"{pages}/{entity}", order, PAGE_ROWS, element, arrival)
    return masters, files


@query
def src_staged_views(p2p):
    """All five sources read from files and asked by name."""
    masters, files = _staged_files(p2p)
    register_views(stage_all(p2p.spark, masters, "", page_files=files))
    counts = [f"select '{name}' as table_name, count(*) as row_count from {name}" for name in p2p.staged]
    return p2p.spark.sql(" union all ".join(counts))


@query
def src_catalog_table(p2p):
    """A table of the session's catalog, replaced and read by name."""
    name = f"dim_item_{uuid.uuid4().hex}"
    replace_table(star.dim_item(p2p.items), name)
    return read_table(p2p.spark, name)


@query
def dq_no_issues(p2p):
    """The issue log of vendors that pass every rule: empty, with its columns."""
    vendors = p2p.vendors
    for column, good in (("Currency", "USD"), ("PaymentTerms", "Net30"), ("Email", "ap@host.example")):
        vendors = vendors.withColumn(column, F.lit(good))
    code = F.col("VendorCode")
    clean = vendors.withColumn("TaxID", F.concat(F.lit("T"), code)).withColumn("VendorName", F.concat(F.lit("N"), code))
    governed = master.govern_vendors(clean)
    return governed["dq_issues"].unionByName(quality.no_issues(p2p.spark)).drop("DetectedAt")


@query
def src_csv_text(p2p):
    path = scratch_path(p2p.spark, "csv")
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    p2p.vendors.write.option("header", True).option("escape", '"').options(**spaces).csv(path)
    return read_text_csv(p2p.spark, path, schemas.VENDOR_COLUMNS)


@query
def src_stored_table(p2p):
    path = scratch_path(p2p.spark, "fact_po_line")
    replace_parquet(p2p.fact_po_line, path)
    return read_parquet(p2p.spark, path)


@query
def src_date_rows(p2p):
    orders = p2p.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return date_rows_spanning(orders, "day")


@query
def src_run_log(p2p):
    log = RunLog()
    for name, df in p2p.staged.items():
        log.observe(df, "extract", name).write.format("noop").mode("overwrite").save()
    return log.frame(p2p.spark)


# Sinks


@query
def snk_audited_load(p2p):
    folder = scratch_path(p2p.spark, "warehouse")
    loaded = load_tables({"stg_vendor": p2p.vendors}, folder, "LegacyERP")["stg_vendor"]
    return loaded.withColumn("stamped", F.col("_LoadedAt").isNotNull()).drop("_LoadedAt")


@query
def snk_load_log(p2p):
    log = RunLog()
    tables = {"fact_receipt": p2p.fact_receipt, "dim_item": star.dim_item(p2p.items)}
    load_tables(tables, scratch_path(p2p.spark, "warehouse"), "DataTeam", run_log=log)
    return log.frame(p2p.spark)


@query
def snk_import_file(p2p):
    path = scratch_path(p2p.spark, "import")
    files.write_import_file(p2p.golden, path)
    return read_text_csv(p2p.spark, path, ["VENDORACCOUNTNUMBER"])


@query
def snk_exceptions_file(p2p):
    path = scratch_path(p2p.spark, "exceptions")
    files.write_exceptions_file(quality.all_issues(p2p.survivors), path)
    rows = read_text_csv(p2p.spark, path, [f.name for f in schemas.ISSUE.fields])
    return rows.withColumn("DetectedAt", F.col("DetectedAt").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$"))


@query
def snk_full_reload(p2p):
    log = RunLog()
    run(p2p.staged, scratch_path(p2p.spark, "warehouse"), run_log=log)
    return log.frame(p2p.spark).select("table_name", "row_count")


@query
def snk_published_set(p2p):
    """Two versions of a set of tables, read as of each, after a run in between that stopped before it was published."""
    tables = TableSet(p2p.spark, scratch_path(p2p.spark, "published"))
    shipped = F.col("Site") == "SITE-F"
    runs = ((p2p.po_lines.filter(shipped), True), (p2p.po_lines.filter(~shipped), False), (p2p.po_lines, True))
    for lines, whole in runs:
        writing = tables.begin()
        loaded = writing.load({"stg_po_line": lines, "stg_item": p2p.items}, "ProcurementAPI")
        if whole:
            totals = loaded["stg_po_line"].groupBy("PurchaseOrderNumber").agg(F.sum("OrderedQuantity").alias("Quantity"))
            writing.write("order_totals", totals)
            writing.publish(replaced=["stg_po_line", "stg_item", "order_totals"])
    counts = None
    for version in tables.versions():
        for name, df in tables.read_all(version).items():
            row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(version.number).cast("long").alias("version"), F.lit(name).alias("table_name"), "row_count"
            )
            counts = row if counts is None else counts.unionByName(row)
    return counts


# Projections and filters


@query
def prj_columns(p2p):
    return p2p.typed_po_lines.select("LineNumber", "OrderedQty", F.col("POAmount").alias("Amount"))


@query
def flt_above(p2p):
    return explore.above(p2p.fact_po_line, "POAmount", 10000)


@query
def flt_count_above(p2p):
    return explore.count_above(p2p.typed_po_lines, "POAmount", 10000)


@query
def flt_large_orders(p2p):
    return explore.large_orders(p2p.typed_po_lines)


@query
def flt_in_list(p2p):
    return explore.in_list(p2p.fact_po_line, "LineNumber", [1, 2])


@query
def flt_not_in_list(p2p):
    return explore.not_in_list(p2p.fact_po_line, "LineNumber", [1, 2])


@query
def flt_in_range(p2p):
    return explore.in_range(p2p.fact_po_line, "UnitPrice", 920, 950)


@query
def flt_equals(p2p):
    return p2p.xref.filter(F.col("MatchType") == "Merged by Tax ID")


@query
def flt_non_blank(p2p):
    return p2p.vendors.filter(~is_blank(F.col("TaxID"))).select("VendorCode", "TaxID")


# Joins


@query
def join_resolve_vendor(p2p):
    resolved = resolve(
        p2p.po_lines, "VendorAccount", p2p.xref, "LegacyVendorCode", "VendorAccount", "ResolvedAccount"
    )
    return resolved.select("PurchaseOrderNumber", "LineNumber", "VendorAccount", "ResolvedAccount")


@query
def join_resolve_item(p2p):
    resolved = resolve(p2p.po_lines, "ItemNumber", p2p.items, "ItemNumber", "ItemNumber", "ResolvedItem")
    return resolved.select("PurchaseOrderNumber", "LineNumber", "ItemNumber", "ResolvedItem")


@query
def join_staged_to_xref(p2p):
    codes = p2p.xref.select(
        F.col("LegacyVendorCode").alias("VendorAccount"), F.col("VendorAccount").alias("NewAccount"), "MatchType"
    )
    return p2p.po_lines.join(codes, "VendorAccount").select(
        "PurchaseOrderNumber", "LineNumber", "NewAccount", "MatchType"
    )


@query
def join_receipt_totals(p2p):
    totals = match.receipt_totals(p2p.fact_receipt)
    lines = p2p.po_lines.select(
        line_key(F.col("PurchaseOrderNumber"), F.col("LineNumber")).alias("POLineKey"), "OrderedQuantity"
    )
    return lines.join(totals, "POLineKey", "left").select(
        "POLineKey",
        "OrderedQuantity",
        F.coalesce("ReceivedQty", F.lit(0)).cast("decimal(24,2)").alias("ReceivedQty"),
    )


@query
def join_blocked_codes(p2p):
    blocking = quality.row_issues(p2p.survivors).filter("IsBlocking")
    vendors = p2p.survivors.select("VendorCode", "SurvivorCode")
    return in_set(vendors, "VendorCode", blocking, "RecordKey", "Blocked")


@query
def join_terms_table(p2p):
    rules = Rules()
    pairs = [F.struct(F.lit(k).alias("key"), F.lit(v).alias("FixedTerms")) for k, v in rules.payment_terms_fix.items()]
    table = p2p.spark.range(1).select(F.inline(F.array(*pairs)))
    terms = strip(F.col("PaymentTerms"))
    # The rule table has a handful of rows.
    return (
        p2p.vendors.filter(~terms.isin(*rules.payment_terms))
        .withColumn("key", F.upper(terms))
        .join(F.broadcast(table), "key", "left")
        .select("VendorCode", "PaymentTerms", "FixedTerms")
    )


# Aggregates and windows


@query
def agg_receipt_totals(p2p):
    totals = match.receipt_totals(p2p.fact_receipt)
    return totals.select("POLineKey", F.col("ReceivedQty").cast("decimal(24,2)").alias("ReceivedQty"))


@query
def agg_repeated_tax_ids(p2p):
    keyed = p2p.vendors.filter(~is_blank(F.col("TaxID")))
    return keyed.groupBy("TaxID").agg(F.count(F.lit(1)).alias("vendors")).filter("vendors > 1")


@query
def win_surrogate_key(p2p):
    order = ["InvoiceNumber", "PurchaseOrderNumber", "LineNumber"]
    return number_rows(p2p.invoices, order, "InvoiceLineID")


@query
def win_duplicate_rank(p2p):
    ranked = match.with_running_quantities(p2p.fact_invoice)
    return ranked.select("InvoiceLineID", "VendorAccount", "InvoiceNumber", "POLineKey", "DupRank")


@query
def win_running_quantity(p2p):
    ranked = match.with_running_quantities(p2p.fact_invoice)
    running = F.col("CumInvoicedQty").cast("decimal(24,2)").alias("CumInvoicedQty")
    return ranked.select("InvoiceLineID", "POLineKey", "InvoiceQty", running)


def _loads(p2p: ProcureToPay) -> list[DataFrame]:
    """The invoice lines in three loads, by the last digit of the order number."""
    digit = F.substring("InvoiceNumber", -1, 1)
    return [p2p.invoices.filter(digit.isin(*digits)) for digits in (["0", "1", "2"], ["3", "4"], ["5", "6", "7", "8", "9"])]


@query
def win_append_numbers(p2p):
    """Numbers and copy ranks that three loads of invoice lines get, each without touching the loads before it."""
    order = ["InvoiceNumber", "PurchaseOrderNumber", "LineNumber"]
    copies = ["InvoiceNumber", "VendorAccount"]
    tables, after, ranked = TableSet(p2p.spark, scratch_path(p2p.spark, "appended")), 0, None
    for rows in _loads(p2p):
        numbered = number_more(rows, order, "InvoiceLineID", after)
        ranked = rank_more(numbered, ranked, copies, "InvoiceLineID", "CopyRank")
        writing = tables.begin()
        after = last_number(writing.write("invoice", ranked), "InvoiceLineID")
        writing.publish(added_to=["invoice"])
        ranked = tables.read("invoice")
    return ranked


@query
def win_oldest_by_tax_id(p2p):
    keyed = p2p.vendors.filter(~is_blank(F.col("TaxID")))
    return keyed.groupBy("TaxID").agg(first_of(["CreatedDate", "VendorCode"], "Oldest"))


@query
def win_oldest_by_name(p2p):
    named = p2p.vendors.withColumn("NormName", normalize_name(F.col("VendorName")))
    return named.groupBy("NormName").agg(first_of(["CreatedDate", "VendorCode"], "Oldest"))


@query
def win_dense_numbers(p2p):
    codes = p2p.vendors.select("VendorCode")
    return number_rows(codes, ["VendorCode"], "Number").withColumn("Code", account_code(F.col("Number")))


@query
def win_share_of_total(p2p):
    return kpis.share_by(p2p.vendors, "Country")


# Profile of the stored PO line fact


def _stored_fact(p2p: ProcureToPay) -> DataFrame:
    return materialize(p2p.fact_po_line, "fact_po_line")


@query
def profile_shape(p2p):
    return profile.shape(_stored_fact(p2p))


@query
def profile_columns(p2p):
    return profile.column_info(_stored_fact(p2p))


@query
def profile_nulls(p2p):
    return profile.null_counts(star.dim_vendor(p2p.golden))


@query
def profile_distinct(p2p):
    return profile.distinct_counts(_stored_fact(p2p))


@query
def profile_numeric(p2p):
    described = profile.describe(_stored_fact(p2p))
    rounded = [F.round(c, 4).alias(c) for c in described.columns[2:]]
    return described.select("column_name", F.col("count").alias("row_count"), *rounded)


def _three_loads(df: DataFrame) -> DataFrame:
    """What three loads of the rows keep, as one stored table of sketches."""
    kept = None
    for load in range(3):
        rows = sketches.sketch_columns(df.filter(F.pmod(F.xxhash64("POLineKey"), F.lit(3)) == load))
        kept = rows if kept is None else kept.unionByName(rows)
    return materialize(kept, "sketches")


@query
def profile_sketch_distinct(p2p):
    """Distinct values of a table from the sketches of its three loads: within the bound of the exact counts?"""
    fact = _stored_fact(p2p)
    exact = profile.distinct_counts(fact)
    estimated = sketches.distinct_estimates(_three_loads(fact)).withColumnRenamed("distinct_count", "estimate")
    off = F.abs(F.col("estimate") - F.col("distinct_count"))
    near = (off <= sketches.DISTINCT_ERROR * F.col("distinct_count")).alias("within_bound")
    return exact.join(estimated, "column_name").select("column_name", "row_count", "null_count", "distinct_count", near)


@query
def profile_sketch_quantiles(p2p):
    """Quartiles of a table from the sketches of its three loads: is their rank within the bound?"""
    fact = _stored_fact(p2p)
    columns = profile.numeric_columns(fact)
    found = {row.column_name: row for row in sketches.quantile_estimates(_three_loads(fact)).collect()}
    checks = None
    for c in columns:
        near = []
        for q in profile.PERCENTILES:
            value, name = F.lit(found[c][profile.percentile_name(q)]), profile.percentile_name(q)
            below, upto = F.avg((F.col(c).cast("double") < value).cast("double")), F.avg((F.col(c).cast("double") <= value).cast("double"))
            near.append(((below <= q + sketches.RANK_ERROR) & (upto >= q - sketches.RANK_ERROR)).alias(name))
        row = fact.agg(*near).select(F.lit(c).alias("column_name"), "*")
        checks = row if checks is None else checks.unionByName(row)
    return checks


@query
def profile_key_overlap(p2p):
    """PO lines, PO lines with a receipt, and what both share, from sketches: within the bound of the exact counts?"""
    lines, receipts = materialize(p2p.fact_po_line, "lines"), materialize(p2p.fact_receipt, "receipts")
    estimate = sketches.key_overlap(
        sketches.sketch_columns(lines, ["POLineKey"]), sketches.sketch_columns(receipts, ["POLineKey"]), "POLineKey"
    ).first()
    keys, received = lines.select("POLineKey").distinct(), receipts.select("POLineKey").distinct()
    exact = {"first_values": keys, "second_values": received, "shared": keys.join(received, "POLineKey")}
    rows = None
    for name, df in exact.items():
        count = F.count(F.lit(1))
        bound = sketches.OVERLAP_ERROR * max(estimate.first_values, estimate.second_values)
        row = df.agg(count.alias("n"), (F.abs(count - F.lit(estimate[name])) <= bound).alias("within_bound"))
        row = row.select(F.lit(name).alias("measure"), "*")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query
def ord_head(p2p):
    return explore.head(p2p.fact_po_line, ["POLineKey"])


@query
def ord_top_lines(p2p):
    return explore.top(p2p.fact_po_line, "POAmount", ["POLineKey"])


# Scalar functions


@query
def sca_strip(p2p):
    return p2p.vendors.select(
        "VendorCode", strip(F.col("PaymentTerms")).alias("Terms"), strip(F.col("Email")).alias("Email")
    )


@query
def sca_normalize_name(p2p):
    return p2p.vendors.select("VendorCode", normalize_name(F.col("VendorName")).alias("NormName"))


@query
def sca_email_test(p2p):
    return p2p.vendors.select("VendorCode", is_email(strip(F.col("Email"))).alias("IsEmail"))


@query
def sca_fixed_terms(p2p):
    fixed = quality.standard_terms(p2p.vendors, Rules())
    return fixed.select("VendorCode", "PaymentTerms")


@query
def sca_line_key(p2p):
    part = F.when(F.col("Site") == "SITE-F", F.col("LineNumber"))
    return p2p.po_lines.select(
        "PurchaseOrderNumber", "LineNumber", line_key(F.col("PurchaseOrderNumber"), part).alias("LineKey")
    )


@query
def sca_exact_amount(p2p):
    """Amounts of prices with nine decimals: only the product is rounded."""
    price = F.col("l_tax").cast("decimal(4,2)") * F.lit(Decimal("0.0000001"))
    quantity = F.col("l_quantity").cast("long") * 100000
    return p2p.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numbers.amount(quantity, price).alias("Amount")
    )


@query
def sca_decimal_casts(p2p):
    return p2p.po_lines.select(
        "PurchaseOrderNumber",
        "LineNumber",
        F.col("UnitPrice").cast(numbers.COST).alias("Cost"),
        numbers.amount(F.col("OrderedQuantity"), F.col("UnitPrice")).alias("Amount"),
        F.col("OrderDate").cast("date").alias("OrderDay"),
        year_month(F.col("OrderDate").cast("date")).alias("OrderMonth"),
    )


# Vendor quality and master data


def _without_time(issues: DataFrame) -> DataFrame:
    return issues.drop("DetectedAt")


@query
def dq_row_rules(p2p):
    return _without_time(quality.row_issues(quality.validate_vendors(p2p.vendors, Rules())))


@query
def dq_duplicate_tax_id(p2p):
    return _without_time(quality.duplicate_key_issues(p2p.survivors))


@query
def dq_duplicate_name(p2p):
    return _without_time(quality.duplicate_name_issues(p2p.survivors))


@query
def dq_issues(p2p):
    return _without_time(quality.all_issues(p2p.survivors))


@query
def dq_validated_vendors(p2p):
    return p2p.survivors.drop(quality.ISSUES)


@query
def vendor_golden(p2p):
    return p2p.golden


@query
def vendor_xref(p2p):
    return p2p.xref


@query
def migration_status(p2p):
    golden = master.golden_records(p2p.survivors)
    status = master.migration_status(golden, quality.all_issues(p2p.survivors))
    return status.select("VendorAccount", "VendorCode", "MigrationStatus")


# Star schema


@query
def dim_vendor(p2p):
    return star.dim_vendor(p2p.golden)


@query
def dim_item(p2p):
    return star.dim_item(p2p.items)


@query
def dim_date(p2p):
    orders = p2p.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return star.calendar(date_rows_spanning(orders, "day"))


@query
def fact_po_line(p2p):
    return p2p.fact_po_line


@query
def fact_receipt(p2p):
    return p2p.fact_receipt


@query
def fact_invoice(p2p):
    return p2p.fact_invoice


# Three-way match


@query
def three_way_match(p2p):
    return p2p.match.withColumn("ReceivedQty", F.col("ReceivedQty").cast("decimal(24,2)"))


@query
def match_summary(p2p):
    summary = match.status_summary(p2p.match)
    return summary.withColumn("Amount", F.col("Amount").cast("decimal(24,2)"))


@query
def match_incremental(p2p):
    """The match after three batches of a stream, receipts of each a batch late, and a batch that comes again."""
    spark, folder = p2p.spark, scratch_path(p2p.spark, "landed")
    tables = TableSet(spark, scratch_path(spark, "incremental"))
    target = IncrementalMatch(tables, p2p.xref, p2p.items)
    part = F.pmod(F.xxhash64("PurchaseOrderNumber"), F.lit(3))
    staged = {"invoice": p2p.invoices, "receipt": p2p.receipts, "po_line": p2p.po_lines}
    for batch in range(3):
        for entity, rows in staged.items():
            late = (batch + 2) % 3 if entity == "receipt" else batch
            columns = [F.col(f.name).cast(f.dataType) for f in CHANGES[entity]]
            rows.filter(part == late).select(*columns).write.mode("append").parquet(f"{folder}/{entity}", compression=COMPRESSION)
        follow(read_changes(spark, folder), target, f"{folder}/checkpoint").awaitTermination()
    target.apply(2, {entity: rows.filter(part == 2) for entity, rows in staged.items()})
    return target.current().withColumn("ReceivedQty", F.col("ReceivedQty").cast("decimal(24,2)")).drop("InvoiceLineID")


@query
def match_together(p2p):
    """The match of facts stored together by PO line: nothing but receipt totals moves."""
    facts = {"fact_invoice": p2p.fact_invoice, "fact_po_line": p2p.fact_po_line, "fact_receipt": p2p.fact_receipt}
    prefix = f"together_{uuid.uuid4().hex}"
    store_together(facts, prefix, buckets=int(p2p.spark.conf.get("spark.sql.shuffle.partitions")))
    matched = stored_match(p2p.spark, prefix)
    return matched.withColumn("ReceivedQty", F.col("ReceivedQty").cast("decimal(24,2)"))


# Reconciliation


@query
def rec_row_counts(p2p):
    staged = p2p.staged
    names = ["stg_vendor", "stg_po_line", "stg_receipt", "stg_invoice"]
    return reconcile.row_counts({**{n: staged[n] for n in names}, "vendor_xref": p2p.xref})


@query
def rec_fact_counts(p2p):
    staged = p2p.staged
    log = RunLog()
    for name, df in staged.items():
        log.observe(df, "extract", name).write.format("noop").mode("overwrite").save()
    seen = {r.table_name: r.row_count for r in log.frame(p2p.spark).collect()}
    facts = {
        "fact_po_line": p2p.fact_po_line,
        "fact_receipt": p2p.fact_receipt,
        "fact_invoice": p2p.fact_invoice,
        "fact_three_way_match": p2p.match,
    }
    expected = {
        "fact_po_line": seen["stg_po_line"],
        "fact_receipt": seen["stg_receipt"],
        "fact_invoice": seen["stg_invoice"],
        "fact_three_way_match": seen["stg_invoice"],
    }
    return reconcile.row_counts(facts, expected)


@query
def rec_run(p2p):
    """What a full run says about its own completeness."""
    done = run(p2p.staged, scratch_path(p2p.spark, "warehouse"))
    return done["reconciliation"]


@query
def rec_content_diff(p2p):
    """The PO lines in which a second load differs from the first: some gone, some changed, some new."""
    keys = ["PurchaseOrderNumber", "LineNumber"]
    first, order = p2p.po_lines, F.expr("cast(substring(PurchaseOrderNumber, 4) as bigint)")
    changed = F.when(order % 991 == 2, F.col("OrderedQuantity") + 1).otherwise(F.col("OrderedQuantity"))
    new = first.filter(order % 983 == 3).withColumn("PurchaseOrderNumber", F.concat(F.lit("NEW-"), order.cast("string")))
    second = first.filter(order % 997 != 1).withColumn("OrderedQuantity", changed).unionByName(new)
    tables = TableSet(p2p.spark, scratch_path(p2p.spark, "loads"))
    for rows in (first, second):
        writing = tables.begin()
        writing.publish(replaced=content_tree.store(writing, "po_line", rows, keys))
    one, two = tables.versions()
    leaves = content_tree.differing_leaves(tables.read("po_line_tree", one), tables.read("po_line_tree", two))
    return content_tree.differing_keys(tables.read("po_line", one), tables.read("po_line", two), keys, leaves)


@query
def rec_orphan_vendors(p2p):
    return reconcile.orphan_vendors(p2p.po_lines, p2p.xref)


@query
def rec_orphan_items(p2p):
    return reconcile.orphan_items(p2p.po_lines, p2p.items)


@query
def rec_merged_code_lines(p2p):
    return reconcile.merged_code_lines(p2p.po_lines, p2p.xref)


@query
def rec_unknown_vendor_lines(p2p):
    return reconcile.unknown_lines(p2p.fact_po_line, "VendorAccount")


@query
def rec_unknown_item_lines(p2p):
    return reconcile.unknown_lines(star.with_known_item(p2p.typed_po_lines, p2p.items), "ItemNumber")


@query
def rec_unmatched_invoices(p2p):
    return reconcile.unmatched_invoices(p2p.fact_invoice, p2p.fact_po_line)


# Report measures


@query
def kpi_readiness(p2p):
    return kpis.readiness(p2p.golden)


@query
def kpi_issues_by_rule(p2p):
    return kpis.issues_by_rule(quality.all_issues(p2p.survivors))


@query
def kpi_rescued_lines(p2p):
    return kpis.rescued_lines(p2p.po_lines, p2p.xref)


@query
def kpi_match_rate(p2p):
    return kpis.match_rate(p2p.match)


@query
def kpi_amount_on_hold(p2p):
    return kpis.amount_on_hold(p2p.match)


@query
def kpi_hold_list(p2p):
    return kpis.hold_list(p2p.match).select("InvoiceLineID", "VendorAccount", "InvoiceAmount", "MatchStatus")


@query
def kpi_exposure(p2p):
    exposure = kpis.exposure(p2p.match)
    return exposure.withColumn("exposure", F.col("exposure").cast("decimal(24,2)"))


@query
def kpi_secondary_price_issues(p2p):
    return kpis.secondary_price_issues(p2p.match).select("InvoiceLineID", "MatchStatus", "PriceVariancePct")


@query
def kpi_monthly_spend(p2p):
    orders = p2p.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return kpis.monthly_spend(p2p.typed_po_lines, star.calendar(date_rows_spanning(orders, "day")))


@query
def kpi_spend_on_days(p2p):
    """Spend by month of the Mondays of two years, from PO lines stored by month and the calendar of the orders."""
    path = scratch_path(p2p.spark, "dated")
    write_by_month(p2p.typed_po_lines, path, "OrderDate")
    orders = p2p.table("orders").withColumn("day", F.col("o_orderdate").cast("date"))
    calendar = materialize(star.calendar(date_rows_spanning(orders, "day")), "calendar")
    mondays = calendar.filter(F.col("YEAR").isin(1994, 1996) & (F.weekday("Date") == 0))
    return kpis.spend_on_days(p2p.spark.read.parquet(path), mondays)


@query
def kpi_monthly_spend_of_run(p2p):
    """The measure over the tables and the calendar that a full run stores."""
    done = run(p2p.staged, scratch_path(p2p.spark, "warehouse"))
    return kpis.monthly_spend(done["fact_po_line"], done["dim_date"])


def _spend(df: DataFrame) -> DataFrame:
    return df.withColumn("spend", F.col("spend").cast(T.DecimalType(24, 2)))


@query
def kpi_top_vendors(p2p):
    return _spend(kpis.top_vendors(p2p.fact_po_line, star.dim_vendor(p2p.golden)))


@query
def kpi_spend_by_item_group(p2p):
    return _spend(kpis.spend_by_item_group(star.with_known_item(p2p.typed_po_lines, p2p.items), star.dim_item(p2p.items)))


@query
def kpi_spend_by_site(p2p):
    return _spend(kpis.spend_by_site(p2p.typed_po_lines))


@query
def kpi_blocked_vendor_spend(p2p):
    return _spend(kpis.blocked_vendor_spend(p2p.fact_po_line, star.dim_vendor(p2p.golden)))

"""TPC-H-shaped tables as staged procure-to-pay tables.

Suppliers and customers make one vendor master, parts the item master. A lineitem is an invoice line and a receipt;
the lineitems of an order line make one PO line, with the quantity of all of them and the vendor and item of the
first. No row is left out. Faults are in the keys instead: some lineitems name a vendor or an item that is in no
master, some invoices an order that does not exist, and what was returned is a receipt of nothing or one for an
order that does not exist. Tax IDs, names, terms and e-mail addresses follow from the account balance, the nation
and the segment.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.numbering import numbered_ranges
from ledgerloom.plans import match, master, star
from ledgerloom.rules import Rules
from ledgerloom.storage import scratch_of_a_run, shuffles_end_with_writes

PRICE = "decimal(12,2)"

_schemas: dict[str, T.StructType] = {}


def _text(column: Column) -> Column:
    return column.cast("string")


def _day(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def _whole(column: Column) -> Column:
    return F.floor(column).cast("long")


def _vendor_code() -> Column:
    """The lineitem's supplier, or a code that is in no master."""
    return F.concat(F.when(F.col("l_partkey") % 13 == 0, "X").otherwise("V"), _text(F.col("l_suppkey")))


def _item_code() -> Column:
    """The lineitem's part, or a number that is in no master."""
    return F.concat(F.when(F.col("l_suppkey") % 23 == 0, "ITX-").otherwise("ITM-"), _text(F.col("l_partkey")))


def _order_number(missing: Column) -> Column:
    """The lineitem's order, or a number of no order."""
    return F.concat(F.when(missing, "NOPO-").otherwise("PO-"), _text(F.col("l_orderkey")))


class ProcureToPay:
    """Staged tables over one folder of parquet tables, and the governed and modelled tables they lead to."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """The table as a lazy frame. Its schema is read from a file footer once, not by every query."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    @property
    def vendors(self) -> DataFrame:
        suppliers = self.table("supplier").select(
            F.concat(F.lit("V"), _text(F.col("s_suppkey"))).alias("code"),
            F.col("s_name").alias("label"),
            F.col("s_nationkey").alias("n_nationkey"),
            F.col("s_acctbal").cast(PRICE).alias("balance"),
            F.lit("SUPPLIER").alias("segment"),
        )
        customers = self.table("customer").select(
            F.concat(F.lit("C"), _text(F.col("c_custkey"))).alias("code"),
            F.col("c_name").alias("label"),
            F.col("c_nationkey").alias("n_nationkey"),
            F.col("c_acctbal").cast(PRICE).alias("balance"),
            F.col("c_mktsegment").alias("segment"),
        )
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", "n_name", "r_name")
        balance, segment, label = F.col("balance"), F.col("segment"), F.col("label")
        last = F.substring(label, -1, 1)
        suffix = (
            F.when(last.isin("0", "1", "2"), ", LLC.")
            .when(last.isin("3", "4"), " Inc")
            .when(last == "5", " S.A.")
            .when(last == "6", " GmbH")
            .otherwise("")
        )
        tax_id = (
            F.when(balance < -500, "")
            .when(balance < 0, "   ")
            .otherwise(
                F.concat(F.lit("T"), _text(F.col("n_nationkey")), F.lit("-"), _text(_whole(balance / 10)))
            )
        )
        currency = (
            F.when(F.col("r_name") == "EUROPE", "EUR")
            .when(F.col("r_name") == "AFRICA", "CRC")
            .when((F.col("r_name") == "MIDDLE EAST") & (balance > 8000), "COL")
            .otherwise("USD")
        )
        terms = (
            F.when(segment == "BUILDING", "n30")
            .when(segment == "FURNITURE", " Net45 ")
            .when(segment == "HOUSEHOLD", "NET 15")
            .when(segment == "MACHINERY", F.when(balance > 9000, "2% 10 Net 30").otherwise("Net60"))
            .when((segment == "SUPPLIER") & (balance > 9500), "NET30")
            .when((segment == "SUPPLIER") & (balance > 5000), "30 days ")
            .otherwise("Net30")
        )
        email = (
            F.when(balance.between(100, 300), "")
            .when(balance.between(300, 400), "accounts payable")
            .otherwise(
                F.concat(
                    F.lit(" "),
                    F.lower(F.replace(label, F.lit("#"), F.lit("."))),
                    F.lit("@"),
                    F.lower("n_name"),
                    F.lit(".example "),
                )
            )
        )
        return (
            suppliers.unionByName(customers)
            .join(nations, "n_nationkey")
            .select(
                F.col("code").alias("VendorCode"),
                F.concat_ws(
                    " ", "r_name", "segment", F.concat(_text(_whole(F.abs(balance) / 3)), suffix)
                ).alias("VendorName"),
                tax_id.alias("TaxID"),
                F.col("n_name").alias("Country"),
                currency.alias("Currency"),
                terms.alias("PaymentTerms"),
                email.alias("Email"),
                F.when(balance > 9900, "Blocked").otherwise("Active").alias("Status"),
                _text(F.date_add(F.lit("2010-01-01").cast("date"), _whole(F.abs(balance)).cast("int"))).alias(
                    "CreatedDate"
                ),
            )
        )

    @property
    def items(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("ITM-"), _text(F.col("p_partkey"))).alias("ItemNumber"),
            F.col("p_name").alias("Description"),
            F.col("p_type").alias("ItemGroup"),
            F.lit("EA").alias("UoM"),
            _text(F.col("p_retailprice")).alias("StandardCost"),
        )

    def _order_lines(self) -> DataFrame:
        """One row per order line: its first lineitem, with the quantity of all. Dealt by order, as the join to it needs."""
        first = F.min(F.struct("l_partkey", "l_suppkey", "l_linestatus")).alias("first")
        columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_quantity"]
        dealt = self.table("lineitem").select(*columns).filter("l_orderkey is not null").repartition("l_orderkey")
        lines = dealt.groupBy("l_orderkey", "l_linenumber")
        return lines.agg(first, F.sum("l_quantity").alias("l_quantity")).select(
            "l_orderkey", "l_linenumber", "l_quantity", "first.*"
        )

    def _prices(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").cast(PRICE).alias("_price")
        )

    @property
    def po_lines(self) -> DataFrame:
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("o_orderdate")
        )
        return (
            self._order_lines()
            .join(orders, "l_orderkey")
            .join(self._prices(), "l_partkey")
            .select(
                F.concat(F.lit("PO-"), _text(F.col("l_orderkey"))).alias("PurchaseOrderNumber"),
                F.col("l_linenumber").cast("long").alias("LineNumber"),
                _vendor_code().alias("VendorAccount"),
                _item_code().alias("ItemNumber"),
                F.col("l_quantity").cast("long").alias("OrderedQuantity"),
                F.col("_price").alias("UnitPrice"),
                _day("o_orderdate").alias("OrderDate"),
                F.concat(F.lit("SITE-"), F.col("l_linestatus")).alias("Site"),
            )
        )

    @property
    def receipts(self) -> DataFrame:
        return self.receipts_of(self.table("lineitem"))

    def receipts_of(self, lineitems: DataFrame, *kept: str) -> DataFrame:
        """A receipt for each of the lineitems, with the columns of them that are named in `kept`."""
        number = F.concat_ws("-", F.lit("RC"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        returned, odd = F.col("l_returnflag") == "R", F.col("l_linenumber") % 2 == 1
        return lineitems.select(
            number.alias("ReceiptNumber"),
            _order_number(returned & ~odd).alias("PurchaseOrderNumber"),
            F.col("l_linenumber").cast("long").alias("LineNumber"),
            F.when(returned & odd, 0).otherwise(F.col("l_quantity")).cast("long").alias("ReceivedQuantity"),
            _day("l_shipdate").alias("ReceiptDate"),
            *kept,
        )

    @property
    def invoices(self) -> DataFrame:
        return self.invoices_of(self.table("lineitem"))

    def invoices_of(self, lineitems: DataFrame, *kept: str) -> DataFrame:
        """An invoice line for each of the lineitems, with the columns of them that are named in `kept`."""
        price = F.col("_price") * (F.lit(1).cast("decimal(4,2)") + F.col("l_discount"))
        # Narrow before the join, which may move the rows.
        lines = lineitems.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").cast("long").alias("l_quantity"),
            F.col("l_discount").cast("decimal(4,2)").alias("l_discount"),
            F.col("l_shipdate").cast("date").alias("l_shipdate"),
            *kept,
        )
        return lines.join(self._prices(), "l_partkey").select(
            F.concat(F.lit("INV-"), _text(F.col("l_orderkey"))).alias("InvoiceNumber"),
            _vendor_code().alias("VendorAccount"),
            _order_number(F.col("l_orderkey") % 50 == 7).alias("PurchaseOrderNumber"),
            F.col("l_linenumber").cast("long").alias("LineNumber"),
            F.col("l_quantity").alias("InvoiceQuantity"),
            price.cast(PRICE).alias("InvoiceUnitPrice"),
            _day("l_shipdate").alias("InvoiceDate"),
            *kept,
        )

    @property
    def staged(self) -> dict[str, DataFrame]:
        return {
            "stg_vendor": self.vendors,
            "stg_item": self.items,
            "stg_po_line": self.po_lines,
            "stg_receipt": self.receipts,
            "stg_invoice": self.invoices,
        }

    @cached_property
    def survivors(self) -> DataFrame:
        return master.stored_survivors(self.vendors, Rules())

    @cached_property
    def numbered_golden(self) -> DataFrame:
        return master.golden_records(self.survivors)

    @cached_property
    def golden(self) -> DataFrame:
        return master.vendor_golden(self.survivors, self.numbered_golden)

    @cached_property
    def xref(self) -> DataFrame:
        return master.vendor_xref(self.survivors, self.numbered_golden)

    @property
    def typed_po_lines(self) -> DataFrame:
        """PO lines for what reads no resolved vendor; no cross-reference is built for it."""
        return star.typed_po_lines(self.po_lines)

    @cached_property
    def fact_po_line(self) -> DataFrame:
        return star.fact_po_line(self.po_lines, self.xref, self.items)

    @cached_property
    def fact_receipt(self) -> DataFrame:
        return star.fact_receipt(self.receipts)

    @cached_property
    def fact_invoice(self) -> DataFrame:
        return star.fact_invoice(self.invoices, self.xref)

    @cached_property
    def match(self) -> DataFrame:
        return match.three_way_match(self.fact_invoice, self.fact_po_line, self.fact_receipt)


def land_pages(
    df: DataFrame,
    entity: str,
    folder: str,
    order_by: list[str],
    page_rows: int,
    element: T.StructType | None = None,
    arrival: str | None = None,
) -> str:
    """Write `df` as linked, gzipped JSON pages of `page_rows` rows, one folder a page; returns the file pattern.

    The rows move once, to their range of the order, and a page within one range is made where it lies; only the pages that
    two ranges share are put together from their parts. `element` gives the types of the pages where `df` has others;
    `arrival` as in `number_rows`. What is stored on the way is removed.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != arrival]
    if element is not None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in element.fields]
    with shuffles_end_with_writes(spark), scratch_of_a_run(spark):
        rows = numbered_ranges(df, order_by, "_row", arrival, together=True)
        rows = rows.withColumn("_page", F.floor((F.col("_row") - 1) / page_rows).cast("long") + 1)
        total = rows.agg(F.max("_row")).first()[0] or 0
        first, end = (F.col("_page") - 1) * page_rows, F.least(F.col("_page") * page_rows, F.lit(total))
        whole = (first >= F.col("_start")) & (end <= F.col("_start") + F.col("_size"))
        link = F.when(
            F.col("_page") < -(-total // page_rows),
            F.format_string(f"https://host.example/data/{entity}_page%d.json", F.col("_page") + 1),
        )
        for part, keys in ((whole, ["_range", "_page"]), (~whole, ["_page"])):
            value = F.sort_array(F.collect_list(F.struct(*columns))).alias("value")
            documents = rows.filter(part).groupBy(*keys).agg(value).select(
                F.to_json(F.struct("value", link.alias("@odata.nextLink"))).alias("document"),
                F.format_string(f"{entity}_page%d", F.col("_page")).alias("page"),
            )
            documents.write.partitionBy("page").mode("append").text(folder, compression="gzip")
    return f"{folder}/page={entity}_page*/*.txt.gz"

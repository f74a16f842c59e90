"""The three facts of the match stored together by PO line.

Catalog tables with equal numbers of buckets: rows of one PO line lie in the bucket of the same number in each, in order,
so the match joins and ranks them where they are read and moves no fact. What moves them is the load, once.

A PO line with so many invoice lines that one task could not hold them would make its bucket as large. Such lines go to
tables without buckets, beside the others, and the match takes them in slices.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.skew import HOT_ROWS, SAMPLE, hot_keys
from ledgerloom.plans import match
from ledgerloom.rules import PRICE_TOLERANCE
from ledgerloom.storage import COMPRESSION

FACTS = ("fact_invoice", "fact_po_line", "fact_receipt")


def store_together(
    facts: dict[str, DataFrame], prefix: str, buckets: int, hot_rows: int = HOT_ROWS, fraction: float = SAMPLE
) -> list[str]:
    """Write the facts as catalog tables `<prefix>_<fact>`, and hot PO lines' rows as `<prefix>_hot_<fact>` if there are
    any; returns the names. `buckets`: about the stored bytes of the largest fact / 256 MB."""
    hot = hot_keys(facts["fact_invoice"], match.LINE, hot_rows, fraction)
    any_hot = not hot.isEmpty()
    names = []
    for fact in FACTS:
        rows = facts[fact].join(hot, match.LINE, "left_anti") if any_hot else facts[fact]
        name = f"{prefix}_{fact}"
        writer = rows.repartition(buckets, *match.LINE).write.mode("overwrite").option("compression", COMPRESSION)
        writer.bucketBy(buckets, *match.LINE).sortBy(*match.LINE).saveAsTable(name)
        names.append(name)
        if any_hot:
            name = f"{prefix}_hot_{fact}"
            facts[fact].join(hot, match.LINE, "left_semi").write.mode("overwrite").saveAsTable(name)
            names.append(name)
    return names


def match_together(
    spark: SparkSession, prefix: str, tolerance: Decimal = PRICE_TOLERANCE, slice_rows: int = match.SLICE_ROWS
) -> DataFrame:
    """The match of facts that `store_together` wrote."""
    rest = match.match_in_place(*[spark.read.table(f"{prefix}_{fact}") for fact in FACTS], tolerance)
    if not spark.catalog.tableExists(f"{prefix}_hot_{FACTS[0]}"):
        return rest
    hot = match.match_in_slices(*[spark.read.table(f"{prefix}_hot_{fact}") for fact in FACTS], tolerance, slice_rows)
    return rest.unionByName(hot)


def drop_together(spark: SparkSession, prefix: str) -> None:
    """Remove what `store_together` wrote under the prefix."""
    for fact in FACTS:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{fact}")
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_hot_{fact}")

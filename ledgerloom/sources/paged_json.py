"""Paged JSON entities landed as files.

A page is one document with an array `value` and, except on the last page, an `@odata.nextLink`. All pages of
an entity are read in parallel; whether the set of pages is complete is checked from a manifest instead of by
walking the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.runlog import RunLog
from ledgerloom.storage import materialize

NEXT_LINK = "@odata.nextLink"


class IncompletePages(ValueError):
    """The landed pages of an entity do not form one unbroken chain from its first page."""


def read_pages(
    spark: SparkSession, location: str, entity: str, element: T.StructType, files: str | None = None
) -> DataFrame:
    """One row per element of every page: the page's file and next link, the place in the page and the element.

    A page without elements is one row without a place. Only the fields named in `element` are kept. The folder is
    listed once and filtered by name; `files` replaces it where pages lie elsewhere.
    """
    envelope = T.StructType(
        [T.StructField("value", T.ArrayType(element)), T.StructField(NEXT_LINK, T.StringType())]
    )
    reader = spark.read.schema(envelope).option("multiLine", True).option("mode", "FAILFAST")
    if files is None:
        reader, files = reader.option("pathGlobFilter", f"{entity}_page*"), location
    pages = reader.json(files).select(
        F.input_file_name().alias("file"),
        F.col(f"`{NEXT_LINK}`").alias("next_link"),
        F.col("value").isNull().alias("without_value"),
        "value",
    )
    return pages.select(
        "file", "next_link", "without_value", F.posexplode_outer("value").alias("place", "element")
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """The elements of `read_pages` as a table."""
    return pages.filter("place is not null").select("element.*")


def page_manifest(pages: DataFrame, entity: str, links: DataFrame | None = None) -> DataFrame:
    """One row per page file: its name, the name its link points to, and its rows (NULL without `value`).

    Pages land as `<entity>_page<N>`, N being their place in the walk. A link that names its page needs nothing
    else; for any other link `links` (columns `link`, `page`) says as which page its answer has landed. A link that
    neither names nor finds a page gives an empty `next_page`.
    """
    name = rf"({entity}_page\d+)"
    counted = pages.groupBy("file", "next_link", "without_value").agg(F.count("place").alias("row_count"))
    named = F.regexp_extract("next_link", name, 1)
    if links is not None:
        landed = links.select(F.col("link").alias("next_link"), F.col("page").alias("_landed")).distinct()
        counted = counted.join(landed, "next_link", "left")
        named = F.coalesce(F.regexp_extract("_landed", name, 1), named)
    return (
        counted
        .select(
            F.lit(entity).alias("entity"),
            F.regexp_extract("file", name, 1).alias("page"),
            F.when(F.col("next_link").isNotNull(), named).alias("next_page"),
            F.when(~F.col("without_value"), F.col("row_count")).alias("row_count"),
        )
    )


def page_faults(manifest: DataFrame, entity: str) -> DataFrame:
    """One row per kind of fault with its count, all zero when the pages are whole.

    A link must lead forward, so that no loop can hide behind correct counts; with that, one last page and
    exactly one link to every page but the first make a single chain.
    """
    names = (
        manifest.select(F.col("page").alias("name"), F.lit(1).alias("landed"), F.lit(0).alias("links"))
        .unionByName(
            manifest.filter("next_page <> ''").select(
                F.col("next_page").alias("name"), F.lit(0).alias("landed"), F.lit(1).alias("links")
            )
        )
        .groupBy("name")
        .agg(F.sum("landed").alias("landed"), F.sum("links").alias("links"))
    )
    is_first = F.col("name") == f"{entity}_page1"
    chain = names.agg(
        F.count_if(F.col("landed") == 0).alias("missing pages"),
        F.count_if(F.col("landed") > 1).alias("repeated pages"),
        F.count_if(~is_first & (F.col("links") == 0)).alias("pages without a link to them"),
        F.count_if((F.col("links") > 1) | (is_first & (F.col("links") > 0))).alias("pages with too many links"),
        F.when(F.count_if(is_first & (F.col("landed") > 0)) == 0, 1).otherwise(0).cast("long").alias("no first page"),
    )
    number = "try_cast(regexp_extract({}, '_page([0-9]+)$', 1) as decimal(38,0))"
    backward = F.expr(f"{number.format('next_page')} <= {number.format('page')}")
    pages = manifest.agg(
        F.count_if(F.col("row_count").isNull()).alias("pages without rows array"),
        F.abs(F.count_if(F.col("next_page").isNull()) - 1).alias("last pages other than one"),
        F.count_if(backward).alias("backward links"),
        F.count_if(F.col("next_page") == "").alias("links to no known page"),
    )
    return chain.unpivot([], chain.columns, "fault", "n").unionByName(
        pages.unpivot([], pages.columns, "fault", "n")
    )


def page_totals(manifest: DataFrame) -> DataFrame:
    """Pages and rows per entity."""
    return manifest.groupBy("entity").agg(
        F.count(F.lit(1)).alias("page_count"), F.sum("row_count").alias("row_count")
    )


def check_pages(manifest: DataFrame, entity: str) -> None:
    """Raise `IncompletePages` unless the landed pages are whole."""
    found = {r.fault: r.n for r in page_faults(manifest, entity).collect() if r.n}
    if found:
        raise IncompletePages(f"{entity}: {found}")


def read_entity(
    spark: SparkSession,
    location: str,
    entity: str,
    element: T.StructType,
    files: str | None = None,
    run_log: RunLog | None = None,
    links: DataFrame | None = None,
) -> DataFrame:
    """The rows of an entity whose pages are whole; a broken or partial extract stops the load.

    The pages are parsed once and stored. The manifest reads a few small columns of what was stored, and its
    totals go to `run_log`. See `page_manifest` for `links`.
    """
    pages = materialize(read_pages(spark, location, entity, element, files), "pages")
    manifest = page_manifest(pages, entity, links)
    check_pages(manifest, entity)
    if run_log is not None:
        for totals in page_totals(manifest).collect():
            run_log.add("extract", entity, totals.row_count, totals.page_count)
    return page_rows(pages)

"""Pages of paged JSON entities as they land: an entity is loaded when its chain of pages has closed.

Pages may land in any order and over any time. What is kept of a page is a few bytes of state: whether it has landed and
how many pages link to it. State is keyed by entity and a hash of the page's name, so an entity of any number of pages
spreads over tasks; a page tells its own key that it is there, and the key of the page it links to that it is wanted. Both
say how the entity's open ends change, and an entity whose changes add up to no open end, one last page and no faults is
whole. A page that lands again is refused: the first one counts, and the refused file is listed.

The open ends and the accepted files are tables of a `TableSet`. A batch adds to them and publishes the entities that have
closed in the same version, so readers never see a part of one, and a batch that comes again after a restart is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ledgerloom.sinks.table_set import TableSet
from ledgerloom.sources.paged_json import NEXT_LINK, page_rows, read_pages
from ledgerloom.storage import materialize

BUCKETS = 64

# Tasks that keep the state, each started anew by every batch. A page is a few bytes, so a task holds millions.
STATE_TASKS = 8

# What a message changes in its entity. The faults must come to nothing.
FAULTS = ("missing", "unlinked", "too_many_links", "without_value", "backward", "bad_links")
COUNTS = ("pages", "last_pages", *FAULTS)

# `accepted` is set for messages of a landed file; `page_log` keeps these rows.
CHANGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("entity", "page", "file")]
    + [T.StructField("accepted", T.BooleanType())]
    + [T.StructField(name, T.LongType()) for name in COUNTS]
)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SHUFFLES = "spark.sql.shuffle.partitions"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_headers(
    spark: SparkSession, location: str, files: str | None = None, files_a_batch: int | None = None
) -> DataFrame:
    """A stream with one row for each page that lands as `<entity>_page<N>`: its file, entity and name, the name its link
    points to (empty if it names none), whether it is a last page, and whether it has no rows array.

    The elements stay unparsed text here, and none is kept. `files` replaces the folder where pages lie elsewhere.
    """
    envelope = T.StructType(
        [T.StructField("value", T.ArrayType(T.StringType())), T.StructField(NEXT_LINK, T.StringType())]
    )
    reader = spark.readStream.schema(envelope).option("multiLine", True).option("mode", "FAILFAST")
    if files is None:
        reader, files = reader.option("pathGlobFilter", "*_page*"), location
    if files_a_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    link = F.col(f"`{NEXT_LINK}`")
    return reader.json(files).select(
        F.input_file_name().alias("file"),
        F.regexp_extract(F.input_file_name(), r".*[/=]([^/=]+)_page\d+", 1).alias("entity"),
        F.regexp_extract(F.input_file_name(), r".*[/=]([^/=]+_page\d+)", 1).alias("page"),
        F.coalesce(F.regexp_extract(link, r"([^/=?#]+_page\d+)", 1), F.lit("")).alias("next_page"),
        link.isNull().alias("is_last"),
        F.col("value").isNull().alias("without_value"),
    )


def messages(headers: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row to the page that landed, and one to the page that it links to, with the bucket that keeps the page."""
    number = "try_cast(regexp_extract({}, '_page([0-9]+)$', 1) as decimal(38,0))"
    backward = F.expr(f"coalesce({number.format('next_page')} <= {number.format('page')}, false)")
    landed = F.struct(F.col("page").alias("to"), F.lit(True).alias("landed"))
    link = F.struct(F.col("next_page").alias("to"), F.lit(False).alias("landed"))
    sent = F.when(F.col("next_page") == "", F.array(landed)).otherwise(F.array(landed, link))
    return headers.select("*", F.explode(sent).alias("m")).select(
        "entity",
        F.pmod(F.xxhash64("m.to"), F.lit(buckets)).cast("int").alias("bucket"),
        F.col("m.to").alias("page"),
        F.col("m.landed").alias("landed"),
        F.col("page").alias("source"),
        "file",
        "is_last",
        "without_value",
        backward.alias("backward"),
        (~F.col("is_last") & (F.col("next_page") == "")).alias("bad_link"),
    )


def _open_ends(landed: bool, links: int, is_first: bool) -> tuple[int, int, int]:
    """Missing, unlinked and too often linked: what one page adds to its entity's open ends."""
    return int(links > 0 and not landed), int(landed and links == 0 and not is_first), int(links > (0 if is_first else 1))


class PageChain(StatefulProcessor):
    """State of the pages of one bucket of an entity: which have landed, and which pages link to them."""

    def init(self, handle) -> None:
        self._pages = handle.getMapState("pages", "page string", "landed boolean, links int")
        self._links = handle.getMapState("links", "page string, source string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            found = [self._take(row) for row in batch.itertuples(index=False)]
            yield pd.DataFrame([row for row in found if row is not None], columns=CHANGE.names)

    def _take(self, row) -> tuple | None:
        page = (row.page,)
        landed, links = self._pages.getValue(page) if self._pages.containsKey(page) else (False, 0)
        is_first = row.page == f"{row.entity}_page1"
        before = _open_ends(landed, links, is_first)
        own = [0] * 5
        if row.landed:
            if landed:
                return row.entity, row.page, row.file, False, *[0] * len(COUNTS)
            landed = True
            own = [1, int(row.is_last), int(row.without_value), int(row.backward), int(row.bad_link)]
        else:
            # A page that lands again repeats its link; a link is one however often it is read.
            link = (row.page, row.source)
            if self._links.containsKey(link):
                return None
            self._links.updateValue(link, (True,))
            links += 1
        self._pages.updateValue(page, (landed, links))
        ends = [now - was for now, was in zip(_open_ends(landed, links, is_first), before)]
        pages, last, *faults = own
        return row.entity, row.page, row.file if row.landed else None, row.landed or None, pages, last, *ends, *faults

    def close(self) -> None:
        pass


def page_changes(headers: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The changes that landing pages make to their entities, a stream of `CHANGE` rows."""
    kept = messages(headers, buckets).groupBy("entity", "bucket")
    return kept.transformWithStateInPandas(PageChain(), CHANGE, "Append", "None")


class PageLoads:
    """Entities loaded as their chains close. `elements` has the table name and element type of each entity.

    Beside the entities' tables the set holds `page_log`, one row a landed file with whether it was accepted, and
    `page_totals`, one row a batch and entity with its changes. `page_sums`, one row an entity, has their sums so far, so that a
    batch reads no more than its own changes and those sums until an entity closes.
    """

    def __init__(
        self, tables: TableSet, location: str, elements: dict[str, tuple[str, T.StructType]], files: dict[str, str] | None = None
    ) -> None:
        self.tables, self.location, self.elements, self.files = tables, location, elements, files or {}

    def totals(self) -> DataFrame:
        """Pages and open ends per entity as of the last batch; `closed` once nothing is open."""
        return self._closed(self.tables.read("page_totals"))

    @staticmethod
    def _closed(changes: DataFrame) -> DataFrame:
        sums = changes.groupBy("entity").agg(*[F.sum(name).alias(name) for name in COUNTS])
        open_ends = sum((F.col(name) for name in FAULTS), F.lit(0))
        return sums.withColumn("closed", (open_ends == 0) & (F.col("last_pages") == 1))

    def apply(self, changes: DataFrame, batch: int) -> bool:
        """Note one batch of changes and load what it closes; False if the batch has been applied before."""
        before = self.tables.current()
        if before is not None and before.notes["batch"] >= batch:
            return False
        writing = self.tables.begin()
        stored = materialize(changes, "changes")
        log = writing.write("page_log", stored.filter("accepted is not null").select("entity", "page", "file", "accepted"))
        new = writing.write("page_totals", stored.groupBy("entity").agg(*[F.sum(n).alias(n) for n in COUNTS]))
        totals = new
        if before is not None:
            # Sets of an earlier release have no sums yet.
            sums = "page_sums" if "page_sums" in before.tables else "page_totals"
            totals = self.tables.read(sums, before).unionByName(new)
        totals = writing.write("page_sums", totals.groupBy("entity").agg(*[F.sum(n).alias(n) for n in COUNTS]))
        # At most the entities of `elements`, by name.
        touched = totals.join(new.select("entity").distinct(), "entity", "left_semi").filter(F.col("entity").isin(*self.elements))
        loaded = []
        for row in self._closed(touched).filter("closed").select("entity").collect():
            table, element = self.elements[row.entity]
            pages = read_pages(self.tables.spark, self.location, row.entity, element, self.files.get(row.entity))
            accepted = log if before is None else self.tables.read("page_log", before).unionByName(log)
            files = accepted.filter(F.col("accepted") & (F.col("entity") == row.entity)).select("file")
            writing.write(table, page_rows(pages.join(files, "file", "left_semi")))
            loaded.append(table)
        writing.publish(replaced=["page_sums", *loaded], added_to=["page_log", "page_totals"], notes={"batch": batch})
        return True


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """Map state needs this provider; batches store what changed, in few tasks. A stream keeps the settings that it starts
    under, a restarted one the number of tasks of its first start."""
    tasks = str(min(STATE_TASKS, int(spark.conf.get(SHUFFLES))))
    wanted = {PROVIDER: ROCKS_DB, CHANGELOG: "true", SHUFFLES: tasks}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def follow_pages(headers: DataFrame, loads: PageLoads, checkpoint: str, buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """Apply every batch of landing pages to `loads`; by default all that is there, and then it ends."""

    def apply(changes: DataFrame, batch: int) -> None:
        loads.apply(changes, batch)

    with _state_settings(headers.sparkSession):
        writer = page_changes(headers, buckets).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

"""Stored intermediate tables.

Where a result is read more than once, or must not change between two reads (row numbers, above all), it is
written as a parquet table and read back. Unlike a checkpointed RDD a parquet table keeps column pruning,
filter pushdown and a real size for the broadcast decision, and it outlives lost executors.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Of stored tables: about a third smaller than Spark's default, and more masters stay below the size of a broadcast.
COMPRESSION = "zstd"
# Delta encodings: keys and numbers in order take an eighth less of the large tables.
PACKED = {"compression": COMPRESSION, "parquet.writer.version": "v2"}

# Of narrow tables whose number of rows is known: rows a file, and files of a small one.
FILE_ROWS = 1 << 18
FEW_FILES = 16

_local_roots: dict[str, str] = {}
_runs: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`; a temporary one only in local mode.

    `local-cluster` has executors of its own, which need a shared folder like any others.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    application = spark.conf.get("spark.app.id")
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no earlier run has used, in this application's folder under the scratch root."""
    folder = "/".join([scratch_root(spark), spark.conf.get("spark.app.id"), *_runs])
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_of_a_run(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is stored meanwhile, removed at the end. Frames over it must not be read after that."""
    _runs.append(f"run-{uuid.uuid4().hex}")
    folder = "/".join([scratch_root(spark), spark.conf.get("spark.app.id"), *_runs])
    try:
        yield folder
    finally:
        _runs.pop()
        remove(spark, folder)


@contextmanager
def shuffles_end_with_writes(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of a write go when it has ended, not when the driver happens to collect its garbage.

    For plans that run once; what runs again shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write `df` once and return a scan of what was written.

    A narrow table known to have at most about `rows` rows goes to files in proportion, however many partitions the
    shuffle before it has: on a local file system without Hadoop's native library an executor starts some six processes
    for each file it writes, and a table of a few thousand rows need not be hundreds of files.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(FEW_FILES, math.ceil(rows / FILE_ROWS)))
    path = scratch_path(spark, label)
    df.write.options(**PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def save_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = ()) -> str:
    """Write `df` to the folder `path`, which must not be there, in buckets by `keys`; returns the table's name for
    `bucketed_scan`. Partition `df` by `keys` into as many partitions before, and each bucket is one file."""
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").options(**PACKED).option("path", path).bucketBy(buckets, *keys)
    (writer.sortBy(*sort_by) if sort_by else writer).saveAsTable(name)
    return name


def bucketed_scan(spark: SparkSession, name: str) -> DataFrame:
    """A scan that knows the buckets: what joins, ranks or groups by the keys moves no row.

    The catalog holds the table only until the scan has its buckets from it; the files stay.
    """
    rows = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows

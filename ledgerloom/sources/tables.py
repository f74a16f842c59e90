"""Stored tables as sources: catalog names, parquet folders, or a database through Spark's jdbc source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, table: str, options: dict[str, str]) -> DataFrame:
    """A database table. Pass `partitionColumn`, `lowerBound`, `upperBound` and `numPartitions` in `options` for
    a parallel read; Spark pushes filters and the column list into the query."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()

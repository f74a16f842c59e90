"""CSV masters staged as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_text_csv(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Every column a string, an empty field '' and never NULL, spaces kept.

    A header that differs from `columns` or a row of the wrong width raises. Files stay splittable unless the
    caller says that quoted values hold line breaks.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(path)
    )
    return rows.na.fill("")

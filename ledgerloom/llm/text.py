"""Words, hold-out remainders and batches, shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one output batch: whole texts and their token arrays stay far below a worker's memory.
OUT_ROWS = 256


def raw_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; `bytes.split` splits at exactly the six characters that `WORD` leaves out."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case, other letters as they are."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into small ones, so that a worker never holds the outputs of many long texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_text(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns of a table: other columns, whatever they are called, cannot clash with new ones."""
    return docs.select(*[docs[name] for name in names])


def quoted(name: str) -> str:
    """A column name for references: dots and backticks in it are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row, whatever their names, as one struct."""
    return F.struct(*[docs[quoted(name)].alias(name) for name in docs.columns])


def one_row_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of the keys: the one whose other columns have the smallest hash, then the smallest values.

    Rows combine before the shuffle, so a key with any number of rows moves as one row a task.
    """
    others = [name for name in rows.columns if name not in keys]
    least = F.min(F.struct(F.xxhash64(*others).alias("_order"), *others)).alias("_least")
    return rows.groupBy(*keys).agg(least).select(*[F.col(n) if n in keys else F.col("_least")[n].alias(n) for n in rows.columns])

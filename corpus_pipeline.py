"""A corpus pipeline of five operators: each stage gets what its predecessor kept, stored as parquet.

    toxicity            rejects documents predicted to be toxic
    near_duplicates     keeps one document of each SimHash group
    personal_data       puts personal values under pseudonyms
    mixing              takes documents so that sources meet their target weights, some of them repeatedly
    tokens              encodes what is left with SentencePiece

All stages but the last return the columns of `documents`. SQL has no expression for these rows (the classifier is
fitted, the others need XXH64, keyed permutations and a tokenizer), so the tests compare with brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import mixing, pieces, pii, simhash, toxicity
from ledgerloom.llm.queries import model_path, query_key, table
from ledgerloom.llm.text import remainder
from ledgerloom.storage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, remainder(labels["doc_id"], 5) != 0)
    return toxicity.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_group(docs, shingle=4, distance=4)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(docs, query_key()).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(docs, model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the `documents` of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

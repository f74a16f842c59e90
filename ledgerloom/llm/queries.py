"""The operators as registered queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import collisions, html_text, line_rules, merkle, mixing, pieces, pii, quality_fm, simhash, suffix_tree, toxicity, url_rules, whitening
from ledgerloom.llm.text import remainder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Name of the public tokenizer file; its folder is known to the installed package.
MODEL = "piece_bpe_32k.model"


def query(build: Query) -> Query:
    """Register `build` under its own name."""
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query_key() -> str:
    """The key of the registered queries, fixed so that reruns agree; a job passes its own secret."""
    return "registered-query-key"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


@query
def op1_suffix_tree(spark, sf_dir):
    """The log probability of every document, learned from those whose remainder by seven is not 2."""
    return suffix_tree.score_texts(table(spark, sf_dir, "documents"))


@query
def op2_quality_fm(spark, sf_dir):
    """Quality of every document, learned from labels whose remainder by three is not 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_fm.train(docs, labels, remainder(labels["doc_id"], 3) != 1)
    held_out = (remainder(F.col("doc_id"), 3) == 1).alias("held_out")
    return quality_fm.score(docs, model).select("doc_id", held_out, "score", "predicted")


@query
def op3_pii(spark, sf_dir):
    """Every document with its personal numbers, dates, addresses and credentials under pseudonyms."""
    changed = pii.pseudonymize(table(spark, sf_dir, "documents"), query_key())
    return changed.select("row.doc_id", "row.text", "n_replaced")


@query
def op4_simhash(spark, sf_dir):
    """Fingerprint and group of every document: shingles of four words, links at four or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op5_html_text(spark, sf_dir):
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op6_mixing(spark, sf_dir):
    """The words that the mix takes of every document."""
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


@query
def op7_collisions(spark, sf_dir):
    """Links and group of every vector at a cosine of 0.9 or more."""
    return collisions.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op8_sentencepiece(spark, sf_dir):
    """Ids with begin and end, their spans, and the decoded text of every document, as digests."""
    return pieces.digests(pieces.encode_documents(table(spark, sf_dir, "documents"), model_path()))


@query
def op9_line_rules(spark, sf_dir):
    """Base counts and the verdict of line-first cleaning for every document."""
    return line_rules.clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


@query
def op10_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from labels whose remainder by five is not 0."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, remainder(labels["doc_id"], 5) != 0)
    scored = toxicity.score(docs, model)
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", *toxicity.COUNTS)


# The registered rules of op11: verdict, host and start of the path.
SITE_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@query
def op11_url_rules(spark, sf_dir):
    """Host, path, site rule, pattern and verdict of every page's URL."""
    sites = [url_rules.site_rule(*rule) for rule in SITE_RULES]
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), sites)


@query
def op12_merkle(spark, sf_dir):
    """Leaf, roots and proof of every document; where 7 divides the checksum of the id, one more character is claimed."""
    docs = table(spark, sf_dir, "documents")
    one_more = {"n_chars": docs["n_chars"].cast("decimal(20,0)") + 1}
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    found = merkle.manifest(merkle.leaf_rows(docs, altered=one_more, where=tampered))
    columns = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return found.select(F.col("id").alias("doc_id"), *columns)


@query
def op13_whitening(spark, sf_dir):
    """Four whitened components of every usable vector, with the exact deviation where it fits 64 bits."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))

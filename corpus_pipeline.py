"""A training corpus from raw documents: quality rules, near duplicates, secrets, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before kept; ``run`` writes each result as
Parquet in the shared folder and reads it again for the next. All stages but the last return the columns of the documents.
A null or empty text is rejected by the first stage; an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import bpe, mixing, quality, queries, secrets, simhash
from claimweave.session import scratch_dir, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the fixed rules or lie far outside their language and source go."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: three-word shingles, two or fewer differing bits."""
    return simhash.first_of_linked(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts and the lengths set anew; the documents stay."""
    cleaned = secrets.redact(docs, scratch_dir(spark, "ledger"))
    return cleaned.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else cleaned


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens are drawn; sources, languages and topics have their target shares as far as their tokens reach."""
    levels = {"source": F.col("source"), "lang": F.col("lang"), "topic": queries.topic("text")}
    return mixing.mix(docs, levels, queries.MIX_TARGETS, "doc_id", "text", keep=queries.MIX_KEEP)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The key of each document with its token ids."""
    encoded = bpe.token_ids(bpe.encode(docs, queries.vocabulary()))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

# SQL has no XXH64 for the fingerprints and no BPE: the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs

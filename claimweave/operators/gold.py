"""Staging views, star schema and the counting marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import vocab

PAIR = ["intervention", "outcome"]


def stg_papers(papers: DataFrame) -> DataFrame:
    """Live papers, one row per upload group."""
    return papers.where(~F.col("is_deleted") & ~F.col("is_duplicate_upload")).select(
        "paper_id", "title", "source_filename", "ingest_status", "ingest_error", "created_at", "is_synthetic"
    )


def stg_claims(claims: DataFrame) -> DataFrame:
    """Live, first-reported claims under their canonical paper."""
    return claims.where(~F.col("is_deleted") & ~F.col("is_duplicate")).select(
        "claim_id",
        F.col("canonical_paper_id").alias("paper_id"),
        "cluster_id",
        "population",
        "intervention",
        "outcome",
        "result",
        "study_type",
        "confidence",
        "confidence_rescaled",
    )


def fct_claims(claims: DataFrame, weights: DataFrame) -> DataFrame:
    """Claims with the weight of their study design. The weights join is unhinted: the built-in
    table is a literal relation, so Spark sees its size and broadcasts it."""
    return claims.join(weights, "study_type").select(
        "claim_id",
        "paper_id",
        "cluster_id",
        "population",
        "intervention",
        "outcome",
        C.claim_pair().alias("claim_pair"),
        "result",
        "study_type",
        F.col("weight").alias("study_weight"),
        "evidence_rank",
        "confidence",
        "confidence_rescaled",
        C.bucket_edge("confidence").alias("confidence_bucket"),
    )


def dim_papers(papers: DataFrame, claims: DataFrame) -> DataFrame:
    """Papers with their claim counts; counting first leaves one row per key on both sides."""
    counts = claims.groupBy("paper_id").agg(F.count("*").alias("n_claims"))
    return papers.join(counts, "paper_id", "left").select(
        "paper_id",
        "title",
        "source_filename",
        "ingest_status",
        "created_at",
        "is_synthetic",
        F.coalesce("n_claims", F.lit(0)).alias("n_claims"),
    )


def claims_by_pair(facts: DataFrame) -> DataFrame:
    by_label = [F.count_if(F.col("result") == x).alias(f"n_{x}") for x in vocab.RESULT_LABELS]
    return facts.groupBy(*PAIR, "claim_pair").agg(
        F.count("*").alias("n_claims"),
        F.countDistinct("paper_id").alias("n_papers"),
        *by_label,
        C.stable_mean("confidence", 3).alias("avg_confidence"),
    )


def confidence_distribution(facts: DataFrame) -> DataFrame:
    keys = ["study_type", "evidence_rank", "result", "confidence_bucket"]
    return (
        facts.groupBy(*keys)
        .agg(F.count("*").alias("n_claims"), C.stable_mean("confidence", 3).alias("avg_confidence"))
        .select(
            *keys,
            C.bucket_label("confidence_bucket").alias("confidence_bucket_label"),
            "n_claims",
            "avg_confidence",
        )
    )

"""Queries of the dashboard page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import vocab
from claimweave.operators.keyed import one_row


def kpi_row(facts: DataFrame, scores: DataFrame) -> DataFrame:
    return one_row(
        facts.agg(F.count("claim_id").alias("claims"), F.countDistinct("paper_id").alias("papers")),
        scores.agg(F.count("claim_pair").alias("pairs")),
    )


def slice_scores(scores: DataFrame, interventions: list[str]) -> DataFrame:
    return scores.where(F.col("intervention").isin(*interventions))


def follow_slicer(table: DataFrame, sliced_scores: DataFrame) -> DataFrame:
    """Keep the rows of a many-side table whose pair survived the slicer."""
    return table.join(sliced_scores.select("claim_pair"), "claim_pair", "left_semi")


def contested_pairs(scores: DataFrame, top: int | None = None) -> DataFrame:
    """Weighted beside unweighted score, most contested first."""
    ordered = scores.select(
        "claim_pair", "weighted_disagreement_score", "unweighted_disagreement_score"
    ).orderBy(F.col("weighted_disagreement_score").desc(), "claim_pair")
    return ordered if top is None else ordered.limit(top)


def findings_share(by_pair: DataFrame) -> DataFrame:
    """Share of each result per pair (a 100 % stacked bar)."""
    return by_pair.select(
        "claim_pair",
        *[
            C.ratio(F.col(f"n_{x}"), F.col("n_claims"), 4).alias(f"share_{x}")
            for x in vocab.RESULT_LABELS
        ],
    )


def confidence_by_design(facts: DataFrame) -> DataFrame:
    return facts.groupBy("confidence_bucket", "study_type").agg(F.count("claim_id").alias("n_claims"))

"""How far studies of one intervention and outcome disagree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import vocab
from claimweave.operators.gold import PAIR


def vote_totals(claims: DataFrame, weight: Column) -> DataFrame:
    """Weight and number of claims behind each result of each pair.

    Weights are added as decimals: ties are exact and no sum depends on partition order.
    """
    return claims.groupBy(*PAIR, "result").agg(
        F.sum(C.exact_weight(weight)).alias("result_weight"), F.count("*").alias("result_claims")
    )


def weighted_disagreement(
    claims: DataFrame, weight: Column | None = None, zero_fraction: float | None = None
) -> DataFrame:
    """Score = 1 - share of the heaviest result; ties go to the alphabetically first result.

    Works for any result labels. Two partial aggregations and no window: the first shrinks claims to one row per pair and
    result before any shuffle, so a pair with a third of all claims costs no more than others.
    ``zero_fraction`` is the share when a pair's weights add up to zero (else NULL).
    """
    votes = vote_totals(claims, F.col("study_weight") if weight is None else weight)
    pairs = votes.groupBy(*PAIR).agg(
        F.sum("result_claims").alias("n_claims"),
        F.sum("result_weight").alias("_total"),
        F.max("result_claims").alias("_top_claims"),
        F.min(F.struct((-F.col("result_weight")).alias("lost"), "result")).alias("_winner"),
    )
    return _scores(
        pairs.withColumns(
            {"_weight": -F.col("_winner.lost"), "weighted_majority_result": F.col("_winner.result")}
        ),
        zero_fraction,
    )


def label_disagreement(claims: DataFrame, weight: Column | None = None, labels=vocab.RESULT_LABELS) -> DataFrame:
    """The same score for claims whose results are known to be ``labels``, as the gold facts' are.

    The votes of each label are columns of one hash aggregation: one shuffle, no sort. A claim
    with another result stops the job.
    """
    exact = C.exact_weight(F.col("study_weight") if weight is None else weight)
    labels = sorted(labels)
    votes = claims.groupBy(*PAIR).agg(
        F.count("*").alias("n_claims"),
        F.sum(exact).alias("_total"),
        *[F.count_if(F.col("result") == x).alias(f"_n_{x}") for x in labels],
        *[F.coalesce(F.sum(F.when(F.col("result") == x, exact)), F.lit(0)).alias(f"_w_{x}") for x in labels],
    )
    best = F.greatest(*[F.when(F.col(f"_n_{x}") > 0, F.col(f"_w_{x}")) for x in labels])
    wins = [F.when((F.col(f"_n_{x}") > 0) & (F.col(f"_w_{x}") == best), F.lit(x)) for x in labels]
    known = sum(F.col(f"_n_{x}") for x in labels)
    checked = F.when(known == F.col("n_claims"), F.coalesce(*wins)).otherwise(
        F.raise_error(F.concat(F.lit("unknown result label under "), C.claim_pair()))
    )
    return _scores(
        votes.withColumns(
            {
                "_top_claims": F.greatest(*[F.col(f"_n_{x}") for x in labels]),
                "_weight": best,
                "weighted_majority_result": checked,
            }
        ),
        None,
    )


def _scores(pairs: DataFrame, zero_fraction: float | None) -> DataFrame:
    share = C.ratio(F.col("_weight"), F.col("_total"))
    if zero_fraction is not None:
        share = F.coalesce(share, F.lit(zero_fraction))
    return pairs.withColumn("_share", share).select(
        *PAIR,
        C.claim_pair().alias("claim_pair"),
        "n_claims",
        F.round(F.col("_total").cast("double"), 4).alias("total_weight"),
        "weighted_majority_result",
        F.round("_share", 4).alias("weighted_majority_fraction"),
        F.round(1 - F.col("_share"), 4).alias("weighted_disagreement_score"),
        F.round(1 - F.col("_top_claims") / F.col("n_claims"), 4).alias("unweighted_disagreement_score"),
    )


def raw_study_weight(study_type: str | Column = "study_type") -> Column:
    """Weight looked up on the raw spelling; unknown spellings count a half."""
    value = F.col(study_type) if isinstance(study_type, str) else study_type
    found = C.mapped(F.lower(value), vocab.RAW_STUDY_WEIGHTS, F.lit(vocab.RAW_STUDY_DEFAULT_WEIGHT))
    return found.cast("double")


def heatmap_cells(claims: DataFrame, weight: Column | None = None) -> DataFrame:
    """One cell per pair over all claims as stored, weighted by raw study type by default."""
    scored = weighted_disagreement(claims, raw_study_weight() if weight is None else weight, 0.0)
    return scored.select(
        *PAIR,
        F.col("weighted_disagreement_score").alias("disagreement_score"),
        F.col("n_claims").alias("total_studies"),
    )


def study_heatmap_cells(studies: DataFrame) -> DataFrame:
    """Cells where every study counts one."""
    return heatmap_cells(studies, F.lit(1))


def heatmap_matrix(cells: DataFrame, outcomes: list[str], fill: float | None = 0.0) -> DataFrame:
    """Interventions as rows, the caller's ``outcomes`` as columns. ``fill=None`` keeps absent cells NULL.

    The columns are named, so nothing is looked up on the driver first; ``heatmap_cells`` is the form for all outcomes.
    """
    matrix = cells.groupBy("intervention").pivot("outcome", outcomes).agg(F.first("disagreement_score"))
    if fill is None:
        return matrix
    return matrix.fillna(fill, subset=[c for c in matrix.columns if c != "intervention"])


def result_counts(studies: DataFrame) -> DataFrame:
    """(intervention, outcome, result, n): the rows behind ``claim_groups``, for any number of labels."""
    return studies.groupBy(*PAIR, "result").agg(F.count("*").alias("n"))


def claim_groups(studies: DataFrame, labels=vocab.RESULT_LABELS) -> DataFrame:
    """Studies per pair with a map of the counts of ``labels``, and the number of studies with another or no result.

    Labels are free text, so only the given ones become map entries; ``result_counts`` has a row for every label.
    """
    counted = studies.groupBy(*PAIR).agg(
        F.count("*").alias("total_studies"), *[F.count_if(F.col("result") == x).alias(f"_n_{x}") for x in labels]
    )
    entries = F.array(*[F.struct(F.lit(x).alias("result"), F.col(f"_n_{x}").alias("n")) for x in sorted(labels)])
    known = sum(F.col(f"_n_{x}") for x in labels)
    return counted.select(
        C.claim_key().alias("claim_key"),
        *PAIR,
        F.map_from_entries(F.filter(entries, lambda e: e["n"] > 0)).alias("result_counts"),
        (F.col("total_studies") - known).alias("other_results"),
        "total_studies",
    )

"""Pipeline-health metrics. ``as_of`` stands for now, so that results can be reproduced."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.operators.keyed import one_row


def _step(df: DataFrame, step: int, layer: str, table: str, description: str, n_rows: Column) -> DataFrame:
    return df.agg(
        F.lit(step).alias("step"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.lit(description).alias("description"),
        n_rows.cast("bigint").alias("n_rows"),
    ).select("step", "layer", "table_name", "description", "n_rows")


def layer_counts(
    runs: DataFrame,
    papers: DataFrame,
    claims: DataFrame,
    rejects: DataFrame,
    dim: DataFrame,
    facts: DataFrame,
) -> DataFrame:
    """Rows per layer for the current data, in pipeline order. Live means not deleted."""
    newest = runs.where(F.col("run_id") == runs.agg(F.max("run_id")).scalar())
    live = F.count_if(~F.col("is_deleted"))

    def exported(table):
        return F.max(F.when(F.col("source_table") == table, F.col("n_rows")))

    # The steps of the report, in order.
    steps = [
        (newest, "bronze", "papers", "papers in the latest export", exported("papers")),
        (newest, "bronze", "claim_evidence", "claims in the latest export", exported("claim_evidence")),
        (papers, "silver", "papers", "live papers", live),
        (claims, "silver", "claims", "live claims that passed the quality checks", live),
        (rejects, "silver", "claims_rejects", "live claims quarantined by the quality checks", live),
        (dim, "gold", "dim_papers", "papers after merging re-uploads", F.count("*")),
        (facts, "gold", "fct_claims", "claims after removing repeated findings", F.count("*")),
    ]
    rows = [_step(s[0], i, *s[1:]) for i, s in enumerate(steps, 1)]
    return reduce(DataFrame.unionByName, rows)


def outcome_shares(outcomes: DataFrame) -> DataFrame:
    """Live claims by outcome of the checks, from (check_outcome, is_deleted) rows."""
    counted = outcomes.where(~F.col("is_deleted")).groupBy("check_outcome").agg(F.count("*").alias("n_claims"))
    total = F.sum("n_claims").over(Window.partitionBy(F.lit(0)))
    return counted.select(
        "check_outcome",
        (F.col("check_outcome") != "passed").alias("is_quarantined"),
        "n_claims",
        F.round(F.col("n_claims") / total, 4).alias("share_of_claims"),
    )


def quarantine_shares(claims: DataFrame, rejects: DataFrame) -> DataFrame:
    """The same from the two silver tables."""
    passed = claims.select(F.lit("passed").alias("check_outcome"), "is_deleted")
    return outcome_shares(passed.unionByName(rejects.select(F.col("reject_reason").alias("check_outcome"), "is_deleted")))


def evidence_per_paper(dim: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts are aggregated per paper first, so the join meets one row per key on both sides."""
    per_paper = facts.groupBy("paper_id").agg(
        F.count("claim_id").alias("_claims"),
        F.countDistinct("claim_pair").alias("_pairs"),
        F.sum(C.exact_weight(F.col("study_weight"))).cast("double").alias("_weight"),
        C.stable_mean("confidence", 4).alias("avg_confidence"),
        F.min("evidence_rank").alias("best_evidence_rank"),
    )
    n_claims = F.coalesce("_claims", F.lit(0))
    return dim.join(per_paper, "paper_id", "left").select(
        "paper_id",
        "title",
        "ingest_status",
        "created_at",
        "is_synthetic",
        n_claims.alias("n_claims"),
        F.coalesce("_pairs", F.lit(0)).alias("n_claim_pairs"),
        F.round(F.coalesce("_weight", F.lit(0.0)), 4).alias("evidence_weight"),
        "avg_confidence",
        "best_evidence_rank",
        (n_claims > 0).alias("has_evidence"),
    )


def freshness(runs: DataFrame, as_of: Column) -> DataFrame:
    """Exports per day: the day's last run, and its change against the previous export day.

    The windows see one row per run and one per day, whatever the size of the tables.
    """

    def rows_of(table):
        return F.sum(F.when(F.col("source_table") == table, F.col("n_rows")).otherwise(0))

    per_run = runs.groupBy("run_id", "ingest_date", "exported_at").agg(
        rows_of("papers").alias("papers_rows"), rows_of("claim_evidence").alias("claims_rows")
    )
    last = F.max(F.struct("run_id", "exported_at", "papers_rows", "claims_rows"))
    per_day = per_run.groupBy("ingest_date").agg(
        F.count("*").alias("n_runs"), F.min("exported_at").alias("first_exported_at"), last.alias("_last")
    )
    by_day = Window.orderBy("ingest_date")
    return per_day.select(
        "ingest_date",
        "n_runs",
        "first_exported_at",
        F.col("_last.exported_at").alias("last_exported_at"),
        F.col("_last.papers_rows").alias("papers_rows"),
        F.col("_last.claims_rows").alias("claims_rows"),
    ).select(
        "*",
        (F.col("papers_rows") - F.lag("papers_rows").over(by_day)).alias("papers_added"),
        (F.col("claims_rows") - F.lag("claims_rows").over(by_day)).alias("claims_added"),
        F.datediff(as_of, F.col("ingest_date")).alias("days_ago"),
    )


def pipeline_summary(
    runs: DataFrame, layers: DataFrame, evidence: DataFrame, facts: DataFrame, as_of: Column
) -> DataFrame:
    """One row of headline numbers."""

    def count_of(table, layer=None):
        match = F.col("table_name") == table
        if layer:
            match = match & (F.col("layer") == layer)
        return F.max(F.when(match, F.col("n_rows")))

    run_part = runs.agg(
        F.max("run_id").alias("latest_run_id"),
        F.max("ingest_date").alias("latest_ingest_date"),
        F.max("exported_at").alias("last_exported_at"),
        F.countDistinct("run_id").alias("n_export_runs"),
    )
    layer_part = layers.agg(
        count_of("papers", "bronze").alias("bronze_papers"),
        count_of("claim_evidence", "bronze").alias("bronze_claims"),
        count_of("claims_rejects").alias("quarantined_claims"),
        count_of("dim_papers").alias("gold_papers"),
        count_of("fct_claims").alias("gold_claims"),
    )
    paper_part = evidence.agg(
        F.count("*").alias("n_papers"),
        F.count_if(F.col("ingest_status") == "failed").alias("failed_papers"),
        F.count_if("has_evidence").alias("papers_with_evidence"),
        F.avg(F.when(F.col("ingest_status") == "processed", F.col("n_claims"))).alias("_mean_claims"),
    )
    pair_part = facts.agg(F.countDistinct("claim_pair").alias("n_claim_pairs"))
    hours = (F.unix_timestamp(as_of) - F.unix_timestamp("last_exported_at")) / 3600.0
    return one_row(run_part, layer_part, paper_part, pair_part).select(
        "latest_run_id",
        "latest_ingest_date",
        "last_exported_at",
        "n_export_runs",
        F.round(hours.cast("double"), 1).alias("hours_since_last_export"),
        "bronze_papers",
        "bronze_claims",
        "quarantined_claims",
        C.ratio(F.col("quarantined_claims"), F.col("bronze_claims"), 4).alias("quarantine_rate"),
        "gold_papers",
        "gold_claims",
        "failed_papers",
        C.ratio(F.col("failed_papers"), F.col("n_papers"), 4).alias("failed_paper_rate"),
        "papers_with_evidence",
        F.round("_mean_claims", 2).alias("avg_claims_per_processed_paper"),
        "n_claim_pairs",
        as_of.alias("measured_at"),
    )

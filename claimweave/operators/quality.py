"""Data-quality rules. A table's column rules share one aggregation pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimweave.functions import vocab
from claimweave.operators.keyed import one_row


@dataclass(frozen=True)
class Rule:
    """``unique``, ``not_null``, ``accepted`` (values), ``between`` (low, high) or
    ``relationships`` (parent frame, its key)."""

    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    parent: DataFrame | None = None
    parent_key: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def unique(column):
    return Rule("unique", column)


def not_null(column):
    return Rule("not_null", column)


def accepted(column, values):
    return Rule("accepted", column, values=tuple(values))


def between(column, low, high):
    return Rule("between", column, low=low, high=high)


def relationships(column, parent, parent_key):
    return Rule("relationships", column, parent=parent, parent_key=parent_key)


def _bad(rule: Rule) -> Column:
    """Condition of a violating row; NULL passes every rule but ``not_null``."""
    value = F.col(rule.column)
    if rule.kind == "not_null":
        return value.isNull()
    if rule.kind == "accepted":
        return ~value.isin(*rule.values)
    return (value < rule.low) | (value > rule.high)


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """Violating values with the number of rows that hold them."""
    counted = F.count("*").alias("n_records")
    if rule.kind == "unique":
        rows = df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(counted)
        return rows.where("n_records > 1")
    if rule.kind == "relationships":
        # Children are counted per key before the join, so a hot key is one row there.
        children = df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(counted)
        parents = rule.parent.select(F.col(rule.parent_key).alias(rule.column))
        return children.join(parents, rule.column, "left_anti")
    return df.where(_bad(rule)).groupBy(rule.column).agg(counted)


# Rules that look at one row alone.
ROW_RULES = ("not_null", "accepted", "between")


def watched(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, Observation]:
    """``df``, whose writing also counts its rows (``rows``) and those that break the rules on single rows, by rule name."""
    observation = Observation()
    broken = [F.count_if(_bad(r)).alias(r.name) for r in rules if r.kind in ROW_RULES]
    return df.observe(observation, F.count("*").alias("rows"), *broken), observation


def check(df: DataFrame, rules: list[Rule], table: str = "", seen: dict[str, int] | None = None) -> DataFrame:
    """(table_name, rule, violations): violating rows, or surplus rows for ``unique``.

    ``seen`` are the counts of ``watched`` from when the table was written: their rules cost no scan.
    """
    seen = seen or {}
    known = [(r.name, seen[r.name]) for r in rules if r.name in seen]
    local = [r for r in rules if r.kind != "relationships" and r.name not in seen]
    parts = [df.sparkSession.createDataFrame(known, "rule string, violations bigint")] if known else []
    if local:
        aggregates = []
        for i, rule in enumerate(local):
            if rule.kind == "unique":
                bad = F.count(rule.column) - F.countDistinct(rule.column)
            else:
                bad = F.count_if(_bad(rule))
            aggregates.append(bad.cast("bigint").alias(f"v{i}"))
        pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"v{i}").alias("violations")) for i, r in enumerate(local)]
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*pairs))))
    for rule in rules:
        if rule.kind == "relationships":
            found = violations(df, rule).agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("violations"))
            parts.append(found.select(F.lit(rule.name).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "rule", "violations")


def gold_rules(weights: DataFrame, tables: dict[str, DataFrame]) -> dict[str, list[Rule]]:
    """Rules of the silver, staging, mart and metric tables, by table name."""
    labels = vocab.RESULT_LABELS

    def key(column):
        return [unique(column), not_null(column)]

    return {
        "papers": key("paper_id"),
        "claims": key("claim_id"),
        "claims_rejects": key("claim_id"),
        "bronze_runs": [not_null("run_id")],
        "stg_papers": [*key("paper_id"), accepted("ingest_status", vocab.INGEST_STATUSES)],
        "stg_claims": [
            *key("claim_id"),
            not_null("paper_id"),
            relationships("paper_id", tables["stg_papers"], "paper_id"),
            not_null("result"),
            accepted("result", labels),
            not_null("study_type"),
            relationships("study_type", weights, "study_type"),
            not_null("confidence"),
            between("confidence", 0, 1),
        ],
        "dim_papers": key("paper_id"),
        "fct_claims": [
            *key("claim_id"),
            not_null("paper_id"),
            relationships("paper_id", tables["dim_papers"], "paper_id"),
            accepted("result", labels),
            not_null("study_weight"),
            between("confidence_bucket", 0, 0.9),
        ],
        "claims_by_pair": [*key("claim_pair"), not_null("n_claims")],
        "weighted_disagreement": [
            *key("claim_pair"),
            accepted("weighted_majority_result", labels),
            not_null("weighted_disagreement_score"),
            between("weighted_disagreement_score", 0, 0.75),
            between("unweighted_disagreement_score", 0, 0.75),
        ],
        "confidence_distribution": [not_null("n_claims"), accepted("result", labels)],
        "layer_counts": [*key("step"), not_null("n_rows")],
        "quarantine_shares": [*key("check_outcome"), between("share_of_claims", 0, 1)],
        "evidence_per_paper": [
            *key("paper_id"),
            relationships("paper_id", tables["dim_papers"], "paper_id"),
            not_null("n_claims"),
        ],
        "freshness": key("ingest_date"),
        "pipeline_summary": [
            *key("latest_run_id"),
            not_null("quarantine_rate"),
            between("quarantine_rate", 0, 1),
        ],
        "study_weights": [*key("study_type"), not_null("weight"), between("weight", 0, 1)],
    }


def gold_totals(facts: DataFrame, by_pair: DataFrame, scores: DataFrame, histogram: DataFrame) -> DataFrame:
    """Claims counted by the fact table and by each mart; ``reconciles`` when all agree."""
    totals = one_row(
        facts.agg(F.count("*").alias("fact_claims")),
        by_pair.agg(F.sum("n_claims").alias("by_pair_claims")),
        scores.agg(F.sum("n_claims").alias("disagreement_claims")),
        histogram.agg(F.sum("n_claims").alias("histogram_claims")),
    )
    marts = ("by_pair_claims", "disagreement_claims", "histogram_claims")
    same = reduce(lambda a, b: a & b, [F.coalesce(m, F.lit(0)) == F.col("fact_claims") for m in marts])
    return totals.withColumn("reconciles", same)


def layer_totals(layers: DataFrame) -> DataFrame:
    """Exported rows against silver rows; ``reconciles`` when none was lost."""

    def n(table, layer=None):
        match = F.col("table_name") == table
        return F.max(F.when(match & (F.col("layer") == layer) if layer else match, F.col("n_rows")))

    totals = layers.agg(
        n("papers", "bronze").alias("bronze_papers"),
        n("papers", "silver").alias("silver_papers"),
        n("claim_evidence").alias("bronze_claims"),
        (n("claims") + n("claims_rejects")).alias("silver_claims_checked"),
    )
    papers_kept = F.col("bronze_papers") == F.col("silver_papers")
    claims_kept = F.col("bronze_claims") == F.col("silver_claims_checked")
    return totals.withColumn("reconciles", papers_kept & claims_kept)


def unanimous_pairs(by_pair: DataFrame, scores: DataFrame) -> DataFrame:
    """Pairs whose claims all report one result, with their score."""
    labels = sum((F.col(f"n_{x}") > 0).cast("int") for x in vocab.RESULT_LABELS)
    one_label = by_pair.where(labels == 1).select("claim_pair")
    return scores.join(one_label, "claim_pair").select("claim_pair", "weighted_disagreement_score")


def unanimous_violations(by_pair: DataFrame, scores: DataFrame) -> DataFrame:
    return unanimous_pairs(by_pair, scores).where("weighted_disagreement_score <> 0")


def claim_rules(papers: DataFrame) -> tuple[list[Rule], list[Rule]]:
    """Rules of valid claims on their own, and those that look into other tables."""
    local = [unique("claim_id"), accepted("result", vocab.RESULT_LABELS), between("confidence", 0, 1)]
    return local, [relationships("paper_id", papers, "paper_id")]


def silver_checks(papers: DataFrame, claims: DataFrame, seen: dict[str, int] | None = None) -> DataFrame:
    """``seen`` are the counts of the claims' rules on single rows, if their writing was watched."""
    local, crossing = claim_rules(papers)
    return check(papers, [unique("paper_id")], "papers").unionByName(check(claims, local + crossing, "claims", seen))


def silver_gate(papers: DataFrame, claims: DataFrame, seen: dict[str, int] | None = None) -> None:
    """Raise when silver breaks one of its guarantees."""
    raise_failed([silver_checks(papers, claims, seen)])


def raise_failed(checks: list[DataFrame]) -> None:
    failed = reduce(DataFrame.unionByName, checks).where("violations > 0").collect() if checks else []
    if failed:
        raise ValueError("Silver checks failed: " + "; ".join(f"{r.table_name}.{r.rule}: {r.violations}" for r in failed))


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Rejects per reason. The raw results behind them are a free-text set without a bound, so
    ``reject_examples`` lists them as rows."""
    return rejects.groupBy("reject_reason").agg(
        F.count("*").alias("n"), F.countDistinct("result_raw").alias("n_results")
    )


def reject_examples(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason", "result_raw").agg(F.count("*").alias("n"))


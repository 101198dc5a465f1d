"""Registered queries and the reference SQL of each."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import vocab
from claimweave.operators import dashboard, disagreement, gold, metrics, quality, search, silver
from claimweave.operators.keyed import latest_versions
from claimweave.plans import pipeline
from claimweave.plans import tables as t
from claimweave.plans.oracles import disagreement as disagreement_sql
from claimweave.plans.oracles import freshness as freshness_sql
from claimweave.plans.oracles import quality_report as quality_report_sql
from claimweave.plans.oracles import sql
from claimweave.sources import bronze
from claimweave.session import buckets_for, scratch_dir, staged, staged_by
from claimweave.sources.weights import study_weights

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = sql(oracle)
        return fn

    return register


# --- gold -----------------------------------------------------------------------------------


@query("SELECT * FROM v_scores")
def weighted_disagreement(spark, sf_dir):
    return disagreement.label_disagreement(t.facts(spark, sf_dir))


@query("SELECT * FROM v_order_scores")
def weighted_disagreement_many_pairs(spark, sf_dir):
    return disagreement.label_disagreement(t.order_facts(spark, sf_dir))


@query("SELECT * FROM v_scores")
def weighted_disagreement_any_label(spark, sf_dir):
    return disagreement.weighted_disagreement(t.facts(spark, sf_dir))


@query("SELECT * FROM v_facts")
def fct_claims(spark, sf_dir):
    return t.facts(spark, sf_dir)


@query("SELECT * FROM v_dim")
def dim_papers(spark, sf_dir):
    return t.papers_dim(spark, sf_dir)


@query("SELECT * FROM v_by_pair")
def claims_by_pair(spark, sf_dir):
    return gold.claims_by_pair(t.facts(spark, sf_dir))


@query("SELECT * FROM v_histogram")
def confidence_distribution(spark, sf_dir):
    return gold.confidence_distribution(t.facts(spark, sf_dir))


@query(
    "SELECT intervention, outcome, weighted_disagreement_score, unweighted_disagreement_score FROM ("
    + disagreement_sql("v_stg_claims", "1.0")
    + ")"
)
def unweighted_disagreement(spark, sf_dir):
    scores = disagreement.weighted_disagreement(t.stg_claims(spark, sf_dir), F.lit(1), 0.0)
    return scores.select(
        "intervention", "outcome", "weighted_disagreement_score", "unweighted_disagreement_score"
    )


FINE_WEIGHT = "CASE result WHEN 'positive' THEN 0.125 WHEN 'negative' THEN 0.2475 WHEN 'null' THEN 0.004 ELSE 0.0005 END"


@query(disagreement_sql("v_stg_claims", FINE_WEIGHT))
def weighted_disagreement_fine_weights(spark, sf_dir):
    """Weights of three and four decimals, where hundredths would elect another result."""
    return disagreement.weighted_disagreement(t.stg_claims(spark, sf_dir), F.expr(FINE_WEIGHT).cast("double"))


RAW_WEIGHT = (
    "CASE lower(study_type) WHEN 'rct' THEN 1.0 WHEN 'randomized controlled trial' THEN 1.0 "
    "WHEN 'quasi-experimental' THEN 0.8 WHEN 'observational' THEN 0.6 WHEN 'case-control' THEN 0.5 "
    "WHEN 'cross-sectional' THEN 0.45 WHEN 'case report' THEN 0.3 ELSE 0.5 END"
)
CELLS = (
    "SELECT intervention, outcome, weighted_disagreement_score AS disagreement_score, n_claims AS total_studies FROM ("
    + disagreement_sql("v_bronze_claims", RAW_WEIGHT)
    + ")"
)


@query(CELLS)
def heatmap_cells(spark, sf_dir):
    return disagreement.heatmap_cells(t.bronze_claims(spark, sf_dir))


@query(CELLS.replace(RAW_WEIGHT, "1.0"))
def study_heatmap_cells(spark, sf_dir):
    return disagreement.study_heatmap_cells(t.bronze_claims(spark, sf_dir))


MATRIX_OUTCOMES = ["economy", "large", "medium", "promo", "small", "standard"]


@query(
    "SELECT intervention, "
    + ", ".join(
        f"coalesce(max(weighted_disagreement_score) FILTER (outcome = '{x}'), 0) AS {x}"
        for x in MATRIX_OUTCOMES
    )
    + " FROM v_scores GROUP BY intervention"
)
def heatmap_matrix(spark, sf_dir):
    return disagreement.heatmap_matrix(disagreement.heatmap_cells(t.stg_claims(spark, sf_dir)), MATRIX_OUTCOMES)


@query(
    """
SELECT lower(trim(intervention)) || ' -> ' || lower(trim(outcome)) AS claim_key, intervention, outcome,
  coalesce(string_agg(result || '=' || n, ';' ORDER BY result) FILTER (result IN ('positive', 'negative', 'null', 'mixed')), '')
    AS result_counts,
  CAST(sum(n) FILTER (result IS NULL OR result NOT IN ('positive', 'negative', 'null', 'mixed')) AS BIGINT) AS other_results,
  CAST(sum(n) AS BIGINT) AS total_studies
FROM (SELECT intervention, outcome, result, count(*) AS n FROM v_bronze_claims GROUP BY 1, 2, 3)
GROUP BY intervention, outcome"""
)
def claim_groups(spark, sf_dir):
    groups = disagreement.claim_groups(t.bronze_claims(spark, sf_dir))
    entries = F.transform(
        F.map_entries("result_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return groups.withColumn("result_counts", F.array_join(entries, ";"))


# --- silver ---------------------------------------------------------------------------------


@query("SELECT id, _run_id, _exported_at, result, confidence, is_deleted FROM v_latest_claims")
def latest_versions_of_claims(spark, sf_dir):
    latest = latest_versions(t.bronze_claims(spark, sf_dir), F.lit(t.LATEST_RUN), ties=t.CLAIM_TIES)
    return latest.select("id", "_run_id", "_exported_at", "result", "confidence", "is_deleted")


def fingerprint_sql(columns) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns)
    return f"sha256(concat_ws('||', {parts})) AS row_hash"


@query(
    "SELECT paper_id, title, source_filename, ingest_status, ingest_error, created_at, is_synthetic, is_deleted, "
    "_last_run_id, _last_exported_at, canonical_paper_id, is_duplicate_upload, "
    + fingerprint_sql(vocab.PAPER_HASH_COLUMNS)
    + " FROM v_silver_papers"
)
def canonical_uploads(spark, sf_dir):
    return t.silver_papers(spark, sf_dir)


@query("SELECT * FROM v_clean_claims")
def normalize_claims(spark, sf_dir):
    latest = latest_versions(t.bronze_claims(spark, sf_dir), F.lit(t.LATEST_RUN), ties=t.CLAIM_TIES)
    return silver.clean_claims(latest)


@query("SELECT claim_id, paper_id, reject_reason FROM v_checked")
def reject_reasons(spark, sf_dir):
    return t.checked_claims(spark, sf_dir).select("claim_id", "paper_id", "reject_reason")


@query("SELECT * FROM v_rejects")
def claims_rejects(spark, sf_dir):
    return t.rejected_claims(spark, sf_dir)


@query(f"SELECT *, {fingerprint_sql(vocab.CLAIM_HASH_COLUMNS)} FROM v_valid")
def valid_claims(spark, sf_dir):
    return t.valid_claims(spark, sf_dir)


@query(
    "SELECT canonical_paper_id, count(*) AS n_findings, count(*) FILTER (is_duplicate) AS n_repeats, "
    "count(*) FILTER (is_deleted) AS n_deleted FROM v_valid GROUP BY 1"
)
def repeated_findings(spark, sf_dir):
    return (
        t.valid_claims(spark, sf_dir)
        .groupBy("canonical_paper_id")
        .agg(
            F.count("*").alias("n_findings"),
            F.count_if("is_duplicate").alias("n_repeats"),
            F.count_if("is_deleted").alias("n_deleted"),
        )
    )


@query(
    """
SELECT claim_id, sha256(concat_ws('||', CAST(claim_id AS VARCHAR), coalesce(CAST(paper_id AS VARCHAR), '~'),
  coalesce(CAST(cluster_id AS VARCHAR), '~'), coalesce(population, '~'), coalesce(intervention, '~'),
  coalesce(outcome, '~'), coalesce(result, '~'), coalesce(study_type, '~'), CAST(is_deleted AS VARCHAR))) AS row_hash
FROM v_clean_claims"""
)
def row_hash(spark, sf_dir):
    latest = latest_versions(t.bronze_claims(spark, sf_dir), F.lit(t.LATEST_RUN), ties=t.CLAIM_TIES)
    columns = [
        "claim_id",
        "paper_id",
        "cluster_id",
        "population",
        "intervention",
        "outcome",
        "result",
        "study_type",
        "is_deleted",
    ]
    return silver.clean_claims(latest).select("claim_id", C.row_hash(columns, "~").alias("row_hash"))


def pipeline_gold(spark, sf_dir) -> dict[str, DataFrame]:
    """Silver and star-schema frames of the messy snapshots; silver is staged, without the fingerprints that no one reads here."""
    papers = staged(t.silver_papers(spark, sf_dir).drop("row_hash"), "papers")
    bronze_claims = t.bronze_claims(spark, sf_dir)
    buckets = buckets_for(bronze_claims)
    checked = silver.checked_claims(bronze_claims, papers, F.lit(t.LATEST_RUN), t.CLAIM_TIES)
    checked = staged_by(checked, "checked", "claim_id", buckets)
    claims = staged_by(silver.valid_claims(checked).drop("row_hash"), "claims", "claim_id", buckets)
    live_papers, live_claims = gold.stg_papers(papers), gold.stg_claims(claims)
    return {
        "papers": papers,
        "claims": claims,
        "rejects": silver.rejected_claims(checked),
        "dim": gold.dim_papers(live_papers, live_claims),
        "facts": gold.fct_claims(live_claims, study_weights(spark)),
        "runs": t.bronze_runs(spark, sf_dir),
    }


@query("SELECT * FROM v_live_facts")
def pipeline_facts(spark, sf_dir):
    claims = gold.stg_claims(t.valid_claims(spark, sf_dir))
    return gold.fct_claims(claims, study_weights(spark))


@query(
    "SELECT paper_id, title, source_filename, ingest_status, ingest_error, created_at, is_synthetic FROM v_live_papers"
)
def stg_papers(spark, sf_dir):
    return gold.stg_papers(t.silver_papers(spark, sf_dir))


@query(disagreement_sql("v_live_facts"))
def pipeline_disagreement(spark, sf_dir):
    claims = gold.stg_claims(t.valid_claims(spark, sf_dir))
    return disagreement.label_disagreement(gold.fct_claims(claims, study_weights(spark)))


# --- pipeline metrics -----------------------------------------------------------------------


def layers_of(frames: dict[str, DataFrame]) -> DataFrame:
    return metrics.layer_counts(*[frames[x] for x in ("runs", "papers", "claims", "rejects", "dim", "facts")])


@query("SELECT * FROM v_layers ORDER BY step")
def layer_counts(spark, sf_dir):
    return layers_of(pipeline_gold(spark, sf_dir)).orderBy("step")


@query("SELECT * FROM v_quarantine")
def quarantine_shares(spark, sf_dir):
    """Straight from the checked claims: repeats and hashes play no part in the shares."""
    return metrics.outcome_shares(silver.outcomes(t.checked_claims(spark, sf_dir)))


@query("SELECT * FROM v_evidence")
def evidence_per_paper(spark, sf_dir):
    return metrics.evidence_per_paper(t.papers_dim(spark, sf_dir), t.facts(spark, sf_dir))


@query(
    """
SELECT run_id, ingest_date, exported_at, source_table, n_rows FROM v_hourly_runs"""
)
def run_history(spark, sf_dir):
    runs = bronze.runs_from_manifests(t.hourly_manifests(spark, sf_dir))
    return runs.withColumn("exported_at", F.col("exported_at").cast("timestamp_ntz"))


@query(freshness_sql("v_hourly_runs", "DATE '2024-02-15'"))
def freshness(spark, sf_dir):
    runs = bronze.runs_from_manifests(t.hourly_manifests(spark, sf_dir))
    runs = runs.withColumn("exported_at", F.col("exported_at").cast("timestamp_ntz"))
    return metrics.freshness(runs, F.lit("2024-02-15").cast("date"))


@query("SELECT * FROM v_summary")
def pipeline_summary(spark, sf_dir):
    frames = pipeline_gold(spark, sf_dir)
    evidence = metrics.evidence_per_paper(frames["dim"], frames["facts"])
    as_of = t.at("2002-01-01 00:00:00")
    summary = metrics.pipeline_summary(frames["runs"], layers_of(frames), evidence, frames["facts"], as_of)
    return summary


# --- data quality ---------------------------------------------------------------------------


@query(
    """
SELECT 'fct_claims' AS table_name, * FROM (VALUES
  ('unique:claim_id', (SELECT count(claim_id) - count(DISTINCT claim_id) FROM v_facts)),
  ('not_null:claim_id', (SELECT count(*) FROM v_facts WHERE claim_id IS NULL)),
  ('not_null:paper_id', (SELECT count(*) FROM v_facts WHERE paper_id IS NULL)),
  ('accepted:result', (SELECT count(*) FROM v_facts WHERE result NOT IN ('positive', 'negative', 'null'))),
  ('between:confidence', (SELECT count(*) FROM v_facts WHERE confidence < 0.1 OR confidence > 0.9)),
  ('relationships:paper_id', (SELECT count(*) FROM v_facts WHERE paper_id NOT IN
     (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')))) AS t(rule, violations)"""
)
def dq_check(spark, sf_dir):
    finished = t.read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    rules = [
        quality.unique("claim_id"),
        quality.not_null("claim_id"),
        quality.not_null("paper_id"),
        quality.accepted("result", ("positive", "negative", "null")),
        quality.between("confidence", 0.1, 0.9),
        quality.relationships("paper_id", finished, "o_orderkey"),
    ]
    return quality.check(t.facts(spark, sf_dir), rules, "fct_claims")


@query("SELECT claim_id, count(*) AS n_records FROM v_facts GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return quality.violations(t.facts(spark, sf_dir), quality.unique("claim_id"))


@query("SELECT paper_id, count(*) AS n_records FROM v_bronze_claims WHERE paper_id IS NULL GROUP BY 1")
def dq_not_null(spark, sf_dir):
    return quality.violations(t.bronze_claims(spark, sf_dir), quality.not_null("paper_id"))


@query(
    "SELECT result, count(*) AS n_records FROM v_bronze_claims "
    "WHERE result NOT IN ('positive', 'negative', 'null', 'mixed') GROUP BY 1"
)
def dq_accepted_values(spark, sf_dir):
    return quality.violations(t.bronze_claims(spark, sf_dir), quality.accepted("result", vocab.RESULT_LABELS))


@query("SELECT doc_id, count(*) AS n_records FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1")
def dq_relationships(spark, sf_dir):
    labels = t.read(spark, sf_dir, "labels")
    rule = quality.relationships("doc_id", labels, "doc_id")
    return quality.violations(t.read(spark, sf_dir, "documents"), rule)


@query("SELECT value, count(*) AS n_records FROM events WHERE value < 1 OR value > 100 GROUP BY 1")
def dq_between(spark, sf_dir):
    return quality.violations(t.read(spark, sf_dir, "events"), quality.between("value", 1, 100))


@query(
    """
SELECT * REPLACE (CAST(by_pair_claims AS BIGINT) AS by_pair_claims, CAST(disagreement_claims AS BIGINT) AS disagreement_claims,
  CAST(histogram_claims AS BIGINT) AS histogram_claims, CAST(fact_claims AS BIGINT) AS fact_claims)
FROM (SELECT max(n) FILTER (part = 'facts') AS fact_claims, max(n) FILTER (part = 'pairs') AS by_pair_claims,
  max(n) FILTER (part = 'scores') AS disagreement_claims, max(n) FILTER (part = 'histogram') AS histogram_claims,
  count(DISTINCT n) = 1 AS reconciles FROM v_totals)"""
)
def dq_reconcile(spark, sf_dir):
    # Four totals read the facts, so their join is written once.
    facts = staged(t.facts(spark, sf_dir), "facts")
    return quality.gold_totals(
        facts,
        gold.claims_by_pair(facts),
        disagreement.label_disagreement(facts),
        gold.confidence_distribution(facts),
    )


@query(
    """
SELECT n['bronze.papers'] AS bronze_papers, n['silver.papers'] AS silver_papers, n['bronze.claim_evidence'] AS bronze_claims,
  n['silver.claims'] + n['silver.claims_rejects'] AS silver_claims_checked,
  [n['bronze.papers'], n['bronze.claim_evidence']] = [n['silver.papers'], n['silver.claims'] + n['silver.claims_rejects']] AS reconciles
FROM v_layer_map"""
)
def dq_no_rows_lost(spark, sf_dir):
    return quality.layer_totals(layers_of(pipeline_gold(spark, sf_dir)))


@query(
    """
SELECT claim_pair, weighted_disagreement_score FROM v_order_scores
SEMI JOIN (SELECT claim_pair FROM v_order_facts GROUP BY 1 HAVING count(DISTINCT result) = 1) USING (claim_pair)"""
)
def dq_unanimous(spark, sf_dir):
    facts = t.order_facts(spark, sf_dir)
    return quality.unanimous_pairs(gold.claims_by_pair(facts), disagreement.label_disagreement(facts))


@query(
    """
SELECT * FROM (VALUES
  ('papers', 'unique:paper_id', (SELECT count(paper_id) - count(DISTINCT paper_id) FROM v_silver_papers)),
  ('claims', 'unique:claim_id', (SELECT count(claim_id) - count(DISTINCT claim_id) FROM v_valid)),
  ('claims', 'accepted:result', (SELECT count(*) FROM v_valid WHERE result NOT IN ('positive', 'negative', 'null', 'mixed'))),
  ('claims', 'between:confidence', (SELECT count(*) FROM v_valid WHERE confidence < 0 OR confidence > 1)),
  ('claims', 'relationships:paper_id', (SELECT count(*) FROM v_valid WHERE paper_id NOT IN (SELECT paper_id FROM v_silver_papers)))
) AS t(table_name, rule, violations)"""
)
def silver_checks(spark, sf_dir):
    frames = pipeline_gold(spark, sf_dir)
    return quality.silver_checks(frames["papers"], frames["claims"])


@query(quality_report_sql())
def quality_report(spark, sf_dir):
    """All 63 declared rules over the silver and gold tables of the messy snapshots."""
    frames = pipeline_gold(spark, sf_dir)
    tables = {
        "papers": frames["papers"],
        "claims": frames["claims"],
        "claims_rejects": frames["rejects"],
        "bronze_runs": staged(frames["runs"], "runs"),
    }
    as_of = datetime(2002, 1, 1, tzinfo=timezone.utc)
    seen: dict[str, dict[str, int]] = {}
    gold_tables = pipeline.write_gold(spark, tables, scratch_dir(spark, "gold"), as_of, seen=seen)
    return pipeline.quality_report(spark, tables, gold_tables, seen)


@query("SELECT reject_reason, count(*) AS n, count(DISTINCT result_raw) AS n_results FROM v_rejects GROUP BY 1")
def reject_summary(spark, sf_dir):
    return quality.reject_summary(t.rejected_claims(spark, sf_dir))


@query("SELECT reject_reason, result_raw, count(*) AS n FROM v_rejects GROUP BY 1, 2")
def reject_examples(spark, sf_dir):
    return quality.reject_examples(t.rejected_claims(spark, sf_dir))


# --- search and listings --------------------------------------------------------------------

STORED = (
    "SELECT 'cluster-' || cluster_id || ': ' || intervention || ' -> ' || outcome AS claim_key, population, "
    "intervention, outcome, result, study_type, confidence, paper_id FROM v_stg_claims"
)


@query(f"SELECT * FROM ({STORED}) WHERE claim_key ILIKE '%BRAND#1_ -> s%' AND population ILIKE '%Older%' AND study_type ILIKE '%case%'")
def claim_search(spark, sf_dir):
    return search.search_claims(
        t.stored_claims(spark, sf_dir), topic="BRAND#1_ -> s", population="Older", study_type="case"
    )


@query(f"SELECT * FROM ({STORED}) WHERE contains(lower(claim_key), 'brand#1 -> ')")
def claim_search_literal(spark, sf_dir):
    return search.search_claims(t.stored_claims(spark, sf_dir), topic="Brand#1 -> ", literal=True)


@query(STORED)
def claim_listing(spark, sf_dir):
    return search.search_claims(t.stored_claims(spark, sf_dir))


@query(
    "SELECT intervention, outcome, population, result, study_type FROM v_bronze_claims "
    "WHERE contains(lower(concat_ws(' ', intervention, outcome)), '#2  promo') AND contains(lower(study_type), 'co')"
)
def study_search(spark, sf_dir):
    found = search.search_studies(t.bronze_claims(spark, sf_dir), topic="#2  Promo", study_type="CO")
    return found.select("intervention", "outcome", "population", "result", "study_type")


@query(
    """
SELECT intervention, outcome, count(*) AS total_studies, count_if(result = 'positive') AS n_positive
FROM v_stg_claims WHERE contains(concat_ws(' ', intervention, outcome), '#2') AND contains(study_type, 'co') GROUP BY ALL"""
)
def grouped_study_search(spark, sf_dir):
    """Filter, then group."""
    groups = disagreement.claim_groups(search.search_studies(t.stg_claims(spark, sf_dir), topic="#2", study_type="CO"))
    return groups.select(
        "intervention",
        "outcome",
        "total_studies",
        F.coalesce(F.try_element_at("result_counts", F.lit("positive")), F.lit(0)).alias("n_positive"),
    )


@query("SELECT id, title, source_filename, ingest_status, ingest_error FROM v_bronze_papers ORDER BY created_at DESC, id")
def paper_listing(spark, sf_dir):
    return search.list_papers(t.bronze_papers(spark, sf_dir))


# --- dashboard ------------------------------------------------------------------------------


@query(
    "SELECT count(claim_id) AS claims, count(DISTINCT paper_id) AS papers, (SELECT count(*) FROM v_scores) AS pairs FROM v_facts"
)
def kpi_row(spark, sf_dir):
    facts = t.facts(spark, sf_dir)
    return dashboard.kpi_row(facts, disagreement.label_disagreement(facts))


@query(
    """
SELECT count(claim_id) AS claims, count(DISTINCT paper_id) AS papers,
  (SELECT count(*) FROM v_scores WHERE intervention IN ('brand#3', 'brand#7')) AS pairs
FROM v_facts WHERE claim_pair IN (SELECT claim_pair FROM v_scores WHERE intervention IN ('brand#3', 'brand#7'))"""
)
def slicer_page(spark, sf_dir):
    facts = t.facts(spark, sf_dir)
    sliced = dashboard.slice_scores(disagreement.label_disagreement(facts), ["brand#3", "brand#7"])
    return dashboard.kpi_row(dashboard.follow_slicer(facts, sliced), sliced)


@query(
    "SELECT claim_pair, weighted_disagreement_score, unweighted_disagreement_score FROM v_scores "
    "ORDER BY weighted_disagreement_score DESC, claim_pair"
)
def contested_pairs(spark, sf_dir):
    return dashboard.contested_pairs(disagreement.label_disagreement(t.facts(spark, sf_dir)))


@query(
    "SELECT claim_pair, "
    + ", ".join(f"round(n_{x} / n_claims, 4) AS share_{x}" for x in vocab.RESULT_LABELS)
    + " FROM v_by_pair"
)
def findings_share(spark, sf_dir):
    return dashboard.findings_share(gold.claims_by_pair(t.facts(spark, sf_dir)))


@query("SELECT confidence_bucket, study_type, count(claim_id) AS n_claims FROM v_facts GROUP BY 1, 2")
def confidence_by_design(spark, sf_dir):
    return dashboard.confidence_by_design(t.facts(spark, sf_dir))

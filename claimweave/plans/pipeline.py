"""The batch pipeline: bronze runs to silver tables to gold tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import vocab
from claimweave.operators import changes, disagreement, gold, metrics, quality, silver
from claimweave.session import buckets_for, remove_staged, scratch_removed, staged, staged_alone, staged_by, staged_bytes
from claimweave.sources import bronze, versions
from claimweave.sources.weights import study_weights


def silver_paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in ("papers", "claims", "claims_rejects", "bronze_runs")}


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: versions.read_table(spark, path).drop(*changes.HIDDEN) for name, path in silver_paths(root).items()}


def write_silver(
    bronze_papers: DataFrame,
    bronze_claims: DataFrame,
    runs: DataFrame,
    latest_run_id: str,
    silver_root: str,
    at: datetime | None = None,
    retire_rejected: bool = False,
) -> dict[str, dict]:
    """Build and commit the four silver tables, if the silver checks pass.

    Papers and checked claims are staged once; the tables are checked and written from the staged files
    instead of repeating the bronze scan and its shuffles for each. What is staged goes as soon as nothing reads it any
    more, so the disk never holds all of it at once.
    """
    spark = bronze_papers.sparkSession
    paths = silver_paths(silver_root)
    more, latest = (changes.SOURCE_HASH,), F.lit(latest_run_id)
    bronze_papers = changes.with_source_hash(bronze_papers, "papers")
    bronze_claims = changes.with_source_hash(bronze_claims, "claim_evidence")

    def staged_papers() -> DataFrame:
        return staged(changes.keep_papers(silver.silver_papers(bronze_papers, latest, stage=True, more=more)), "silver-papers")

    papers = staged_alone(spark, staged_papers)

    def staged_claims() -> DataFrame:
        rows = silver.checked_claims(bronze_claims, papers, latest, more=more).withColumn(changes.GONE, F.col("is_deleted"))
        return staged_by(rows, "checked-claims", "claim_id", buckets_for(bronze_claims))

    checked = staged_alone(spark, staged_claims)
    rejects = silver.rejected_claims(checked)
    claims, counts = quality.watched(changes.keep_claims(silver.valid_claims(checked)), quality.claim_rules(papers)[0])
    valid = claims = staged(claims, "silver-claims")
    quality.silver_gate(papers, claims, counts.get)
    size = staged_bytes(claims)
    if retire_rejected and versions.table_exists(spark, paths["claims"]):
        claims = claims.unionByName(_newly_rejected(spark, paths["claims"], rejects))
    # Rejects are a part of the checked claims: their bytes follow from their share of the rows.
    share = rejects.count() / max(checked.count(), 1)
    rejected = versions.create(
        rejects.withColumn(versions.UPDATED_AT, versions.stamp(at)),
        paths["claims_rejects"],
        "claim_id",
        round(share * staged_bytes(checked)),
    )
    if claims is valid:
        remove_staged(checked)
    done = {"papers": versions.upsert(papers, paths["papers"], "paper_id", at=at, quiet=changes.HIDDEN, size=staged_bytes(papers))}
    remove_staged(papers)
    done["claims"] = versions.upsert(claims, paths["claims"], "claim_id", at=at, quiet=changes.HIDDEN, size=size)
    remove_staged(valid)
    # Rejects and the run history describe the current state, so they are replaced.
    done["claims_rejects"] = {"operation": "OVERWRITE", "inserted": rejected, "updated": 0}
    return {**done, "bronze_runs": versions.overwrite(runs, paths["bronze_runs"], at=at)}


def _newly_rejected(spark: SparkSession, path: str, rejects: DataFrame) -> DataFrame:
    """Stored live claims that the checks reject now, marked as deleted."""
    stored = versions.read_table(spark, path).drop(versions.UPDATED_AT)
    live = stored.where(~F.col("is_deleted")).join(rejects.select("claim_id"), "claim_id", "left_semi")
    gone = live.withColumn("is_deleted", F.lit(True))
    return gone.withColumn("row_hash", C.row_hash(vocab.CLAIM_HASH_COLUMNS))


def run_bronze_to_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    at: datetime | None = None,
    strict: bool = False,
    retire_rejected: bool = False,
) -> dict:
    """Read every complete run and commit silver. Running again on the same runs changes nothing."""
    run_ids = bronze.complete_run_ids(spark, bronze_root)
    if not run_ids:
        raise ValueError(f"No complete bronze runs under {bronze_root}")
    with scratch_removed(spark):
        write_silver(
            bronze.read_bronze(spark, bronze_root, "papers", run_ids, strict=strict),
            bronze.read_bronze(spark, bronze_root, "claim_evidence", run_ids, strict=strict),
            bronze.run_history(spark, bronze_root),
            run_ids[-1],
            silver_root,
            at,
            retire_rejected,
        )
    return {"runs_read": len(run_ids), "latest_run_id": run_ids[-1], **silver_counts(spark, silver_root)}


def silver_counts(spark: SparkSession, silver_root: str) -> dict[str, int]:
    """Row counts of the silver tables in one query."""
    tables = read_silver(spark, silver_root)
    names = {"papers": "papers", "claims": "claims", "claims_rejected": "claims_rejects"}
    counts = [
        tables[table].agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, table in names.items()
    ]
    return {r["name"]: r.n for r in reduce(DataFrame.unionByName, counts).collect()}


def gold_frames(
    spark: SparkSession, tables: dict[str, DataFrame], as_of: datetime, weights: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every gold table as a lazy frame over the silver tables."""
    weights = study_weights(spark) if weights is None else weights
    papers, claims, rejects = tables["papers"], tables["claims"], tables["claims_rejects"]
    runs = tables["bronze_runs"]
    now = F.lit(as_of.isoformat()).cast("timestamp")
    stg_papers, stg_claims = gold.stg_papers(papers), gold.stg_claims(claims)
    dim, facts = gold.dim_papers(stg_papers, stg_claims), gold.fct_claims(stg_claims, weights)
    layers = metrics.layer_counts(runs, papers, claims, rejects, dim, facts)
    evidence = metrics.evidence_per_paper(dim, facts)
    return {
        "study_weights": weights,
        "stg_papers": stg_papers,
        "stg_claims": stg_claims,
        "dim_papers": dim,
        "fct_claims": facts,
        "claims_by_pair": gold.claims_by_pair(facts),
        "confidence_distribution": gold.confidence_distribution(facts),
        "weighted_disagreement": disagreement.label_disagreement(facts),
        "layer_counts": layers,
        "quarantine_shares": metrics.quarantine_shares(claims, rejects),
        "evidence_per_paper": evidence,
        "freshness": metrics.freshness(runs, now.cast("date")),
        "pipeline_summary": metrics.pipeline_summary(runs, layers, evidence, facts, now),
    }


VIEWS = ("stg_papers", "stg_claims")


def build_gold(
    spark: SparkSession, silver_root: str, gold_root: str, as_of: datetime, weights: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Write the gold tables of the stored silver tables."""
    return write_gold(spark, read_silver(spark, silver_root), gold_root, as_of, weights)


def write_gold(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    gold_root: str,
    as_of: datetime,
    weights: DataFrame | None = None,
    seen: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Write the gold tables in build order; later tables read what earlier ones wrote.

    ``seen`` receives, by table, what the writing counted for the rules on single rows (see ``quality_report``).
    """
    weights = study_weights(spark) if weights is None else weights
    now = F.lit(as_of.isoformat()).cast("timestamp")
    plan = gold_frames(spark, tables, as_of, weights)
    rules = quality.gold_rules(weights, plan)

    def write(name: str, df: DataFrame) -> DataFrame:
        path = f"{gold_root.rstrip('/')}/{name}"
        counted, counts = quality.watched(df, rules[name])
        counted.write.mode("overwrite").parquet(path)
        if seen is not None:
            seen[name] = counts.get
        return spark.read.schema(df.schema).parquet(path)

    done = {name: plan[name] for name in VIEWS}
    for name in ("study_weights", "dim_papers", "fct_claims"):
        done[name] = write(name, plan[name])
    facts, dim = done["fct_claims"], done["dim_papers"]
    done["claims_by_pair"] = write("claims_by_pair", gold.claims_by_pair(facts))
    done["confidence_distribution"] = write("confidence_distribution", gold.confidence_distribution(facts))
    done["weighted_disagreement"] = write("weighted_disagreement", disagreement.label_disagreement(facts))
    runs, claims, rejects = tables["bronze_runs"], tables["claims"], tables["claims_rejects"]
    layers = metrics.layer_counts(runs, tables["papers"], claims, rejects, dim, facts)
    done["layer_counts"] = write("layer_counts", layers)
    done["quarantine_shares"] = write("quarantine_shares", metrics.quarantine_shares(claims, rejects))
    done["evidence_per_paper"] = write("evidence_per_paper", metrics.evidence_per_paper(dim, facts))
    done["freshness"] = write("freshness", plan["freshness"])
    summary = metrics.pipeline_summary(runs, done["layer_counts"], done["evidence_per_paper"], facts, now)
    done["pipeline_summary"] = write("pipeline_summary", summary)
    return done


def quality_report(
    spark: SparkSession,
    silver_tables: dict[str, DataFrame],
    gold_tables: dict[str, DataFrame],
    seen: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """(table_name, rule, violations) of every declared rule and the three cross-table checks.

    ``seen`` are the counts of the tables' writing, whose rules are not scanned for again.
    """
    seen = seen or {}
    tables = {**silver_tables, **gold_tables}
    rules = quality.gold_rules(gold_tables["study_weights"], gold_tables)
    parts = [quality.check(tables[name], rules[name], name, seen.get(name)) for name in rules]
    by_pair, scores = gold_tables["claims_by_pair"], gold_tables["weighted_disagreement"]
    totals = quality.gold_totals(gold_tables["fct_claims"], by_pair, scores, gold_tables["confidence_distribution"])
    crosses = {
        "totals_reconcile": totals.where(~F.col("reconciles")),
        "no_rows_lost": quality.layer_totals(gold_tables["layer_counts"]).where(~F.col("reconciles")),
        "unanimous_pairs": quality.unanimous_violations(by_pair, scores),
    }
    for name, bad in crosses.items():
        counted = bad.agg(F.count("*").alias("violations"))
        parts.append(counted.select(F.lit("gold").alias("table_name"), F.lit(name).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts)

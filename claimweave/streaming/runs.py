"""Incremental bronze to silver: only runs that were not seen before are read, and only what they change is written."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions import schemas
from claimweave.operators import changes, quality
from claimweave.plans.pipeline import read_silver, silver_paths, write_silver
from claimweave.session import broadcasts_by_memory, folder_names, remove_folder, scratch_removed
from claimweave.sources import bronze, versions

KEYS = {"papers": "paper_id", "claims": "claim_id", "claims_rejects": "claim_id"}


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/_batches/batch={batch_id}"


def _prepared(spark: SparkSession, folder: str, run_ids: list[str]) -> dict | None:
    """What an interrupted run of this batch had prepared; None if it had not come to the end of that."""
    if "plan" not in folder_names(spark, folder):
        return None
    plan = json.loads(spark.read.text(f"{folder}/plan").head().value)
    return plan if plan["run_ids"] == run_ids else None


def _gate(papers: DataFrame | None, claims: DataFrame | None, delta: DataFrame, lookup: DataFrame) -> None:
    """The silver checks on what is about to be stored. A key can only be doubled within its bucket."""
    found = []
    if papers is not None:
        found.append(quality.check(papers, [quality.unique("paper_id")], "papers"))
    if claims is not None:
        local, crossing = quality.claim_rules(lookup)
        found.append(quality.check(claims, local, "claims"))
        found += [quality.check(delta, [rule], "claims") for rule in crossing]
    quality.raise_failed(found)


def _prepare(spark: SparkSession, bronze_root: str, silver_root: str, run_ids: list[str], folder: str) -> dict:
    """Work out what the runs change and write the touched buckets anew beside the tables, which stay as they are."""
    paths = silver_paths(silver_root)
    history = versions.read_table(spark, paths["bronze_runs"])
    before = history.agg(F.max(F.struct("run_id", F.col("exported_at").cast("string").alias("at"))).alias("x")).head().x
    runs = changes.Runs(max([*run_ids, before.run_id]), before.run_id, before.at)
    new = {table: bronze.read_bronze(spark, bronze_root, table, run_ids) for table in schemas.BRONZE}
    papers, seen = changes.paper_changes(spark, new["papers"], paths["papers"], runs)
    claims, rejects, checked = changes.claim_changes(spark, new["claim_evidence"], paths, papers, seen, runs)
    at = datetime.now(timezone.utc)
    rows = {"papers": (papers, papers), "claims": (claims, claims), "claims_rejects": (rejects, checked)}
    touched = {}
    for name, (delta, gone) in rows.items():
        target = versions.read_table(spark, paths[name])
        stamped = versions.stamped(delta, target, KEYS[name], at, None if name == "claims_rejects" else "row_hash")
        touched[name] = versions.stage_buckets(stamped, paths[name], KEYS[name], f"{folder}/{name}", gone)
    staged = {name: spark.read.parquet(f"{folder}/{name}") if touched[name] else None for name in ("papers", "claims")}
    _gate(staged["papers"], staged["claims"], claims, changes.lookup(versions.read_table(spark, paths["papers"]), papers))
    plan = {"run_ids": run_ids, "touched": touched}
    # The plan comes last: without it the batch is prepared again from the unchanged tables.
    spark.range(1).select(F.lit(json.dumps(plan)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/plan")
    return plan


def apply_runs(spark: SparkSession, bronze_root: str, silver_root: str, run_ids: list[str], batch_id: int) -> None:
    """Bring silver up to date with new runs.

    The first batch builds the tables, or goes on from tables that the batch pipeline built. Later ones change the
    buckets that hold affected rows. What a batch does is complete beside the tables before it touches them, so a batch
    that is interrupted is finished by its replay; only the newest batch's folder is kept for that. A batch other than
    the first needs tables of an earlier one: without them the history of earlier runs would be lost silently. The
    intermediate tables of a batch go with it.
    """
    with scratch_removed(spark), broadcasts_by_memory(spark):
        _apply(spark, bronze_root, silver_root, run_ids, batch_id)


def _apply(spark: SparkSession, bronze_root: str, silver_root: str, run_ids: list[str], batch_id: int) -> None:
    paths, folder = silver_paths(silver_root), _batch_path(silver_root, batch_id)
    built = versions.table_exists(spark, paths["bronze_runs"])
    if not built and batch_id > 0:
        raise ValueError(f"Batch {batch_id} finds no state of an earlier batch under {silver_root}")
    history = bronze.run_history(spark, bronze_root).where(F.col("run_id").isin(run_ids))
    if not built:
        new = [bronze.read_bronze(spark, bronze_root, table, run_ids) for table in ("papers", "claim_evidence")]
        write_silver(*new, history, max(run_ids), silver_root)
        return
    plan = _prepared(spark, folder, run_ids)
    if plan is None:
        remove_folder(spark, folder)
        plan = _prepare(spark, bronze_root, silver_root, run_ids, folder)
    for name, key in KEYS.items():
        versions.publish_buckets(spark, f"{folder}/{name}", paths[name], plan["touched"][name])
        versions.fit_buckets(spark, paths[name], key)
    known = read_silver(spark, silver_root)["bronze_runs"].drop(versions.UPDATED_AT)
    fresh = history.join(known, ["run_id", "source_table"], "left_anti").select(*known.columns)
    versions.overwrite(known.unionByName(fresh), paths["bronze_runs"])
    for other in folder_names(spark, f"{silver_root.rstrip('/')}/_batches"):
        if other != f"batch={batch_id}":
            remove_folder(spark, f"{silver_root.rstrip('/')}/_batches/{other}")


def process_new_runs(spark: SparkSession, bronze_root: str, silver_root: str, checkpoint: str) -> None:
    """Process every manifest that arrived since the last call, then stop."""
    manifests = (
        spark.readStream.schema(schemas.MANIFEST)
        .json(f"{bronze_root.rstrip('/')}/_manifests/*", multiLine=True)
        .select("run_id")
    )

    def batch(rows: DataFrame, batch_id: int) -> None:
        run_ids = sorted(r.run_id for r in rows.distinct().collect())
        if run_ids:
            apply_runs(rows.sparkSession, bronze_root, silver_root, run_ids, batch_id)

    query = (
        manifests.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

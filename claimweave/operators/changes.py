"""What new exports change in silver: found on keys and hashes, worked out on the rows that need it.

A new run is compared with the stored rows by id and content hash alone. Wide rows are read only for what differs, and for what
that reaches: papers of an upload group with a changed member, claims of papers whose canonical copy or deletion changed, and
claims that share a finding with a changed one. Every export holds all rows of its source, so a stored row that the newest run
lacks is deleted; rows that are simply still there are neither read nor written, and keep the run in which they last changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import schemas, vocab
from claimweave.operators import silver
from claimweave.operators.keyed import flag_repeats, latest_versions
from claimweave.session import staged
from claimweave.sources import versions

# Columns that silver tables carry for the next run: hash of the source row, the claim's own deletion, numbers of the upload
# group and of the finding. Readers do not see them.
SOURCE_HASH, GONE, GROUP, FINDING = "_source_hash", "_gone", "_group", "_finding"
HIDDEN = (SOURCE_HASH, GONE, GROUP, FINDING)

LAST_RUN, LAST_AT = "_last_run_id", "_last_exported_at"


@dataclass(frozen=True)
class Runs:
    """The newest run after and before a batch; ``before_at`` is when the latter was exported, as text."""

    latest: str
    before: str
    before_at: str


def with_source_hash(bronze: DataFrame, table: str) -> DataFrame:
    names = [n for n in schemas.SOURCE_COLUMNS[table].fieldNames() if n != "id"]
    return bronze.withColumn(SOURCE_HASH, C.row_hash(names))


def group_number() -> Column:
    return F.xxhash64(F.lower("source_filename"), F.lower("title"))


def finding_number() -> Column:
    return F.xxhash64(*vocab.FINDING_COLUMNS)


def keep_papers(papers: DataFrame) -> DataFrame:
    """Silver papers with their hidden columns."""
    return papers.withColumn(GROUP, group_number())


def keep_claims(claims: DataFrame) -> DataFrame:
    return claims.withColumn(FINDING, finding_number())


def changed_keys(bronze: DataFrame, stored: DataFrame, key: str, runs: Runs, extras: tuple[str, ...]) -> DataFrame:
    """(key, change, is_deleted, run, exported_at, extras) of what a batch of runs inserts, updates, deletes or brings back.

    ``bronze`` are the new runs' rows with their source hash; ``stored`` has key, source hash, own deletion and last run. A
    stored live row was last seen in the newest earlier run.
    """
    version = F.struct("_exported_at", "_run_id", SOURCE_HASH)
    fresh = bronze.groupBy(F.col("id").alias(key)).agg(F.max(version).alias("_new"))
    last = F.struct(F.col(LAST_AT), F.col(LAST_RUN))
    before = F.struct(F.lit(runs.before_at).cast("timestamp").alias(LAST_AT), F.lit(runs.before).alias(LAST_RUN))
    seen = F.when(F.col(GONE), last).otherwise(before)
    old = stored.select(key, F.col(SOURCE_HASH).alias("_old_hash"), F.col(GONE).alias("_old_gone"), seen.alias("_seen"), *extras)
    both = fresh.join(old, key, "full_outer")
    is_old = F.col("_old_hash").isNotNull()
    new_at, new_run, new_hash = (F.col(f"_new.{c}") for c in ("_exported_at", "_run_id", SOURCE_HASH))
    newer = new_run.isNotNull() & (~is_old | (F.struct(new_at.alias(LAST_AT), new_run.alias(LAST_RUN)) > F.col("_seen")))
    gone = F.when(newer, new_run != runs.latest).otherwise(F.col("_old_gone") | F.lit(runs.before != runs.latest))
    change = (
        F.when(~is_old, "insert")
        .when(newer & (new_hash != F.col("_old_hash")), "update")
        .when((gone != F.col("_old_gone")) | (newer & gone), "state")
    )
    return both.select(
        key,
        change.alias("change"),
        gone.alias("is_deleted"),
        F.when(newer, new_run).otherwise(F.col(f"_seen.{LAST_RUN}")).alias(LAST_RUN),
        F.when(newer, new_at).otherwise(F.col(f"_seen.{LAST_AT}")).alias(LAST_AT),
        *extras,
    ).where(F.col("change").isNotNull())


def _new_rows(bronze: DataFrame, changes: DataFrame, clean, key: str, runs: Runs) -> DataFrame:
    """Cleaned rows of the keys that are new or have new content."""
    content = changes.where("change <> 'state'").select(F.col(key).alias("id"))
    return clean(latest_versions(bronze.join(content, "id", "left_semi"), F.lit(runs.latest)), (SOURCE_HASH,))


def _in_state(stored: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Stored rows, those with a change in their state (is it there, and since when) in the new one."""
    names = ("is_deleted", LAST_RUN, LAST_AT)
    state = changes.where("change = 'state'").select(key, *[F.col(n).alias(f"_now_{n}") for n in names])
    return stored.join(state, key, "left").withColumns({n: F.coalesce(f"_now_{n}", n) for n in names})


def paper_changes(spark: SparkSession, bronze: DataFrame, path: str, runs: Runs) -> tuple[DataFrame, DataFrame]:
    """(rows to store, ids of papers that claims now see otherwise)."""
    stored = versions.read_table(spark, path)
    bronze = with_source_hash(bronze, "papers")
    narrow = stored.withColumn(GONE, F.col("is_deleted"))
    changes = staged(changed_keys(bronze, narrow, "paper_id", runs, (GROUP,)), "paper-changes")
    fresh = _new_rows(bronze, changes, silver.clean_papers, "paper_id", runs)
    flipped = versions.stored_rows(spark, path, "paper_id", changes.where("change = 'state'"))
    moved = staged(fresh.unionByName(_in_state(flipped, changes, "paper_id").select(*fresh.columns)), "moved-papers")
    groups = moved.select(group_number().alias(GROUP)).unionByName(changes.select(GROUP)).distinct()
    reached = stored.select("paper_id", GROUP).join(groups, GROUP, "left_semi").join(changes, "paper_id", "left_anti")
    others = versions.stored_rows(spark, path, "paper_id", staged(reached.select("paper_id"), "reached-papers"))
    changed = F.lit(True).alias("_changed")
    members = moved.select("*", changed).unionByName(others.select(*moved.columns, F.lit(False).alias("_changed")))
    before = stored.select(
        "paper_id", F.col("canonical_paper_id").alias("_canonical"), F.col("is_deleted").alias("_was_deleted")
    )
    seen_otherwise = ~F.col("canonical_paper_id").eqNullSafe(F.col("_canonical")) | ~F.col("is_deleted").eqNullSafe(
        F.col("_was_deleted")
    )
    rows = silver.canonical_uploads(members).join(before, "paper_id", "left").withColumn("_seen_otherwise", seen_otherwise)
    rows = keep_papers(rows.where("_changed OR _seen_otherwise")).withColumn("row_hash", C.row_hash(vocab.PAPER_HASH_COLUMNS))
    delta = staged(rows.drop("_changed", "_canonical", "_was_deleted"), "papers-delta")
    return delta.drop("_seen_otherwise"), delta.where("_seen_otherwise").select("paper_id")


def lookup(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """What claims need of every paper, after the papers' changes."""
    columns = ("paper_id", "canonical_paper_id", "is_deleted")
    old = stored.select(*columns).join(delta.select("paper_id"), "paper_id", "left_anti")
    return old.unionByName(delta.select(*columns))


def claim_changes(
    spark: SparkSession, bronze: DataFrame, paths: dict[str, str], papers: DataFrame, seen: DataFrame, runs: Runs
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid rows to store, rejected rows to store, ids that were checked).

    ``papers`` are the papers' changes and ``seen`` the ids of those that claims see otherwise. A claim that is rejected now
    keeps its last valid row, so stored claims count only if the rejects do not list them.
    """
    bronze = with_source_hash(bronze, "claim_evidence")
    rejects = versions.read_table(spark, paths["claims_rejects"])
    valid = versions.read_table(spark, paths["claims"])
    narrow = ("claim_id", "paper_id", SOURCE_HASH, GONE, LAST_RUN, LAST_AT)
    current = valid.select(*narrow, FINDING).join(rejects.select("claim_id"), "claim_id", "left_anti")
    stored = current.unionByName(rejects.select(*narrow, F.lit(None).cast("bigint").alias(FINDING)))
    changes = staged(changed_keys(bronze, stored, "claim_id", runs, (FINDING,)), "claim-changes")
    # One paper may have very many claims: its id is the small side, which Spark broadcasts or splits.
    by_paper = stored.join(seen, "paper_id", "left_semi").join(changes, "claim_id", "left_anti")
    again = changes.where("change = 'state'").select("claim_id", FINDING).unionByName(by_paper.select("claim_id", FINDING))
    again = staged(again, "claims-again")

    def own_rows(name: str) -> DataFrame:
        """Stored rows as they were before the checks."""
        rows = versions.stored_rows(spark, paths[name], "claim_id", again)
        return _in_state(rows.withColumn("is_deleted", F.col(GONE)), changes, "claim_id")

    fresh = _new_rows(bronze, changes, silver.clean_claims, "claim_id", runs)
    old = own_rows("claims").join(rejects.select("claim_id"), "claim_id", "left_anti").select(*fresh.columns)
    touched = fresh.unionByName(old).unionByName(own_rows("claims_rejects").select(*fresh.columns))
    known = lookup(versions.read_table(spark, paths["papers"]), papers)
    checked = staged(silver.check_claims(touched, known).withColumn(GONE, F.col("is_deleted")), "claims-checked")
    passed = keep_claims(silver.passed_claims(checked))

    old_findings = changes.select(FINDING).unionByName(again.select(FINDING))
    findings = passed.select(FINDING).unionByName(old_findings).where(F.col(FINDING).isNotNull()).distinct()
    reached = current.select("claim_id", FINDING).join(findings, FINDING, "left_semi")
    reached = staged(reached.join(checked, "claim_id", "left_anti").select("claim_id"), "claims-reached")
    others = versions.stored_rows(spark, paths["claims"], "claim_id", reached).withColumnRenamed("is_duplicate", "_was_duplicate")
    group = passed.withColumn("_was_duplicate", F.lit(None).cast("boolean"))
    flagged = flag_repeats(group.unionByName(others.select(*group.columns)), list(vocab.FINDING_COLUMNS), "claim_id")
    delta = flagged.where(~F.col("is_duplicate").eqNullSafe(F.col("_was_duplicate"))).drop("_was_duplicate")
    delta = staged(delta.withColumn("row_hash", C.row_hash(vocab.CLAIM_HASH_COLUMNS)), "claims-delta")
    return delta, silver.rejected_claims(checked), checked.select("claim_id")

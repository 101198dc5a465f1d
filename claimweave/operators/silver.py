"""Bronze to silver: cleaning, canonical uploads, quarantine, repeated findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import vocab
from claimweave.operators.keyed import attach_to_groups, flag_repeats, latest_versions
from claimweave.session import buckets_for, staged, staged_by


def clean_papers(latest: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Trimmed texts and normalized state; ``more`` columns pass as they are."""
    return latest.select(
        F.col("id").alias("paper_id"),
        F.trim("title").alias("title"),
        F.trim("source_filename").alias("source_filename"),
        C.norm_text("ingest_status").alias("ingest_status"),
        "ingest_error",
        "created_at",
        F.startswith("source_filename", F.lit(vocab.SYNTHETIC_PREFIX)).alias("is_synthetic"),
        "is_deleted",
        F.col("_run_id").alias("_last_run_id"),
        F.col("_exported_at").alias("_last_exported_at"),
        *more,
    )


def canonical_uploads(papers: DataFrame) -> DataFrame:
    """Point every copy of a file at its lowest live id.

    A paper of a group without a live copy points at itself. One file name may stand for a large
    share of all papers, so the minimum is pre-aggregated and staged, which lets the join split hot names. The
    lower-cased texts are keys of the join only and do not travel beside the papers' own.
    """
    keys = {"_file": F.lower("source_filename"), "_title": F.lower("title")}
    live_id = F.when(~F.col("is_deleted"), F.col("paper_id"))
    groups = papers.groupBy(*[x.alias(k) for k, x in keys.items()]).agg(F.min(live_id).alias("_first_live"))
    attached = attach_to_groups(papers, staged(groups, "upload-groups"), keys)
    canonical = F.coalesce("_first_live", "paper_id")
    return attached.select(
        *papers.columns,
        canonical.alias("canonical_paper_id"),
        (F.col("paper_id") != canonical).alias("is_duplicate_upload"),
    )


def silver_papers(
    bronze: DataFrame, latest_run_id: str | Column, ties=(), stage: bool = False, more: tuple[str, ...] = ()
) -> DataFrame:
    """Cleaned papers with upload groups. Grouping reads the newest versions twice; ``stage``
    writes them once in between instead of ranking bronze again."""
    papers = clean_papers(latest_versions(bronze, latest_run_id, ties=ties), more)
    if stage:
        papers = staged(papers, "latest-papers")
    return canonical_uploads(papers).withColumn("row_hash", C.row_hash(vocab.PAPER_HASH_COLUMNS))


def _normal_claims(bronze: DataFrame, more: tuple[str, ...]) -> DataFrame:
    """What of a claim's row is looked at from here on, with its texts normalized: about half as wide as the row."""
    return bronze.select(
        F.col("id").alias("claim_id"),
        "paper_id",
        C.cluster_number("claim_key").alias("cluster_id"),
        C.norm_text("population").alias("population"),
        C.norm_text("intervention").alias("intervention"),
        C.norm_text("outcome").alias("outcome"),
        C.norm_text("result").alias("result_raw"),
        C.norm_text("study_type").alias("study_type_raw"),
        F.col("confidence").alias("confidence_raw"),
        "_run_id",
        "_exported_at",
        *more,
    )


NORMAL_TEXTS = ("population", "intervention", "outcome", "result_raw", "study_type_raw")


def _packed_texts(normal: DataFrame) -> DataFrame:
    """The normalized texts in one column, a third less to shuffle. They hold no line break and are never empty."""
    packed = F.concat_ws("\n", *[F.coalesce(x, F.lit("")) for x in NORMAL_TEXTS])
    return normal.withColumn("_texts", packed).drop(*NORMAL_TEXTS)


def _unpacked_texts(packed: DataFrame) -> DataFrame:
    parts = packed.withColumn("_texts", F.split("_texts", "\n"))
    return parts.withColumns({x: F.nullif(F.get("_texts", F.lit(i)), F.lit("")) for i, x in enumerate(NORMAL_TEXTS)}).drop("_texts")


def _labelled_claims(normal: DataFrame, more: tuple[str, ...]) -> DataFrame:
    confidence = F.col("confidence_raw")
    return normal.select(
        "claim_id",
        "paper_id",
        "cluster_id",
        "population",
        "intervention",
        "outcome",
        "result_raw",
        C.result_label(F.col("result_raw")).alias("result"),
        "study_type_raw",
        C.study_type_label(F.col("study_type_raw")).alias("study_type"),
        "confidence_raw",
        C.unit_confidence(confidence).alias("confidence"),
        C.is_percent(confidence).alias("confidence_rescaled"),
        "is_deleted",
        F.col("_run_id").alias("_last_run_id"),
        F.col("_exported_at").alias("_last_exported_at"),
        *more,
    )


def clean_claims(latest: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Normalize text, labels and confidence; the raw values stay beside the clean ones, ``more`` columns as they are."""
    return _labelled_claims(_normal_claims(latest, ("is_deleted", *more)), more)


def latest_claims(
    bronze: DataFrame,
    latest_run_id: str | Column,
    ties: tuple[str, ...] = (),
    more: tuple[str, ...] = (),
    parts: int | None = None,
) -> DataFrame:
    """``clean_claims`` of the newest versions. Texts are normalized before versions are ranked and labels are looked up
    after that, so less is sorted and shuffled. ``parts`` is that of ``latest_versions``."""
    normal = _packed_texts(_normal_claims(bronze, tuple(dict.fromkeys([*ties, *more]))))
    return _labelled_claims(_unpacked_texts(latest_versions(normal, latest_run_id, "claim_id", ties, parts)), more)


def check_claims(claims: DataFrame, papers: DataFrame) -> DataFrame:
    """Add the canonical paper and the reject reason to cleaned claims.

    ``papers`` has one row per paper, so the join never multiplies claims. No side is hinted:
    Spark broadcasts papers when their measured size allows and else splits a skewed paper id.
    """
    lookup = papers.select("paper_id", "canonical_paper_id", F.col("is_deleted").alias("_paper_deleted"))
    return claims.join(lookup, "paper_id", "left").withColumn("reject_reason", C.reject_reason())


def outcomes(checked: DataFrame) -> DataFrame:
    """(check_outcome, is_deleted) per checked claim: the reject reason or ``passed``, and the state of its silver row."""
    passed = F.col("reject_reason").isNull()
    return checked.select(
        F.coalesce("reject_reason", F.lit("passed")).alias("check_outcome"),
        (F.col("is_deleted") | (passed & F.coalesce("_paper_deleted", F.lit(False)))).alias("is_deleted"),
    )


def rejected_claims(checked: DataFrame) -> DataFrame:
    """Quarantined claims. ``is_deleted`` is the claim's own state, whatever its paper's is."""
    return checked.where(F.col("reject_reason").isNotNull()).drop("_paper_deleted")


def passed_claims(checked: DataFrame) -> DataFrame:
    """Claims that passed, with deletion cascaded from papers."""
    return (
        checked.where(F.col("reject_reason").isNull())
        .withColumn("is_deleted", F.col("is_deleted") | F.col("_paper_deleted"))
        .drop("reject_reason", "_paper_deleted")
    )


def valid_claims(checked: DataFrame) -> DataFrame:
    """Claims that passed, with repeated findings flagged."""
    flagged = flag_repeats(passed_claims(checked), list(vocab.FINDING_COLUMNS), "claim_id")
    return flagged.withColumn("row_hash", C.row_hash(vocab.CLAIM_HASH_COLUMNS))


def checked_claims(
    bronze: DataFrame, papers: DataFrame, latest_run_id: str | Column, ties=(), more: tuple[str, ...] = ()
) -> DataFrame:
    """``check_claims`` of the newest claims, which are staged by their id.

    Only ids go to the papers and come back with what is found there; the claims stay where they are, in ``buckets_for(bronze)``
    buckets. Who stages the result by its id takes as many.
    """
    buckets = buckets_for(bronze)
    claims = staged_by(latest_claims(bronze, latest_run_id, ties, more, buckets), "latest-claims", "claim_id", buckets)
    lookup = papers.select("paper_id", "canonical_paper_id", F.col("is_deleted").alias("_paper_deleted"))
    found = claims.select("claim_id", "paper_id").join(lookup, "paper_id").drop("paper_id")
    # One claim at most has no id, as versions are ranked by it; it would meet nothing in the join on ids.
    no_id = F.when(F.col("claim_id").isNull(), F.lit(0))
    nameless = found.where("claim_id IS NULL").select(
        no_id.alias("_no_id"), F.col("canonical_paper_id").alias("_canonical"), F.col("_paper_deleted").alias("_deleted")
    )
    named = claims.join(found, "claim_id", "left")
    checked = named.join(F.broadcast(nameless), no_id == F.col("_no_id"), "left").withColumns(
        {"canonical_paper_id": F.coalesce("canonical_paper_id", "_canonical"), "_paper_deleted": F.coalesce("_paper_deleted", "_deleted")}
    )
    return checked.drop("_no_id", "_canonical", "_deleted").withColumn("reject_reason", C.reject_reason())


def silver_claims(
    bronze: DataFrame, papers: DataFrame, latest_run_id: str | Column, ties=()
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). Callers that write both should stage ``checked_claims`` first."""
    checked = checked_claims(bronze, papers, latest_run_id, ties)
    return valid_claims(checked), rejected_claims(checked)

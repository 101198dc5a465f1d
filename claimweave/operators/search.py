"""Listings and filters over claims, studies and papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLAIM_COLUMNS = (
    "claim_key",
    "population",
    "intervention",
    "outcome",
    "result",
    "study_type",
    "confidence",
    "paper_id",
)


def _like(column: str, term: str, literal: bool) -> Column:
    if literal:
        return F.contains(F.lower(column), F.lower(F.lit(term)))
    # The term's own backslashes are plain characters: another character, doubled inside the term, escapes.
    pattern = F.concat(F.lit("%"), F.replace(F.lower(F.lit(term)), F.lit("!"), F.lit("!!")), F.lit("%"))
    return F.like(F.lower(column), pattern, F.lit("!"))


def search_claims(
    claims: DataFrame,
    topic: str | None = None,
    population: str | None = None,
    study_type: str | None = None,
    literal: bool = False,
) -> DataFrame:
    """Claims whose columns contain every given term, ignoring case.

    ``%`` and ``_`` inside a term are wildcards unless ``literal`` is set.
    """
    terms = {"claim_key": topic, "population": population, "study_type": study_type}
    for column, term in terms.items():
        if term:
            claims = claims.where(_like(column, term, literal))
    return claims.select(*CLAIM_COLUMNS)


def search_studies(
    studies: DataFrame,
    topic: str | None = None,
    population: str | None = None,
    study_type: str | None = None,
) -> DataFrame:
    """Plain substring search; the topic is looked up in "intervention outcome"."""
    if topic:
        text = F.concat_ws(" ", "intervention", "outcome")
        studies = studies.where(F.contains(F.lower(text), F.lower(F.lit(topic))))
    if population:
        studies = studies.where(_like("population", population, True))
    if study_type:
        studies = studies.where(_like("study_type", study_type, True))
    return studies


def list_papers(papers: DataFrame) -> DataFrame:
    """Newest first; equal times in order of id."""
    return papers.orderBy(F.col("created_at").desc(), "id").select(
        "id", "title", "source_filename", "ingest_status", "ingest_error"
    )

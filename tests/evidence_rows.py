"""Rows of papers and claims with sensible values, for tests to change."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Row

from claimweave.functions import schemas

T0 = datetime(2026, 10, 1, 12, 0, tzinfo=timezone.utc)
T1 = T0 + timedelta(days=1)


def claim(id, paper_id=1, run="r1", exported=T0, **changes):
    fields = {
        "id": id,
        "paper_id": paper_id,
        "claim_key": "cluster-0: statins -> ldl cholesterol",
        "population": "adults",
        "intervention": "statins",
        "outcome": "ldl cholesterol",
        "result": "negative",
        "study_type": "rct",
        "confidence": 0.9,
        "_run_id": run,
        "_exported_at": exported,
        "_source_table": "claim_evidence",
    }
    return Row(**{**fields, **changes})


def paper(id, run="r1", exported=T0, **changes):
    fields = {
        "id": id,
        "title": f"Paper {id}",
        "source_filename": f"paper_{id}.pdf",
        "ingest_status": "processed",
        "ingest_error": None,
        "created_at": T0,
        "_run_id": run,
        "_exported_at": exported,
        "_source_table": "papers",
    }
    return Row(**{**fields, **changes})


def claims_frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.BRONZE["claim_evidence"])


def papers_frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.BRONZE["papers"])


def by(df, key):
    return {r[key]: r for r in df.collect()}

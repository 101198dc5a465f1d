"""Declared schemas."""

from pyspark.sql import types as T

LINEAGE = [
    T.StructField("_run_id", T.StringType(), False),
    T.StructField("_exported_at", T.TimestampType(), False),
    T.StructField("_source_table", T.StringType(), False),
]

# Source columns that reach bronze; full_text stays behind.
SOURCE_COLUMNS = {
    "papers": T.StructType()
    .add("id", T.LongType(), False)
    .add("title", T.StringType())
    .add("source_filename", T.StringType())
    .add("ingest_status", T.StringType())
    .add("ingest_error", T.StringType())
    .add("created_at", T.TimestampType()),
    "claim_evidence": T.StructType()
    .add("id", T.LongType(), False)
    .add("paper_id", T.LongType())
    .add("claim_key", T.StringType())
    .add("population", T.StringType())
    .add("intervention", T.StringType())
    .add("outcome", T.StringType())
    .add("result", T.StringType())
    .add("study_type", T.StringType())
    .add("confidence", T.DoubleType()),
}

BRONZE = {name: T.StructType([*columns.fields, *LINEAGE]) for name, columns in SOURCE_COLUMNS.items()}

MANIFEST = (
    T.StructType()
    .add("run_id", T.StringType())
    .add("ingest_date", T.StringType())
    .add("exported_at", T.StringType())
    .add(
        "tables",
        T.MapType(
            T.StringType(),
            T.StructType().add("rows", T.LongType()).add("uri", T.StringType()),
        ),
    )
)

STUDY_WEIGHT = (
    T.StructType()
    .add("study_type", T.StringType())
    .add("weight", T.DoubleType())
    .add("evidence_rank", T.IntegerType())
)

# One claim taken from a document.
CLAIM = (
    T.StructType()
    .add("population", T.StringType())
    .add("intervention", T.StringType())
    .add("outcome", T.StringType())
    .add("result", T.StringType())
    .add("study_type", T.StringType())
    .add("confidence", T.DoubleType())
)

STUDY = (
    T.StructType()
    .add("population", T.StringType())
    .add("intervention", T.StringType())
    .add("outcome", T.StringType())
    .add("result", T.StringType())
    .add("study_type", T.StringType())
)

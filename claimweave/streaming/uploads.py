"""Document ingestion as a stream: new files become papers, chunks and claims."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.plans import ingest
from claimweave.sources.documents import file_rows

SINKS = {
    "papers": ingest.paper_rows,
    "chunks": ingest.chunk_rows,
    "claims": ingest.claim_evidence_rows,
}


def stream_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` as a stream; the id is a hash of the path, so it survives restarts."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
    )
    rows = file_rows(files.load(path))
    return rows.select(F.xxhash64("path").alias("paper_id"), "filename", "content")


def process_new_documents(files: DataFrame, out_root: str, checkpoint: str, **options) -> None:
    """Process every document that arrived since the last call, then stop.

    Each micro-batch is worked through once, staged, and written to folders named after it; a
    replayed batch replaces its own folders, so nothing is stored twice.
    """
    out_root = out_root.rstrip("/")

    def batch(rows: DataFrame, batch_id: int) -> None:
        staged = f"{out_root}/_processed/batch={batch_id}"
        ingest.process_documents(rows, **options).write.mode("overwrite").parquet(staged)
        processed = rows.sparkSession.read.parquet(staged)
        _check_ids(processed.select("paper_id"), out_root, batch_id)
        for name, make in SINKS.items():
            make(processed).write.mode("overwrite").parquet(f"{out_root}/{name}/batch={batch_id}")

    query = (
        files.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _check_ids(ids: DataFrame, out_root: str, batch_id: int) -> None:
    """Raise when two files share an id, in this batch or with an earlier one; only ids are read."""
    spark = ids.sparkSession
    if batch_id > 0:
        try:
            stored = spark.read.parquet(f"{out_root}/papers").where(F.col("batch") < batch_id)
            ids = ids.unionByName(stored.select(F.col("id").alias("paper_id")))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    if ids.groupBy("paper_id").count().where("count > 1").limit(1).collect():
        raise ValueError("Two paths share a hash: number the files instead")


def read_sink(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out_root.rstrip('/')}/{name}").drop("batch")

"""Uploaded documents to chunks, vectors and claims; one bad document never stops the others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.functions import columns as C
from claimweave.functions import vocab
from claimweave.operators.extraction import extracted_claims, with_replies
from claimweave.operators.keyed import sequential_ids
from claimweave.operators.text import chunks
from claimweave.operators.vectors import average_linkage, hashed_words
from claimweave.session import staged
from claimweave.sources.documents import decode_text, read_files

PARSED = T.StructType().add("text", T.StringType()).add("error", T.StringType())
VECTORS = T.StructType().add("vectors", T.ArrayType(T.ArrayType(T.FloatType()))).add("error", T.StringType())
LABELS = T.StructType().add("labels", T.ArrayType(T.IntegerType())).add("error", T.StringType())

Embedder = Callable[[list[str]], np.ndarray]

# Texts of an Arrow batch that are Python objects together, and have their vectors in memory if only labels are wanted.
TEXTS_AT_ONCE = 2048


def parse_files(filename: str, content: str, pdf_parser: Callable[[bytes], str] | None = None) -> Column:
    """Text or error per file. PDF files need a parser; all others are UTF-8 text, decoded without Python."""

    @F.pandas_udf(PARSED)
    def parse(data: pd.Series) -> pd.DataFrame:
        rows = []
        for raw in data:
            try:
                rows.append((None if raw is None else pdf_parser(bytes(raw)), None))
            except Exception as error:
                rows.append((None, str(error)))
        return pd.DataFrame(rows, columns=["text", "error"], dtype=object)

    def outcome(text: Column | None = None, error: str | None = None) -> Column:
        text = F.lit(None) if text is None else text
        return F.struct(text.cast("string").alias("text"), F.lit(error).cast("string").alias("error"))

    is_pdf = F.coalesce(F.endswith(F.lower(filename), F.lit(".pdf")), F.lit(False))
    empty = F.coalesce(F.octet_length(content), F.lit(0)) == 0
    # Only the bytes of PDF files go to the parser.
    by_parser = outcome(error="No parser for PDF files") if pdf_parser is None else parse(F.when(is_pdf & ~empty, F.col(content)))
    return F.when(empty, outcome(error="Empty upload")).when(is_pdf, by_parser).otherwise(outcome(decode_text(content)))


def _portions(lists: pa.Array) -> Iterator[list[list[str] | None]]:
    """Lists that follow each other, as many as have ``TEXTS_AT_ONCE`` texts; a longer list is a portion of its own."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), dtype=np.int64)
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + TEXTS_AT_ONCE, side="right")))
        yield lists.slice(start, end - start).to_pylist()
        start = end


def _safely(embedder: Embedder, lists: list[list[str] | None]) -> list[tuple[np.ndarray | None, str | None]]:
    """Vectors per list: one call for all lists, list by list if that call fails."""
    lists = [[t if t is not None else "" for t in texts] if texts is not None else [] for texts in lists]
    try:
        flat = [t for texts in lists for t in texts]
        found = np.asarray(embedder(flat), dtype=np.float32) if flat else np.zeros((0, 0), np.float32)
        if len(found) != len(flat):
            raise ValueError("embedder must return one vector per text")
        ends = np.cumsum([len(texts) for texts in lists])
        return [(part, None) for part in np.split(found, ends[:-1])]
    except Exception as error:
        if len(lists) <= 1:
            return [(None, str(error)) for _ in lists]
        return [_safely(embedder, [texts])[0] for texts in lists]


def _nested(vectors: list[np.ndarray | None]) -> pa.Array:
    """Matrices as lists of lists, without an object for each vector."""
    found = [v for v in vectors if v is not None]
    numbers = np.concatenate([v.ravel() for v in found]) if found else np.zeros(0, np.float32)
    widths = np.concatenate([np.full(len(v), v.shape[1]) for v in found]) if found else np.zeros(0, np.int64)
    rows = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(widths)], pa.int32()), pa.array(numbers, pa.float32()))
    ends = np.cumsum([0 if v is None else len(v) for v in vectors], dtype=np.int64)
    missing = pa.array([v is None for v in vectors], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), rows, mask=missing)


def _embedded(texts: Column, embedder: Embedder) -> Column:
    @F.arrow_udf(VECTORS)
    def vectors(lists: pa.Array) -> pa.Array:
        rows = [row for part in _portions(lists) for row in _safely(embedder, part)]
        errors = pa.array([e for _, e in rows], pa.string())
        return pa.StructArray.from_arrays([_nested([v for v, _ in rows]), errors], ["vectors", "error"])

    return vectors(texts)


def _clustered(texts: Column, embedder: Embedder, threshold: float) -> Column:
    @F.arrow_udf(LABELS)
    def labels(lists: pa.Array) -> pa.Array:
        found, errors = [], []
        for part in _portions(lists):
            # Of a portion's vectors only the labels stay.
            for v, error in _safely(embedder, part):
                found.append(None if v is None else average_linkage(v, threshold))
                errors.append(error)
        return pa.StructArray.from_arrays(
            [pa.array(found, pa.list_(pa.int32())), pa.array(errors, pa.string())], ["labels", "error"]
        )

    return labels(texts)


def process_documents(
    files: DataFrame,
    pdf_parser: Callable[[bytes], str] | None = None,
    model: Callable[[list[str]], list[str]] | None = None,
    embedder: Embedder = hashed_words,
    threshold: float = vocab.CLUSTER_THRESHOLD,
    **rules,
) -> DataFrame:
    """(paper_id, filename, content) to one row per document with its chunks, claims and status.

    Everything about a document stays in its row: the job is a map without a shuffle, for batch
    and streaming input alike.
    """
    parsed = files.withColumn("_parsed", parse_files("filename", "content", pdf_parser)).select(
        "paper_id", "filename", F.col("_parsed.text").alias("full_text"), F.col("_parsed.error").alias("_parse_error")
    )
    if model is not None:
        parsed = with_replies(parsed, "full_text", model)
    reply = "reply" if model is not None else None
    readable = F.col("full_text").isNotNull()
    arrays = F.struct(
        F.when(readable, chunks("full_text")).alias("chunks"),
        F.when(readable, extracted_claims("full_text", reply, **rules)).alias("claims"),
    )
    # A generator is not merged into later projections: the arrays are built once, not again for
    # each Python function that reads them.
    found = parsed.select("paper_id", "filename", "full_text", "_parse_error", F.inline(F.array(arrays)))
    phrases = F.transform("claims", lambda c: F.concat_ws(" ", c["intervention"], c["outcome"]))
    worked = found.withColumn("_vectors", _embedded(F.col("chunks"), embedder)).withColumn(
        "_labels", _clustered(phrases, embedder, threshold)
    )
    error = F.coalesce("_parse_error", "_vectors.error", "_labels.error")
    return worked.select(
        "paper_id",
        "filename",
        "full_text",
        F.when(error.isNull(), "processed").otherwise("failed").alias("ingest_status"),
        error.alias("ingest_error"),
        F.when(error.isNull(), F.arrays_zip("chunks", F.col("_vectors.vectors").alias("vectors"))).alias("chunks"),
        F.when(error.isNull(), F.arrays_zip("claims", F.col("_labels.labels").alias("labels"))).alias("claims"),
    )


def paper_rows(processed: DataFrame) -> DataFrame:
    return processed.select(
        F.col("paper_id").alias("id"),
        F.col("filename").alias("title"),
        F.col("filename").alias("source_filename"),
        F.coalesce("full_text", F.lit("")).alias("full_text"),
        "ingest_status",
        "ingest_error",
    )


def chunk_rows(processed: DataFrame) -> DataFrame:
    exploded = processed.select("paper_id", F.posexplode("chunks").alias("chunk_index", "_c"))
    return exploded.select(
        F.concat_ws(":", F.col("paper_id").cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        "paper_id",
        "chunk_index",
        F.lit("body").alias("section"),
        F.col("_c.chunks").alias("content"),
        F.col("_c.vectors").alias("embedding"),
    )


def claim_evidence_rows(processed: DataFrame) -> DataFrame:
    exploded = processed.select("paper_id", F.posexplode("claims").alias("claim_index", "_c"))
    claim = F.col("_c.claims")
    intervention, outcome = F.lower(C.strip(claim["intervention"])), F.lower(C.strip(claim["outcome"]))
    return exploded.select(
        "paper_id",
        "claim_index",
        C.cluster_key(F.col("_c.labels"), intervention, outcome).alias("claim_key"),
        claim["population"].alias("population"),
        intervention.alias("intervention"),
        outcome.alias("outcome"),
        claim["result"].alias("result"),
        claim["study_type"].alias("study_type"),
        claim["confidence"].alias("confidence"),
    )


def ingest(files: DataFrame, pdf_parser: Callable[[bytes], str] | None = None, **options) -> dict[str, DataFrame]:
    """Papers, chunks and claims of a set of files; the work is done once and staged."""
    processed = staged(process_documents(files, pdf_parser, **options), "ingest")
    return {
        "papers": paper_rows(processed),
        "chunks": chunk_rows(processed),
        "claims": claim_evidence_rows(processed),
    }


def ingest_folder(
    spark: SparkSession, path: str, numbered: bool = False, first_id: int = 1, **options
) -> dict[str, DataFrame]:
    """Ingest every file below ``path``.

    A paper's id is a hash of its path, checked to be unique on the paths alone, so no file content
    moves. ``numbered`` counts up from ``first_id`` in order of path instead: the paths are
    numbered without content and then joined to it.
    """
    files = read_files(spark, path)
    if numbered:
        files = files.join(sequential_ids(files.select("path"), ["path"], "paper_id", first_id), "path")
    else:
        files = files.withColumn("paper_id", F.xxhash64("path"))
        shared = files.groupBy("paper_id").agg(F.count("*").alias("n")).where("n > 1")
        if shared.limit(1).collect():
            raise ValueError("Two paths share a hash; use numbered=True")
    return ingest(files.select("paper_id", "filename", "content"), **options)

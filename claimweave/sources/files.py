"""Files as rows: listed by Spark, read and copied inside tasks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

PIECE = 8 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address as Spark writes it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bytes) of all files below the folders; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return found.select("path", F.col("length").alias("bytes"))


def _digest(path: str, target: str | None) -> str:
    """SHA-256 of a file, which is copied on the way if there is a target; a copy appears whole under its name."""
    store, name = opened(path)
    digest = hashlib.sha256()
    with store.open_input_stream(name) as data:
        if target is None:
            while piece := data.read(PIECE):
                digest.update(piece)
            return digest.hexdigest()
        other, to = opened(target)
        folder, _, leaf = to.rpartition("/")
        other.create_dir(folder, recursive=True)
        attempt = f"{folder}/_{uuid.uuid4().hex}"
        with other.open_output_stream(attempt) as copy:
            while piece := data.read(PIECE):
                digest.update(piece)
                copy.write(piece)
        other.move(attempt, f"{folder}/{leaf}")
    return digest.hexdigest()


def file_digests(files: DataFrame, targets: tuple[str, ...] = ()) -> DataFrame:
    """(name, bytes, sha256) of listed files; each is copied byte by byte into every folder of ``targets``.

    Copying again gives the same files, so a lost task is no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, digests = [], []
            for path in batch["path"].to_pylist():
                name = path.rpartition("/")[2]
                found = [_digest(path, f"{t.rstrip('/')}/{name}") for t in targets] or [_digest(path, None)]
                names.append(name)
                digests.append(found[0])
            yield pa.RecordBatch.from_arrays([pa.array(names), batch["bytes"], pa.array(digests)], ["name", "bytes", "sha256"])

    # A file a task at most: listings pack many small rows into one partition.
    return files.repartition("path").mapInArrow(run, "name string, bytes bigint, sha256 string")


def summary(digests: DataFrame) -> DataFrame:
    """(files, bytes, checksum) of a folder, whatever the order of its files."""
    mark = F.bit_xor(F.xxhash64("name", "sha256"))
    return digests.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.lower(F.hex(F.coalesce(mark, F.lit(0)))).alias("checksum"),
    )


def _footer_types(path: str) -> dict[str, str]:
    store, name = opened(path)
    with store.open_input_file(name) as data:
        footer = pq.ParquetFile(data)
        ancient = {c.name for c in (footer.schema.column(i) for i in range(len(footer.schema))) if c.physical_type == "INT96"}
        kinds = {}
        for field in footer.schema_arrow:
            # Spark reads the old time format as a time stamp with a zone.
            kind = T.TimestampType() if field.name in ancient else from_arrow_type(field.type, prefer_timestamp_ntz=True)
            kinds[field.name] = kind.simpleString()
    return kinds


def schema_differences(files: DataFrame, schema: T.StructType) -> DataFrame:
    """(path, changed) of the Parquet files whose footer has other columns or types than ``schema``."""
    wanted = {f.name: f.dataType.simpleString() for f in schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch["path"].to_pylist():
                stored = _footer_types(path)
                changed = sorted(n for n in stored.keys() | wanted.keys() if stored.get(n) != wanted.get(n))
                if changed:
                    out.append((path, changed))
            paths, names = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(names, pa.list_(pa.string()))], ["path", "changed"]
            )

    return files.repartition("path").mapInArrow(run, "path string, changed array<string>")

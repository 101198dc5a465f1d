"""A deterministic sharded WARC writer, and its reader.

Records are sorted by range of their id into shards whose bounds follow from the ids and sizes alone, so every run writes the
same files. A shard's task writes one gzip member per record, starts a new file when the compressed size reaches the limit,
and makes headers and digests anew from the payloads. Files are written under temporary names that hold a random token, so a
repeated or speculative task disturbs nothing; the manifest of the attempts that Spark accepted names what is then renamed,
and a final manifest, written last, is what readers go by.

A payload that occurs before (with the smallest id) is written as a revisit that refers to the first record.

Defined cases: a null payload is empty; a null id sorts first and is never referred to while another record has the payload;
records with equal id and payload are all written, the first in order as the response; an empty table gives an empty
archive; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.base import whole_text
from claimweave.session import staged

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

FILES = "shard int, part int, name string, temp string, records bigint, bytes bigint"
RECORDS = "id bigint, uri string, kind string, refers bigint, digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(number: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{number}')}>"


def record(number: int | None, uri: str, payload: bytes, refers: int | None, revisit: bool) -> bytes:
    """One record as WARC text; a revisit has no block."""
    block = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_name(number)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join(uri.split())),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("X-Record-Number", "" if number is None else str(number)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_name(refers)),
            ("X-Refers-To-Number", "" if refers is None else str(refers)),
        ]
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address and the path in it."""
    if ":/" not in folder or folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/") if ":/" in folder else folder
    return pafs.FileSystem.from_uri(folder)


class _Roll:
    """Writes records to files of a shard, a new one when the last has reached the limit."""

    def __init__(self, folder: str, shard: int, limit: int):
        self.fs, self.root = _filesystem(folder)
        self.shard, self.limit = shard, limit
        self.token, self.part = uuid.uuid4().hex, -1
        self.out, self.done = None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.part += 1
            self.temp = f"temp-{self.shard:06d}-{self.part:05d}-{self.token}"
            self.out, self.records, self.bytes = self.fs.open_output_stream(f"{self.root}/{self.temp}", compression=None), 0, 0
        self.out.write(data)
        self.records, self.bytes = self.records + 1, self.bytes + len(data)
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            name = f"part-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.done.append((self.shard, self.part, name, self.temp, self.records, self.bytes))
            self.out = None


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
    )


FILE_ARROW = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("name", pa.string()), ("temp", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]
)
RECORD_ARROW = pa.schema(
    [("id", pa.int64()), ("uri", pa.string()), ("kind", pa.string()), ("refers", pa.int64()), ("digest", pa.string()), ("payload", pa.binary())]
)


def write_shards(folder: str, limit: int, least_revisit: int):
    """Rows sorted by shard and id to files; gives the files' rows.

    Before the records of an id come its notes: rows without a payload that say which record holds a payload first.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, current, notes, met = None, object(), {}, set()
        for batch in batches:
            for row in batch.to_pylist():
                if roll is None or roll.shard != row["shard"]:
                    if roll is not None:
                        roll.close()
                        if roll.done:
                            yield _rows(roll.done, FILE_ARROW)
                    roll, current = _Roll(folder, row["shard"], limit), object()
                if current != row["id"]:
                    current, notes, met = row["id"], {}, set()
                if row["payload"] is None:
                    notes[row["digest"]] = row["first"]
                    continue
                payload = row["payload"].encode()
                digest = hashlib.sha256(payload).digest()
                # Repeated ids are neighbours: all but the first with a payload revisit it.
                revisit = len(payload) >= least_revisit and (digest in notes or digest in met)
                first = notes.get(digest, row["id"])
                met.add(digest)
                roll.add(member(record(row["id"], row["uri"], payload, first, revisit)))
        if roll is not None:
            roll.close()
            if roll.done:
                yield _rows(roll.done, FILE_ARROW)

    return write


def shard_bounds(sized: DataFrame, shard_bytes: int, cells: int = 1024) -> list[int]:
    """Upper ids of all shards but the last, so that each holds about ``shard_bytes``.

    The id range is cut into ``cells`` equal cells and their bytes summed; a cell that is too large for a shard is cut
    again, down to single ids. Only sums of cells reach the driver.
    """
    ends = sized.agg(F.min("id"), F.max("id")).first()
    if ends[0] is None:
        return []
    bounds: list[int] = []
    held = 0

    def walk(low: int, high: int) -> None:
        nonlocal held
        width = max(1, -(-(high - low + 1) // cells))
        inside = sized.where(F.col("id").between(low, high))
        sums = (
            inside.groupBy(F.expr(f"(id - {low}L) div {width}L").alias("cell"))
            .agg(F.sum("bytes").alias("bytes"))
            .orderBy("cell")
            .collect()
        )
        for row in sums:
            start = low + row["cell"] * width
            if row["bytes"] > shard_bytes and width > 1:
                walk(start, min(high, start + width - 1))
                continue
            held += row["bytes"]
            if held >= shard_bytes:
                bounds.append(min(high, start + width - 1))
                held = 0

    walk(ends[0], ends[1])
    return bounds


def write_archive(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    shard_bytes: int = 32 << 20,
    file_bytes: int = 16 << 20,
    least_revisit: int = 0,
) -> DataFrame:
    """Write the archive and give its manifest: one row per file.

    ``shard_bytes`` are payload bytes, ``file_bytes`` compressed bytes; payloads shorter than ``least_revisit`` are always
    written as responses. The folder must be new.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("bigint").alias("id"),
        F.coalesce(F.col(uri).cast("string"), F.lit("")).alias("uri"),
        whole_text(payload).alias("payload"),
    )
    digest = F.unhex(F.sha2("payload", 256))
    sized = staged(
        rows.select("id", digest.alias("digest"), F.octet_length("payload").cast("bigint").alias("bytes")), "sized"
    )
    # The smallest id of each payload that occurs twice; a payload on a third of the pages is one row here.
    firsts = (
        sized.where(F.col("bytes") >= least_revisit)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    bounds = shard_bounds(sized, shard_bytes)
    # Which records revisit an earlier one is told by notes that travel to the shard of the record: the payloads are moved
    # once. ``firsts`` is staged, so that a payload with very many ids can be split in this join.
    notes = sized.join(staged(firsts, "firsts"), "digest").where(~F.col("id").eqNullSafe(F.col("first")))
    notes = notes.select("id", F.lit("").alias("uri"), F.lit(None).cast("string").alias("payload"), "digest", "first").distinct()
    records = rows.withColumns({"digest": F.lit(None).cast("binary"), "first": F.lit(None).cast("bigint")})
    routed = records.unionByName(notes).withColumn("shard", _shard_of(bounds).cast("int"))
    sorted_rows = routed.repartitionByRange(len(bounds) + 1, "shard").sortWithinPartitions("shard", "id", "payload", "uri")
    fs, root = _filesystem(folder)
    fs.create_dir(root)
    written = staged(sorted_rows.mapInArrow(write_shards(folder, file_bytes, least_revisit), FILES), "written")
    moved = written.mapInArrow(rename_files(folder), FILES)
    manifest = f"{folder.rstrip('/')}/manifest"
    moved.select("shard", "part", "name", "records", "bytes").write.parquet(manifest)
    return read_manifest(spark, folder)


def _shard_of(bounds: list[int]):
    """The number of bounds below an id, by halving: an expression of logarithmic depth."""

    def pick(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("id") <= bounds[middle], pick(low, middle)).otherwise(pick(middle + 1, high))

    return F.when(F.col("id").isNull(), F.lit(0)).otherwise(pick(0, len(bounds)))


def rename_files(folder: str):
    """Give the accepted files their names; a file that a repeated task finds renamed already is left."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                temp, name = f"{root}/{row['temp']}", f"{root}/{row['name']}"
                if fs.get_file_info(temp).type != pafs.FileType.NotFound:
                    fs.move(temp, name)
            yield batch

    return rename


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("shard int, part int, name string, records bigint, bytes bigint").parquet(
        f"{folder.rstrip('/')}/manifest"
    )


def _members(stream: io.IOBase, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one by one."""
    left = b""
    while True:
        left = left or stream.read(chunk)
        if not left:
            return
        packer, parts = zlib.decompressobj(31), []
        while not packer.eof:
            if not left:
                left = stream.read(chunk)
                if not left:
                    raise ValueError("the archive ends inside a record")
            parts.append(packer.decompress(left))
            left = packer.unused_data
        yield b"".join(parts)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if f"sha1:{base32_sha1(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} differs")
    return fields, block


def read_files(folder: str, batch_bytes: int = 8 << 20):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        rows, size = [], 0
        for batch in batches:
            for name in batch["name"].to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        fields, block = parse(data)
                        number = lambda k: int(fields[k]) if fields.get(k) else None
                        rows.append(
                            (
                                number("X-Record-Number"),
                                fields["WARC-Target-URI"],
                                fields["WARC-Type"],
                                number("X-Refers-To-Number"),
                                fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                block,
                            )
                        )
                        size += len(block) + 200
                        if size >= batch_bytes:
                            yield _rows(rows, RECORD_ARROW)
                            rows, size = [], 0
        if rows:
            yield _rows(rows, RECORD_ARROW)

    return read


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files in the manifest: id, uri, kind, refers, digest, payload (empty for a revisit)."""
    files = read_manifest(spark, folder).select("name")
    files = files.repartition(max(1, files.count()))
    return files.mapInArrow(read_files(folder), RECORDS)

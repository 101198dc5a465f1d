"""Vectors as codes: one codebook for each part of a vector, trained and applied in whole numbers.

A vector's components become floor(256 x) and its ``parts`` equal parts are coded one by one: each by the nearest entry of
the codebook of its place. One pass over the table lays the vectors out in flat chunks. In a chunk, every part's points are
sorted along a Hilbert curve and cut into blocks of near points; a block keeps the box around its points (least and largest
component) and their sum. Every round then works on blocks: an entry whose least distance to the box exceeds the smallest of
all entries' largest distances is nearest to none of its points, which leaves a shortlist. A block with one entry on its
shortlist adds its stored sum and is done without its points; the others compare their points with the shortlist, all blocks
with shortlists of about one length in one exact kernel. Pruning is strict, so ties stay and go to the lower index.

Points are sorted within a chunk and not over the whole table: boxes need near points, not the nearest of all, and so nothing
is shuffled. A round sends ``parts`` x ``entries`` sums a task; the codebooks, equally bounded, travel back to the tasks.

Defined cases: rows whose vector is null or holds a null or a component that is not finite are left out; vectors shorter than
the longest one, or whose length is no multiple of ``parts``, are coded as if zeros followed; with fewer rows than entries the
codebooks are shorter; null keys are coded and come last when the first codebooks are taken; rows of equal keys are all
returned, and their order in the first codebooks is that of their components; an empty table gives no rows; null labels form
one group; further columns are not read. A component of 2^18 or more in size is an error, as its distances may not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.session import staged

SCALE = 256
MOST = 1 << 18
# Whole numbers in a chunk, which bounds a task's memory for vectors of any length.
CHUNK_NUMBERS = 1 << 20
BLOCK = 32

# Codebooks: one table of whole numbers (parts, entries, components of a part).
Codebooks = np.ndarray


def whole_numbers(rows: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        values = np.asarray(row, dtype=np.float64)
        if values.size and np.abs(values).max() >= MOST:
            raise ValueError(f"A component is not below {MOST} in size")
        out[i, : values.size] = np.floor(values * SCALE)
    return out


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each point (rows of whole numbers) on a Hilbert curve over a grid of all or the first 62 components."""
    x = points[:, :62] - points[:, :62].min(axis=0)
    axes = x.shape[1]
    bits = max(1, min(10, 62 // max(axes, 1)))
    x = (x >> max(0, int(x.max(initial=0)).bit_length() - bits)).astype(np.uint64)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        high = one << np.uint64(level)
        below = high - one
        for a in range(axes):
            turned = (x[:, a] & high) != 0
            swapped = np.where(turned, np.uint64(0), (x[:, 0] ^ x[:, a]) & below)
            x[:, 0] ^= np.where(turned, below, swapped)
            x[:, a] ^= swapped
    for a in range(1, axes):
        x[:, a] ^= x[:, a - 1]
    flips = np.zeros(len(x), dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        high = one << np.uint64(level)
        flips ^= np.where((x[:, -1] & high) != 0, high - one, np.uint64(0))
    x ^= flips[:, None]
    keys = np.zeros(len(x), dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for a in range(axes):
            keys = (keys << one) | ((x[:, a] >> np.uint64(level)) & one)
    return keys


class Chunk:
    """The points of a chunk by part, each part in its own order, with the boxes and sums of its blocks."""

    FIELDS = (("points", np.int32), ("order", np.int32), ("low", np.int32), ("high", np.int32), ("sums", np.int64))

    def __init__(self, n: int, parts: int, **arrays: np.ndarray):
        self.n, self.parts = n, parts
        self.points, self.order, self.low, self.high, self.sums = (arrays[name] for name, _ in self.FIELDS)
        self.starts = np.arange(0, n, BLOCK)
        self.sizes = np.minimum(BLOCK, n - self.starts)

    @classmethod
    def of(cls, vectors: np.ndarray, parts: int) -> Chunk:
        n, width = vectors.shape
        starts = np.arange(0, n, BLOCK)
        cut = vectors.reshape(n, parts, width // parts).transpose(1, 0, 2)
        order = np.stack([np.argsort(hilbert_keys(part), kind="stable") for part in cut])
        points = np.take_along_axis(cut, order[:, :, None], axis=1)
        return cls(
            n,
            parts,
            points=points.astype(np.int32),
            order=order.astype(np.int32),
            low=np.minimum.reduceat(points, starts, axis=1).astype(np.int32),
            high=np.maximum.reduceat(points, starts, axis=1).astype(np.int32),
            sums=np.add.reduceat(points, starts, axis=1),
        )

    def packed(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.FIELDS}

    @classmethod
    def unpacked(cls, row: dict, parts: int, width: int) -> Chunk:
        n = row["n"]
        blocks = -(-n // BLOCK)
        shapes = {"points": (parts, n, width // parts), "order": (parts, n)}
        return cls(
            n,
            parts,
            **{
                name: np.frombuffer(row[name], kind).reshape(shapes.get(name, (parts, blocks, width // parts)))
                for name, kind in cls.FIELDS
            },
        )

    def shortlists(self, part: int, entries: np.ndarray) -> np.ndarray:
        """Which entries may be nearest to a point of a block: rows are blocks, columns entries."""
        low, high = (box[part].astype(np.int64)[:, None, :] for box in (self.low, self.high))
        under, over = low - entries[None], entries[None] - high
        nearest = np.maximum(np.maximum(under, over), 0)
        farthest = np.maximum(-under, -over)
        least = (nearest * nearest).sum(axis=2)
        most = (farthest * farthest).sum(axis=2)
        return least <= most.min(axis=1)[:, None]

    def open_blocks(self, part: int, entries: np.ndarray, listed: np.ndarray, at: np.ndarray):
        """Index and squared distance of the nearest entry for the points of the blocks ``at``: (blocks, rows, found, distance).

        Shortlists are worked together by length, rounded up to a power of two by naming the last entry again; rows are
        places in the part's order, and those after the end of a short block are named twice.
        """
        lengths = listed[at].sum(axis=1)
        classes = 1 << np.ceil(np.log2(lengths)).astype(np.int64)
        reach = int(max(np.abs(self.points[part]).max(initial=0), np.abs(entries).max(initial=0)))
        kind = np.int32 if 4 * reach * reach * max(entries.shape[1], 1) < 2**31 else np.int64
        own, table = self.points[part].astype(kind, copy=False), entries.astype(kind)
        for size in np.unique(classes):
            chosen = at[classes == size]
            at_once = max(1, (1 << 20) // (int(size) * BLOCK))
            for piece in (chosen[i : i + at_once] for i in range(0, chosen.size, at_once)):
                candidates = np.argsort(~listed[piece], axis=1, kind="stable")[:, :size]
                last = listed[piece].sum(axis=1) - 1
                candidates = np.take_along_axis(candidates, np.minimum(np.arange(size)[None], last[:, None]), axis=1)
                rows = np.minimum(self.starts[piece][:, None] + np.arange(BLOCK)[None], self.n - 1)
                distance = np.zeros((piece.size, BLOCK, candidates.shape[1]), dtype=kind)
                for axis in range(entries.shape[1]):
                    gap = own[rows, axis][:, :, None] - table[candidates, axis][:, None, :]
                    distance += gap * gap
                found = distance.argmin(axis=2)
                yield piece, rows, np.take_along_axis(candidates, found, axis=1), distance.min(axis=2)

    def totals(self, part: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of the points nearest to each entry."""
        counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        listed = self.shortlists(part, entries)
        alone = listed.sum(axis=1) == 1
        only = listed[alone].argmax(axis=1)
        np.add.at(counts, only, self.sizes[alone])
        np.add.at(sums, only, self.sums[part][alone])
        for piece, rows, found, _ in self.open_blocks(part, entries, listed, np.flatnonzero(~alone)):
            real = np.arange(BLOCK)[None] < self.sizes[piece][:, None]
            found, points = found[real], self.points[part][rows[real]]
            counts += np.bincount(found, minlength=len(entries))
            for axis in range(entries.shape[1]):
                # Sums of a chunk are far below 2^53: exact.
                sums[:, axis] += np.bincount(found, points[:, axis], len(entries)).astype(np.int64)
        return counts, sums

    def assigned(self, part: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance for each row of the chunk, in the rows' own order."""
        found_all, distance_all = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        listed = self.shortlists(part, entries)
        for _, rows, found, distance in self.open_blocks(part, entries, listed, np.arange(len(self.starts))):
            found_all[rows], distance_all[rows] = found, distance
        at = self.order[part]
        codes, errors = np.empty(self.n, np.int64), np.empty(self.n, np.int64)
        codes[at], errors[at] = found_all, distance_all
        return codes, errors


def _lay_out(parts: int, width: int, id_type: pa.DataType, label_type: pa.DataType):
    per_chunk = max(BLOCK, CHUNK_NUMBERS // max(width, 1))

    def laid(ids, labels, vectors):
        chunk = Chunk.of(np.concatenate(vectors), parts)
        columns = [
            pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(id_type)),
            pa.array([pa.concat_arrays(labels).to_pylist()], pa.list_(label_type)),
            pa.array([chunk.n], pa.int32()),
        ]
        packed = chunk.packed()
        return pa.RecordBatch.from_arrays(
            columns + [pa.array([packed[name]], pa.binary()) for name, _ in Chunk.FIELDS],
            ["ids", "labels", "n", *[name for name, _ in Chunk.FIELDS]],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, n = [], [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, per_chunk - n)
                ids.append(piece["k"])
                labels.append(piece["label"])
                vectors.append(whole_numbers(piece["vector"].to_pylist(), width))
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == per_chunk:
                    yield laid(ids, labels, vectors)
                    ids, labels, vectors, n = [], [], [], 0
        if n:
            yield laid(ids, labels, vectors)

    return run


def _chunks(batches: Iterator[pa.RecordBatch], parts: int, width: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch[name][i].as_py() for name in ("n", *[f for f, _ in Chunk.FIELDS])}
            yield batch, i, Chunk.unpacked(row, parts, width)


def _round(books: Codebooks, width: int):
    parts, size, _ = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, size), np.int64), np.zeros(books.shape, np.int64)
        for _, _, chunk in _chunks(batches, parts, width):
            for part in range(parts):
                more, total = chunk.totals(part, books[part])
                counts[part] += more
                sums[part] += total
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["part", "entry", "n", *[f"s{i}" for i in range(books.shape[2])]]
        )

    return run


def _assign(books: Codebooks, width: int):
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, chunk in _chunks(batches, parts, width):
            codes, errors = np.empty((chunk.n, parts), np.uint8), np.zeros(chunk.n, np.int64)
            for part in range(parts):
                codes[:, part], distance = chunk.assigned(part, books[part])
                errors += distance
            yield pa.RecordBatch.from_arrays(
                [
                    batch["ids"][i].values,
                    batch["labels"][i].values,
                    pa.array([row.tobytes() for row in codes], pa.binary()),
                    pa.array(errors, pa.int64()),
                ],
                ["k", "label", "code", "error"],
            )

    return run


def improved(books: Codebooks, totals: list) -> Codebooks:
    """Entries as the floored means of the points that were nearest to them; others stay."""
    books = books.copy()
    for row in totals:
        books[row["part"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(books.shape[2])]
    return books


def codebook_digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_vectors(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, Codebooks]:
    """The key, ``label``, ``code`` (one byte a part) and ``error`` of every kept row, and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("A code has one byte a part: 1 to 256 entries")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = table.select(
        F.col(key).alias("k"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    ).where(F.col("vector").isNotNull() & ~odd)
    longest = rows.agg(F.max(F.size("vector"))).head()[0] or 0
    width = max(parts, -(-longest // parts) * parts)
    first = rows.orderBy(F.asc_nulls_last("k"), "vector").limit(entries).collect()
    books = whole_numbers([r["vector"] for r in first], width).reshape(len(first), parts, width // parts)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    id_type, label_type = (rows.schema[c].dataType for c in ("k", "label"))
    codes = f"k {id_type.simpleString()}, label {label_type.simpleString()}, code binary, error bigint"
    if not first:
        return table.sparkSession.createDataFrame([], codes).withColumnRenamed("k", key), books
    arrow = rows.limit(0).toArrow().schema
    chunks = staged(
        rows.mapInArrow(
            _lay_out(parts, width, arrow.field("k").type, arrow.field("label").type),
            f"ids array<{id_type.simpleString()}>, labels array<{label_type.simpleString()}>, n int, "
            + ", ".join(f"{name} binary" for name, _ in Chunk.FIELDS),
        ),
        "chunks",
    )
    places = [f"s{i}" for i in range(width // parts)]
    for _ in range(rounds):
        sums = chunks.drop("ids", "labels").mapInArrow(
            _round(books, width), "part bigint, entry bigint, n bigint, " + ", ".join(f"{s} bigint" for s in places)
        )
        totals = sums.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *places)]).collect()
        books = improved(books, totals)
    return chunks.mapInArrow(_assign(books, width), codes).withColumnRenamed("k", key), books


def decode_vectors(coded: DataFrame, books: Codebooks, code: str = "code", vector: str = "vector") -> DataFrame:
    """``coded`` with the entries that its codes name, joined and scaled back, as ``vector``."""
    shared = coded.sparkSession.sparkContext.broadcast(books / SCALE)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema if f.name != vector]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        parts, _, step = table.shape
        for batch in batches:
            names = [n for n in batch.schema.names if n != vector]
            codes = np.frombuffer(b"".join(batch[code].to_pylist()), np.uint8).reshape(batch.num_rows, parts)
            values = table[np.arange(parts)[None], codes].reshape(-1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * (parts * step)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], column], [*names, vector])

    return coded.mapInArrow(run, ", ".join([*schema, f"`{vector}` array<double>"]))


def group_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows of its label added up; null labels form one group."""
    coded = staged(coded, "coded")
    sums = staged(
        coded.groupBy(F.col(label).alias("of_label")).agg(F.sum("error").cast("bigint").alias("label_error")), "label-errors"
    )
    return coded.join(sums, F.col(label).eqNullSafe(F.col("of_label"))).drop("of_label")

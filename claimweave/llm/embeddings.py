"""Near-duplicate embeddings by tiled comparison in the order of principal components.

Vectors are scaled to length one and turned so that the leading dimensions hold most of their products. Tiles of vectors are
compared with each other: the products of the leading dimensions come first, the rest is bounded by the product of the suffix
norms, and a pair is given up as soon as its cosine cannot reach the threshold. Linked vectors lie within sqrt(2 - 2t) of each
other in every coordinate, so tiles are cut by the two leading coordinates and only compared with tiles of the same or a
neighbouring cell.

Work is one group per pair of tiles of at most about ``tile`` vectors each, so it spreads over as many tasks as there are pairs;
how many there are grows with the square of the vectors of neighbouring cells, which an exact comparison of every vector with
every one near it cannot avoid. Equal vectors are one entry with a count. A pair of tiles gives a number of links per vector
and a forest that spans them, never the pairs themselves.

Defined cases: a vector that is null, empty or zero, or holds a null or a number that is not finite, links with nothing; only
vectors of the same length are compared; null ids sort before others; repeated rows are vectors of their own and all returned;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.components import components
from claimweave.session import staged

LEADING = 16
SLICE = 512
# Cosines this close to the threshold are computed once more from the vectors as given.
CLOSE = 1e-9


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    lengths = batch["length"].to_numpy()
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, places in _by_length(batch):
            x = unit_rows(_matrix(batch["vector"].take(pa.array(places))))
            sums[length] = sums.get(length, 0) + x.T @ x
    for length, m in sums.items():
        for start in range(0, m.size, 1 << 20):
            part = m.reshape(-1)[start : start + (1 << 20)]
            at = np.arange(start, start + len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), length)), pa.array(at), pa.array(part)], ["length", "at", "value"]
            )


def rotations(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per length the principal axes of all its unit vectors, the strongest first. Sums of squares reach the driver."""
    sums = (
        classes.mapInArrow(_moments, "length bigint, at bigint, value double")
        .groupBy("length", "at")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )
    lengths, at, values = (sums[c].to_numpy() for c in ("length", "at", "value"))
    out = {}
    for length in np.unique(lengths):
        mine = lengths == length
        m = np.zeros(int(length) ** 2)
        m[at[mine]] = values[mine]
        m = m.reshape(int(length), int(length))
        _, axes = np.linalg.eigh((m + m.T) / 2)
        out[int(length)] = np.ascontiguousarray(axes[:, ::-1])
    return out


def _cells(turned, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, 2), np.int64)
            for length, places in _by_length(batch):
                x = unit_rows(_matrix(batch["vector"].take(pa.array(places)))) @ turned.value[length][:, :2]
                cells[places, : x.shape[1]] = np.floor(x / reach)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["length"], pa.array(cells[:, 0]), pa.array(cells[:, 1])], ["id", "length", "c0", "c1"]
            )

    return run


def near_pairs(a: np.ndarray, b: np.ndarray, threshold: float, step: int = LEADING) -> Iterator[tuple]:
    """(rows of a, rows of b, cosines) of the pairs that reach the threshold less ``CLOSE``; a and b are turned unit rows."""
    width = a.shape[1]

    def suffix(x: np.ndarray) -> np.ndarray:
        squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.concatenate((squares, np.zeros((len(x), 1))), axis=1))

    rest_a, rest_b = suffix(a), suffix(b)
    least = threshold - CLOSE
    for start in range(0, len(a), SLICE):
        rows = slice(start, min(start + SLICE, len(a)))
        upto = min(step, width)
        products = a[rows, :upto] @ b[:, :upto].T
        while True:
            alive = products + rest_a[rows, upto, None] * rest_b[None, :, upto] >= least
            if upto == width or np.count_nonzero(alive) < alive.size // 8:
                break
            products += a[rows, upto : upto + step] @ b[:, upto : upto + step].T
            upto = min(upto + step, width)
        i, j = np.nonzero(alive)
        values, i = products[i, j], i + start
        # Few pairs are left: go on with them alone.
        while upto < width and len(i):
            part = slice(upto, min(upto + step, width))
            values = values + (a[i, part] * b[j, part]).sum(axis=1)
            upto = part.stop
            keep = values + rest_a[i, upto] * rest_b[j, upto] >= least
            i, j, values = i[keep], j[keep], values[keep]
        yield i, j, values


def _joined(labels: np.ndarray, row: int, others: np.ndarray) -> None:
    places = np.append(others, row)
    roots = labels[places]
    while True:
        above = labels[roots]
        if np.array_equal(above, roots):
            break
        roots = above
    lowest = roots.min()
    labels[roots] = lowest
    labels[places] = lowest


def _compare(turned, threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        alone = not right.num_rows
        left, right = left.combine_chunks(), (left if alone else right).combine_chunks()
        if not left.num_rows:
            return schema.empty_table()
        xs = [_matrix(t["vector"].combine_chunks()) for t in (left, right)]
        axes = turned.value[xs[0].shape[1]]
        a, b = (unit_rows(x) @ axes for x in xs)
        ids = [t["id"].to_numpy() for t in (left, right)]
        copies = [t["copies"].to_numpy() for t in (left, right)]
        offset = 0 if alone else len(a)
        labels = np.arange(offset + len(b))
        links = np.zeros(len(labels), np.int64)
        for i, j, values in near_pairs(a, b, threshold):
            if alone:
                keep = i < j
                i, j, values = i[keep], j[keep], values[keep]
            close = np.abs(values - threshold) <= CLOSE
            if close.any():
                x, y = xs[0][i[close]], xs[1][j[close]]
                exact = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
                keep = ~close
                keep[close] = exact >= threshold
                i, j = i[keep], j[keep]
            np.add.at(links, i, copies[1][j])
            np.add.at(links, j + offset, copies[0][i])
            if len(i):
                bounds = np.flatnonzero(np.diff(i)) + 1
                for row, others in zip(i[np.concatenate(([0], bounds))], np.split(j, bounds)):
                    _joined(labels, int(row), others + offset)
        while not np.array_equal(labels[labels], labels):
            labels = labels[labels]
        everyone = ids[1] if alone else np.concatenate(ids)
        linked, hung = np.flatnonzero(links), np.flatnonzero(labels != np.arange(len(labels)))
        none = pa.nulls(len(linked), pa.int64())
        counts = pa.table([pa.array(everyone[linked]), none, pa.array(links[linked])], schema=schema)
        edges = pa.table(
            [pa.array(everyone[hung]), pa.array(everyone[labels[hung]]), pa.nulls(len(hung), pa.int64())], schema=schema
        )
        return pa.concat_tables([counts, edges])

    return run


def _usable(vector: str) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def link_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, tile: int = 8_192
) -> DataFrame:
    """Per row: the key, ``n_links`` (other vectors with a cosine of ``threshold`` or more) and ``component``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("k"), F.col(vector).alias("vector"))
    classes = staged(
        rows.where(_usable("vector"))
        .groupBy("vector")
        .agg(F.min("k").alias("lowest"), F.count("*").alias("copies"))
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("length", F.size("vector").cast("bigint")),
        "classes",
    )
    turned = spark.sparkContext.broadcast(rotations(classes))
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    cells = staged(
        classes.mapInArrow(_cells(turned, reach), "id bigint, length bigint, c0 bigint, c1 bigint"), "cells"
    )
    parts = cells.groupBy("length", "c0", "c1").agg(F.ceil(F.count("*") / tile).alias("parts"))
    tiles = staged(
        parts.select("length", "c0", "c1", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .withColumn("tile", F.monotonically_increasing_id()),
        "tiles",
    )
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    placed = cells.join(tiles, ["length", "c0", "c1"]).where(part == F.col("part")).select("id", "tile")
    placed = staged(classes.join(placed, "id").select("id", "vector", "copies", "tile"), "placed")
    # Neighbouring cells by equality: every tile names the nine cells around it.
    shifts = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (-1, 0, 1) for y in (-1, 0, 1)])
    around = tiles.select("length", F.col("tile").alias("of"), "c0", "c1", F.inline(shifts)).select(
        "length", "of", (F.col("c0") + F.col("x")).alias("c0"), (F.col("c1") + F.col("y")).alias("c1")
    )
    units = staged(
        around.join(tiles, ["length", "c0", "c1"]).where("of <= tile").select("of", F.col("tile").alias("with"))
        .withColumn("unit", F.monotonically_increasing_id()),
        "units",
    )
    fields = ("unit", "id", "vector", "copies")
    left = placed.join(units, F.col("tile") == F.col("of")).select(*fields)
    right = placed.join(units.where("of <> `with`"), F.col("tile") == F.col("with"))
    right = right.select(*[F.col(x).alias(x) for x in fields])
    found = staged(
        left.groupBy("unit").cogroup(right.groupBy("unit")).applyInArrow(_compare(turned, threshold), "a bigint, b bigint, n bigint"),
        "found",
    )
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    labels = components(found.where("b IS NOT NULL").select("a", "b"), "a", "b")
    inside = staged(
        classes.join(labels, F.col("id") == F.col("node")).select("id", "lowest", "component"), "inside"
    )
    lowest = inside.groupBy("component").agg(F.min("lowest").alias("reached"))
    reached = inside.join(lowest, "component").select("id", "reached")
    known = staged(
        classes.join(counts, "id", "left")
        .join(reached, "id", "left")
        .select(
            F.col("vector").alias("of"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("reached", "lowest").alias("component"),
        ),
        "known",
    )
    return rows.join(known, F.col("vector") == F.col("of"), "left").select(
        F.col("k").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("of").isNull(), F.col("k")).otherwise(F.col("component")).alias("component"),
    )

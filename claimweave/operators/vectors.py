"""Embeddings, nearest centroids and per-document clustering."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.functions import vocab

# Numbers of a block of centroids (32 MB), and vectors that meet a block in one task.
BLOCK_NUMBERS = 4_000_000
ROWS_PER_GROUP = 65_536

# Letters, digits, underscore and every byte of a non-ASCII character belong to words.
IN_WORD = np.array([chr(b).isalnum() or b == 95 or b >= 128 for b in range(256)], dtype=np.int8)
HASH_BASE = 0x9E3779B97F4A7C15
SLICE = 512
# Vectors that are multiplied with a block at once.
PRODUCT_ROWS = 256


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0, 1, norms)


def hashed_words(texts: list[str], size: int = vocab.EMBEDDING_SIZE) -> np.ndarray:
    """Word counts hashed into ``size`` slots, scaled to length 1: equal texts, equal vectors.

    All texts of a slice are hashed together as one byte array, without a loop over words.
    """
    parts = [_slice_counts(texts[i : i + SLICE], size) for i in range(0, len(texts), SLICE)]
    return unit_rows(np.concatenate(parts)) if parts else np.zeros((0, size), np.float32)


def _slice_counts(texts: list[str], size: int) -> np.ndarray:
    encoded = [(t or "").lower().encode() for t in texts]
    data = np.frombuffer(b" ".join([*encoded, b""]), dtype=np.uint8)
    inside = IN_WORD[data]
    edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0), append=np.int8(0)))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    counts = np.zeros((len(texts), size), dtype=np.float32)
    if len(starts):
        # Position inside the word decides each byte's factor; arithmetic wraps at 64 bits.
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        factors = np.full(lengths.max(), HASH_BASE, dtype=np.uint64).cumprod()
        values = data[inside == 1].astype(np.uint64) * factors[place]
        hashes = np.add.reduceat(values, np.cumsum(lengths) - lengths)
        slots = ((hashes >> np.uint64(17)) % np.uint64(size)).astype(np.intp)
        ends = np.cumsum([len(e) + 1 for e in encoded])
        owner = np.searchsorted(ends, starts, side="right")
        counts += np.bincount(owner * size + slots, minlength=counts.size).reshape(counts.shape)
    return counts


def embed(
    df: DataFrame,
    text_col: str,
    embedder: Callable[[list[str]], np.ndarray] = hashed_words,
    name: str = "embedding",
) -> DataFrame:
    """Add a vector per text. ``embedder`` maps a list of texts to one vector each."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vectors(texts: pd.Series) -> pd.Series:
        found = embedder([t if t is not None else "" for t in texts])
        return pd.Series([np.asarray(v, dtype=np.float32) for v in found], index=texts.index)

    return df.withColumn(name, vectors(text_col))


# --- nearest centroid -----------------------------------------------------------------------


def mean_centroids(vectors: DataFrame, group_col: str, vector_col: str, size: int) -> DataFrame:
    """Mean vector per group as ``size`` plain averages: nothing is exploded, and map tasks
    pre-aggregate every dimension."""
    means = [F.avg(F.get(vector_col, F.lit(i))) for i in range(size)]
    return vectors.groupBy(F.col(group_col).alias("centroid_id")).agg(F.array(*means).alias("centroid"))


def nearest_centroid(
    vectors: DataFrame,
    centroids: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_numbers: int = BLOCK_NUMBERS,
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """(id, centroid_id, similarity): largest cosine, ties to the lowest centroid id.

    ``centroids`` is (centroid_id, centroid). They form as many blocks of ``block_numbers`` numbers as they need; each vector
    meets each block once, and the best hit per vector survives. A block is one row, so what is shuffled is vectors x
    blocks, never vectors x centroids. A vector that is NULL, of another width than the centroids or with a NULL inside has
    no nearest centroid; neither has any vector when there are no centroids.
    """
    count, width = centroids.agg(F.count("*"), F.max(F.size("centroid"))).first()
    slim = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    usable = F.coalesce((F.size("vector") == (width or 0)) & F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
    nothing = slim.where(F.lit(True) if not count else ~usable).select(
        F.col("id").alias(id_col), F.lit(None).cast("bigint").alias("centroid_id"), F.lit(None).cast("double").alias("similarity")
    )
    if not count:
        return nothing
    n_blocks = -(-count * width // block_numbers)
    salts = max(1, -(-slim.count() // rows_per_group))
    member = F.struct(F.col("centroid_id").cast("bigint").alias("centroid_id"), "centroid")
    packed = (
        centroids.groupBy(F.pmod(F.xxhash64("centroid_id"), F.lit(n_blocks)).cast("int").alias("block"))
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .select("block", "members", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    )
    asked = slim.where(usable).select(
        "*",
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
    )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return left[["id"]].iloc[:0].assign(centroid_id=0, similarity=0.0)
        members = right["members"].iloc[0]
        ids = np.array([r["centroid_id"] for r in members])
        matrix = unit_rows(np.stack([r["centroid"] for r in members]).astype(np.float64)).T
        found, values = np.empty(len(left), np.int64), np.empty(len(left))
        for start in range(0, len(left), PRODUCT_ROWS):
            part = slice(start, start + PRODUCT_ROWS)
            similarity = unit_rows(np.stack(left["vector"].iloc[part]).astype(np.float64)) @ matrix
            best = similarity.argmax(axis=1)
            found[part], values[part] = ids[best], similarity[np.arange(len(best)), best]
        return pd.DataFrame({"id": left["id"], "centroid_id": found, "similarity": values})

    schema = T.StructType(
        [
            slim.schema["id"],
            T.StructField("centroid_id", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    hits = asked.groupBy("block", "salt").cogroup(packed.groupBy("block", "salt")).applyInPandas(run, schema)
    best = F.max(F.struct("similarity", (-F.col("centroid_id")).alias("low")))
    nearest = hits.groupBy("id").agg(best.alias("best")).select(
        F.col("id").alias(id_col), (-F.col("best.low")).alias("centroid_id"), F.col("best.similarity").alias("similarity")
    )
    return nearest.unionByName(nothing)


# --- clustering inside one document ---------------------------------------------------------


def average_linkage(vectors: np.ndarray, threshold: float = vocab.CLUSTER_THRESHOLD) -> list[int]:
    """Merge clusters while their mean cosine distance is below ``threshold``.

    The mean distance of two clusters is 1 - the product of their mean unit vectors, so a cluster
    is one vector and a size, and memory grows with the claims, not with their pairs. Equal
    vectors start as one cluster. Mutual nearest neighbours are merged along a chain; a cluster
    without a neighbour inside the threshold is final, because later merges never bring others
    closer to it. Labels count up in the order of each cluster's first member.
    """
    if len(vectors) <= 1:
        return [0] * len(vectors)
    vectors = np.ascontiguousarray(vectors)
    first: dict[bytes, int] = {}
    member = np.array([first.setdefault(v.tobytes(), len(first)) for v in vectors])
    if len(first) == 1:
        return [0] * len(vectors)
    means = unit_rows(vectors[np.unique(member, return_index=True)[1]].astype(np.float64))
    owner = merge_nearest(means, np.bincount(member).astype(np.float64), threshold)
    labels: dict[int, int] = {}
    return [labels.setdefault(int(owner[m]), len(labels)) for m in member]


def merge_nearest(means: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """For each cluster, given by the mean of its unit vectors and its size, the lowest cluster that it ends up with."""
    means, sizes = means.copy(), sizes.copy()
    owner = np.arange(len(means))
    is_open = np.ones(len(means), dtype=bool)
    chain: list[int] = []
    while is_open.any():
        if not chain:
            chain = [int(is_open.argmax())]
        top = chain[-1]
        distance = np.where(is_open, 1 - means @ means[top], np.inf)
        distance[top] = np.inf
        nearest = int(distance.argmin())
        if len(chain) > 1 and distance[chain[-2]] <= distance[nearest]:
            nearest = chain[-2]
        if not distance[nearest] < threshold:
            is_open[top] = False
            chain.pop()
        elif len(chain) > 1 and nearest == chain[-2]:
            keep, gone = min(top, nearest), max(top, nearest)
            both = sizes[keep] + sizes[gone]
            means[keep] = (sizes[keep] * means[keep] + sizes[gone] * means[gone]) / both
            sizes[keep] = both
            is_open[gone] = False
            owner[owner == gone] = keep
            del chain[-2:]
        else:
            chain.append(nearest)
    return owner


def cluster_labels(vectors: str | Column, threshold: float = vocab.CLUSTER_THRESHOLD) -> Column:
    """Cluster label of each vector in an array of vectors.

    The vectors of one document sit in one row, so no rows are gathered and no group can grow
    beyond a single document.
    """

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def labels(lists: pd.Series) -> pd.Series:
        found = [average_linkage(np.array([np.asarray(v) for v in one]), threshold) for one in lists]
        return pd.Series(found, index=lists.index)

    return labels(vectors)

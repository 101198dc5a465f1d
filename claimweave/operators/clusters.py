"""Average-linkage clusters of claims, for documents of any size.

Average linkage is reducible: a merged cluster is never nearer to a third one than the nearer of its two parts was. So all pairs
that are nearest to each other can merge in one round with the same result as merging them one by one, and a cluster without a
neighbour inside the threshold is final. Large documents go through such rounds of joins: their clusters are cut into tiles, each
pair of tiles is compared once, in a task of its own. What is left of a document when few clusters are open is finished in one
task, as are small documents from the start.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions import vocab
from claimweave.operators.keyed import sequential_ids
from claimweave.operators.vectors import merge_nearest, unit_rows
from claimweave.session import staged

# Clusters of a tile, and open clusters of a document that one task finishes.
TILE = 1024
LOCAL = 2048
# Rows that a Python function sees at once: many small documents together, as a call takes longer than most of them.
PACK_ROWS = 8192

CLUSTER = "doc bigint, cid bigint, size bigint, mean array<double>"


def _start(claims: DataFrame) -> DataFrame:
    """One cluster per distinct vector of a document, numbered by its first claim; vectors have length 1."""
    first = claims.groupBy("doc", "vector").agg(F.min("claim").alias("cid"), F.count("*").alias("size"))

    def unit(frames):
        for frame in frames:
            vectors = [np.asarray(v, dtype=np.float64) for v in frame["vector"]]
            if len({len(v) for v in vectors}) == 1:
                rows = list(unit_rows(np.stack(vectors)))
            else:
                rows = [unit_rows(v[None])[0] for v in vectors]
            yield frame.assign(mean=rows)[["doc", "cid", "size", "mean", "vector"]]

    return first.mapInPandas(unit, f"{CLUSTER}, vector array<float>")


def _by_document(frame: pd.DataFrame):
    """(document, its rows' positions) of a frame that is sorted by document."""
    docs = frame["doc"].to_numpy()
    starts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    for start, end in zip(starts, [*starts[1:], len(docs)]):
        yield docs[start], slice(start, end)


def _nearest_in_tiles(frame: pd.DataFrame) -> pd.DataFrame:
    """Nearest cluster of each cluster of two tiles in the other one, or of one tile within itself, document by document.

    Every pair of clusters is computed once, so both see the same distance. Of equally near ones the pair with the lower
    numbers counts.
    """
    first, last = frame["lower"].iloc[0], frame["upper"].iloc[0]
    one = first == last
    frame = frame.sort_values(["doc", "cid"])
    cids, tiles, means = frame["cid"].to_numpy(), frame["tile"].to_numpy(), frame["mean"].to_numpy()
    out = []
    for doc, rows in _by_document(frame):
        is_lower, is_upper = tiles[rows] == first, tiles[rows] == last
        a, b = cids[rows][is_lower], cids[rows][is_upper]
        if not len(a) or not len(b) or (one and len(a) == 1):
            continue
        distance = 1 - np.stack(means[rows][is_lower]) @ np.stack(means[rows][is_upper]).T
        if one:
            distance = np.minimum(distance, distance.T)
            np.fill_diagonal(distance, np.inf)
        for mine, others, d in ((a, b, distance), (b, a, distance.T))[: 1 if one else 2]:
            # Others are sorted: the first of equal ones is the lower pair.
            at = d.argmin(axis=1)
            out.append((np.full(len(mine), doc), mine, others[at], d[np.arange(len(mine)), at]))
    if not out:
        return frame.iloc[:0][["doc", "cid"]].assign(other=0, distance=0.0)
    return pd.DataFrame(dict(zip(("doc", "cid", "other", "distance"), map(np.concatenate, zip(*out)))))


def _pack(rows: int):
    """Number of the pack that a document goes to, for tasks that see packs of many small documents at once.

    A pack holds about ``PACK_ROWS`` rows. A larger document fills one of its own, but for chance company.
    """
    return F.pmod(F.xxhash64("doc"), F.lit(max(1, -(-rows // PACK_ROWS))))


def nearest_clusters(clusters: DataFrame, tile: int = TILE) -> DataFrame:
    """(doc, cid, other, distance): the nearest other cluster of the same document; none for a cluster that is alone."""
    counts = clusters.groupBy("doc").agg(F.count("*").alias("n"))
    sizes = staged(counts.select("doc", "n", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "tiles")
    rows = sizes.agg(F.sum(F.col("n") * F.col("tiles"))).first()[0] or 0
    placed = clusters.join(sizes, "doc").withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int"))
    with_all = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = with_all.select(
        "doc", "cid", "mean", "tile", F.least("tile", "with").alias("lower"), F.greatest("tile", "with").alias("upper")
    )
    found = pairs.groupBy(_pack(rows).alias("pack"), "lower", "upper").applyInPandas(
        _nearest_in_tiles, "doc bigint, cid bigint, other bigint, distance double"
    )
    order = F.struct("distance", F.least("cid", "other").alias("low"), F.greatest("cid", "other").alias("high"), "other")
    best = found.groupBy("doc", "cid").agg(F.min(order).alias("best"))
    return best.select("doc", "cid", F.col("best.other").alias("other"), F.col("best.distance").alias("distance"))


def merge_round(clusters: DataFrame, threshold: float, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(clusters that are still open, (doc, gone, keep) of the merges) after all mutual nearest pairs have merged."""
    near = nearest_clusters(clusters, tile).where(F.col("distance") < threshold)
    near = staged(clusters.join(near, ["doc", "cid"]).drop("distance"), "nearest")
    back = near.select("doc", F.col("cid").alias("other"), F.col("other").alias("cid"), F.col("size").alias("_n"), F.col("mean").alias("_m"))
    mutual = near.join(back, ["doc", "cid", "other"]).where("cid < other")
    both = F.col("size") + F.col("_n")
    mean = F.zip_with("mean", "_m", lambda x, y: (x * F.col("size") + y * F.col("_n")) / both)
    # Under another name first: inside the function, "size" would mean the new column.
    merged = mutual.select("doc", "cid", both.alias("total"), mean.alias("mean"), "other")
    merged = staged(merged.withColumnRenamed("total", "size"), "merged-clusters")
    merges = merged.select("doc", F.col("other").alias("gone"), F.col("cid").alias("keep"))
    ends = merges.select("doc", F.explode(F.array("gone", "keep")).alias("cid"))
    rest = near.join(ends, ["doc", "cid"], "left_anti").select("doc", "cid", "size", "mean")
    return rest.unionByName(merged.drop("other")), merges


def _finished(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc", "cid"])
        ids, means, sizes = frame["cid"].to_numpy(), frame["mean"].to_numpy(), frame["size"].to_numpy(dtype=np.float64)
        keep = [ids[rows][merge_nearest(np.stack(means[rows]), sizes[rows], threshold)] for _, rows in _by_document(frame)]
        return pd.DataFrame({"doc": frame["doc"].to_numpy(), "gone": ids, "keep": np.concatenate(keep)})

    return run


def _follow(owners: DataFrame, merges: DataFrame, label: str) -> DataFrame:
    moved = owners.join(merges.withColumnRenamed("gone", "cid"), ["doc", "cid"], "left")
    return staged(moved.select("doc", "start", F.coalesce("keep", "cid").alias("cid")), label)


def cluster_claims(
    claims: DataFrame,
    doc_col: str,
    claim_col: str,
    vector_col: str,
    threshold: float = vocab.CLUSTER_THRESHOLD,
    tile: int = TILE,
    local: int = LOCAL,
) -> DataFrame:
    """(document, claim, label): labels count up in the order of each cluster's first claim, from 0 in every document.

    Claim numbers are unique in their document and vectors have no NULL inside; a claim without a vector has no label.
    """
    rows = claims.select(
        F.col(doc_col).cast("bigint").alias("doc"),
        F.col(claim_col).cast("bigint").alias("claim"),
        F.col(vector_col).cast("array<float>").alias("vector"),
    )
    rows = staged(rows, "claim-vectors")
    start = staged(_start(rows.where("vector IS NOT NULL")), "start-clusters")
    owners = start.select("doc", F.col("cid").alias("start"), "cid")
    clusters = start.drop("vector")
    while True:
        sizes = staged(clusters.groupBy("doc").count().where(F.col("count") > local), "large-sizes")
        large = staged(clusters.join(sizes, "doc", "left_semi"), "large-documents")
        if large.isEmpty():
            break
        small = clusters.join(sizes, "doc", "left_anti")
        still_open, merges = merge_round(large, threshold, tile)
        owners = _follow(owners, merges, "owners")
        clusters = staged(small.unionByName(still_open), "open-clusters")
    merges = clusters.groupBy(_pack(clusters.count()).alias("pack")).applyInPandas(_finished(threshold), "doc bigint, gone bigint, keep bigint")
    owners = _follow(owners, merges, "owners")
    # A cluster's number is its first claim. Ranks come from one range partition over all documents.
    ranks = staged(sequential_ids(owners.select("doc", "cid").distinct(), ["doc", "cid"], "rank"), "ranks")
    lowest = ranks.groupBy("doc").agg(F.min("rank").alias("lowest"))
    labels = ranks.join(lowest, "doc").select("doc", "cid", (F.col("rank") - F.col("lowest")).cast("int").alias("label"))
    of_vector = owners.join(labels, ["doc", "cid"]).select("doc", F.col("start").alias("cid"), "label")
    of_vector = staged(start.select("doc", "cid", "vector").join(of_vector, ["doc", "cid"]), "labelled-vectors")
    return rows.join(of_vector, ["doc", "vector"], "left").select(
        F.col("doc").alias(doc_col), F.col("claim").alias(claim_col), "label"
    )

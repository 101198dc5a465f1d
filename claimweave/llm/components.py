"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.session import staged


def _lowest(edges: DataFrame, label: str) -> DataFrame:
    """Per node u its smallest neighbour, staged: a join with it then meets plain shuffles, whose hot nodes can be split."""
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")), label)


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node of the component) for every node that has an edge to another one.

    Large-star and small-star steps alternate until the edges stay as they are: first every node hangs its larger neighbours
    on its smallest one, then every node hangs itself and its other smaller neighbours on the smallest one. Edges never
    grow in number, and every round is written to the shared folder, so no lineage builds up.
    """
    pairs = edges.select(F.least(left, right).alias("v"), F.greatest(left, right).alias("u")).where("u <> v").distinct()
    current, seen = staged(pairs, "edges"), None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_lowest(both, "lowest"), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = staged(large, "large-star")
        low = _lowest(large, "lowest")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = staged(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

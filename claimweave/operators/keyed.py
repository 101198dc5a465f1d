"""Per-key steps that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.session import staged


def latest_versions(
    df: DataFrame,
    latest_run_id: str | Column,
    key: str = "id",
    ties: tuple[str, ...] = (),
    parts: int | None = None,
) -> DataFrame:
    """Newest row of each key; ``is_deleted`` marks keys that the latest run no longer has.

    The rank filter is pushed below the shuffle (WindowGroupLimit): each map task sends at most
    one row per key, so a key with very many versions is no hot spot. For that a map task sorts its whole rows.
    With ``parts``, for wide rows, nothing is sorted before the shuffle into that many parts: outdated rows are left
    out of each Arrow batch instead (``without_outdated``).
    """
    if parts:
        df = without_outdated(df, key, "_exported_at").repartition(parts, key)
    newest = Window.partitionBy(key).orderBy(
        F.col("_exported_at").desc(), F.col("_run_id").desc(), *[F.col(c) for c in ties]
    )
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .where("_rank = 1")
        .drop("_rank")
        .withColumn("is_deleted", F.col("_run_id") != latest_run_id)
    )


def without_outdated(df: DataFrame, key: str, at: str) -> DataFrame:
    """``df`` without the rows that a row of the same key and a later ``at`` outdoes within an Arrow batch; NULL is the earliest.

    A key with very many versions shrinks to a few rows a batch, in the memory of one batch.
    """

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            order = pc.rank(batch.column(at), sort_keys="ascending", null_placement="at_start", tiebreaker="dense")
            times = pd.Series(order.to_numpy(zero_copy_only=False))
            keep = (times == times.groupby(keys).transform("max")).to_numpy(dtype=np.bool_)
            yield batch if keep.all() else batch.filter(pa.array(keep))

    return df.mapInArrow(newest, df.schema)


def attach_to_groups(rows: DataFrame, groups: DataFrame, keys: list[str] | dict[str, Column]) -> DataFrame:
    """Give every row the values of its group, one row per key in ``groups``; NULL keys match each other.

    ``keys`` are columns of both, or columns of ``groups`` with what of a row they equal, which then needs no column there.

    A plain equi-join: Spark broadcasts the groups if they are small, otherwise adaptive execution splits the rows of a
    hot key over several tasks. For that the groups must not come straight out of an aggregation by the same key (stage
    them), because a join that reuses its partitioning is never split.
    """
    values = [c for c in groups.columns if c not in keys]
    side = groups.select(*[F.col(c).alias(f"_g_{c}") for c in groups.columns])
    return rows.join(side, _same_keys(keys, "_g_"), "left").select(
        *rows.columns, *[F.col(f"_g_{v}").alias(v) for v in values]
    )


def _same_keys(keys: list[str] | dict[str, Column], prefix: str) -> Column:
    values = keys if isinstance(keys, dict) else {k: F.col(k) for k in keys}
    return reduce(lambda a, b: a & b, [x.eqNullSafe(F.col(prefix + k)) for k, x in values.items()])


def flag_repeats(df: DataFrame, keys: list[str], id_col: str, name: str = "is_duplicate") -> DataFrame:
    """True for every row that is not the lowest id of its key group.

    The lowest ids are found by a pre-aggregated minimum and matched back on the unique id, so
    neither step ever gathers a large group. Keys are compared by a fingerprint, so none of their texts is kept or shuffled.
    """
    first = df.groupBy(*_narrow_key(df, keys)).agg(F.min(id_col).alias(id_col)).select(id_col, F.lit(False).alias(name))
    return df.join(first, id_col, "left").withColumn(name, F.coalesce(F.col(name), F.lit(True)))


# Equal values of these have equal texts, and others have not.
_AS_TEXT = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType())


def _narrow_key(df: DataFrame, keys: list[str]) -> list[Column]:
    """Columns that agree where ``keys`` do: 16 bytes of a SHA-256 over values and their lengths stand for them, if one is a text."""
    kinds = {k: df.schema[k].dataType for k in keys}
    inside = [k for k in keys if kinds[k] in _AS_TEXT]
    if T.StringType() not in kinds.values():
        return [F.col(k) for k in keys]
    texts = [F.col(k).cast("string") for k in inside]
    marked = [F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    fingerprint = F.substring(F.unhex(F.sha2(F.concat(*marked), 256)), 1, 16)
    return [*[F.col(k) for k in keys if k not in inside], fingerprint.alias("_key")]


def sequential_ids(df: DataFrame, order_by: list[str], name: str = "id", start: int = 1) -> DataFrame:
    """Number rows 1, 2, 3, ... in the order of ``order_by``, without one task seeing all rows.

    ``order_by`` must end in a unique column. Rows are range partitioned and numbered inside
    their range; the ranges' sizes (one number per range) give the offsets.
    """
    ranged = staged(
        df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id()), "sequential-ids"
    )
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order_by))
    return (
        ranged.withColumn("_row", inside)
        .join(F.broadcast(offsets), "_range")
        .select(
            (F.col("_before") + F.col("_row") + F.lit(start - 1)).cast("bigint").alias(name), *df.columns
        )
    )


def items(df: DataFrame, keep: list[str], array: str | Column, index: str, item: str) -> DataFrame:
    """One row per item of an array that is computed here; no row for an empty or missing one.

    The outer generator with a filter behind it: before an inner one Spark filters by the size of the array, which computes
    the array a second and a third time.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(index, item)).where(F.col(index).isNotNull())


def one_row(*frames: DataFrame) -> DataFrame:
    """Put several one-row frames with different columns side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

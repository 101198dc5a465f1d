"""Tables that are brought up to date by key: plain Parquet in hash buckets of the key.

An upsert finds the inserted and changed rows by their hashes, rewrites only the buckets that hold such rows, and leaves all
other files as they are; reads are plain scans. Running it again with the same rows writes nothing. One writer at a time.

The number of buckets follows from the table's bytes when it is made, and is made anew when the table has outgrown it, so the
rewrite behind one changed row stays about as large. Rows are rebalanced by bucket before they are written: adaptive execution
spreads a bucket above its advisory size over several tasks, each with a file of its own, and lets one task write many small
buckets. New buckets are complete in a folder of their own before they replace the old ones.

Where the catalog has a table format with MERGE, use ``merge_into_table`` instead.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.session import STAGED_CODEC, folder_bytes, folder_names, remove_folder, scratch_dir, staged

UPDATED_AT = "_silver_updated_at"
# Folder levels of a table: how many buckets it has, and the bucket.
OF, BUCKET = "_of", "_bucket"
BUCKET_BYTES = 64 << 20
LEAST_BUCKETS, MOST_BUCKETS = 8, 1 << 16
# A larger table is dealt out in passes over a part of its buckets each: its staged rows are read so many times, and the disk
# holds the shuffle files of one pass at a time.
LARGE_BYTES, PASSES = 1 << 30, 4
# Fingerprints are half as long in bytes as in hexadecimal digits: they are shuffled as bytes, and files are written with a
# codec that finds that out.
HASH_SUFFIX, AS_BYTES = "_hash", "_bytes_of_"
# A table is put into more buckets when they are this many times as large as they should be.
OUTGROWN = 4


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, path: str) -> bool:
    return _stored(spark, path) is not None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    found = _stored(spark, path)
    if found is None:
        raise ValueError(f"No table at {path}")
    return found.drop(OF, BUCKET)


def classify_changes(target: DataFrame, source: DataFrame, key: str, hash_col: str = "row_hash") -> DataFrame:
    """(key, change) over both sides: insert, update, unchanged, or kept (not in the source)."""
    old = target.select(key, F.col(hash_col).alias("_old"), F.lit(True).alias("_in_target"))
    new = source.select(key, F.col(hash_col).alias("_new"), F.lit(True).alias("_in_source"))
    change = (
        F.when(F.col("_in_target").isNull(), "insert")
        .when(F.col("_in_source").isNull(), "kept")
        .when(F.col("_old") != F.col("_new"), "update")
        .otherwise("unchanged")
    )
    return new.join(old, key, "full_outer").select(key, change.alias("change"))


def stamp(at: datetime | None) -> Column:
    at = at or datetime.now(timezone.utc)
    return F.lit(at.isoformat()).cast("timestamp")


def buckets_for(size: int) -> int:
    """A power of two, so that more buckets only divide the old ones."""
    wanted = -(-size // BUCKET_BYTES)
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, wanted - 1).bit_length()))


def _in_buckets(df: DataFrame, key: str, of: int) -> DataFrame:
    return df.withColumns({OF: F.lit(of), BUCKET: F.pmod(F.xxhash64(key), F.lit(of)).cast("int")})


def _narrowed(df: DataFrame) -> DataFrame:
    """Fingerprints as bytes, beside those texts that are no lower-case hexadecimal digits; see ``_widened``."""
    for name in [c for c, kind in df.dtypes if c.endswith(HASH_SUFFIX) and kind == "string"]:
        data = F.unhex(name)
        is_hex = F.coalesce(F.lower(F.hex(data)) == F.col(name), F.lit(False))
        df = df.withColumns({f"{AS_BYTES}{name}": F.when(is_hex, data), name: F.when(~is_hex, F.col(name))})
    return df


def _widened(df: DataFrame) -> DataFrame:
    narrow = [c for c in df.columns if c.startswith(AS_BYTES)]
    texts = {c.removeprefix(AS_BYTES): F.coalesce(F.lower(F.hex(c)), c.removeprefix(AS_BYTES)) for c in narrow}
    return df.withColumns(texts).drop(*narrow) if narrow else df


def _dealt(df: DataFrame) -> DataFrame:
    """Narrowed rows in buckets, spread over the tasks that write them."""
    return _widened(df.hint("rebalance", BUCKET))


def _write(df: DataFrame, path: str, replace: str = "static") -> None:
    """``replace``: the whole table (static) or only the buckets that ``df`` has rows of (dynamic)."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", replace).option("compression", STAGED_CODEC)
    writer.partitionBy(OF, BUCKET).parquet(path)


def create(df: DataFrame, path: str, key: str, size: int | None = None) -> int:
    """Make or replace the table; the new content is complete before the old one goes. Gives the number of rows.

    ``size`` are the bytes of ``df`` if it comes straight from staged files, which then are that complete content.
    """
    spark, folder, rows = df.sparkSession, None, df
    if size is None:
        folder = scratch_dir(spark, "created")
        df.write.parquet(folder, compression=STAGED_CODEC)
        rows, size = spark.read.schema(df.schema).parquet(folder), folder_bytes(spark, folder)
    of = buckets_for(size)
    placed, passes = _in_buckets(_narrowed(rows), key, of), PASSES if size > LARGE_BYTES else 1
    for n in range(passes):
        part = placed.where(F.col(BUCKET) % passes == n) if passes > 1 else placed
        _write(_dealt(part), path, "dynamic" if n else "static")
    _write_schema(rows, path, of)
    n = rows.count()
    if folder:
        remove_folder(spark, folder)
    return n


def _write_schema(df: DataFrame, path: str, of: int) -> None:
    """A file without rows in a bucket that no row has.

    Readers take the schema from the first file, which this is, and a table without rows keeps schema and number of buckets.
    """
    df.drop(OF, BUCKET).limit(0).write.mode("overwrite").parquet(f"{path}/{OF}={of}/{BUCKET}=-1")


def _bucket_number(target: DataFrame) -> int:
    files = target.inputFiles()
    return int(files[0].split(f"/{OF}=")[1].split("/")[0])


def stored_rows(spark: SparkSession, path: str, key: str, ids: DataFrame) -> DataFrame:
    """The rows of the given keys; only their buckets are opened."""
    target = _stored(spark, path)
    touched = touched_buckets(target, key, ids)
    return target.where(F.col(BUCKET).isin(touched)).join(ids.select(key), key, "left_semi").drop(OF, BUCKET)


def touched_buckets(target: DataFrame, key: str, ids: DataFrame) -> list[int]:
    """One number a bucket at most."""
    of = _bucket_number(target)
    return sorted(r[0] for r in _in_buckets(ids.select(key), key, of).select(BUCKET).distinct().collect())


def stamped(rows: DataFrame, target: DataFrame, key: str, at: datetime | None, hash_col: str | None) -> DataFrame:
    """``rows`` with their time of update: the stored one where the stored hash is the same."""
    if hash_col is None:
        return rows.withColumn(UPDATED_AT, stamp(at))
    old = target.select(key, F.col(hash_col).alias("_old"), F.col(UPDATED_AT).alias("_stamp"))
    time = F.when(F.col("_old") == F.col(hash_col), F.col("_stamp")).otherwise(stamp(at))
    return rows.join(old, key, "left").withColumn(UPDATED_AT, time).drop("_old", "_stamp")


def stage_buckets(rows: DataFrame, path: str, key: str, folder: str, gone: DataFrame | None = None) -> list[int]:
    """Write the touched buckets of the table at ``path`` anew in ``folder``, and tell which these are.

    ``rows`` replace the stored rows of their keys, or of the keys of ``gone`` if it is given.
    """
    target = _stored(rows.sparkSession, path)
    keys = (rows if gone is None else gone).select(key)
    touched = touched_buckets(target, key, keys)
    if touched:
        kept = _narrowed(target.where(F.col(BUCKET).isin(touched))).join(keys, key, "left_anti")
        # A column that is new in the source is NULL in the rows that stay.
        merged = _in_buckets(_narrowed(rows), key, _bucket_number(target)).unionByName(kept, allowMissingColumns=True)
        _write(_dealt(merged), folder)
    return touched


def publish_buckets(spark: SparkSession, folder: str, path: str, touched: list[int]) -> None:
    """Put staged buckets into the table. Doing it again gives the same table."""
    if not touched:
        return
    target, new = _stored(spark, path), _stored(spark, folder)
    of = _bucket_number(target)
    if new is not None:
        if set(new.columns) != set(target.columns):
            _write_schema(new, path, of)
        _write(new, path, "dynamic")
    filled = set(folder_names(spark, f"{folder}/{OF}={of}"))
    for bucket in touched:
        if f"{BUCKET}={bucket}" not in filled:
            remove_folder(spark, f"{path}/{OF}={of}/{BUCKET}={bucket}")


def fit_buckets(spark: SparkSession, path: str, key: str) -> None:
    """Put a table that has outgrown its buckets into more of them."""
    target = _stored(spark, path)
    size, of = folder_bytes(spark, path), _bucket_number(target)
    if size > OUTGROWN * BUCKET_BYTES * of and of < MOST_BUCKETS:
        create(target.drop(OF, BUCKET), path, key)


def upsert(
    df: DataFrame,
    path: str,
    key: str,
    hash_col: str = "row_hash",
    at: datetime | None = None,
    quiet: tuple[str, ...] = (),
    size: int | None = None,
) -> dict:
    """Add new keys and rows whose hash changed; nothing is ever deleted. Gives the counts of both.

    Of the target only key, hash and ``quiet`` are read to find the changes. A row of which only ``quiet`` columns
    changed is stored, but keeps its time of update and is not counted. ``size`` is for ``create``.
    """
    spark = df.sparkSession
    target = _stored(spark, path)
    if target is None:
        return {"operation": "CREATE", "inserted": create(df.withColumn(UPDATED_AT, stamp(at)), path, key, size), "updated": 0}
    quiet = tuple(q for q in quiet if q in target.columns)
    old = target.select(
        key, F.col(hash_col).alias("_old"), F.col(UPDATED_AT).alias("_stamp"), *[F.col(q).alias(f"_old{q}") for q in quiet]
    )
    # As bytes on the way to the join.
    old = _narrowed(old.withColumnRenamed("_old", f"_old{HASH_SUFFIX}"))
    same = F.col("_old") == F.col(hash_col)
    change = F.when(F.col("_old").isNull(), "insert").when(~same, "update")
    for q in quiet:
        change = change.when(~F.col(q).eqNullSafe(F.col(f"_old{q}")), "quiet")
    changed = staged(
        _widened(df.join(old, key, "left"))
        .withColumnRenamed(f"_old{HASH_SUFFIX}", "_old")
        .withColumn("_change", change)
        .where(F.col("_change").isNotNull())
        .withColumn(UPDATED_AT, F.when(same, F.col("_stamp")).otherwise(stamp(at)))
        .select(*df.columns, UPDATED_AT, "_change"),
        "changed",
    )
    counts = {r["_change"]: r["count"] for r in changed.groupBy("_change").count().collect()}
    if counts:
        folder = scratch_dir(spark, "merged")
        publish_buckets(spark, folder, path, stage_buckets(changed.drop("_change"), path, key, folder))
        remove_folder(spark, folder)
        fit_buckets(spark, path, key)
    return {"operation": "MERGE", "inserted": counts.get("insert", 0), "updated": counts.get("update", 0)}


def overwrite(df: DataFrame, path: str, at: datetime | None = None) -> dict:
    """Replace content and schema. The new content is complete before the old one goes."""
    rows = staged(df.withColumn(UPDATED_AT, stamp(at)), "overwrite")
    rows.write.mode("overwrite").parquet(path)
    return {"operation": "OVERWRITE", "inserted": rows.count(), "updated": 0}


def merge_into_table(df: DataFrame, table: str, key: str, hash_col: str = "row_hash", at: datetime | None = None) -> None:
    """The same upsert for a catalog table whose format supports MERGE."""
    df = df.withColumn(UPDATED_AT, stamp(at)).alias("source")
    same_key = F.col(f"{table}.{key}") == F.col(f"source.{key}")
    changed = F.col(f"{table}.{hash_col}") != F.col(f"source.{hash_col}")
    df.mergeInto(table, same_key).whenMatched(changed).updateAll().whenNotMatched().insertAll().merge()

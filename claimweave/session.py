"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed side is split even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(
    app_name: str = "claimweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Folders to remove at the end of ``scratch_removed``.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session, whose executors share
    this machine's disk, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="claimweave-")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return path


@contextmanager
def _settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """The session has these settings inside and its own again afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the intermediate tables that are made inside, at its end: for jobs whose results lie elsewhere by then.

    Gives the list of their folders; one that is taken off it stays. Shuffle files go with their query, where they would
    stay until the driver happens to collect its garbage.
    """
    paths: list[str] = []
    before = _passing.set(paths)
    try:
        with _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
            yield paths
    finally:
        _passing.reset(before)
        for path in paths:
            remove_folder(spark, path)


# A table of ids takes this many times its files' bytes in the hash table that the driver makes for a broadcast; 160 were measured.
FILES_TO_MEMORY = 128


@contextmanager
def broadcasts_by_memory(spark: SparkSession) -> Iterator[None]:
    """Inside, a table read from files is broadcast only if its rows fit the session's threshold, which otherwise goes by its files' bytes.

    Compressed ids take less than a byte each there, so the driver would build hash tables of a hundred times the threshold. What
    has been shuffled is measured as it is and keeps the whole threshold.
    """
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    threshold = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    values = {planned: threshold // FILES_TO_MEMORY, measured: spark.conf.get(measured, None) or threshold}
    with _settings(spark, values if threshold > 0 else {}):
        yield


# Staged files are read a few times on the way and then left: small ones are worth the codec's time.
STAGED_CODEC = "zstd"


def staged_bytes(table: DataFrame) -> int:
    """Size of the files of a staged table."""
    found = table.inputFiles()
    return folder_bytes(table.sparkSession, unquote(found[0]).rpartition("/")[0]) if found else 0


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a shared Parquet table and read it back.

    Several consumers then read files instead of recomputing the shuffles behind them, and a
    lost executor costs a re-read, not a re-run.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=STAGED_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_alone(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` stages as its last step; the other intermediate tables that it made on the way go at once."""
    with scratch_removed(spark) as paths:
        result = make()
        kept = paths.pop()
    if (passing := _passing.get()) is not None:
        passing.append(kept)
    return result


def remove_staged(table: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    if found := table.inputFiles():
        remove_folder(table.sparkSession, unquote(found[0]).rpartition("/")[0])


# Bytes of input files behind one bucket. Their rows take some 15 times that in a task, which sorts them twice.
BUCKET_INPUT = 4 << 20


def buckets_for(source: DataFrame) -> int:
    """Buckets for rows read from ``source``: as many as shuffle partitions, and more where a bucket would outgrow a task's memory."""
    spark = source.sparkSession
    folders: dict[str, set[str]] = {}
    for path in source.inputFiles():
        parent, _, name = unquote(path).rpartition("/")
        folders.setdefault(parent, set()).add(name)
    size = 0
    for parent, names in folders.items():
        files, folder = _folder(spark, parent)
        size += sum(x.getLen() for x in files.listStatus(folder) if x.getPath().getName() in names)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_INPUT))


def staged_by(df: DataFrame, label: str, key: str, buckets: int | None = None) -> DataFrame:
    """``staged``, dealt out by ``key``: joins with it on that key do not shuffle its rows, only those of the other side.

    Rows that come dealt out by the key, as from a window over it, are not shuffled for this either. The catalog knows the
    table only while it is opened.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, label)
    name = f"claimweave_{path.rpartition('-')[2]}"
    rows = df.repartition(buckets, key).write.format("parquet").option("path", path).option("compression", STAGED_CODEC)
    rows.bucketBy(buckets, key).saveAsTable(name)
    table = spark.table(name)
    # Its files lie at a path of their own and stay.
    spark.sql(f"DROP TABLE {name}")
    return table


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder of any store that Spark writes to."""
    files, folder = _folder(spark, path)
    return files.getContentSummary(folder).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder if it is there."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is not there."""
    files, folder = _folder(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(folder)) if files.exists(folder) else []

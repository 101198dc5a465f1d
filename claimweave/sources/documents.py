"""Uploaded files as text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _decode(data: pd.Series) -> pd.Series:
    return data.map(lambda raw: None if raw is None else bytes(raw).decode("utf-8", errors="ignore"))


def decode_text(data: str | Column) -> Column:
    """UTF-8 text with invalid bytes dropped (Spark's own decoders raise or substitute).

    Only invalid texts go to Python; for the others it gets a NULL.
    """
    data = F.col(data) if isinstance(data, str) else data
    valid = F.is_valid_utf8(data.cast("string"))
    return F.when(valid, data.cast("string")).otherwise(_decode(F.when(~valid, data)))


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(filename, content) of every file below ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return file_rows(reader.load(path))


def file_rows(files: DataFrame) -> DataFrame:
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), "path", "content")

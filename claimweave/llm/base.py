"""What several operators share: words, names of working columns, the query registry."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# White space between words, as a Java and a DuckDB character class.
SPACE = r"[\x20\x09-\x0D]+"


def query(oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text, a null as the empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def same(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """Null-safe equality of two lists of columns."""
    test = F.lit(True)
    for a, b in zip(left, right, strict=True):
        test = test & a.eqNullSafe(b)
    return test


def lower_words(text: str) -> list[bytes]:
    """Words between white space in UTF-8, A-Z in lower case, other letters as they are."""
    return text.encode().lower().split()

"""Study-design weights: the built-in table, or a typed CSV of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimweave.functions import vocab
from claimweave.functions.schemas import STUDY_WEIGHT


def study_weights(spark: SparkSession) -> DataFrame:
    """The seven built-in designs as a literal relation, so Spark knows that it is tiny."""
    rows = ", ".join(f"('{name}', {weight}D, {rank})" for name, weight, rank in vocab.STUDY_WEIGHTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(study_type, weight, evidence_rank)")


def read_study_weights(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STUDY_WEIGHT).option("header", True).option("mode", "FAILFAST").csv(path)

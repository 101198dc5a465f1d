"""Study records as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.schemas import STUDY
from claimweave.operators.keyed import sequential_ids


def parse_studies(lines: DataFrame, json_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(studies, refused). A study is a JSON object whose five fields are all strings."""
    fields = F.try_variant_get(F.try_parse_json(json_col), "$", "map<string,variant>")
    parsed = lines.withColumn("_fields", fields)

    def value(name: str) -> Column:
        return F.try_element_at("_fields", F.lit(name))

    missing = F.array_compact(
        F.array(
            *[
                F.when(F.coalesce(F.schema_of_variant(value(f.name)), F.lit("")) != "STRING", F.lit(f.name))
                for f in STUDY
            ]
        )
    )
    checked = parsed.withColumn("_missing", missing)
    good = F.col("_fields").isNotNull() & (F.size("_missing") == 0)
    rest = [c for c in lines.columns if c != json_col]
    studies = checked.where(good).select(
        *rest, *[F.try_variant_get(value(f.name), "$", "string").alias(f.name) for f in STUDY]
    )
    reason = F.when(F.col("_fields").isNull(), "not a JSON object").otherwise(
        F.concat(F.lit("not a string: "), F.array_join("_missing", ", "))
    )
    refused = checked.where(~good).select(*rest, json_col, reason.alias("reason"))
    return studies, refused


def read_studies(spark: SparkSession, path: str, start: int = 1) -> tuple[DataFrame, DataFrame]:
    """Studies of JSON-lines files, numbered from ``start`` in order of file and line."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )
    studies, refused = parse_studies(lines)
    numbered = sequential_ids(studies, ["_file", "_block", "_line"], start=start)
    return numbered.drop("_file", "_block", "_line"), refused.drop("_file", "_block", "_line")

"""The given test tables, read as papers, claims, export runs and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions import columns as C
from claimweave.functions import vocab
from claimweave.operators import gold, silver
from claimweave.session import buckets_for, staged_by
from claimweave.sources.weights import study_weights

FIRST_RUN = "19951231T000000Z"
SECOND_RUN = "19961231T000000Z"
LATEST_RUN = "20011231T000000Z"
CLAIM_TIES = ("_price", "_part", "_supplier")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _pick(index: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


# --- gold: already clean claims and papers -------------------------------------------------


def stg_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem")
    parts = read(spark, sf_dir, "part")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    joined = items.join(parts, items.l_partkey == parts.p_partkey)
    return joined.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("claim_id"),
        F.col("l_orderkey").alias("paper_id"),
        F.col("l_linenumber").alias("cluster_id"),
        F.when(status == "O", "older adults").otherwise("adults").alias("population"),
        F.lower("p_brand").alias("intervention"),
        F.lower("p_type").alias("outcome"),
        F.when(flag == "A", "positive")
        .when(flag == "R", "negative")
        .when(status == "O", "null")
        .otherwise("mixed")
        .alias("result"),
        _pick(F.col("l_linenumber"), [w[0] for w in vocab.STUDY_WEIGHTS]).alias("study_type"),
        (F.col("l_quantity") / 50).alias("confidence"),
        (F.col("l_quantity") > 1).alias("confidence_rescaled"),
    )


def stg_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("paper_id"),
        F.concat(F.lit("Study of customer "), F.col("o_custkey").cast("string")).alias("title"),
        F.concat(F.lit("uploads/"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("source_filename"),
        F.when(status == "F", "processed").when(status == "P", "failed").otherwise("pending").alias("ingest_status"),
        F.when(status == "P", "timeout").alias("ingest_error"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_synthetic"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_claims(stg_claims(spark, sf_dir), study_weights(spark))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts regrouped so that an order is an intervention: very many small pairs."""
    intervention = F.concat(F.lit("order "), F.col("paper_id").cast("string"))
    return facts(spark, sf_dir).withColumns(
        {"intervention": intervention, "claim_pair": C.claim_pair(intervention, F.col("outcome"))}
    )


def papers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_papers(stg_papers(spark, sf_dir), stg_claims(spark, sf_dir))


def stored_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims as the application stores them, with their cluster key."""
    return stg_claims(spark, sf_dir).withColumn("claim_key", C.cluster_key("cluster_id"))


# --- silver: messy snapshots of several export runs ----------------------------------------


def bronze_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("o_custkey").cast("string")
    status = F.col("o_orderstatus")
    run = F.when(F.col("o_orderdate") < at("1995-07-01 00:00:00"), FIRST_RUN).otherwise(LATEST_RUN)
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit(" Study of customer "), customer).alias("title"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("synthetic/C"), customer, F.lit(".PDF")))
        .otherwise(F.concat(F.lit("uploads/C"), customer, F.lit("-"), status, F.lit(".pdf ")))
        .alias("source_filename"),
        F.when(status == "F", " Processed").when(status == "P", "failed").otherwise("PENDING ").alias("ingest_status"),
        F.when(status == "P", "timeout").alias("ingest_error"),
        F.col("o_orderdate").alias("created_at"),
        run.alias("_run_id"),
        F.when(run == FIRST_RUN, at("1995-12-31 00:00:00")).otherwise(at("2001-12-31 00:00:00")).alias("_exported_at"),
        F.lit("papers").alias("_source_table"),
    )


def bronze_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem")
    parts = read(spark, sf_dir, "part")
    flag, status, quantity = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    spellings = (
        "RCT",
        "Randomized Controlled  Trial",
        "Cohort",
        "Case Control",
        "cross-sectional",
        "Case Report",
        "meta-analysis",
    )
    key = F.concat(
        F.lit("cluster-"), F.col("l_linenumber").cast("string"), F.lit(": "), C.claim_pair("p_brand", "p_type")
    )
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("l_tax") != 0.08, F.col("l_orderkey")).alias("paper_id"),
        F.when((flag == "N") & (status == "O"), "no cluster").otherwise(key).alias("claim_key"),
        F.when(status == "O", "  Older   Adults ").otherwise("ADULTS").alias("population"),
        F.when(F.col("p_size") == 50, "   ").otherwise(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("intervention"),
        F.col("p_type").alias("outcome"),
        F.when(F.col("l_discount") == 0.1, "Improved")
        .when(flag == "A", " Positive")
        .when(flag == "R", "NEGATIVE ")
        .when(status == "O", "No  Effect")
        .otherwise("inconclusive")
        .alias("result"),
        _pick(F.col("l_linenumber"), spellings).alias("study_type"),
        F.when(quantity == 50, 250.0)
        .when(quantity == 1, quantity)
        .when(status == "F", quantity / 50)
        .otherwise(quantity * 2)
        .alias("confidence"),
        F.when(F.col("l_shipdate") < at("1996-01-01 00:00:00"), FIRST_RUN)
        .when(F.col("l_shipdate") < at("1997-01-01 00:00:00"), SECOND_RUN)
        .otherwise(LATEST_RUN)
        .alias("_run_id"),
        F.col("l_shipdate").alias("_exported_at"),
        F.lit("claim_evidence").alias("_source_table"),
        F.col("l_extendedprice").alias("_price"),
        F.col("l_partkey").alias("_part"),
        F.col("l_suppkey").alias("_supplier"),
    )


def silver_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_papers(bronze_papers(spark, sf_dir), F.lit(LATEST_RUN), stage=True)


def checked_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = silver_papers(spark, sf_dir)
    return silver.checked_claims(bronze_claims(spark, sf_dir), papers, F.lit(LATEST_RUN), CLAIM_TIES)


def valid_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagging repeats reads the checked claims twice, so they are staged, as in the pipeline."""
    buckets = buckets_for(bronze_claims(spark, sf_dir))
    return silver.valid_claims(staged_by(checked_claims(spark, sf_dir), "checked", "claim_id", buckets))


def rejected_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rejected_claims(checked_claims(spark, sf_dir))


def bronze_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each run exported, one per id. Ids are dealt out first: a map task would hold nearly all of its own to no end."""

    def rows_of(df):
        return df.repartition(buckets_for(df), "id").groupBy("_run_id", "_source_table").agg(
            F.max("_exported_at").alias("exported_at"), F.countDistinct("id").alias("n_rows")
        )

    both = rows_of(bronze_papers(spark, sf_dir)).unionByName(rows_of(bronze_claims(spark, sf_dir)))
    return both.select(
        F.col("_run_id").alias("run_id"),
        F.to_date("exported_at").alias("ingest_date"),
        "exported_at",
        F.col("_source_table").alias("source_table"),
        "n_rows",
    )


# --- export history ------------------------------------------------------------------------


def hourly_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as export runs: one manifest per hour, one table entry per kind of event."""
    table = F.when(F.col("event_type").isin("view", "click"), "papers").otherwise("claim_evidence")
    counts = (
        read(spark, sf_dir, "events")
        .groupBy(F.date_trunc("hour", "ts").alias("hour"), table.alias("t"))
        .agg(F.max("ts").alias("last"), F.count("*").alias("rows"))
    )
    entry = F.struct(F.col("t"), F.struct("rows", F.concat(F.lit("events/"), "t").alias("uri")))
    return counts.groupBy("hour").agg(
        F.max("last").alias("_last"), F.map_from_entries(F.collect_list(entry)).alias("tables")
    ).select(
        C.run_id(F.col("hour")).alias("run_id"),
        F.date_format("hour", "yyyy-MM-dd").alias("ingest_date"),
        F.date_format("_last", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("exported_at"),
        "tables",
    )

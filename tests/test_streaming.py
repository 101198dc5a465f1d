import os
import random
from datetime import timedelta

import pytest
from evidence_rows import T0, T1, claim, claims_frame, paper, papers_frame
from pyspark.sql import functions as F

from claimweave.functions import vocab
from claimweave.operators import quality
from claimweave.plans.pipeline import read_silver, run_bronze_to_silver
from claimweave.sources import bronze, versions
from claimweave.streaming import runs as run_stream
from claimweave.streaming import uploads
from claimweave.streaming.runs import apply_runs, process_new_runs


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_incremental_silver_equals_batch(spark, tmp_path):
    root, silver, checkpoint = (str(tmp_path / x) for x in ("bronze", "silver", "checkpoint"))
    same = {"source_filename": "a.pdf", "title": "Same"}
    first = {
        "papers": papers_frame(spark, paper(1, **same), paper(2, **same), paper(3)),
        "claim_evidence": claims_frame(spark, claim(1, 1), claim(2, 2), claim(3, 3, result="?"), claim(4, 3)),
    }
    second = {
        "papers": papers_frame(spark, paper(2, **same), paper(3), paper(4)),
        "claim_evidence": claims_frame(spark, claim(2, 2), claim(3, 3), claim(4, 3, confidence=70.0), claim(5, 4)),
    }
    bronze.snapshot(spark, first, root, T0)
    process_new_runs(spark, root, silver, checkpoint)
    bronze.snapshot(spark, second, root, T1)
    process_new_runs(spark, root, silver, checkpoint)
    before = rows(read_silver(spark, silver)["claims"], ("claim_id", "_silver_updated_at"))
    process_new_runs(spark, root, silver, checkpoint)
    assert rows(read_silver(spark, silver)["claims"], ("claim_id", "_silver_updated_at")) == before

    batch = str(tmp_path / "batch")
    run_bronze_to_silver(spark, root, batch)
    streamed, expected = read_silver(spark, silver), read_silver(spark, batch)
    claim_columns = ("claim_id", *vocab.CLAIM_HASH_COLUMNS)
    assert rows(streamed["claims"], claim_columns) == rows(expected["claims"], claim_columns)
    paper_columns = ("paper_id", *vocab.PAPER_HASH_COLUMNS)
    assert rows(streamed["papers"], paper_columns) == rows(expected["papers"], paper_columns)
    assert streamed["claims_rejects"].count() == expected["claims_rejects"].count() == 0
    run_columns = ("run_id", "source_table", "n_rows")
    assert rows(streamed["bronze_runs"], run_columns) == rows(expected["bronze_runs"], run_columns)

    # Replaying the last batch finds nothing to change.
    apply_runs(spark, root, silver, ["20261002T120000Z"], 1)
    assert rows(read_silver(spark, silver)["claims"], ("claim_id", "_silver_updated_at")) == before
    # A batch number may be skipped; a batch without any earlier state stops instead of forgetting the history.
    apply_runs(spark, root, silver, ["20261002T120000Z"], 5)
    assert rows(read_silver(spark, silver)["claims"], claim_columns) == rows(expected["claims"], claim_columns)
    with pytest.raises(ValueError, match="no state of an earlier batch"):
        apply_runs(spark, root, str(tmp_path / "other"), ["20261002T120000Z"], 2)


def test_nested_uploads_are_read_and_ids_checked(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_text("Doses decrease pain.")
    (tmp_path / "in" / "deep" / "b.txt").write_text("Nothing.")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    uploads.process_new_documents(uploads.stream_files(spark, str(tmp_path / "in")), out, checkpoint)
    assert sorted(r.title for r in uploads.read_sink(spark, out, "papers").collect()) == ["a.txt", "b.txt"]
    one_id = uploads.stream_files(spark, str(tmp_path / "in")).withColumn("paper_id", F.lit(1).cast("bigint"))
    with pytest.raises(Exception, match="share a hash"):
        uploads.process_new_documents(one_id, str(tmp_path / "clash"), str(tmp_path / "checkpoint2"))


def export(rng, ids, paper_ids):
    """One full export: some files share a name, some claims fail a check, some repeat a finding."""
    papers = [
        paper(i, title=f"On {rng.choice('ab')}", source_filename=f"{rng.choice('abc')}.pdf", ingest_status=rng.choice(["processed", "failed"]))
        for i in paper_ids
    ]
    claims = [
        claim(
            i,
            rng.choice([*paper_ids, 99]),
            result=rng.choice(["positive", "negative", "?"]),
            population=rng.choice(["adults", "Adults ", "children"]),
            confidence=rng.choice([0.5, 70.0, -1.0]),
        )
        for i in ids
    ]
    return papers, claims


def state(silver_root, spark):
    tables = read_silver(spark, silver_root)
    valid = tables["claims"].join(tables["claims_rejects"], "claim_id", "left_anti")
    return {
        "papers": rows(tables["papers"], ("paper_id", "is_duplicate_upload", "row_hash", *vocab.PAPER_HASH_COLUMNS)),
        "claims": rows(valid, ("claim_id", "row_hash", *vocab.CLAIM_HASH_COLUMNS)),
        "rejects": rows(tables["claims_rejects"], ("claim_id", "paper_id", "is_deleted", "result_raw", "reject_reason")),
        "runs": rows(tables["bronze_runs"], ("run_id", "source_table", "n_rows")),
    }


@pytest.mark.parametrize("seed", [1])
def test_random_histories_give_what_the_batch_gives(spark, tmp_path, seed):
    rng = random.Random(seed)
    root, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    kept: dict = {}
    for n in range(4):
        live = rng.sample(range(1, 13), 9)
        fresh, claims = export(rng, rng.sample(range(100, 130), 22), live)
        # Most rows are exported as they were before.
        papers = [kept.get(p.id, p) if rng.random() < 0.8 else p for p in fresh]
        claims = [kept.get(c.id, c) if rng.random() < 0.8 else c for c in claims]
        kept.update({x.id: x for x in [*papers, *claims]})
        tables = {"papers": papers_frame(spark, *papers), "claim_evidence": claims_frame(spark, *claims)}
        bronze.snapshot(spark, tables, root, T0 + timedelta(days=n))
    run_ids = bronze.complete_run_ids(spark, root)
    # The third run comes late, together with nothing else.
    for batch, runs in enumerate([run_ids[:1], [run_ids[1]], [run_ids[3]], [run_ids[2]]]):
        apply_runs(spark, root, silver, runs, batch)
    batch = str(tmp_path / "batch")
    run_bronze_to_silver(spark, root, batch)
    assert state(silver, spark) == state(batch, spark)


def test_the_stream_goes_on_from_batch_tables(spark, tmp_path):
    root, silver, batch = (str(tmp_path / x) for x in ("bronze", "silver", "batch"))
    rng = random.Random(3)
    for n in range(3):
        papers, claims = export(rng, range(100, 120), range(1, 8 - n))
        bronze.snapshot(spark, {"papers": papers_frame(spark, *papers), "claim_evidence": claims_frame(spark, *claims)}, root, T0 + timedelta(days=n))
        if n == 1:
            run_bronze_to_silver(spark, root, silver)
    apply_runs(spark, root, silver, bronze.complete_run_ids(spark, root)[2:], 0)
    run_bronze_to_silver(spark, root, batch)
    assert state(silver, spark) == state(batch, spark)


def part_files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.startswith("part-")}


def one_change(spark, root):
    papers = [paper(i, source_filename=f"{i}.pdf") for i in range(1, 60)]
    claims = [claim(i, 1 + i % 59, population=f"group {i}") for i in range(1, 400)]
    bronze.snapshot(spark, {"papers": papers_frame(spark, *papers), "claim_evidence": claims_frame(spark, *claims)}, root, T0)
    claims[10] = claim(11, 12, population="another group")
    bronze.snapshot(spark, {"papers": papers_frame(spark, *papers), "claim_evidence": claims_frame(spark, *claims)}, root, T1)
    return bronze.complete_run_ids(spark, root)


def test_one_changed_claim_rewrites_one_bucket(spark, tmp_path):
    root, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    run_ids = one_change(spark, root)
    apply_runs(spark, root, silver, run_ids[:1], 0)
    before = {name: part_files(f"{silver}/{name}") for name in ("papers", "claims", "claims_rejects")}
    apply_runs(spark, root, silver, run_ids[1:], 1)
    after = {name: part_files(f"{silver}/{name}") for name in before}
    assert after["papers"] == before["papers"] and after["claims_rejects"] == before["claims_rejects"]
    gone = {os.path.dirname(f) for f in before["claims"] - after["claims"]}
    assert len(gone) == 1 and len({os.path.dirname(f) for f in before["claims"]}) > 5
    assert os.listdir(f"{silver}/_batches") == ["batch=1"]


def test_an_interrupted_batch_is_finished_by_its_replay(spark, tmp_path, monkeypatch):
    root, silver, batch = (str(tmp_path / x) for x in ("bronze", "silver", "batch"))
    run_ids = one_change(spark, root)
    apply_runs(spark, root, silver, run_ids[:1], 0)

    def stop(*_):
        raise RuntimeError("lost")

    # The claims' buckets are prepared, the first table is published, then the job dies.
    with monkeypatch.context() as m:
        m.setattr(versions, "fit_buckets", stop)
        with pytest.raises(RuntimeError):
            apply_runs(spark, root, silver, run_ids[1:], 1)
    apply_runs(spark, root, silver, run_ids[1:], 1)
    run_bronze_to_silver(spark, root, batch)
    assert state(silver, spark) == state(batch, spark)


def test_a_batch_that_breaks_a_rule_changes_nothing(spark, tmp_path, monkeypatch):
    root, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    run_ids = one_change(spark, root)
    apply_runs(spark, root, silver, run_ids[:1], 0)
    before = state(silver, spark)
    with monkeypatch.context() as m:
        m.setattr(quality, "claim_rules", lambda papers: ([quality.between("confidence", 0, 0.1)], []))
        with pytest.raises(ValueError, match="between:confidence"):
            apply_runs(spark, root, silver, run_ids[1:], 1)
    assert state(silver, spark) == before


def test_a_batch_broadcasts_no_table_of_many_ids(spark, tmp_path, monkeypatch):
    """300 000 ids take some kilobytes in files, but megabytes in the hash table that the driver would make."""
    spark.range(300_000).select(F.col("id"), F.lit("state").alias("change")).write.parquet(str(tmp_path / "ids"), compression="zstd")
    spark.range(20).coalesce(1).write.parquet(str(tmp_path / "few"))
    joins = {}

    def batch(session, *_):
        rows = session.range(2_000_000).selectExpr("id", "id + 1 AS value")
        for name in ("ids", "few"):
            joined = rows.join(session.read.parquet(str(tmp_path / name)).select("id"), "id", "left_semi")
            joins[name] = joined._jdf.queryExecution().sparkPlan().toString()

    monkeypatch.setattr(run_stream, "_apply", batch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
        run_stream.apply_runs(spark, "", "", [], 0)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "1m"
        assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in joins["ids"] and "BroadcastHashJoin" in joins["few"]

import numpy as np
from pyspark.sql import functions as F

from claimweave.operators.vectors import hashed_words
from claimweave.plans import ingest
from claimweave.sources.documents import decode_text
from claimweave.sources.studies import read_studies
from claimweave.streaming import uploads


def test_decode_drops_invalid_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb\xc3\xa9\xc3"),), (None,)], "b binary")
    assert [r.t for r in df.select(decode_text("b").alias("t")).collect()] == ["abé", None]


def write_files(folder):
    (folder / "sub").mkdir(parents=True)
    (folder / "a.txt").write_bytes(b"Doses decrease pain. \xff Sleep did improve.")
    (folder / "b.pdf").write_bytes(b"%PDF")
    (folder / "c.md").write_text("")
    (folder / "sub" / "d.txt").write_text("Nothing. " * 300)
    (folder / "e.txt").write_text("poison")


def test_a_bad_document_does_not_stop_the_others(spark, tmp_path):
    def careful(texts):
        if any("poison" in t for t in texts):
            raise RuntimeError("cannot embed")
        return hashed_words(texts)

    write_files(tmp_path / "in")
    frames = ingest.ingest_folder(spark, str(tmp_path / "in"), numbered=True, first_id=10, embedder=careful)
    papers = {r.title: r for r in frames["papers"].collect()}
    assert sorted(r.id for r in papers.values()) == [10, 11, 12, 13]  # an empty file is no upload
    assert {t: r.ingest_status for t, r in papers.items()} == {
        "a.txt": "processed",
        "b.pdf": "failed",
        "d.txt": "processed",
        "e.txt": "failed",
    }
    assert papers["b.pdf"].ingest_error == "No parser for PDF files"
    assert papers["e.txt"].ingest_error == "cannot embed"
    claims = frames["claims"].orderBy("paper_id", "claim_index").collect()
    assert [c.result for c in claims if c.paper_id == papers["a.txt"].id] == ["negative", "positive"]
    assert claims[0].claim_key == "cluster-0: intervention from paper -> primary outcome"
    chunks = frames["chunks"].where(F.col("paper_id") == papers["d.txt"].id).orderBy("chunk_index").collect()
    assert [c.chunk_id for c in chunks] == [f"{papers['d.txt'].id}:{i}" for i in range(3)]
    assert len(chunks[0].embedding) == 256
    failed = [papers[t].id for t in ("b.pdf", "e.txt")]
    assert not [c for c in claims if c.paper_id in failed]


def test_parser_and_model_hooks_and_clusters(spark):
    def model(texts):
        return [
            '[{"intervention":" Statins ","outcome":"LDL"},{"intervention":"x","outcome":"y"},{"intervention":"statins","outcome":"ldl"}]'
            for _ in texts
        ]

    rows = [(1, "p.PDF", bytearray(b"%PDF body")), (2, "empty.txt", bytearray(b""))]
    df = spark.createDataFrame(rows, "paper_id long, filename string, content binary")
    done = ingest.process_documents(df, pdf_parser=lambda raw: raw[5:].decode(), model=model)
    row, empty = done.orderBy("paper_id").collect()
    assert empty.ingest_status == "failed" and empty.ingest_error == "Empty upload"
    assert row.full_text == "body" and row.ingest_status == "processed"
    keys = [r.claim_key for r in ingest.claim_evidence_rows(done).orderBy("claim_index").collect()]
    assert keys == ["cluster-0: statins -> ldl", "cluster-1: x -> y", "cluster-0: statins -> ldl"]


def test_hashed_ids_read_paths_only(spark, tmp_path):
    write_files(tmp_path)
    papers = ingest.ingest_folder(spark, str(tmp_path))["papers"].collect()
    assert len({r.id for r in papers}) == len(papers) == 4


def test_processing_is_one_map(spark):
    df = spark.createDataFrame([(1, "p.txt", bytearray(b"x"))], "paper_id long, filename string, content binary")
    assert "Exchange" not in ingest.process_documents(df)._jdf.queryExecution().executedPlan().toString()


def test_files_that_arrive_later_are_ingested_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.txt").write_text("Doses decrease pain.")
    options = {"embedder": lambda texts: np.ones((len(texts), 2))}
    uploads.process_new_documents(uploads.stream_files(spark, str(folder)), out, f"{out}/_c", **options)
    (folder / "b.txt").write_text("Nothing here.")
    uploads.process_new_documents(uploads.stream_files(spark, str(folder)), out, f"{out}/_c", **options)
    uploads.process_new_documents(uploads.stream_files(spark, str(folder)), out, f"{out}/_c", **options)
    assert sorted(r.title for r in uploads.read_sink(spark, out, "papers").collect()) == ["a.txt", "b.txt"]
    assert sorted(r.result for r in uploads.read_sink(spark, out, "claims").collect()) == ["negative", "null"]
    assert uploads.read_sink(spark, out, "chunks").count() == 2


def test_studies_are_numbered_and_bad_ones_refused(spark, tmp_path):
    good = '{"population":"p","intervention":"i%d","outcome":"o","result":"r","study_type":"s","extra":1}'
    lines = [good % 1, "nonsense", good % 2, '{"population":"p","intervention":3,"outcome":null}', good % 3, "[1]"]
    (tmp_path / "s.json").write_text("\n".join(lines))
    studies, refused = read_studies(spark, str(tmp_path / "s.json"), start=4)
    assert [(r.id, r.intervention) for r in studies.orderBy("id").collect()] == [(4, "i1"), (5, "i2"), (6, "i3")]
    assert studies.columns == ["id", "population", "intervention", "outcome", "result", "study_type"]
    assert sorted(r.reason for r in refused.collect()) == [
        "not a JSON object",
        "not a JSON object",
        "not a string: intervention, outcome, result, study_type",
    ]


def test_an_embedder_never_sees_a_whole_large_batch(spark):
    n = 2 * ingest.TEXTS_AT_ONCE
    files = spark.range(n, numPartitions=1).select(
        F.col("id").alias("paper_id"), F.lit("a.txt").alias("filename"), F.encode(F.concat(F.lit("t"), "id"), "UTF-8").alias("content")
    )
    done = ingest.process_documents(files, embedder=lambda texts: np.full((len(texts), 1), len(texts)))
    found = done.select(F.col("chunks")[0]["vectors"][0].alias("seen"), F.col("claims")[0]["labels"].alias("label"))
    row = found.agg(F.count("seen"), F.max("seen"), F.max("label"), F.count("label")).first()
    assert row[0] == n and 1 < row[1] <= ingest.TEXTS_AT_ONCE and (row[2], row[3]) == (0, n)


def test_matrices_become_nested_lists():
    parts = [np.ones((2, 3), np.float32), None, np.zeros((0, 0), np.float32), np.full((1, 2), 5, np.float32)]
    assert ingest._nested(parts).to_pylist() == [[[1, 1, 1], [1, 1, 1]], None, [], [[5, 5]]]
    assert ingest._nested([]).to_pylist() == [] and ingest._nested([None]).to_pylist() == [None]

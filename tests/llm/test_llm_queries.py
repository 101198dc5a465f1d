"""Queries without reference SQL against brute force on the smallest test tables, and the pipeline's stages."""

import base64
import collections
import hashlib
import math
import os
import re
import struct
import zlib

import numpy as np
import plain
import public_tokenizers
import pytest
from test_operators import plain_print, plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from claimweave.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, "documents")}


def run(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def test_secret_scan(spark, texts):
    rows = run(spark, "op1_secret_scan")
    kinds = ("assign", "access", "hex")
    for r in rows:
        found = plain_spans(texts[r["doc_id"]])
        listed = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
        counts = collections.Counter(k for _, k, _ in found)
        assert [r[f"n_{k}"] for k in kinds] == [counts[i] for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))
    assert len(rows) == len(texts)


def test_simhash(spark, texts):
    prints = {i: plain_print(t) for i, t in texts.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    label = plain.components(prints, links)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in run(spark, "op2_simhash_near_dup")}
    assert got == {(i, f"{p:016x}", label[i]) for i, p in prints.items()}


def test_embeddings(spark):
    rows = table(spark, "embeddings")
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = [r["vec_id"] for r in rows]
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(x @ x.T >= 0.9)) if i < j]
    degree, label = collections.Counter(n for e in links for n in e), plain.components(ids, links)
    got = {tuple(r) for r in run(spark, "op3_embedding_near_dup")}
    assert got == {(i, degree[i], label[i], label[i] == i) for i in ids}


def test_lm_scores(spark, texts):
    tokens = {i: [*plain.words(t), b" "] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    rows = run(spark, "op4_lm_scoring")
    for r in rows:
        t = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[r["doc_id"]],
            len(t),
            sum(w in counts for w in t),
            n,
        )
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
    # The model is better than the counts alone on texts that it has not seen.
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_warc(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table(spark, "pages")}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    rows = run(spark, "op5_warc_archive")
    assert len(rows) == len(pages)
    for r in rows:
        data = pages[r["page_id"]]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        own = first[data] == r["page_id"]
        want = (len(data), digest, "response" if own else "revisit", None if own else first[data])
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == want


def test_bpe(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = run(spark, "op6_bpe_round_trip")
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert len(rows) == len(texts)


def test_toxicity(spark, texts):
    rows = run(spark, "op9_toxicity")
    assert len(rows) == len(texts)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_pipeline_stages(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {"documents": {r["doc_id"]: r for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_DIR), name)
        if name != "tokens":
            assert docs.columns == columns
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    before = seen["documents"]
    kept = {r["doc_id"] for r in run(spark, "op10_quality_rules") if r["kept"]}
    assert set(seen["quality_rules"]) == kept
    prints = {i: plain_print(texts[i]) for i in kept}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    label = plain.components(prints, links)
    alone = set(seen["near_duplicates"])
    assert alone == {i for i in kept if label[i] == i}
    for i, r in seen["secret_scan"].items():
        found = plain_spans(before[i]["text"])
        assert ("[secret]" in r["text"]) >= bool(found) and r["n_chars"] == len(r["text"])
        assert not plain_spans(r["text"])
        if not found and not re.search("PRIVATE KEY|://", before[i]["text"]):
            assert r["text"] == before[i]["text"]
    assert set(seen["secret_scan"]) == alone
    assert set(seen["tokens"]) == set(seen["mix_sources"]) < alone
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in seen["tokens"].items():
        assert r["ids"] == library.encode(seen["mix_sources"][i]["text"], add_special_tokens=False).ids

"""Vector codes, importance resampling and merge replay against brute force, and their odd inputs."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from claimweave.llm import importance, merge_replay, queries, vector_codes

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


# --- vector codes -----------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds):
    """Codes and errors by id, and the codebooks, with every part compared with every entry."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: r[0])
    v = np.array([[math.floor(256 * x) for x in r[1]] for r in kept], dtype=object).reshape(len(kept), parts, -1)
    books = v[:entries].transpose(1, 0, 2).copy()

    def nearest():
        d = ((v.transpose(1, 0, 2)[:, :, None] - books[:, None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(rounds):
        found, _ = nearest()
        for part in range(parts):
            for entry in set(found[part].tolist()):
                own = v[found[part] == entry, part]
                books[part, entry] = [int(s) // len(own) for s in own.sum(axis=0)]
    found, d = nearest()
    return {r[0]: (bytes(found[:, i].tolist()), int(d[:, i].sum())) for i, r in enumerate(kept)}, books


def vector_rows(n=700, width=32, seed=2):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, width)], int(i) % 5 or None) for i in rng.permutation(n)]
    rows += [(10_000 + i, rows[i % 3][1], 1) for i in range(300)]  # one value many times
    return rows + [(-1, None, 1), (-2, [None] * width, 2), (-3, [float("nan")] * width, None), (-4, [math.inf] + [0.0] * (width - 1), 1)]


VECTORS = "vec_id bigint, embedding array<double>, label int"


@pytest.mark.parametrize("block", [4, 32])
def test_codes_match_all_comparisons(spark, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = vector_rows()
    want, books = plain_codes(rows, 8, 20, 2)
    got, found = vector_codes.encode_vectors(spark.createDataFrame(rows, VECTORS).repartition(3), parts=8, entries=20)
    assert np.array_equal(found, books.astype(np.int64))
    assert {r["vec_id"]: (bytes(r["code"]), r["error"]) for r in got.collect()} == want


def test_shortlists_hold_every_nearest_entry_and_are_short():
    rng = np.random.default_rng(4)
    points = (rng.integers(-160, 160, (64, 4))[:, None] + rng.integers(-9, 10, (64, 64, 4))).reshape(-1, 4)
    chunk = vector_codes.Chunk.of(points, 1)
    entries = points[::64]
    listed = chunk.shortlists(0, entries)
    d = ((chunk.points[0].astype(np.int64)[:, None] - entries[None]) ** 2).sum(axis=2)
    assert listed[np.arange(4096) // vector_codes.BLOCK, d.argmin(axis=1)].all()
    assert listed.mean() < 0.3


def test_hilbert_keys_visit_every_cell_by_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    walk = grid[np.argsort(vector_codes.hilbert_keys(grid))]
    assert np.array_equal(np.abs(np.diff(walk, axis=0)).sum(axis=1), np.ones(511))


def test_ties_go_to_the_lower_index(spark):
    rows = [(1, [0.0, 0.0], 0), (2, [2.0, 2.0], 0), (3, [1.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    got, _ = vector_codes.encode_vectors(spark.createDataFrame(rows, VECTORS), parts=2, entries=2, rounds=0)
    assert sorted(bytes(r["code"]) for r in got.collect()) == [b"\0\0", b"\0\0", b"\0\0", b"\1\1"]


def test_short_and_no_vectors(spark):
    rows = [(1, [0.5], None), (2, [], None), (None, [0.5, 0.25, 0.125], 3), (4, [0.5, 0.25, 0.125], 3)]
    odd = spark.createDataFrame(rows, VECTORS).withColumn("k", F.lit("x")).withColumn("n", F.lit(1)).withColumn("code", F.lit(2))
    got, books = vector_codes.encode_vectors(odd, parts=2)
    back = vector_codes.decode_vectors(vector_codes.group_errors(got), books).collect()
    assert {(r["vec_id"], tuple(r["vector"]), r["label_error"]) for r in back} == {
        (1, (0.5, 0.0, 0.0, 0.0), 0),
        (2, (0.0, 0.0, 0.0, 0.0), 0),
        (None, (0.5, 0.25, 0.125, 0.0), 0),
        (4, (0.5, 0.25, 0.125, 0.0), 0),
    }
    for nothing in (odd.limit(0), odd.where("vec_id = 1").withColumn("embedding", F.lit(None).cast("array<double>"))):
        got, books = vector_codes.encode_vectors(nothing, parts=2)
        assert vector_codes.group_errors(got).count() == 0 and books.size == 0
    with pytest.raises(Exception, match="not below"):
        vector_codes.encode_vectors(spark.createDataFrame([(1, [1e9, 0.0], 1)], VECTORS), parts=2)[0].collect()


# --- importance resampling --------------------------------------------------------------------


def plain_features(text, grams=3):
    words = re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)})
    )
    runs = [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain_draw(docs, target, share=(5, 100), least=20):
    t, s = (Counter(b for _, text in rows for b in plain_features(text)[1]) for rows in (target, docs))
    big_t, big_s = sum(t.values()) + 10_000, sum(s.values()) + 10_000
    rows = []
    for key, text in docs:
        words, found = plain_features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(words), len(found), weight, score))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = {r[0]: i + 1 for i, r in enumerate(fit[: len(fit) * share[0] // share[1]])}
    return {(key, feats, weight, score, ranks.get(key)) for key, _, feats, weight, score in rows}


@pytest.mark.parametrize("piece", [64, 2 << 20])
def test_draws_match_plain_ones(spark, monkeypatch, piece):
    monkeypatch.setattr(importance, "SLICE", piece)
    rng = random.Random(6)
    words = ["Alpha", "beta", "GAMMA9", "délta", "É", "ß", "x" * 300, "中文", "a1", "ſ", "don't", "e_f"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 90)))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, " \n\0\x7f-"), (903, docs[0][1]), (None, docs[1][1])]
    target = [(1, "alpha beta gamma9 alpha beta"), (2, None), (3, "中文 délta")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    for name in ("k", "rank", "bucket", "n", "place", "score"):
        frame = frame.withColumn(name, F.lit("x"))
    got = importance.resample(frame, spark.createDataFrame(target, "item_id bigint, text string"), share=(20, 100))
    assert {tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()} == plain_draw(
        docs, target, (20, 100)
    )


def test_draws_from_and_for_nothing(spark):
    docs = spark.createDataFrame([(i, "one two three " * 10) for i in range(40)], "doc_id bigint, text string")
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    rows = importance.resample(docs, none).orderBy("rank").collect()
    assert [r["rank"] for r in rows if r["rank"]] == [1, 2] and len({r["weight"] for r in rows}) == 1


def test_repeated_rows_are_all_ranked(spark):
    docs = spark.createDataFrame([(7, "one two three " * 10)] * 40, "doc_id bigint, text string")
    ranks = [r["rank"] for r in importance.resample(docs, docs, share=(50, 100)).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 21)) and len(ranks) == 40


def test_crc_of_spans_is_crc():
    data = bytes(random.Random(1).randrange(256) for _ in range(3000))
    spans = [(a, n) for a in range(0, 1000, 37) for n in (0, 1, 5, 6, 200, 300, 1900)]
    got = importance.crc_of_spans(data, np.array([a for a, _ in spans]), np.array([n for _, n in spans]))
    assert got.tolist() == [zlib.crc32(data[a : a + n]) for a, n in spans]


# --- merge replay -----------------------------------------------------------------------------


def library(ranks, pattern=public_tokenizers.PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.ids, special_tokens={})


def hard_texts(seed=8):
    rng = random.Random(seed)

    def letter():
        return chr(rng.choice([rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000), 32, 10, 39, 115]))

    texts = ["".join(letter() for _ in range(rng.randrange(200))) for _ in range(150)]
    return [None, "", " ", "\n\n  x", "'s S 'LL x's՘'s", "<|endoftext|> a", "a" * 5000, "ab" * 3000, "é࢏中文" * 50, *texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
@pytest.mark.parametrize("piece", [50, 1 << 21])
def test_replayed_ids_match_the_library(spark, monkeypatch, name, piece):
    for bound in ("SLICE", "REPLAY", "KNOWN"):
        monkeypatch.setattr(merge_replay, bound, min(piece, getattr(merge_replay, bound)))
    ranks = merge_replay.Ranks(public_tokenizers.path(name))
    texts = hard_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    for clash in ("k", "ids", "data"):
        docs = docs.withColumn(clash, F.lit("x"))
    rows = merge_replay.decode(merge_replay.encode(docs, ranks), ranks).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library(ranks).encode_ordinary(text)
        assert bytes(r["data"]) == text.encode()


def test_ranks_that_no_merging_made():
    rng = random.Random(5)
    for _ in range(60):
        pieces = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)})
        ids = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(pieces)}
        table = tiktoken.Encoding("odd", pat_str=r"\S+", mergeable_ranks=ids, special_tokens={})
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 20))) for _ in range(40)]
        got = merge_replay.Replay(ids).encode(words)
        assert [np.frombuffer(g, np.int32).tolist() for g in got] == [table.encode_ordinary(w.decode()) for w in words]


def test_characters_are_classed_as_in_the_library():
    stands = merge_replay.stand_ins()
    split = merge_replay.splitter(public_tokenizers.PATTERN, stands)
    text = "x'sa՘ " + " ".join(map(chr, sorted(stands)[::50]))
    single = {bytes([b]): b for b in range(256)}
    for kind in ("L", "N"):
        table = tiktoken.Encoding(kind, pat_str=rf"\p{{{kind}}}", mergeable_ranks=single, special_tokens={})
        for c in map(chr, sorted(stands)[::50]):
            assert bool(table.encode_ordinary(c)) == (stands[ord(c)] == {"L": "x", "N": "1"}[kind])
    assert "".join(w for words in split(text) for w in words) == text


def test_replay_of_nothing(spark):
    ranks = merge_replay.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert merge_replay.decode(merge_replay.encode(docs, ranks), ranks).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [999_999, 0]), (3, [])], "doc_id bigint, ids array<int>")
    got = {r["doc_id"]: bytes(r["data"]) for r in merge_replay.decode(odd, ranks).collect()}
    assert got == {1: b"", 2: b"!", 3: b""}


# --- the registered queries -------------------------------------------------------------------


@needs_tables
def test_merge_replay_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    table = library(merge_replay.Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    rows = queries.QUERIES["op13_merge_replay"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = table.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest(),
        )


@needs_tables
def test_importance_query(spark):
    docs, target = (
        [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").select(key, "text").collect()]
        for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    rows = queries.QUERIES["op12_importance_resample"](spark, SF_DIR).collect()
    assert {tuple(r) for r in rows} == plain_draw(docs, target) and len(rows) == len(docs)


@needs_tables
def test_vector_code_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, books = plain_codes(rows, 16, 64, 2)
    by_label = Counter()
    for key, _, label in rows:
        by_label[label] += want[key][1]
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    got = {tuple(r) for r in queries.QUERIES["op11_vector_codes"](spark, SF_DIR).collect()}
    assert got == {(i, want[i][0].hex(), want[i][1], by_label[label], digest) for i, _, label in rows}

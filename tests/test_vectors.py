import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import QUERIES
from claimweave.operators import clusters, vectors


def brute_linkage(points, threshold):
    """Average linkage from all pair distances, merging the closest clusters one step at a time."""
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    pair = 1 - unit @ unit.T
    clusters = [[i] for i in range(len(points))]
    while len(clusters) > 1:
        best = min(
            (pair[np.ix_(a, b)].mean(), i, j)
            for i, a in enumerate(clusters)
            for j, b in enumerate(clusters)
            if i < j
        )
        if best[0] >= threshold:
            break
        clusters[best[1]] += clusters.pop(best[2])
    labels = np.empty(len(points), int)
    for k, members in enumerate(sorted(clusters, key=min)):
        labels[members] = k
    return labels.tolist()


@pytest.mark.parametrize("seed", range(12))
def test_linkage_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(4, 6))
    points = centers[rng.integers(0, 4, 30)] + rng.normal(scale=0.45, size=(30, 6))
    points[7] = points[3]
    for threshold in (0.05, 0.25, 0.6):
        assert vectors.average_linkage(points, threshold) == brute_linkage(points, threshold)


def test_linkage_of_few_vectors():
    assert vectors.average_linkage(np.zeros((0, 3))) == []
    assert vectors.average_linkage(np.ones((1, 3))) == [0]
    assert vectors.average_linkage(np.ones((3, 3))) == [0, 0, 0]


def test_cluster_labels_per_row(spark):
    df = spark.createDataFrame([(1, [[1.0, 0.0], [0.0, 1.0], [1.0, 0.1]]), (2, [])], "id int, v array<array<double>>")
    rows = {r.id: r.l for r in df.select("id", vectors.cluster_labels("v").alias("l")).collect()}
    assert rows == {1: [0, 1, 0], 2: []}


def test_nearest_centroid_both_ways(spark):
    rng = np.random.default_rng(1)
    points, centers = rng.normal(size=(500, 8)), rng.normal(size=(40, 8))
    centers[30] = centers[10] * 2  # same direction: the lower id wins
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<float>")
    cs = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "centroid_id int, centroid array<double>")
    p32 = points.astype(np.float32).astype(np.float64)
    cosine = (p32 / np.linalg.norm(p32, axis=1)[:, None]) @ (centers / np.linalg.norm(centers, axis=1)[:, None]).T
    best = cosine.max(axis=1)
    for options in ({}, {"block_numbers": 64, "rows_per_group": 100}):
        rows = vectors.nearest_centroid(df, cs, **options).collect()
        assert len(rows) == 500
        for r in rows:
            assert r.similarity == pytest.approx(best[r.vec_id])
            assert cosine[r.vec_id, r.centroid_id] == pytest.approx(best[r.vec_id]) and r.centroid_id != 30
    assert [r.centroid_id for r in vectors.nearest_centroid(df.limit(2), cs.limit(0)).collect()] == [None, None]
    odd = spark.createDataFrame([(1, None), (2, [1.0]), (3, [None] * 8), (4, [1.0] * 8)], "vec_id long, embedding array<float>")
    found = {r.vec_id: r.centroid_id for r in vectors.nearest_centroid(odd, cs).collect()}
    assert found[4] is not None and [found[i] for i in (1, 2, 3)] == [None] * 3


def test_mean_centroids(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, 6.0])], "label int, e array<float>")
    rows = {r.centroid_id: r.centroid for r in vectors.mean_centroids(df, "label", "e", 2).collect()}
    assert rows == {0: [2.0, 3.0], 1: [5.0, 6.0]}


def test_hashed_words_depend_on_text_only(spark):
    one = vectors.hashed_words(["Statins lower LDL", "", "ldl statins, LOWER!"])
    assert np.allclose(one[0], one[2]) and not one[1].any()
    assert np.linalg.norm(one[0]) == pytest.approx(1, abs=1e-6)
    many = vectors.hashed_words(["x y"] * 1100 + ["Statins lower LDL"])
    assert np.array_equal(many[-1], one[0]) and np.array_equal(many[0], many[1099])
    df = spark.createDataFrame([("Statins lower LDL",), (None,)], "t string")
    rows = vectors.embed(df, "t").collect()
    assert np.allclose(rows[0].embedding, one[0]) and len(rows[1].embedding) == 256


def test_embedder_sees_batches(spark):
    df = spark.range(50).select(F.concat(F.lit("t"), "id").alias("t"))
    rows = vectors.embed(df, "t", lambda texts: np.array([[len(t)] for t in texts])).collect()
    assert all(r.embedding == [float(len(r.t))] for r in rows)


def chain(n):
    """Directions whose gaps grow: only the closest two are nearest to each other."""
    angles = np.cumsum([0.0, *(0.12 * 1.05**i for i in range(n - 1))])
    return np.stack([np.cos(angles), np.sin(angles)], axis=1)


def test_rounds_of_joins_give_the_labels_of_one_task(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 4))
    documents = {
        1: centers[rng.integers(0, 6, 70)] + rng.normal(scale=0.3, size=(70, 4)),
        2: np.pad(chain(20), ((0, 0), (0, 2))),
        3: np.repeat(rng.normal(size=(3, 4)), 5, axis=0),
        4: rng.normal(size=(1, 4)),
    }
    rows = [(d, i, [float(x) for x in v.astype(np.float32)]) for d, points in documents.items() for i, v in enumerate(points)]
    rows.append((5, 0, None))
    frame = spark.createDataFrame(rows, "paper long, n int, v array<float>").withColumn("doc", F.lit("x"))
    found = clusters.cluster_claims(frame, "paper", "n", "v", tile=16, local=6).collect()
    labels = {(r.paper, r.n): r.label for r in found}
    assert len(found) == len(rows) and labels.pop((5, 0)) is None
    for d, points in documents.items():
        want = vectors.average_linkage(points.astype(np.float32))
        assert [labels[d, i] for i in range(len(points))] == want
    assert len(set(vectors.average_linkage(documents[2].astype(np.float32)))) > 1


def test_rounds_of_nothing(spark):
    frame = spark.createDataFrame([], "paper long, n int, v array<float>")
    assert clusters.cluster_claims(frame, "paper", "n", "v").count() == 0


def test_one_call_serves_many_documents():
    rng = np.random.default_rng(6)
    rows = [(d, c, c % 2, 0, 1, v) for d in (7, 3, 5) for c, v in enumerate(vectors.unit_rows(rng.normal(size=(6, 4))))]
    frame = pd.DataFrame(rows, columns=["doc", "cid", "tile", "lower", "upper", "mean"]).sample(frac=1, random_state=1)
    together = clusters._nearest_in_tiles(frame).sort_values(["doc", "cid"]).reset_index(drop=True)
    apart = pd.concat([clusters._nearest_in_tiles(frame[frame["doc"] == d]) for d in (3, 5, 7)])
    pd.testing.assert_frame_equal(together, apart.sort_values(["doc", "cid"]).reset_index(drop=True))
    assert len(together) == 18

    sized = frame.assign(size=1)
    merged = clusters._finished(0.5)(sized).sort_values(["doc", "gone"])
    for d in (3, 5, 7):
        alone = clusters._finished(0.5)(sized[sized["doc"] == d]).sort_values("gone")
        assert list(merged[merged["doc"] == d]["keep"]) == list(alone["keep"])


def test_the_least_slot_is_found_once_a_vector(spark, tmp_path):
    texts = ["Statins lower LDL, statins", "", "a b c"]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["embed_chunks_hashed"](spark, str(tmp_path))
    assert "array_min(filter(" not in found._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.chunk_id: r for r in found.collect()}
    assert sorted(x.split(":")[1] for x in rows["0:0"].slots.split(",")) == ["1000", "1000", "2000"]
    assert set(rows) == {"0:0", "2:0"} and rows["2:0"].is_unit and rows["2:0"].size == 256

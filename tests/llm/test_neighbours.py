"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statmart.llm import kmeans_tree as kt


def exact(ids, vectors, query, k=10):
    d = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(1))
    other = ids != query
    order = np.lexsort((ids[other], d[other]))[:k]
    return list(zip(ids[other][order].tolist(), d[other][order].tolist()))


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, leaf int, vector string").repartition(6)


def test_tree_files_and_visits_agree():
    points = np.random.default_rng(1).normal(size=(2000, 8))
    tree = kt.fit_tree(points)
    leaf = tree.file(points)
    assert tree.leaves > 20 and set(leaf) <= set(range(tree.leaves))
    for p, l in zip(points[:50], leaf[:50]):
        seen = list(tree.visits(p))
        assert sorted(seen) == list(range(tree.leaves)) and l in seen[:5]


def test_search_recall_and_scores(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16)) * 3
    vectors = (centres[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 16))).astype(np.float32)
    vectors[1000:3000] = vectors[999]  # a third of all rows are one vector
    ids = rng.permutation(6000)
    out = kt.search(table(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors)]), F.col("vec_id") % 100 == 0).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == {i for i in range(6000) if i % 100 == 0}
    wide, hits = vectors.astype(np.float64), 0
    place = {int(i): v for i, v in zip(ids, wide)}
    for q, found in got.items():
        assert [r for _, _, r in found] == list(range(1, 11))
        assert [(s, v) for v, s, _ in found] == sorted((s, v) for v, s, _ in found)
        for v, s, _ in found:
            assert s == pytest.approx(np.sqrt(((place[v] - place[q]) ** 2).sum()), rel=1e-12)
        hits += len({v for v, _, _ in found} & {v for v, _ in exact(ids, wide, q)})
    assert hits / (10 * len(got)) >= 0.93


def test_odd_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [nan, 1.0]), (400, [1.0, None]), (500, [inf, 1.0]),
            (600, []), (700, [1.0, 2.0, 3.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [9.0, 9.0]), (3, [1.0, 0.0]),
            (None, [1.0, 1.0]), (800, [5.0, 5.0]), (800, [4.0, 5.0])]
    out = kt.search(table(spark, rows), F.col("vec_id") % 100 == 0).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert set(got) == {0, 800}
    assert got[0] == [(3, 0.0), (1, 1.0), (2, 1.0), (800, round(np.sqrt(34), 9))]
    assert [v for v, _ in got[800]] == [1, 2, 0, 3]  # from its smallest vector
    assert kt.search(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert kt.search(table(spark, [(1, [1.0, 1.0])]), F.col("vec_id") % 100 == 0).count() == 0
    assert kt.search(table(spark, [(100, [1.0, 1.0])]), F.col("vec_id") % 100 == 0).count() == 0


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    out = kt.op4_kmeans_tree(spark, sf).collect()
    want = {(int(q), v) for q in ids if q % 100 == 0 for v, _ in exact(ids, vectors, q)}
    assert len(out) == len(want) and len(want & {(r["query_id"], r["vec_id"]) for r in out}) >= 0.9 * len(want)


def test_wanted_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    want = {(int(q), v) for q in ids if q % 100 == 0 for v, _ in exact(ids, vectors, q)}
    got = {(r["query_id"], r["vec_id"]) for r in kt.op4_kmeans_tree(spark, sf).collect()}
    assert kt.RECALL == 0.97 and len(want & got) >= 0.97 * len(want)


def test_double_vectors_keep_their_precision(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(500, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (1000, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    out = kt.search(df, F.col("vec_id") % 100 == 0).collect()
    assert {r["query_id"] for r in out} == {0, 100, 200, 300, 400}
    for r in out:
        assert r["score"] == pytest.approx(np.sqrt(((vectors[r["vec_id"]] - vectors[r["query_id"]]) ** 2).sum()), rel=1e-14)
    best = {r["query_id"]: r["vec_id"] for r in out if r["rank"] == 1}
    assert sum(best[q] == exact(np.arange(500), vectors, q)[0][0] for q in best) >= 4

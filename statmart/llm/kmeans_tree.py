"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector of the table is then filed under
one leaf. A query walks the tree best bin first: a priority queue holds the nodes seen
so far by distance to their centroid, and leaves are visited in the order in which they
leave the queue. How many leaves are visited is calibrated: for a bounded set of queries
the exact neighbours are found against all rows, and visits are widened until the
wanted part of these neighbours lies in the visited leaves. A query also goes on until
its leaves hold enough candidates.

Vectors meet queries in pools of neighbouring leaves that hold about equally many
vectors; a leaf with more is a pool of its own, cut into slices by a hash of vec_id, so a
vector that a third of the rows repeat is spread as well. A query is sent to each pool
once, with the leaves it visits there. Each group returns its best ``k`` per query, and
only these are brought together.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart.llm.common import stored, table

SAMPLE, SAMPLE_VALUES = 20_000, 2_000_000  # the tree is fitted on so many rows or components at most
LEAF_SAMPLE = 40  # sample rows at which a node is no longer split
BRANCH = 8
POOL_ROWS = 2048, 65_536  # vectors that one group holds, at least and at most, about
CALIBRATION = 64  # queries whose exact neighbours are found
RECALL = 0.97  # wanted part of the exact neighbours


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by the expanded form; for choosing branches only."""
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :]


@dataclass
class Tree:
    """``children[node]`` lists the nodes below; a node without any is leaf ``leaf[node]``."""

    centre: np.ndarray
    children: list[list[int]]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector, going down to the nearest centroid."""
        out = np.zeros(len(vectors), dtype=np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            near = squared(vectors[rows], self.centre[below]).argmin(1)
            todo += [(child, rows[near == i]) for i, child in enumerate(below) if (near == i).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield self.leaf[node]
                continue
            gap = ((self.centre[below] - query) ** 2).sum(1)
            for child, d in zip(below, gap.tolist()):
                heapq.heappush(queue, (d, child))


def fit_tree(points: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_SAMPLE, seed: int = 7) -> Tree:
    """Hierarchical k-means over sample points (rows); the same sample gives the same tree."""
    random = np.random.default_rng(seed)
    dims = points.shape[1] if points.ndim == 2 else 0
    centres, children = [points.mean(0) if len(points) else np.zeros(dims)], [[]]
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        own = points[rows]
        if len(rows) <= leaf_rows or not (own != own[0]).any():
            continue
        start = np.unique(own, axis=0)
        middle = start[random.permutation(len(start))[:branch]]
        for _ in range(12):
            near = squared(own, middle).argmin(1)
            moved = np.array([own[near == i].mean(0) if (near == i).any() else middle[i] for i in range(len(middle))])
            if np.allclose(moved, middle):
                break
            middle = moved
        near = squared(own, middle).argmin(1)
        kept = [i for i in range(len(middle)) if (near == i).any()]
        if len(kept) < 2:
            continue
        for i in kept:
            children[node].append(len(centres))
            todo.append((len(centres), rows[near == i]))
            centres.append(middle[i])
            children.append([])
    leaf, number = [], 0
    for below in children:
        leaf.append(-1 if below else number)
        number += not below
    return Tree(np.array(centres), children, leaf)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.array(column.tolist(), dtype=np.float64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nearest(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, vector_ids: np.ndarray,
            k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and exact distances of the ``k`` nearest rows of each query, ties to smaller ids.

    A row with the query's own id is left out; of rows with one id the nearest counts.
    """
    by_id = np.argsort(vector_ids, kind="stable")
    vectors, vector_ids = vectors[by_id], vector_ids[by_id]
    repeated = (vector_ids[1:] == vector_ids[:-1]).any()
    out = []
    for q, own in zip(queries, ids):
        d = np.sqrt(((vectors - q) ** 2).sum(1))
        near, dist = vector_ids[vector_ids != own], d[vector_ids != own]
        if not repeated and len(dist) > k:
            keep = dist <= np.partition(dist, k - 1)[k - 1]  # ties at the end stay for the order below
            near, dist = near[keep], dist[keep]
        order = np.lexsort((near, dist))
        if repeated:
            order = order[np.sort(np.unique(near[order], return_index=True)[1])]
        order = order[:k]
        out.append((near[order], dist[order]))
    return out


def exact_neighbours(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """query_id, vec_id, score of the exact ``k`` nearest rows of a few queries, over all rows in blocks."""
    ids = np.array([q[0] for q in queries], dtype=np.int64)
    points = np.array([q[1] for q in queries], dtype=np.float64)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, points))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, qs = shared.value
        for batch in batches:
            if batch.num_rows:
                got = nearest(qs, own, _matrix(batch.column(1)), batch.column(0).to_numpy(), k)
                yield pa.record_batch([pa.array(np.repeat(own, [len(g[0]) for g in got])),
                                       pa.array(np.concatenate([g[0] for g in got])),
                                       pa.array(np.concatenate([g[1] for g in got]))],
                                      names=["query_id", "vec_id", "score"])
    found = vectors.select("vec_id", "vector").mapInArrow(run, "query_id long, vec_id long, score double")
    return ranked(found, k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query's partial results, with their rank."""
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _collected(df: DataFrame) -> list[tuple[int, list[float]]]:
    return [(r[0], r[1]) for r in df.collect()]


def search(table_: DataFrame, is_query: Column, k: int = 10, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row that ``is_query`` picks.

    ``table_`` has vec_id and embedding. Vectors that are null, empty, zero or hold a null
    or non-finite component take no part, nor do vectors of another length than most
    have. A repeated vec_id is one query (its smallest vector) and one candidate (the
    nearest of its vectors). With fewer than ``k`` candidates all are returned; an empty
    table gives no rows.
    """
    spark = table_.sparkSession
    valid = table_.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = valid.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    valid = valid.where(F.size("vector") == sizes[0]["dims"])
    sample = _collected(valid.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id")
                        .limit(min(SAMPLE, max(1, SAMPLE_VALUES // sizes[0]["dims"]))))
    tree = fit_tree(np.array([s[1] for s in sample], dtype=np.float64))
    shared = spark.sparkContext.broadcast(tree)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([*batch.columns, pa.array(shared.value.file(_matrix(batch.column(1))))],
                                      names=["vec_id", "vector", "leaf"])

    own = valid.schema["vector"].dataType.simpleString()  # floats or doubles, kept as they are
    filed = stored(valid.mapInArrow(file, f"vec_id long, vector {own}, leaf int"), "leaves")
    held = {r["leaf"]: r["count"] for r in filed.groupBy("leaf").count().collect()}  # at most a row per leaf
    queries = filed.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    probes = _collected(queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(CALIBRATION))
    if not probes:
        return spark.createDataFrame([], result)
    width = calibrate(tree, probes, exact_neighbours(filed, probes, k).join(
        filed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect(), recall)
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = min(max(sum(held.values()) // (4 * n), POOL_ROWS[0]), POOL_ROWS[1])
    pools, cuts = pack(held, size)
    plan = spark.sparkContext.broadcast((width, held, pools, cuts))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visits, rows, pool_of, cut = plan.value
        for batch in batches:
            for query, vector in zip(batch.column(0).to_pylist(), _matrix(batch.column(1))):
                wanted: dict[int, list[int]] = {}
                seen = near = 0
                for leaf in shared.value.visits(vector):
                    if seen >= visits and near > k:
                        break
                    seen += 1
                    if leaf in rows:
                        near += rows[leaf]
                        wanted.setdefault(pool_of[leaf], []).append(leaf)
                to = [(p, i, leaves) for p, leaves in wanted.items() for i in range(cut[p])]
                yield pa.record_batch([pa.array([query] * len(to), pa.int64()),
                                       pa.array([vector.tolist()] * len(to), pa.list_(pa.float64())),
                                       pa.array([x[0] for x in to], pa.int32()), pa.array([x[1] for x in to], pa.int32()),
                                       pa.array([x[2] for x in to], pa.list_(pa.int32()))],
                                      names=["query_id", "query", "pool", "slice", "leaves"])

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            vectors, ids, leaf = _matrix(right["vector"]), right["vec_id"].to_numpy(), right["leaf"].to_numpy()
            for q, v, leaves in zip(left["query_id"], _matrix(left["query"]), left["leaves"]):
                there = np.isin(leaf, leaves)
                near, score = nearest(v[None], [q], vectors[there], ids[there], k)[0]
                out.append(pd.DataFrame({"query_id": q, "vec_id": near, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    visited = queries.repartition(n).mapInArrow(
        walk, "query_id long, query array<double>, pool int, slice int, leaves array<int>")
    where = spark.createDataFrame([(leaf, p, cuts[p]) for leaf, p in pools.items()], "leaf int, pool int, cuts int")
    pooled = filed.join(F.broadcast(where), "leaf").select(  # at most a row per leaf
        "vec_id", "vector", "leaf", "pool", F.pmod(F.xxhash64("vec_id"), F.col("cuts")).cast("int").alias("slice"))
    found = visited.groupBy("pool", "slice").cogroup(pooled.groupBy("pool", "slice")) \
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    return ranked(found, k)


def pack(held: dict[int, int], size: int) -> tuple[dict[int, int], dict[int, int]]:
    """Pool of each leaf and slices of each pool: leaves in order until a pool holds ``size`` rows."""
    pools: dict[int, int] = {}
    rows: list[int] = []
    for leaf in sorted(held):
        if not rows or rows[-1] + held[leaf] > size:
            rows.append(0)
        pools[leaf] = len(rows) - 1
        rows[-1] += held[leaf]
    return pools, {p: -(-r // size) for p, r in enumerate(rows)}


def calibrate(tree: Tree, probes: list[tuple[int, list[float]]], neighbours: list, recall: float) -> int:
    """Visits after which the wanted part of the probes' exact neighbours has been met."""
    wanted: dict[int, list[int]] = {}
    for r in neighbours:
        wanted.setdefault(r["query_id"], []).append(r["leaf"])
    met = np.zeros(tree.leaves + 1, dtype=np.int64)
    for query, vector in probes:
        place = {leaf: i for i, leaf in enumerate(tree.visits(np.array(vector, dtype=np.float64)))}
        for leaf in wanted.get(query, []):
            met[place[leaf] + 1] += 1
    enough = np.cumsum(met) >= recall * met.sum()
    return max(1, int(enough.argmax()))


def op4_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector, against all others."""
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                  F.col("vec_id") % 100 == 0)

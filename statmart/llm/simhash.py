"""Near-duplicate classes of SimHash fingerprints by covering locality-sensitive hashing.

A fingerprint has a bit set where more than half of the text's shingle hashes have it.
Every bit place gets one of the 31 non-zero vectors of five bits; mask ``v`` keeps the
places whose vector has an odd product with ``v``. Four or fewer differing places give at
most four linear conditions on five bits, so some non-zero ``v`` meets them all, its mask
keeps none of these places, and the two fingerprints fall into one bucket of its table.
No pair within the radius is lost.

1. Equal fingerprints become one node, so copies of any number meet no table.
2. Nodes are filed into the 31 tables; only buckets of two or more go on.
3. A bucket of two is compared by the JVM, one of at most ``GATHER`` nodes in numpy; both
   return a spanning star for each linked set, never the pairs.
4. A larger bucket is never gathered. Its nodes agree under the mask, so two of them are
   linked exactly if some value lies within two flips of both in the places outside it.
   Every node is filed under all values within two flips; a value has at most as many
   nodes as there are such flips, and all of them are linked to each other.
5. Linked nodes are connected, and every document gets the smallest doc_id of its set.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import stored, table
from statmart.llm.components import connected_components
from statmart.llm.textunits import slices

BITS, WORDS, SEED = 64, 4, 42
RADIUS = 4
GATHER = 1024  # nodes of a bucket that are compared in one place
PIECE = 1 << 16  # shingles of a text hashed at once
HEAVY = 1000  # a fingerprint of more than one in so many rows is joined by a broadcast


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks of which at least one avoids any ``radius`` places, as unsigned integers."""
    count = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((i % count + 1) & v).bit_count() % 2) for v in range(1, count + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprints(texts: list[str]) -> np.ndarray:
    """The fingerprint of each text; 0 for a text without words.

    Words are runs of other bytes than blank and 0x09 to 0x0D with A-Z in lower case,
    shingles are ``WORDS`` of them joined by blanks (fewer words: all of them), repeats
    count. Every word of a text is used, whatever its length.
    """
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for at, text in enumerate(texts):
        words = text.encode().lower().split()
        if not words:
            continue
        total, shingles = np.zeros(BITS, dtype=np.int64), max(1, len(words) - WORDS + 1)
        for first in range(0, shingles, PIECE):
            part = words[first:first + PIECE + WORDS - 1]
            line = b" ".join(part)
            ends = np.cumsum([len(w) + 1 for w in part]) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            last = min(WORDS, len(part)) - 1
            h = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[last:].tolist())], dtype=">u8")
            total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out[at] = np.packbits(2 * total > shingles).view(">u8")[0]
    return out


def linked_sets(values: np.ndarray) -> np.ndarray:
    """For each value the position of the first one it is joined to by links."""
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= RADIUS
    label = np.arange(len(values))
    while True:
        least = np.where(near, label[None, :], len(values)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _star_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = [], []
        for nodes in batch.column(0):
            x = np.sort(nodes.values.to_numpy())
            label = linked_sets(x.view(np.uint64))
            on = label != np.arange(len(x))
            u.append(x[on])
            v.append(x[label[on]])
        if u:
            yield pa.record_batch([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])


def _flips(mask: int) -> list[int]:
    """All ways to change at most half the radius of the places outside ``mask``."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    return [sum(c) for n in range(RADIUS // 2 + 1) for c in combinations(free, n)]


def near_edges(nodes: DataFrame, gather: int = GATHER) -> DataFrame:
    """(u, v) edges that connect the distinct fingerprints ``nodes`` (fp long) as their links do."""
    masks = covering_masks()
    filed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                         .alias("mask", "key"))
    met = filed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("c"), F.min("fp").alias("u"), F.max("fp").alias("v"))
    met = stored(met.where("c > 1"), "buckets")
    two = met.where(f"c = 2 AND bit_count(u ^ v) <= {RADIUS}").select("u", "v")
    crowd = stored(filed.join(met.where("c > 2").select("mask", "key", "c"), ["mask", "key"]), "crowd")
    few = crowd.where(F.col("c") <= gather).groupBy("mask", "key").agg(F.collect_list("fp").alias("nodes")) \
        .select("nodes").mapInArrow(_star_edges, "u long, v long")
    big = crowd.where(F.col("c") > gather)
    edges = two.union(few)
    if not big.isEmpty():
        flips = nodes.sparkSession.createDataFrame(  # some 500 rows a mask, whatever the corpus holds
            [(i, _signed(e)) for i, m in enumerate(masks) for e in _flips(m)], "mask int, flip long")
        around = big.select("mask", "fp").join(F.broadcast(flips), "mask") \
            .select("mask", F.expr("fp ^ flip").alias("z"), "fp")
        groups = around.groupBy("mask", "z").agg(F.collect_set("fp").alias("nodes")).where(F.size("nodes") > 1)
        edges = edges.union(groups.select(F.explode("nodes").alias("u"), F.array_min("nodes").alias("v"))
                            .where("u <> v").distinct())
    return edges.distinct()


def near_duplicates(docs: DataFrame, gather: int = GATHER) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs`` (doc_id, text).

    Null and empty texts and texts without words have fingerprint zero and are linked like
    any other. Repeated rows each give a row. A null doc_id is never the smallest; a set
    with no other has a null component_id. An empty table gives no rows; other columns are
    ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in slices(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(done, len(texts)),
                                       pa.array(fingerprints(texts).view(np.int64))], names=["doc_id", "fp"])
                done += len(texts)

    kept = stored(docs.mapInArrow(hashed, "doc_id long, fp long"), "fingerprints")
    nodes = stored(kept.groupBy("fp").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("rows")), "nodes")
    parts = connected_components(near_edges(nodes.select("fp"), gather), "linked")
    member = nodes.select("fp", "own").join(parts.withColumnRenamed("node", "fp"), "fp")
    least = member.groupBy("component").agg(F.min("own").alias("least"))
    placed = nodes.join(member.select("fp", "component").join(least, "component").select("fp", "least"), "fp", "left") \
        .select("fp", "rows", F.coalesce("least", "own").alias("component_id"))
    placed = stored(placed, "placed")
    total = kept.count()
    heavy = placed.where(F.col("rows") * HEAVY > total).select("fp", "component_id")  # fewer than HEAVY rows
    light = placed.where(F.col("rows") * HEAVY <= total).select("fp", "component_id")
    rest = kept.join(F.broadcast(heavy.select("fp")), "fp", "left_anti")
    out = kept.join(F.broadcast(heavy), "fp").unionByName(rest.join(light, "fp"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op13_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents, links at four or fewer differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))

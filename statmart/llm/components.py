"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.llm.common import discard, stored


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v long): the smallest node it reaches.

    A large star links each node's larger neighbours to its smallest one, a small star
    the smaller ones; repeated, every component ends as one star around its smallest
    node. Each step is a minimum per node and a join, so a node with very many edges is
    neither collected nor paired, and each result is written to the shared folder, where
    it takes the place of the one before.
    Self links and repeated edges are allowed; no edges give no rows.
    """
    both = lambda e: e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct(), name)
    before = None
    print_ = _fingerprint(now)
    while print_ != before and print_[0]:
        before = print_
        around = both(now)
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(down.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        last, now = now, stored(small, name)
        discard(last)
        print_ = _fingerprint(now)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")) \
        .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows get their global rank in id order, the rank is permuted by a keyed Feistel
network over the smallest power of four that holds all rows, and results outside
the table are walked through the network again until they fall inside. The shuffle
is reproducible from (row number, row count, seed), and so are shard and slot:
``shard = p mod shards``, ``slot = p div shards``. Shard sizes differ by at most one
row and every shard's slots run from 0 without gaps, whatever the keys look like.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from statmart.llm.common import numbered, table, text_or_empty

ROUNDS = 6


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(rows: np.ndarray, total: int, seed: int) -> np.ndarray:
    """Bijection of ``0..total-1`` onto itself; any subset of rows may be asked for."""
    if total < 2:
        return np.zeros(len(rows), dtype=np.int64)
    half = max(1, ((total - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(seed % (1 << 63)) * np.uint64(ROUNDS))
    out = np.asarray(rows).astype(np.uint64)
    walking = np.ones(len(out), dtype=bool)
    while walking.any():
        left, right = out[walking] >> shift, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        out[walking] = (left << shift) | right
        walking &= out >= np.uint64(total)
    return out.astype(np.int64)


def locate(row: int, total: int, shards: int, seed: int = 17) -> tuple[int, int]:
    """Shard and slot of one row number, without any table."""
    p = int(permute(np.array([row]), total, seed)[0])
    return p % shards, p // shards


def feistel_shards(df: DataFrame, order: list[str], shards: int, seed: int = 17) -> DataFrame:
    """``df`` with ``row_no``, ``position`` (permuted), ``shard`` and ``slot``.

    Order columns fix the row numbers: nulls come first, rows equal in all of them
    are interchangeable (repeated rows each get a place of their own). Columns of
    ``df`` that carry one of the four output names are replaced. An empty table
    gives an empty result.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    df = df.drop("row_no", "position", "shard", "slot")
    ranked = numbered(df, order, "feistel")
    total = ranked.count()

    @pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), total, seed))

    placed = ranked.withColumn("position", place("row_no"))
    return (placed.withColumn("shard", (F.col("position") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("position") / F.lit(shards)).cast("long")))


def op9_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the ``rows`` law.

    A null text counts as no bytes (size 16, checksum of the empty text).
    """
    utf8 = F.encode(text_or_empty(), "UTF-8")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text_or_empty()) + 16).cast("long").alias("size"),
        F.crc32(utf8).alias("text_crc32"))
    placed = feistel_shards(docs, ["doc_id", "size", "text_crc32"], 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_no", "position")

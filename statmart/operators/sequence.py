"""Exact position of each row inside its group, without a per-group task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group to
one task; a group holding a third of the table then runs in one task. Here only a
narrow table of keys is ranked, and the positions are joined back to the rows:

1. a key is (g, o) and two 64-bit hashes of the whole row; equal rows are one key with
   a count (partial aggregation), so neither a hot group nor many copies fill a task;
2. the keys are range-partitioned on (g, o, hashes), in as many partitions as their
   number asks for, and sorted; each task adds up the counts of the keys before;
3. counts per ``(partition, g)`` — a table no larger than partitions + groups — and
   their running sum over the partitions of a group give the offset of every block;
4. rows get their key's position by a join on the hashes, which spreads every group.
   A key of several equal rows is one row of each column's value, repeated for all its
   positions; long runs of positions are cut into pieces that are dealt over the tasks.

Only keys are written to the shared folder: the key table and the ranked one, so that
all readers of them see the same partitions. The rows themselves are not stored, and
nothing depends on the order in which a plan gives them when it runs again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, MapType, StructType

from statmart.session import scratch_path

KEYS_PER_TASK = 1_000_000  # keys that one partition of the ranked table holds, about
PIECE = 10_000             # positions of equal rows that one task writes at a time


def _holds_map(t: DataType) -> bool:
    if isinstance(t, StructType):
        return any(_holds_map(f.dataType) for f in t.fields)
    return isinstance(t, MapType) or isinstance(t, ArrayType) and _holds_map(t.elementType)


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row; nulls are told from values and from each other's places."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts += [F.to_json(F.struct(c)) if _holds_map(f.dataType) else c, c.isNull()]
    return [F.xxhash64(*parts).alias("__h1"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("__h2")]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _count_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partition's number and, for each key, the rows of the partition's keys before it."""
    pid, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(batch.num_columns - 1).to_numpy()
        ends = np.cumsum(n) + total
        total = int(ends[-1]) if len(n) else total
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([pid] * len(n), pa.int32()), pa.array(ends - n)],
            names=[*batch.schema.names, "__pid", "__local"])


def sequence_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    name: str = "seq", keys_per_task: int = KEYS_PER_TASK) -> DataFrame:
    """Add ``name``: 0-based position of the row in its group ordered by ``order_cols``.

    Rows equal in all columns are interchangeable. Nulls are values of their own and come
    first. Among rows equal in group and order a hash of the row decides.
    """
    names = list(df.columns)
    groups = [f"__g{i}" for i in range(len(group_cols))]
    orders = [f"__o{i}" for i in range(len(order_cols))]
    hashed = df.select("*", *_row_hashes(df))
    keys = _stored(hashed.select(
        *[F.col(f"`{c}`").alias(g) for c, g in zip(group_cols, groups)],
        *[F.col(f"`{c}`").alias(o) for c, o in zip(order_cols, orders)], "__h1", "__h2")
        .groupBy("__h1", "__h2").agg(*[F.any_value(c).alias(c) for c in groups + orders], F.count(F.lit(1)).alias("__n"))
        .select(*groups, *orders, "__h1", "__h2", "__n"), "seqkeys")
    tasks = max(1, -(-keys.count() // keys_per_task))
    by = groups + orders + ["__h1", "__h2"]
    sorted_keys = keys.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    layout = StructType(keys.schema.fields).add("__pid", IntegerType()).add("__local", LongType())
    ranked = _stored(sorted_keys.mapInArrow(_count_before, layout)
                     .select(*groups, "__h1", "__h2", "__n", "__pid", "__local"), "seqranks")
    blocks = ranked.groupBy("__pid", *groups).agg(F.min("__local").alias("__start"), F.sum("__n").alias("__rows"))
    w = Window.partitionBy(*groups).orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = blocks.select(F.col("__pid").alias("__bpid"), *[F.col(g).alias(f"__b{g}") for g in groups],
                            (F.sum("__rows").over(w) - F.col("__rows") - F.col("__start")).alias("__shift"))
    on = [ranked["__pid"] == offsets["__bpid"]] + [ranked[g].eqNullSafe(offsets[f"__b{g}"]) for g in groups]
    placed = ranked.join(offsets, on).select("__h1", "__h2", "__n", (F.col("__local") + F.col("__shift")).alias("__first"))
    single = hashed.join(placed.where("__n = 1"), ["__h1", "__h2"]) \
        .select(*[F.col(f"`{c}`") for c in names], F.col("__first").alias(name))
    copies = placed.where("__n > 1")
    if ranked.where("__n > 1").isEmpty():
        return single
    one = hashed.join(copies.select("__h1", "__h2"), ["__h1", "__h2"], "left_semi").groupBy("__h1", "__h2").agg(
        F.any_value(F.struct(*[F.col(f"`{c}`") for c in names])).alias("__row"))
    pieces = one.join(copies, ["__h1", "__h2"]).select(
        "__row", "__first", "__n", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {PIECE}"))).alias("__piece"))
    at = F.explode(F.sequence(F.col("__first") + F.col("__piece") * PIECE,
                              F.col("__first") + F.least(F.col("__n"), (F.col("__piece") + 1) * PIECE) - 1))
    spread = pieces.repartition(F.col("__first"), F.col("__piece"))
    return single.unionByName(spread.select("__row", at.alias(name))
                              .select(*[F.col(f"__row.`{c}`") for c in names], name))


def batch_number(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                 size: int = 10, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows per group (W1): 0, 0, …, 1, …

    A group of exactly ``size`` rows makes one batch (no empty trailing batch).
    """
    seq = sequence_within(df, group_cols, order_cols, "__seq")
    return seq.withColumn(name, F.floor(F.col("__seq") / size).cast("bigint")).drop("__seq")

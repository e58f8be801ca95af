"""Helpers shared by the operators: scratch tables, lineage cuts, row numbering."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.session import scratch_path

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


TEXT_ROWS = 1000  # whole documents in one Arrow batch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Arrow batches are kept small from here on, as rows hold whole texts."""
    if int(spark.conf.get(BATCH)) > TEXT_ROWS:
        spark.conf.set(BATCH, TEXT_ROWS)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage with a table every executor can read, so a lost executor
    costs at most the running stage. The shuffle files behind the write are no
    longer needed afterwards and are dropped with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing will read again."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``row_no``: the 0-based rank of each row in the order of ``order`` (nulls first).

    Rows are range-partitioned and sorted, numbered inside their partition and
    shifted by the rows of all partitions before it; only one count per partition
    is brought together. Rows equal in every column of ``order`` are interchangeable.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("d"),
                    *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)])
    cols = [F.col(f"o{i}").asc_nulls_first() for i in range(len(order))]
    local = stored(own.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                   .select("d", F.monotonically_increasing_id().alias("id")), name)
    part = F.shiftright("id", 33)
    sizes = local.groupBy(part.alias("part")).count().collect()  # one row per partition
    starts, total = [], 0
    for r in sorted(sizes):
        starts.append((r["part"], total))
        total += r["count"]
    base = df.sparkSession.createDataFrame(starts, "part long, base long")
    return (local.withColumn("part", part).join(F.broadcast(base), "part")
            .select("d.*", (F.col("base") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).alias("row_no")))


def release_memory() -> None:
    """Give what this process holds and no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


HELD: dict[str, Callable[[], None]] = {}  # how to drop the tables a process keeps between tasks, by their name


def drop_held(keeps: str | None) -> None:
    for name, drop in HELD.items():
        if name != keeps:
            drop()
    release_memory()


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str | None = None):
    """``work`` for ``mapInArrow``, whose process is lean again when a task of it ends.

    Spark keeps Python processes for later tasks, of other queries too, so what an
    allocator holds back adds up over the stages of a job. Tables in ``HELD`` that other
    work left are dropped first, but for those named ``keeps``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held(keeps)  # found by name, so it is the task process's own table
        try:
            yield from work(batches)
        finally:
            release_memory()
    return run


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))

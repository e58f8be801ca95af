"""Incremental file loads (J6, K8) as Structured Streaming.

Loading "only what is new" is what a streaming file source with a checkpoint
does: the checkpoint records which files were committed to the sink, so a rerun
after new files arrive loads exactly those files, and a rerun without new
files loads nothing. ``availableNow`` processes whatever is there in bounded
micro-batches and stops, so the same code runs as a scheduled batch job.
The parquet sink is exactly-once with its own commit log, and a failed run
resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


# Spark keeps the reports of so many micro-batches; a load has one for each that had files
REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
MOST_REPORTS = 1_000_000


def load_new_files(spark: SparkSession, source: str, target: str, checkpoint: str,
                   schema: StructType, fmt: str = "json", max_files_per_trigger: int = 1000,
                   options: dict[str, str] | None = None) -> int:
    """Append every not-yet-loaded file below ``source`` to the parquet table
    ``target``; returns the number of rows appended by this run.

    The rows are counted by the micro-batches themselves as they are written, so
    the target is not read, and what others put there meanwhile does not count.
    """
    opts = {"recursiveFileLookup": "true", "maxFilesPerTrigger": str(max_files_per_trigger)}
    if fmt == "json":
        opts["timestampNTZFormat"] = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    opts.update(options or {})
    kept = spark.conf.get(REPORTS)
    stream = spark.readStream.format(fmt).schema(schema).options(**opts).load(source)
    spark.conf.set(REPORTS, str(MOST_REPORTS))  # the query takes it over when it starts
    try:
        q = (stream.writeStream.format("parquet").outputMode("append")
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start(target))
        q.awaitTermination()
    finally:
        spark.conf.set(REPORTS, kept)
    if q.exception() is not None:
        raise q.exception()
    return sum({p.batchId: p.numInputRows for p in q.recentProgress}.values())

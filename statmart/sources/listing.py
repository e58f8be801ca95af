"""File listings as DataFrames.

The listing is a ``binaryFile`` scan that selects only ``path``, ``length`` and
``modificationTime``: Spark then lists (in parallel for many folders) without
reading any file content. Hidden files (``_SUCCESS``, ``.crc``) are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions import paths


def list_files(spark: SparkSession, folder: str, suffix: str | None = None,
               base: str | None = None) -> DataFrame:
    """Every file below ``folder`` (recursive), optionally only ``suffix``.

    ``folder`` may be a glob (``root/83502NED_*``) so only matching entries are
    listed; ``relative`` is then taken from ``base`` (default: ``folder``).
    Columns: ``path, length, modificationTime, relative``.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        suffix = suffix if suffix.startswith(".") else "." + suffix
        r = r.option("pathGlobFilter", f"*{suffix}")
    df = r.load(folder).select("path", "length", "modificationTime")
    return df.withColumn("relative", paths.relative_to("path", qualified(spark, base or folder)))


def list_prefix(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Files whose path below ``root`` starts with ``prefix``.

    Object-store prefix semantics: ``cbs/kwb`` also matches ``cbs/kwb2/…``.
    """
    if prefix and not any(ch in prefix for ch in "*?[]{}\\"):
        # Only entries under the prefix are listed (a glob), not the whole root.
        listed = list_files(spark, f"{root.rstrip('/')}/{prefix}*", base=root)
    else:
        listed = list_files(spark, root)
    return listed.where(F.col("relative").startswith(prefix))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as Spark reports paths: a path without a scheme is on the default filesystem."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") or "/")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString()


def with_path_parts(df: DataFrame, col: str = "path") -> DataFrame:
    """Name, stem, suffix, parent folder and table id of every path."""
    return df.withColumns({
        "name": paths.name(col),
        "stem": paths.stem(col),
        "suffix": paths.suffix(col),
        "parent": paths.parent(col),
        "table_id": paths.table_id(col),
    })

"""Delimited text scans.

Columns are read as text by default and typed afterwards with an explicit cast
step (:func:`statmart.functions.columns.cast_columns`): a column that mixes
numbers with text then cannot fail the scan, and codes keep leading zeros.
``infer=True`` gives Spark's schema inference instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions.columns import year_in_name
from statmart.functions.names import lower_columns
from statmart.sources.files import as_list, charset, first_lines, input_files


def read_delimited(spark: SparkSession, paths: str | Sequence[str], sep: str = ",",
                   encoding: str = "utf-8", header: bool = True, infer: bool = False,
                   schema=None) -> DataFrame:
    """One distributed CSV scan over ``paths``."""
    r = (spark.read.option("sep", sep).option("encoding", charset(encoding))
              .option("header", header).option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(as_list(paths))


def read_yearly(spark: SparkSession, paths: str | Sequence[str], sep: str = ";",
                encoding: str = "utf-8", year_col: str = "jaar") -> DataFrame:
    """Many yearly files as one table.

    Files are grouped by header line; each group is one multi-path scan. Column
    names are lower-cased, groups are aligned by name (missing columns become
    null) and the year is taken from each file's path. A file without a year in
    its name fails the job.
    """
    files = input_files(spark, paths)
    heads = first_lines(spark, files, encoding)
    groups: dict[str, list[str]] = {}
    for f, h in heads.items():
        groups.setdefault(h, []).append(f)
    out = None
    for group in groups.values():
        df = lower_columns(read_delimited(spark, group, sep=sep, encoding=encoding))
        # The metadata path is a URI: decode it before reading a year from it.
        df = df.withColumn("__file", F.url_decode(F.col("_metadata.file_path")))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no files in {paths!r}")
    year = year_in_name(F.regexp_extract("__file", r"([^/]*)$", 1))
    checked = F.when(year.isNotNull(), year).otherwise(
        F.raise_error(F.concat(F.lit("no year in file name: "), F.col("__file"))))
    return out.withColumn(year_col, checked).drop("__file")

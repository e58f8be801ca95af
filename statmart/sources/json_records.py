"""JSON sources.

Saved API responses are read as JSON documents; the record arrays inside them
are unfolded with ``inline`` / ``explode``, one row per element. A response may
be one pretty-printed document per file (``multi_line=True``) or one document
per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from statmart.session import scratch_path
from statmart.sources.files import as_list
from statmart.sources.ranges import elements, sized_files


def read_envelope(spark: SparkSession, paths: str | Sequence[str], key: str = "value",
                  element_schema: StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Rows of the ``key`` array of every response document.

    ``multi_line`` is for documents that take several lines, of any size: their elements
    are read one by one with bounded memory (:mod:`statmart.sources.ranges`), so one task
    never holds a whole document. Without a schema the elements are stored once, as lines,
    to infer it from all of them.
    """
    if multi_line:
        found = elements(spark, sized_files(spark, paths), key)
        if element_schema is not None:
            return found.select(F.from_json("value", element_schema).alias("r")).select("r.*")
        path = scratch_path(spark, "elements")
        found.write.text(path)
        return spark.read.json(path)
    r = spark.read
    if element_schema is not None:
        r = r.schema(StructType([StructField(key, ArrayType(element_schema))]))
    return r.json(as_list(paths)).select(F.inline(key))


def portal_datasets(responses: DataFrame, strict: bool = False, skip_failed: bool = False) -> DataFrame:
    """Datasets of portal search responses (S9), only ``type = 'dataset'`` when ``strict``.

    A response that reports no success fails the job, unless ``skip_failed`` leaves it out.
    """
    good = F.coalesce(F.col("success"), F.lit(False))
    if skip_failed:
        responses, results = responses.where(good), F.col("result.results")
    else:
        results = F.when(good, F.col("result.results")).otherwise(
            F.raise_error(F.concat(F.lit("portal response without success: "),
                                   F.to_json(F.struct(*responses.columns)))))
    ds = responses.select(F.explode(results).alias("d")).select("d.*")
    return ds.where(F.col("type") == "dataset") if strict else ds


def resource_urls(datasets: DataFrame, contains: str | None = ".zip",
                  keep: Sequence[str] = ("name",)) -> DataFrame:
    """One row per resource URL of each dataset, optionally only URLs that
    contain ``contains``."""
    res = datasets.select(*keep, F.explode("resources").alias("r")).select(*keep, "r.url")
    return res.where(F.col("url").contains(contains)) if contains else res

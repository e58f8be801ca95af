"""Report on failed load runs.

Runs and their log records are two tables: ``runs(run_id, name, state,
start_time, end_time)`` and ``logs(run_id, level, timestamp, message)``. Error
logs are aggregated per run first (partial aggregation: count, first and last
by ``(timestamp, message)``) and only then joined to the runs, so a run with a
huge log is never gathered in one place, and runs without error logs still
show (left join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def failed_runs(runs: DataFrame, logs: DataFrame, name_pattern: str = "cbs_v3%",
                state: str = "Failed", level: str = "ERROR") -> DataFrame:
    """Failed runs whose name matches ``name_pattern`` case-insensitively, with
    error count and first/last error, newest start first."""
    picked = runs.where((F.col("state") == state) & F.col("name").ilike(name_pattern))
    errors = logs.where(F.col("level") == level)
    order = F.struct("timestamp", "message")
    errors = errors.join(picked.select("run_id"), "run_id", "left_semi")  # logs of other runs are not aggregated
    per_run = errors.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.min_by(order, order).alias("first"),
        F.max_by(order, order).alias("last"))
    out = picked.join(per_run, "run_id", "left")
    return (out.select("run_id", "name", "start_time", "end_time",
                       F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
                       F.col("first.timestamp").alias("first_error_time"),
                       F.col("first.message").alias("first_error"),
                       F.col("last.timestamp").alias("last_error_time"),
                       F.col("last.message").alias("last_error"))
               .orderBy(F.col("start_time").desc()))


def count_failed(runs: DataFrame, name_pattern: str = "cbs_v3%",
                 state: str = "Failed") -> DataFrame:
    """Number of failed runs (A4): one row, ``n_failed``."""
    return runs.where((F.col("state") == state) & F.col("name").ilike(name_pattern)) \
               .agg(F.count(F.lit(1)).alias("n_failed"))


def first_last_by(df: DataFrame, group_cols: list[str], order_cols: list[str],
                  value_cols: list[str], count_name: str = "n_errors") -> DataFrame:
    """Per group: row count (``count_name``) and the values of the first and
    last row by ``order_cols`` (A3), as ``first_<col>`` / ``last_<col>``.
    Partial aggregation (``min_by``/``max_by`` on a struct key), so a large
    group is reduced in every task before the shuffle."""
    order = F.struct(*order_cols)
    vals = F.struct(*value_cols)
    agg = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(count_name),
                                      F.min_by(vals, order).alias("__first"),
                                      F.max_by(vals, order).alias("__last"))
    return agg.select(*group_cols, count_name,
                      *[F.col(f"__first.{c}").alias(f"first_{c}") for c in value_cols],
                      *[F.col(f"__last.{c}").alias(f"last_{c}") for c in value_cols])

"""Parameterised mart SQL.

A mart written as SQL text names its tables through ``IDENTIFIER(:name)`` and
its constants through ``:name`` markers; both are bound by Spark's parameterised
``spark.sql(text, args=...)``, so values are never pasted into the text. Tables
given as DataFrames are exposed as session temp views under fresh names while the
text is analysed. The text of a mart is rendered from its spec.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from statmart.plans.marts import POPULATION_PC4, Dim, MartSpec, fill


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame | str],
            args: Mapping[str, object] | None = None) -> DataFrame:
    """Run ``text`` with ``tables`` bound to ``IDENTIFIER(:<name>)`` markers.

    A table value may be a DataFrame (registered as a temp view) or an existing
    table name such as ``project.dataset.table``.
    """
    bound: dict[str, object] = dict(args or {})
    tag = uuid.uuid4().hex[:8]
    views = []
    try:
        for name, t in tables.items():
            if isinstance(t, DataFrame):
                views.append(f"sm_{tag}_{name}")
                t.createOrReplaceTempView(views[-1])
                bound[name] = views[-1]
            else:
                bound[name] = t
        return spark.sql(text, args=bound)  # names are resolved here, the views are not needed later
    finally:
        for view in views:
            spark.catalog.dropTempView(view)


def mart_sql(spec: MartSpec) -> str:
    """The SQL text of a mart, tables as ``IDENTIFIER(:<alias>)`` markers."""
    def key(d: Dim) -> str:
        return d.fact_key if "." in d.fact_key else f"{spec.fact_alias}.{d.fact_key}"

    lines = ["SELECT " + ", ".join(f"{fill(e, spec.params)} AS {n}" for n, e in spec.select),
             f"FROM IDENTIFIER(:{spec.fact_alias}) AS {spec.fact_alias}"]
    lines += [f"{d.how.upper()} JOIN IDENTIFIER(:{d.alias}) AS {d.alias} ON {d.alias}.{d.dim_key} = {key(d)}"
              for d in spec.dims]
    if spec.where:
        lines.append("WHERE " + " AND ".join(f"({fill(w, spec.params)})" for w in spec.where))
    if spec.order_by:
        lines.append("ORDER BY " + ", ".join(spec.order_by))
    return "\n".join(lines)


def run_mart_sql(spark: SparkSession, spec: MartSpec, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """Run a mart as SQL; ``tables`` are by the spec's table names."""
    named = {spec.fact_alias: tables[spec.fact], **{d.alias: tables[d.table] for d in spec.dims}}
    return run_sql(spark, mart_sql(spec), named)


def population_pc4(spark: SparkSession, project: str, schema: str = "cbs",
                   dataset: str = "83502NED") -> DataFrame:
    """The population mart as SQL over catalog tables ``{project}.{schema}.{dataset}_…``."""
    prefix = [p for p in (project, schema) if p]
    spec = POPULATION_PC4
    tables = {t: ".".join(f"`{p}`" for p in [*prefix, f"{dataset}_{t.split('_', 1)[1]}"])
              for t in [spec.fact, *(d.table for d in spec.dims)]}
    return run_mart_sql(spark, spec, tables)

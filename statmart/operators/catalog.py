"""Dataset catalog work.

A catalog is a table of dataset ids and the catalog (source) each belongs to,
built from the saved ``value`` arrays of the catalog responses. The operators
here pick ids per source, decide which ids need a reload, and cut id lists into
batches. All of them are grouped aggregations and joins: partial aggregation
before every shuffle, and no source's id list is ever collected in one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.operators.nesting import nest
from statmart.operators.sequence import batch_number, sequence_within

MAX_IDS_PER_ROW = 1000


def source_filter(catalog_col: Column | str, source: str | None) -> Column:
    """Case-insensitive equality on the catalog name (P7); no filter for None."""
    c = F.col(catalog_col) if isinstance(catalog_col, str) else catalog_col
    return F.lit(True) if source is None else (F.lower(c) == source.lower())


def latest_catalog(catalog: DataFrame, id_col: str = "Identifier",
                   catalog_col: str = "Catalog") -> DataFrame:
    """One catalog per id (A1). A repeated id keeps one catalog; SQL rows have
    no order, so the greatest catalog name wins, which makes it deterministic."""
    return catalog.groupBy(id_col).agg(F.max(catalog_col).alias(catalog_col))


def ids_by_source(catalog: DataFrame, id_col: str = "Identifier", catalog_col: str = "Catalog",
                  source: str | None = None, max_ids: int = MAX_IDS_PER_ROW) -> DataFrame:
    """Ids per lower-cased catalog.

    Returns ``(source, part, n_ids, ids)``: the ids of a source sorted and cut
    into consecutive parts of at most ``max_ids``, so a source with a very
    large share of the ids is spread over many rows and tasks. Catalog names
    differing only by case are merged.
    """
    latest = latest_catalog(catalog.where(source_filter(catalog_col, source)), id_col, catalog_col)
    keyed = latest.select(F.lower(catalog_col).alias("source"), F.col(id_col))
    parts = nest(keyed, ["source"], [id_col], name="__items", max_items=max_ids)
    return parts.select("source", "part", F.col("n_items").alias("n_ids"),
                        F.transform("__items", lambda x: x[id_col]).alias("ids"))


def distinct_sources(catalog: DataFrame, catalog_col: str = "Catalog",
                     lower: bool = False) -> DataFrame:
    """Distinct catalogs (A2)."""
    c = F.lower(catalog_col) if lower else F.col(catalog_col)
    return catalog.select(c.alias("source")).distinct()


def expect_one(df: DataFrame, what: str = "result") -> DataFrame:
    """Fail unless ``df`` has exactly one row; return that row.

    A keyless aggregate: partial counts per partition, one tiny final merge.
    The check is part of the plan (``raise_error``), not a driver-side count.
    """
    cols = df.columns
    # With exactly one row any_value is that row; it also takes maps and
    # other types max() cannot order.
    agg = df.agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*cols)).alias("__row"))
    checked = agg.select(
        F.when(F.col("__n") == 1, F.col("__row"))
         .otherwise(F.raise_error(F.concat(F.lit(f"expected exactly one {what}, got "),
                                           F.col("__n").cast("string")))).alias("__row"))
    return checked.select("__row.*")


def needs_refresh(source_meta: DataFrame, loaded_meta: DataFrame, id_col: str = "id",
                  modified_col: str = "modified", force: bool = False) -> DataFrame:
    """Ids to (re)load (J6): not loaded yet, or loaded with another Modified
    value (null-safe compare). ``force`` selects every id.

    Returns ``source_meta``'s rows plus ``reason`` in (new, changed, forced).
    """
    if force:
        return source_meta.withColumn("reason", F.lit("forced"))
    s, l_ = source_meta.alias("s"), loaded_meta.alias("l")
    same = (F.col(f"s.{id_col}") == F.col(f"l.{id_col}")) & \
        F.col(f"s.{modified_col}").eqNullSafe(F.col(f"l.{modified_col}"))
    stale = s.join(l_, same, "left_anti")
    loaded_ids = loaded_meta.select(F.col(id_col).alias("__lid")).distinct()
    out = stale.join(loaded_ids, stale[id_col] == loaded_ids["__lid"], "left")
    return out.withColumn("reason", F.when(F.col("__lid").isNull(), F.lit("new"))
                                    .otherwise(F.lit("changed"))).drop("__lid")


def batches(ids: DataFrame, source_col: str, id_col: str, size: int = 10) -> DataFrame:
    """Consecutive batches of ``size`` ids per source, ordered by id."""
    return batch_number(ids, [source_col], [id_col], size=size, name="batch")


__all__ = ["source_filter", "latest_catalog", "ids_by_source", "distinct_sources", "expect_one",
           "needs_refresh", "batches", "sequence_within"]

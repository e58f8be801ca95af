"""Nested datamart rows (A5, X2): fold child rows into an array of structs per
parent, and unfold them again.

A parent's children are cut into consecutive parts of at most ``max_items``
(exact positions from :func:`statmart.operators.sequence.sequence_within` for
the few parents above the bound), so a parent with a very large share of the
rows becomes many bounded rows spread over many tasks instead of one giant
array in one task. Unfolding ignores the parts: the rows come back whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.operators.sequence import batch_number
from statmart.operators.star import row_bytes

MAX_ITEMS = 1000
# Keys of oversized parents are broadcast for the split up to this size.
BIG_PARENTS_BYTES = 64 * 1024 * 1024


def nest(df: DataFrame, parent_cols: Sequence[str], child_cols: Sequence[str],
         order_cols: Sequence[str] | None = None, name: str = "items",
         max_items: int = MAX_ITEMS) -> DataFrame:
    """``(parent..., part, n_items, items)`` with ``items`` sorted by ``order_cols``
    (default: the child columns in order). ``n_items`` counts the part's items.

    Parents with at most ``max_items`` children (nearly all) are folded with one
    shuffle, as part 0. Only parents above the bound get exact consecutive
    parts from the distributed sequence; there are at most rows / max_items of
    them, and that set is broadcast only after a size check.
    """
    order = list(order_cols or child_cols)
    struct_cols = order + [c for c in child_cols if c not in order]
    parents = list(parent_cols)
    df = df.select(*dict.fromkeys(parents + struct_cols))  # no other column is carried or ranked
    counts = df.groupBy(*parents).agg(F.count(F.lit(1)).alias("__n"))
    big = counts.where(F.col("__n") > max_items).select(*parents)
    n_big = big.count()
    if n_big == 0:
        rows = df.withColumn("part", F.lit(0).cast("bigint"))
    else:
        big = big.select(*[F.col(c).alias(f"__b_{c}") for c in parents])
        key_bytes = big.agg(F.sum(row_bytes(big)).alias("b")).first()["b"]
        big_b = F.broadcast(big) if key_bytes <= BIG_PARENTS_BYTES else big
        # Null-safe: a large group with a null parent key is split as well.
        on = [df[c].eqNullSafe(big_b[f"__b_{c}"]) for c in parents]
        small_rows = df.join(big_b, on, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
        # all child columns decide, so which of two equal rows is in which part does not matter
        big_rows = batch_number(df.join(big_b, on, "left_semi"), parents, struct_cols,
                                size=max_items, name="part")
        rows = small_rows.unionByName(big_rows)
    return rows.groupBy(*parents, "part").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sort_array(F.collect_list(F.struct(*struct_cols))).alias(name))


def unnest(nested: DataFrame, name: str = "items", keep: Sequence[str] | None = None) -> DataFrame:
    """Unfold ``name`` back into one row per item (``inline``)."""
    keep = list(keep) if keep is not None else [c for c in nested.columns
                                                 if c not in (name, "part", "n_items")]
    return nested.select(*keep, F.inline(name))


def map_items(nested: DataFrame, fn: Callable[[Column], Column], name: str = "items",
              out: str = "mapped") -> DataFrame:
    """Apply ``fn`` to every element of the array (X2, ``transform``)."""
    return nested.withColumn(out, F.transform(F.col(name), fn))
